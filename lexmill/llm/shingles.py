"""Word shingles of texts or lines as 64-bit hashes, computed over whole Arrow buffers.

Words are runs of bytes other than space and 0x09-0x0D with A-Z lower-cased.  A unit (a whole text, or one line of it)
has the set of its distinct shingles of ``width`` words; with fewer words the whole sequence is the one
shingle; without words the set is empty.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Unit numbers below this fit into a sort key together with the head of a token.
UNITS = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first 0 to 8 bytes of a little-endian 64-bit word.
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_SIZE = np.arange(33, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F)
_PLACE = mix(np.arange(1, 33, dtype=np.uint64) * _U(0xA24BAED4963EE407)) | _U(1)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, size: int = CHUNK):
    """Row ranges of about ``size`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, at + 200_000)
        yield at, end
        at = end


def units(data: np.ndarray, offsets: np.ndarray, lines: bool, width: int = 5):
    """Units of some rows: (row of each unit, number in its row, unit of each shingle, shingles).

    Shingles are neither sorted nor distinct; units without words have none.
    """
    base = int(offsets[0])
    b = data[base : int(offsets[-1])]
    row_at = (offsets[:-1] - base).astype(np.int64)
    if lines:
        breaks = np.flatnonzero(b == 10)
        of_row = np.searchsorted(row_at, breaks, "right") - 1  # rows of the breaks (empty rows come before)
        rows = np.concatenate([np.arange(len(row_at)), of_row])
        begins = np.concatenate([row_at, breaks + 1])
        order = np.lexsort((begins, rows))
        rows, begins = rows[order], begins[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1]) if len(rows) else np.zeros(0, int)
        number = np.arange(len(rows)) - np.repeat(first, np.diff(np.concatenate([first, [len(rows)]])))
    else:
        rows, begins, number = np.arange(len(row_at)), row_at, np.zeros(len(row_at), np.int64)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(b):
        return rows, number, *none
    word = ~_SPACE[b]
    fresh = np.empty(len(b), bool)
    fresh[0] = True
    np.logical_not(word[:-1], out=fresh[1:])
    fresh[row_at[row_at < len(b)]] = True
    starts = np.flatnonzero(word & fresh)
    if not len(starts):
        return rows, number, *none
    last = np.empty(len(b), bool)
    last[-1] = True
    np.logical_or(~word[1:], fresh[1:], out=last[:-1])
    sizes = np.flatnonzero(word & last) + 1 - starts
    padded = np.zeros(len(b) + 8, np.uint8)
    padded[:-8] = _LOWER[b]
    eight = np.ndarray((len(b) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from any place
    w = mix((eight[starts] & _MASK[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    more, at = np.flatnonzero(sizes > 8), 8
    while len(more):
        part = eight[starts[more] + at] & _MASK[np.minimum(sizes[more] - at, 8)]
        w[more] = mix(w[more] * _U(0xA0761D6478BD642F) + part)
        at += 8
        more = more[sizes[more] > at]
    first = np.searchsorted(starts, begins)  # of each unit's words
    per = np.diff(first, append=len(starts))
    unit = np.repeat(np.arange(len(rows)), per)
    m = max(0, len(w) - width + 1)  # places with `width` words ahead, in this unit or the next
    s = np.zeros(m, np.uint64)
    for k in range(width):
        s += w[k : k + m] * _PLACE[k]
    whole = unit[:m] == unit[width - 1 : width - 1 + m]
    s, of = s[whole] + _SIZE[width], unit[:m][whole]
    short = np.flatnonzero((per > 0) & (per < width))  # units with fewer words: all of them are the one shingle
    if len(short):
        t = _SIZE[per[short]]
        for k in range(width - 1):
            t += np.where(per[short] > k, w[np.minimum(first[short] + k, len(w) - 1)] * _PLACE[k], _U(0))
        s, of = np.concatenate([s, t]), np.concatenate([of, short])
    return rows, number, of, mix(s)


def distinct(unit: np.ndarray, tokens: np.ndarray, rank: np.ndarray | None = None):
    """Distinct tokens of each unit, by (unit, rank of the token's class, token).

    rank: a 12-bit class for each token, so that rarer classes come first.
    """
    whole = len(unit) > 0 and int(unit.max()) >= UNITS  # the lines of a very long text
    if not whole:
        if rank is not None:
            key = (unit.astype(np.uint64) << _U(44)) | (rank.astype(np.uint64) << _U(32)) | (tokens >> _U(32))
        else:
            key = (unit.astype(np.uint64) << _U(44)) | (tokens >> _U(20))
        order = np.argsort(key)
        key, t = key[order], tokens[order]
        tie = key[1:] == key[:-1]
        whole = (tie & (t[1:] != t[:-1])).any()  # different tokens that look alike
    if whole:  # the full order
        order = np.lexsort((tokens, rank if rank is not None else unit, unit))
        t = tokens[order]
    u = unit[order]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (u[1:] != u[:-1])
    return u[fresh], t[fresh], order[fresh]


def signatures(unit: np.ndarray, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, order-free 63-bit hash) of each unit's set; needs distinct tokens by unit."""
    sizes = np.bincount(unit, minlength=n)
    total = np.zeros(n, np.uint64)
    if len(unit):
        first = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1])
        total[unit[first]] = np.add.reduceat(mix(tokens + _U(0x51ED270B)), first)
    return sizes, (mix(total + sizes.astype(np.uint64)) >> _U(1)).astype(np.int64)
