"""Byte-level BPE encoding and decoding by DuckDB recursive queries.

Each partition cuts its texts by the pre-splitting pattern and hands the distinct pieces it hasn't met to an
in-process DuckDB.  There a piece is a run of (piece, position, token) rows; a recursive query joins every
token and its right neighbour with the merge table, contracts the leftmost pair of least rank in each piece,
and repeats until no piece holds a mergeable pair.  Decoding joins ids with the vocabulary and puts their
bytes together by an ordered aggregation.  Results are remembered by piece, within a bound.

Very long pieces are cut first where no token of the vocabulary that occurs in them reaches across: no merge can ever join
the two sides there.  Parts that stay long (runs of a letter, repeated passages) go through a recursion that contracts all
pairs of the least rank in one step, leftmost first, up to the first whose token could merge with a neighbour at a lower
rank; its steps go with the ranks that occur, not with the bytes.

Defined results: a null text is an empty text; no ids, and the digests of nothing; repeated rows and repeated or null doc_ids give a
row each; ties of rank go to the leftmost pair; columns other than doc_id and text are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocab import _BYTE_CUT, _UNSAFE

#: Distinct pieces kept by a worker, and pieces given to one recursive query.
MAX_WORDS = 1_500_000
QUERY_WORDS = 40_000
#: Texts whose new pieces are gathered for one round of queries.
ROWS = 4000
#: Pieces beyond so many bytes are long: they are cut, and not remembered.
LONG_BYTES = 64
#: Bytes of long parts given to one recursive query.
QUERY_BYTES = 1 << 20

class RankFile:
    """Merge and vocabulary tables of a rank file (base64 token, rank) inside DuckDB."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "rank": pa.array(rank, pa.int32())})
        self.tokens = [t for t in ranks if len(t) > 1]
        self.spans = None
        vocab = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())})
        self.db.register("m", merges)
        self.db.register("v", vocab)
        self.db.execute("create table merges as select * from m")
        self.db.execute("create table vocab as select * from v")
        self.db.unregister("m")
        self.db.unregister("v")
        self.byte_id = [ranks[bytes([b])] for b in range(256)]

    def cut(self, word: bytes) -> list[bytes]:
        """Parts of a long piece between which no token reaches across."""
        import ahocorasick

        if self.spans is None:
            self.spans = ahocorasick.Automaton()
            for t in self.tokens:
                self.spans.add_word(t.decode("latin-1"), len(t))
            self.spans.make_automaton()
        across = np.zeros(len(word) + 1, np.int32)
        found = np.array([(end - n + 2, end + 1) for end, n in self.spans.iter(word.decode("latin-1"))], np.int64).reshape(-1, 2)
        np.add.at(across, found[:, 0], 1)
        np.add.at(across, found[:, 1], -1)
        edges = [0, *(np.flatnonzero(np.cumsum(across)[1 : len(word)] == 0) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def encode_long(self, words: list[bytes]) -> list[list[int]]:
        """Ids of long pieces, by their parts."""
        parts = [self.cut(w) for w in words]
        ids: dict[bytes, list[int]] = {}
        distinct = sorted({p for x in parts for p in x}, key=len)
        short = [p for p in distinct if len(p) <= LONG_BYTES]
        for i in range(0, len(short), QUERY_WORDS):
            ids |= zip(short[i : i + QUERY_WORDS], self.encode(short[i : i + QUERY_WORDS]), strict=True)
        group: list[bytes] = []
        for p in [*distinct[len(short) :], b""]:
            if group and (not p or sum(map(len, group)) + len(p) > QUERY_BYTES):
                ids |= zip(group, self.encode(group, _RECURSIVE_LONG), strict=True)
                group = []
            group.append(p)
        return [[t for p in x for t in ids[p]] for x in parts]

    def encode(self, words: list[bytes], query: str | None = None) -> list[list[int]]:
        """Ids of each piece."""
        w = [i for i, x in enumerate(words) for _ in x]
        pos = [k for x in words for k in range(len(x))]
        tok = [self.byte_id[b] for x in words for b in x]
        start = pa.table({"w": pa.array(w, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())})
        self.db.register("start", start)
        rows = self.db.sql(query or _RECURSIVE).to_arrow_table()
        self.db.unregister("start")
        out: list[list[int]] = [[] for _ in words]
        for i, ids in zip(rows.column("w").to_pylist(), rows.column("ids").to_pylist(), strict=True):
            out[i] = ids
        return out

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """Bytes of each list of ids."""
        flat = pa.table({
            "w": pa.array([i for i, x in enumerate(ids) for _ in x], pa.int32()),
            "pos": pa.array([k for x in ids for k in range(len(x))], pa.int32()),
            "id": pa.array([t for x in ids for t in x], pa.int32()),
        })
        self.db.register("flat", flat)
        rows = self.db.sql("select w, string_agg(hex(bytes), '' order by pos) as h from flat join vocab using (id) group by w").to_arrow_table()
        self.db.unregister("flat")
        out = [b""] * len(ids)
        for i, h in zip(rows.column("w").to_pylist(), rows.column("h").to_pylist(), strict=True):
            out[i] = bytes.fromhex(h)
        return out


#: A piece between two steps is its list of tokens; a step unrolls it to (piece, position, token, right neighbour) rows.  A piece
#: that no pair of could be merged leaves the recursion.
_RECURSIVE = """
with recursive step(w, toks, live) as (
    select w, list(tok order by pos), true from start group by w
    union all
    select s.w, case when best.w is null then s.toks else list_concat(s.toks[:best.p - 1], [best.tok], s.toks[best.p + 2:]) end, best.w is not null
    from (select * from step where live) s
    left join (
        select pair.w, min(m.rank) as tok, arg_min(pair.p, m.rank::bigint << 32 | pair.p) as p
        from (
            select w, unnest(range(1, len(toks))) as p, unnest(toks[:-2]) as l, unnest(toks[2:]) as r from step where live
        ) pair
        join merges m on m.l = pair.l and m.r = pair.r
        group by pair.w
    ) best on best.w = s.w
)
select w, toks as ids from step where not live
"""

#: The same for long pieces: of the pairs of least rank, every one that doesn't overlap the chosen one before it, up to the first
#: after which a pair of a lower rank would be next.
_RECURSIVE_LONG = """
with recursive step(w, toks, live) as (
    select w, list(tok order by pos), true from start group by w
    union all
    select s.w, coalesce(made.toks, s.toks), made.toks is not null
    from (select * from step where live) s
    left join (
        with pair as (
            select x.*, m.rank, min(m.rank) over (partition by x.w) as least
            from (
                select w, unnest(range(1, len(toks))) as p, unnest(toks[:-2]) as l, unnest(toks[2:]) as r,
                    unnest(list_concat([-1], toks[:-3])) as before, unnest(list_concat(toks[3:], [-1])) as after
                from step where live
            ) x
            join merges m on m.l = x.l and m.r = x.r
        ), in_line as (
            select *, row_number() over (partition by w order by p) as k from pair where rank = least
        ), apart as (
            select *, lag(p) over (partition by w order by p) as last from (select *, row_number() over (partition by w, p - k order by p) as turn from in_line) where turn % 2 = 1
        ), chosen as (
            select w, p, rank from (
                select o.w, o.p, o.rank, min(case when a.rank is not null or z.rank is not null then o.p end) over (partition by o.w) as stop
                from apart o
                left join merges a on a.l = case when o.last = o.p - 2 then o.rank else o.before end and a.r = o.rank and a.rank < o.rank
                left join merges z on z.l = o.rank and z.r = o.after and z.rank < o.rank
            ) where stop is null or p <= stop
        )
        select t.w, list(coalesce(here.rank, t.tok) order by t.p) as toks
        from (select w, unnest(range(1, len(toks) + 1)) as p, unnest(toks) as tok from step where live) t
        left join chosen here on here.w = t.w and here.p = t.p
        left join chosen gone on gone.w = t.w and gone.p = t.p - 1
        where gone.p is null
        group by t.w having count(here.p) > 0
    ) made on made.w = s.w
)
select w, toks as ids from step where not live
"""

_FILES: dict[str, RankFile] = {}
_KNOWN: dict[str, Known] = {}


def rank_file(path: str) -> RankFile:
    if path not in _FILES:
        _FILES[path] = RankFile(path)
    return _FILES[path]


def _cutter(pattern: str):
    import regex

    whole = regex.compile(pattern)
    import public_tokenizers

    quick = _BYTE_CUT if pattern == public_tokenizers.PATTERN else None
    return lambda text: quick.findall(text) if quick and not _UNSAFE.search(text) else whole.findall(text)


class Known:
    """Pieces a worker has met: ids as text.  Their ids have been decoded to the piece's own bytes."""

    def __init__(self):
        self.ids: dict[str, str] = {}

    def learn(self, file: RankFile, words: set[str]) -> dict[str, str]:
        """Encode and decode new pieces; returns those that the bound leaves out, for the texts at hand."""
        todo = sorted(words, key=len)
        cut = next((i for i, w in enumerate(todo) if len(w) > LONG_BYTES), len(todo))
        groups = [todo[i : min(i + QUERY_WORDS, cut)] for i in range(0, cut, QUERY_WORDS)] + ([todo[cut:]] if todo[cut:] else [])
        over: dict[str, str] = {}
        for group in groups:
            raw = [w.encode() for w in group]
            long = len(group[-1]) > LONG_BYTES
            ids = file.encode_long(raw) if long else file.encode(raw)
            for w, r, x, back in zip(group, raw, ids, file.decode(ids), strict=True):
                kept = not long and len(self.ids) < MAX_WORDS
                (self.ids if kept else over)[w] = ",".join(map(str, x))
                if back != r:
                    raise ValueError(f"ids of a piece of {len(r)} bytes don't decode to it")
        return over


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, with_output: bool = False) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_output else "")

    def work(batches):
        file = rank_file(ranks_path)
        known = _KNOWN.setdefault(ranks_path, Known())
        cut = _cutter(pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                new: set[str] = set()
                for t in texts:
                    new.update(w for w in cut(t) if w not in known.ids)
                over = known.learn(file, new) if new else {}
                ns, shas, raws, ids_out, dec_out = [], [], [], [], []
                for t in texts:
                    words = cut(t)
                    try:
                        ids = ",".join(map(known.ids.__getitem__, words))
                    except KeyError:
                        ids = ",".join([known.ids.get(w) or over[w] for w in words])
                    raw = "".join(words).encode()  # every piece has been decoded to itself
                    ns.append(ids.count(",") + 1 if ids else 0)
                    shas.append(hashlib.sha256(ids.encode()).hexdigest())
                    raws.append(hashlib.sha256(raw).hexdigest())
                    if with_output:
                        ids_out.append([int(x) for x in ids.split(",")] if ids else [])
                        dec_out.append(raw)
                cols = [part.column(0), pa.array(ns, pa.int64()), pa.array(shas, pa.string()), pa.array(raws, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_output:
                    cols += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(dec_out, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)
