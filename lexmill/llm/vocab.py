"""Fast exact encoding with the public tokenizer files.

A text is cut into the pieces that the tokenizer's own pre-splitting rule gives; each distinct piece is
encoded once by the ``tokenizers`` library and remembered as little-endian unsigned 32-bit ids, so a text's
ids are one ``bytes.join``.  The cut is done here only for texts made of characters on which Python's ``re`` and
the library's expression engine are known to agree; any other text goes to the library whole.
"""

from __future__ import annotations

import re

import numpy as np

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
#: Any character outside this set sends the whole text through the library.
_UNSAFE = re.compile(rf"[^\t\n\x0b\f\r\x20-\x7e{_LETTERS}¡-©«¬®-±´¶-¸»¿×÷]")
_BYTE_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_WORD_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
#: Distinct pieces remembered by a worker; later ones are encoded each time, so memory stays bounded.
MAX_WORDS = 600_000


class _Known(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        ids = np.array(self.encode(word), dtype="<u4").tobytes()
        if len(self) < MAX_WORDS and len(word) < 64:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts for one tokenizer file; ``kind`` is ``byte`` or ``word``."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = kind
        self.cut = _BYTE_CUT if kind == "byte" else _WORD_CUT
        self.known = _Known(self._library_ids)
        # the library looks for added tokens before it cuts; a text that may hold one is its own from end to end
        added = sorted({t.content for t in self.library.get_added_tokens_decoder().values()})
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None

    def _library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; null counts as empty."""
        if not text:
            return b""
        if _UNSAFE.search(text) or (self.added and self.added.search(text)):
            return np.array(self._library_ids(text), dtype="<u4").tobytes()
        if self.kind == "word":
            text = text.lower()
        return b"".join(map(self.known.__getitem__, self.cut.findall(text)))


_LOADED: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """One encoder per worker process."""
    if (path, kind) not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path, kind] = Encoder(path, kind)
    return _LOADED[path, kind]
