"""Byte-level BPE ids of whole texts, with a bounded cache of space-separated units.

The vocabulary file is a ``tokenizers`` JSON. Its ranks drive ``tiktoken``'s merge loop, which gives
the same ids several times faster; the tests hold both against each other. Texts are cut at single
spaces and line feeds between two other characters, where the pre-tokenizer always cuts as well;
a text with any other white-space run is encoded whole. As in ``tokenizers``, an added token of the file
(``<|endoftext|>``) is matched in plain text before anything else, and the parts around it are encoded alone.
"""

from __future__ import annotations

import json
import re

import numpy as np

CACHE_UNITS = 120_000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in byte-level BPE files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


def _engine(path: str, pattern: str):
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = _byte_alphabet()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(alphabet[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), _added(spec)


def _added(spec: dict):
    """(pattern or None, content -> little-endian uint32 id) of the added tokens; the longest of those at a place counts."""
    tokens = [t for t in spec.get("added_tokens", []) if t["content"]]
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take in their surroundings are not supported")
    ids = {t["content"]: np.asarray([t["id"]], "<u4").tobytes() for t in tokens}
    return re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True)))) if ids else None, ids


_ENGINES: dict = {}


class _Units(dict):
    """unit -> little-endian uint32 ids of prefix + unit; None where the unit does not stand alone."""

    def __init__(self, encode, prefix: str):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, unit: str):
        if not unit or unit[0].isspace() or unit[-1].isspace():
            out = None
        else:
            out = np.asarray(self.encode(self.prefix + unit), "<u4").tobytes()
        if len(self) < CACHE_UNITS:
            self[unit] = out
        return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        if (path, pattern) not in _ENGINES:  # once per worker process; the caches live as long as the encoder
            _ENGINES[path, pattern] = _engine(path, pattern)
        engine, (self.added, self.added_ids) = _ENGINES[path, pattern]
        self.encode = engine.encode_ordinary
        self.first, self.rest = _Units(self.encode, ""), _Units(self.encode, " ")
        self.feed = np.asarray(self.encode("\n"), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts, at = [], 0
        for m in self.added.finditer(text):
            parts += [self._plain(text[at:m.start()]), self.added_ids[m.group()]]
            at = m.end()
        return b"".join(parts) + self._plain(text[at:])

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if not text:
            return b""
        first, rest, feed = self.first, self.rest.__getitem__, self.feed
        parts = []
        try:
            for line in text.split("\n"):
                units = line.split(" ")
                parts.append(first[units[0]])
                parts.extend(map(rest, units[1:]))
                parts.append(feed)
            parts.pop()
            return b"".join(parts)
        except TypeError:  # a unit that does not stand alone
            return np.asarray(self.encode(text), "<u4").tobytes()
