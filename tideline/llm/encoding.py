"""Token ids of whole texts by the public tokenizers library, with the work shared between equal words."""

from __future__ import annotations

import codecs
import re
from struct import pack

import numpy as np
import pyarrow as pa

# Runs of text that are remembered: as many of the present generation, and as many of the one before.
CACHE = 300_000
# Bytes of text that are encoded together: a run that they share is handled once.
CHUNK = 1 << 23

# Classes of bytes. The tokenizer ends a token at white space, between letters and what is neither letter nor digit, and
# around every digit. A byte of JOIN says nothing by itself: it stays with its neighbours, and the tokenizer decides.
SPACE, LETTER, OTHER, DIGIT, JOIN = range(5)
_SPECIAL = b"<|"
_LOWER = bytes(range(256)).lower()


def _classes(joined: bytes) -> bytes:
    found = bytearray([JOIN] * 256)
    for byte in range(0x21, 0x7F):
        char = chr(byte)
        found[byte] = LETTER if char.isalpha() else DIGIT if char.isdigit() else OTHER
    for byte in b" \t\n\r":
        found[byte] = SPACE
    for byte in joined:
        found[byte] = JOIN
    return bytes(found)


def _begins() -> bytes:
    """By 5 * class of the byte before + class: does a run begin here?"""
    found = bytearray(256)
    for before in range(5):
        for own in range(5):
            apart = before == SPACE or own == before == DIGIT or (own != before and JOIN not in (own, before))
            found[5 * before + own] = own != SPACE and apart
    return bytes(found)


_PLAIN, _CAREFUL, _BEGIN = _classes(b"'"), _classes(b"'<|>"), _begins()
# Latin letters, each one code point in every normal form, whose lower case depends on no neighbour.
_LATIN = re.compile("[A-Za-zªµºÀ-ÖØ-öø-įĲ-ɏ]+")
# The byte-level alphabet of the vocabulary. Printable bytes stand for themselves, the others are 256 and on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = "".join(chr(b) if b in _SHOWN else chr(256 + b - sum(s < b for s in _SHOWN)) for b in range(256))


class Encoder:
    """Ids of whole texts, equal to those of tokenizers' encode, with a bounded memory of runs seen before."""

    def __init__(self, path: str, limit: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.limit = limit
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, run: bytes) -> bytes:
        tokenize = self.tokenizer.model.tokenize
        if run.isalpha():  # ASCII letters only
            ids = [t.id for t in tokenize(run.decode("ascii").lower())]
        else:
            text = run.decode("utf-8", "replace")
            if _LATIN.fullmatch(text):
                ids = [t.id for t in tokenize(codecs.charmap_decode(text.lower().encode(), "strict", _BYTE_LEVEL)[0])]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs, as little-endian 32-bit numbers."""
        found = list(map(self.young.get, runs))
        for i, ids in enumerate(found):
            if ids is None:
                run = runs[i]
                ids = self.old.get(run)
                if ids is None:
                    ids = self._learn(run)
                found[i] = self.young[run] = ids
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
        return found

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); NULL counts as empty."""
        flat = pa.compute.fill_null(texts.cast(pa.large_string()), "")
        bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        raw = flat.buffers()[2].slice(int(bounds[0]), int(bounds[-1] - bounds[0])).to_pybytes() if bounds[-1] > bounds[0] else b""
        bounds = bounds - bounds[0]
        if not raw:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if _SPECIAL in raw:  # may hold the text of a special token, which is read before letters are lowered
            kind = raw.translate(_CAREFUL)
        else:
            raw, kind = raw.translate(_LOWER), raw.translate(_PLAIN)
        kinds = np.frombuffer(kind, np.uint8)
        pairs = np.empty(len(kinds), np.uint8)
        pairs[0] = kinds[0]  # as if after white space
        np.multiply(kinds[:-1], 5, out=pairs[1:])
        pairs[1:] += kinds[1:]
        begins = np.frombuffer(bytearray(pairs.tobytes().translate(_BEGIN)), np.bool_)
        solid = kinds != SPACE
        own = bounds[:-1][bounds[:-1] < bounds[1:]]
        begins[own] = solid[own]
        kept = np.frombuffer(raw, np.uint8)[solid]
        places = np.flatnonzero(begins)
        offsets = np.append(np.flatnonzero(begins[solid]), len(kept)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        coded = words.dictionary_encode()
        pieces = self.runs(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts = np.cumsum(sizes) - sizes
        table = np.frombuffer(b"".join(pieces), "<u4")
        each = sizes[index]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        small = np.int32 if max(total, len(table)) < 1 << 31 else np.int64
        at = np.repeat((starts[index] - (ends - each)).astype(small), each)
        at += np.arange(total, dtype=small)
        upto = np.append(0, ends)[np.searchsorted(places, bounds)]
        return table[at], np.diff(upto)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
