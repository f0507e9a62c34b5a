"""Fast exact encoding of many texts with a tokenizers file.

Text repeats its words, so each Python worker remembers the ids of pieces that
it has met.  A text is cut only where the tokenizer itself always cuts; every
distinct piece is encoded by the tokenizers library, and anything unusual is
handed to the library as it is.
"""

from __future__ import annotations

import json
import string
from functools import lru_cache
from sys import getsizeof

import numpy as np

#: Bytes that a worker's remembered pieces take, dictionary entries included; further ones are encoded each time they occur.
REMEMBERED = 96 << 20
#: Pieces put together from others are remembered while at least so much is left.
RESERVED = 64 << 20
#: About what one entry takes besides its two objects.
ENTRY = 110
#: ASCII punctuation: no letters, digits or white space, so a tokenizer cuts between it and a letter, but for an apostrophe before one.
MARKS = string.punctuation
#: Longer pieces are never remembered.
LONGEST = 64


class _Cannot(Exception):
    """The text has white space that the cutting rule does not cover."""


class _Pieces(dict):
    """Piece -> its ids as little-endian 32-bit integers."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, piece: str) -> bytes:
        out, whole = self.encoder.piece(self, piece)
        if self.encoder.room > (0 if whole else RESERVED) and len(piece) <= LONGEST:
            self[piece] = out
            self.encoder.room -= getsizeof(piece) + getsizeof(out) + ENTRY
        return out


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """``ids(text)`` equals ``encode(text, add_special_tokens=False)`` of the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [pre]
        norm = spec.get("normalizer") or {}
        kinds = [n["type"] for n in norm.get("normalizers") or ([norm] if norm else [])]
        self.lower = "Lowercase" in kinds
        plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec["added_tokens"])
        spaced = any(" " in t["content"] or "\n" in t["content"] for t in spec["added_tokens"])
        drops = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") and r"\s" in str(steps[0]["pattern"])
        keeps = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not kinds
        self.mode = "drop" if drops and plain and not spaced else "keep" if keeps and plain and not spaced else "whole"
        stand_in = {b: c for c, b in _byte_of().items()}
        self.stand_in, self.model = {b: stand_in[b] for b in range(256)}, self.lib.model
        self.special = tuple(t["content"][:2] for t in spec["added_tokens"])
        self.bare, self.spaced, self.room = _Pieces(self, ""), _Pieces(self, " "), REMEMBERED

    def library(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, where: _Pieces, piece: str) -> tuple[bytes, bool]:
        """The ids of a piece, and whether the library encoded it as a whole."""
        if self.mode == "drop":
            if not piece:
                return b"", True
        elif not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Cannot
        if piece.isalpha() and max(piece) < "\u0100":
            # A word of Latin letters is one pre-token that no normalizer but lower-casing changes, so the model takes it directly.
            word = where.before + (piece.lower() if self.lower else piece)
            return np.array([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.stand_in))], "<u4").tobytes(), True
        if any(s in piece for s in self.special):
            return self.library(where.before + piece), True
        if self.mode == "keep" and "\n" in piece:
            lines = piece.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return where[lines[0]] + b"".join(self.newline + self.bare[x] for x in lines[1:]), False
        core = piece.rstrip(MARKS)
        if len(core) < len(piece) and core and core[-1].isascii() and core[-1].isalpha():
            return where[core] + self.bare[piece[len(core) :]], False
        core = piece.lstrip(MARKS)
        if len(core) < len(piece) and core and core[0].isascii() and core[0].isalpha() and (head := piece[: len(piece) - len(core)])[-1] != "'":
            return where[head] + self.bare[core], False
        if self.lower and piece.isascii() and piece != (low := piece.lower()):
            return where[low], False
        return self.library(where.before + piece), True

    @property
    @lru_cache(None)  # noqa: B019  one encoder lives as long as its worker
    def newline(self) -> bytes:
        return self.library("\n")

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.mode == "drop":
            return b"".join(map(self.bare.__getitem__, text.replace("\n", " ").split(" ")))
        if self.mode == "whole" or not text:
            return self.library(text)
        first, *rest = text.split(" ")
        try:
            return self.bare[first] + b"".join(map(self.spaced.__getitem__, rest))
        except _Cannot:
            return self.library(text)


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker."""
    return Encoder(path)


class Decoder:
    """``text(ids)`` equals ``decode(ids, skip_special_tokens=False)`` of a byte-level tokenizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _byte_of()
        self.tokens = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in vocabulary.items()}

    def raw(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def text(self, ids: bytes) -> str:
        return self.raw(ids).decode("utf-8", "replace")


@lru_cache(4)
def decoder(path: str) -> Decoder:
    return Decoder(path)
