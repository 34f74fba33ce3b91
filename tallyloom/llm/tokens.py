"""Token ids of whole texts by the tokenizers library, with a bounded memo of chunks.

A byte-level BPE with the usual split pattern never joins across a single space between two characters that aren't white
space, so a text is the concatenation of chunks that start at such spaces. Chunks repeat; each is pre-tokenized and merged
by the library once and kept. Any other tokenizer file, and any text that contains an added token's string, is encoded
whole by the library.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np
import public_tokenizers
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO = 300_000  #: chunks in use that a worker keeps at least
SPLIT = regex.compile(public_tokenizers.PATTERN)
LATIN = "\u0250"  #: below it, no version of Unicode changes a character's class
SAFE = re.compile(r"(?<=\S) (?=\S)")


class _Memo(dict):
    """Key to value, made by `make` when missing; the last MEMO to 2 * MEMO keys in use are kept."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str):
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        self[key] = got
        return got


class _Chunks(_Memo):
    """The same for chunks that begin with `lead`; plain words, most of all, go straight to the merges."""

    def __init__(self, make, lead: str, tokenize) -> None:
        super().__init__(make)
        self.lead, self.tokenize = lead, tokenize

    def __missing__(self, key: str):
        got = self.old.get(key)
        if got is None:
            if key.isalpha() and key.isascii():
                got = array("I", [t.id for t in self.tokenize(self.lead + key)]).tobytes()
            else:
                got = self.make(key)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next free one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """encode(text) gives the ids' bytes as little-endian uint32, as Tokenizer.encode(text, add_special_tokens=False) does."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        pre, model, added = self.tokenizer.pre_tokenizer, self.tokenizer.model, self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.chunked = (
            isinstance(pre, ByteLevel) and not pre.add_prefix_space and pre.use_regex and self.tokenizer.normalizer is None
            and isinstance(model, BPE) and not model.dropout and not model.ignore_merges and all(not t.lstrip and not t.rstrip for t in added)
        )
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.split, self.merge = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.letters = byte_letters()
        self.first = _Chunks(lambda word: self._safe(word, ""), "", self.merge.tokenize)
        self.rest = _Chunks(lambda word: self._safe(word, " "), self.letters[32], self.merge.tokenize)
        self.pieces = _Memo(self._piece)

    def _safe(self, word: str, lead: str) -> bytes | None:
        """None for a chunk that must not be cut at its space."""
        core = word.rstrip(",.")
        if core.isalpha() and (core.isascii() or max(core) < LATIN):  # a run of letters and one of marks
            if len(core) < len(word):
                return (self.rest if lead else self.first)[core] + self.pieces[word[len(core) :]]
            return self._piece(lead + word)
        if "\n" in word:  # a single line end between other characters is a piece of its own
            parts = word.split("\n")
            got = [(self.rest if lead else self.first)[parts[0]], *map(self.first.__getitem__, parts[1:])] if all(parts) else [None]
            if None not in got:
                return self.pieces["\n"].join(got)
        return self._chunk(lead + word) if word and not word[0].isspace() and not word[-1].isspace() else None

    def _chunk(self, chunk: str) -> bytes:
        if max(chunk) < LATIN:
            return b"".join(map(self.pieces.__getitem__, SPLIT.findall(chunk)))
        return b"".join([self._merge(p) for p, _ in self.split.pre_tokenize_str(chunk)])

    def _piece(self, piece: str) -> bytes:
        return self._merge(piece.encode().decode("latin-1").translate(self.letters))

    def _merge(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.merge.tokenize(piece)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.chunked or any(x in text for x in self.added):
            return self.whole(text)
        words = text.split(" ")
        try:
            head = self.first[words[0]]
            return head + b"".join(map(self.rest.__getitem__, words[1:]))
        except TypeError:  # white space meets a space somewhere: cut at the safe ones only
            parts = SAFE.split(text)
            return self._chunk(parts[0]) + b"".join([self.rest[p] or self._chunk(" " + p) for p in parts[1:]])

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One a worker process; the memo outlives a task."""
    return Encoder(path)


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
