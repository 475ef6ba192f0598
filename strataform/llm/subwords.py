"""Subword encoders over public vocabulary files, cached by word.

Both encoders cut a text at single spaces.  A cut before a space that is
followed by a non-space is always a boundary of the split patterns used here,
so each part can be encoded by itself, and each distinct part of a task is
encoded once.  The cache is emptied when it reaches ``cache_chars``; that bounds
memory and changes no result.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import tiktoken

# White space in the sense of the split patterns (the Unicode
# White_Space property).
WHITE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
         "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_WHITE_SET = frozenset(WHITE)
_MARK = "\x00"
_ENCODED = 2048  # parts the library encodes at a time; its results are far larger than their ids


def _bytes_of_unicode_symbols() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _PartCache:
    """Encodes texts part by part; subclasses encode the parts not seen yet."""

    dtype = np.dtype("<u2")

    def __init__(self, cache_chars: int):
        self.cache_chars = cache_chars
        self.cache: dict[str, bytes] = {}
        self.held = 0

    def parts(self, text: str) -> list[str]:
        """``text`` cut before single spaces, each part with its space."""
        raise NotImplementedError

    def encode_missing(self, parts: list[str]) -> None:
        raise NotImplementedError

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each of the distinct ``parts`` as little-endian ``dtype`` bytes."""
        self._encode_new(set(parts))
        return list(map(self.cache.__getitem__, parts))

    def _encode_new(self, parts: set[str]) -> None:
        if self.held > self.cache_chars:
            self.cache.clear()
            self.held = 0
        missing = list(parts.difference(self.cache))
        if missing:
            self.encode_missing(missing)
            self.held += sum(map(len, missing))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian ``dtype`` bytes."""
        out = []
        step: list[list[str]] = []
        size = 0

        def flush() -> None:
            self._encode_new(set(chain.from_iterable(step)))
            get = self.cache.__getitem__
            out.extend(b"".join(map(get, parts)) for parts in step)
            step.clear()

        for text in texts:
            step.append(self.parts(text))
            size += len(text)
            if size > 1 << 21:
                flush()
                size = 0
        flush()
        return out


def read_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rank_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    table = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    return table


class ByteBpe(_PartCache):
    """Byte-level BPE by a rank file, one split-pattern match at a time."""

    def __init__(self, rank_file: str, pattern: str, cache_chars: int = 4_000_000):
        super().__init__(cache_chars)
        ranks = read_ranks(rank_file)
        self.table = rank_table(ranks)
        if len(self.table) > 1 << 16:
            self.dtype = np.dtype("<u4")
        self.whole = tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens={})
        # The same pattern with a mark that never joins its neighbours, so that
        # many parts are encoded in one call.
        marked = f"{_MARK}|" + pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s\p{{L}}\p{{N}}{_MARK}]")
        self.can_mark = marked.count(_MARK) == 2 and bytes([0]) in ranks
        self.marked = tiktoken.Encoding("marked", pat_str=marked, mergeable_ranks=ranks,
                                        special_tokens={})
        self.mark_id = ranks.get(bytes([0]), -1)

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        cut = text.split(" ")
        head = cut[0]
        if any(not p or p[0] in _WHITE_SET for p in cut[1:]):
            # A space before white space stays with what stands before it.
            groups = [[head]]
            for p in cut[1:]:
                if not p or p[0] in _WHITE_SET:
                    groups[-1] += (" ", p)
                else:
                    groups.append([" ", p])
            return [g for g in map("".join, groups) if g]
        rest = [" " + p for p in cut[1:]]
        return [head, *rest] if head else rest

    def encode_missing(self, parts: list[str]) -> None:
        bulk = []
        for p in parts:
            if self.can_mark and _MARK not in p and p[-1] not in _WHITE_SET:
                bulk.append(p)
            else:
                self.cache[p] = np.asarray(self.whole.encode_ordinary(p), self.dtype).tobytes()
        if not bulk:
            return
        ids = np.asarray(self.marked.encode_ordinary(_MARK.join(bulk) + _MARK), self.dtype)
        data, width = ids.tobytes(), self.dtype.itemsize
        start = 0
        for p, end in zip(bulk, np.flatnonzero(ids == self.mark_id).tolist(), strict=True):
            self.cache[p] = data[start * width:end * width]
            start = end + 1

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, self.dtype).tolist()))


class WordBpe(_PartCache):
    """Word-level BPE of a ``tokenizers`` file whose words end with a mark.

    Plain Latin parts go through a rank encoder built from the same file; every
    other part goes to the ``tokenizers`` library itself.  In the rank encoder
    a space stands for the end-of-word mark.  It gives the library's ids as
    long as each listed token is what its own text encodes to; tokens for which
    that does not hold are left out of the ranks (``tests/llm`` checks that).
    """

    # The split pattern of the file, for plain Latin text.
    _SPLIT = re.compile(r"\x00|'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s\x00]|_)+")
    _PLAIN = re.compile(r"[\t\n\x0b\x0c\r\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")

    def __init__(self, path: str, cache_chars: int = 4_000_000):
        super().__init__(cache_chars)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        symbols = _bytes_of_unicode_symbols()
        special = {t["id"] for t in spec["added_tokens"]}
        if max(vocab.values()) >= 1 << 16:
            self.dtype = np.dtype("<u4")
        ranks: dict[bytes, int] = {}
        for token, i in vocab.items():
            if i in special:
                continue
            mark = token.endswith(end) and token != end
            body = token[: -len(end)] if mark else token
            ranks[bytes(symbols[c] for c in body) + b" " * mark] = i
        self.ranks = ranks
        self.fast = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks,
                                      special_tokens={})
        self.mark_id = ranks[b"\x00 "]

    def parts(self, text: str) -> list[str]:
        return [p for p in text.split(" ") if p]

    def encode_missing(self, parts: list[str]) -> None:
        plain = [p for p in parts if self._PLAIN.fullmatch(p)]
        if len(plain) < len(parts):
            other = [p for p in parts if not self._PLAIN.fullmatch(p)]
            for at in range(0, len(other), _ENCODED):
                some = other[at:at + _ENCODED]
                for p, e in zip(some, self.library.encode_batch(some, add_special_tokens=False),
                                strict=True):
                    self.cache[p] = np.asarray(e.ids, self.dtype).tobytes()
        if not plain:
            return
        text = unicodedata.normalize("NFC", _MARK.join(plain) + _MARK).lower()
        words = self._SPLIT.findall(text)
        ids = np.asarray(self.fast.encode_ordinary(" ".join(words) + " "), self.dtype)
        data, width = ids.tobytes(), self.dtype.itemsize
        start = 0
        for p, end in zip(plain, np.flatnonzero(ids == self.mark_id).tolist(), strict=True):
            self.cache[p] = data[start * width:end * width]
            start = end + 1


@functools.lru_cache(maxsize=4)
def byte_bpe(rank_file: str, pattern: str) -> ByteBpe:
    """One encoder per Python worker and file."""
    return ByteBpe(rank_file, pattern)


@functools.lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
