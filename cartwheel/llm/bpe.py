"""Operator 1: BPE encoding and decoding.

``WordBpe`` reads a public tokenizer file (BPE with word ends) and merges each
short word in a contiguous rank array: the parts between boundaries and the
ranks of adjacent parts lie side by side; the smallest rank is found by
scanning, its inner boundary deleted and the two neighbouring ranks looked up
again. Blocks of distinct words take each step together, a row for each word.
Words beyond ``SHORT_WORD`` bytes would make the scan quadratic, so they go
through a heap of (rank, position), with the same merges in the same order.

Texts are cut at white space, which the tokenizer drops and which no token
crosses, so equal pieces are merged once per Python worker (bounded cache).

Defined results: null and empty texts have no ids and decode to ''; repeated
rows and null ids pass through as rows; an empty table gives an empty table;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from cartwheel.llm.common import id_and_text, map_slices

#: Longest word, in UTF-8 bytes, that the rank array merges by scanning.
SHORT_WORD = 96
#: Distinct pieces and words a Python worker remembers.
CACHE_ENTRIES = 400_000
#: Words merged at once.
BLOCK_WORDS = 4096
NO_RANK, NO_PART = 1 << 30, -1


@lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it prints,
    else the next free code point from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class TextPieces:
    """Cuts texts at white space into pieces that a tokenizer of this form
    (lower case, white space dropped) treats one by one, and pieces into words;
    remembers the ids of both. ``word_ids`` gives the ids of distinct words,
    ``odd_ids`` those of pieces that hold anything but verified letters.

    For the verified letters (a test holds every one of them against the
    library) lower-casing and cutting are Python's; they are in normal form, and
    none of them combines with another. All else, marks, rare scripts, letters
    newer than somebody's tables, special tokens, goes through the library's own
    normaliser and pre-tokeniser."""

    VERIFIED = re.compile("[\t\n\r -~¡-ſΑ-ΡΣ-ωА-я]*")
    #: White space of the tokenizer's pattern.
    SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self, path: str, word_ids: Callable[[list[str]], list[bytes]],
                 odd_ids: Callable[[list[str]], list[bytes]]):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError("the tokenizer file is not of the lower-case word-end form")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.word = regex.compile(split)
        self.word_ids, self.odd_ids = word_ids, odd_ids
        self.known: dict[str | tuple, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        cut = [self.pieces(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(known)
        if new:
            self.learn(new)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def learn(self, new: set) -> None:
        known, words, cut, odd = self.known, set(), [], []
        for p in new:
            if type(p) is tuple:
                odd.append(p)
            elif p.isalpha():
                words.add(p)
            else:
                parts = (p[:-1], p[-1]) if p[-1] in ".,;:!?" and p[:-1].isalpha() else self.word.findall(p)
                cut.append((p, parts))
                words.update(parts)
        fresh = list(words.difference(known))
        # A word is a piece too (one that isn't cut): both share the table.
        known.update(zip(fresh, self.word_ids(fresh)))
        known.update([(p, b"".join(map(known.__getitem__, parts))) for p, parts in cut if len(parts) != 1 or parts[0] != p])
        known.update(zip(odd, self.odd_ids([p for p, in odd]) if odd else ()))

    def pieces(self, text: str) -> list:
        """The pieces of a text: lower-cased, or as they are in a 1-tuple."""
        verified = self.VERIFIED.fullmatch
        if "<|" not in text and verified(text):
            return self.lower(text).split()
        return [self.lower(p) if "<|" not in p and verified(p) else (p,) for p in self.SPACE.split(text) if p]

    @staticmethod
    def lower(text: str) -> str:
        # One letter at a time: no special form for a sigma that ends a word.
        return text.replace("Σ", "σ").lower()


class WordBpe:
    """A tokenizer of the word-end form, read from its file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.library = Tokenizer.from_file(path)
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.cut = TextPieces(path, self.word_ids, self.odd_ids)
        self.token_of = {i: t for t, i in (vocab | self.cut.specials).items()}
        self.inner = np.array([vocab[c] for c in byte_letters()], np.int32)
        self.final = np.array([vocab[c + suffix] for c in byte_letters()], np.int32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in model["merges"]], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in model["merges"]], np.int32)

    # -- encoding ---------------------------------------------------------
    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        return self.cut.encode(texts)

    def odd_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that the library normalises and cuts into words."""
        normal, cut = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        special, specials, letters = self.cut.special.split, self.cut.specials, self.byte_of.__getitem__
        parts = [[[p] if p in specials else [w for w, _ in cut(normal(p))] for p in special(piece) if p] for piece in pieces]
        words = list({w for piece in parts for part in piece for w in part}.difference(specials))
        known = dict(zip(words, self.word_ids([bytes(map(letters, w)).decode() for w in words])))
        known.update((t, i.to_bytes(4, "little")) for t, i in specials.items())
        return [b"".join([known[w] for part in piece for w in part]) for piece in parts]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of adjacent parts; NO_RANK where they don't merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, as bytes."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        short = [i for i in order if len(raw[i]) <= SHORT_WORD]
        for i in order[len(short):]:
            out[i] = self._long_word(raw[i])
        for at in range(0, len(short), BLOCK_WORDS):        # words of like length lie together
            rows = short[at:at + BLOCK_WORDS]
            for i, ids in zip(rows, self._short_words([raw[i] for i in rows])):
                out[i] = ids
        return out

    def _short_words(self, raw: list[bytes]) -> list[bytes]:
        """Merges a block of words, a row of the arrays for each: ``parts``
        holds the parts between a word's boundaries and ``ranks`` those of
        adjacent parts, both without gaps and padded at the end."""
        size = np.array([len(w) for w in raw])
        width = int(size.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in raw), np.uint8).reshape(len(raw), width)
        column = np.arange(width)
        parts = np.where(column < size[:, None] - 1, self.inner[text],
                         np.where(column < size[:, None], self.final[text], NO_PART)).astype(np.int32)
        done = np.full((len(raw), width), NO_PART, np.int32)
        rows, ranks = np.arange(len(raw)), np.full((len(raw), width), NO_RANK, np.int32)
        if width > 1:
            ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            if (over := best == NO_RANK).any():             # no pair of these words merges any more
                done[rows[over]] = parts[over]
                go = ~over
                rows, parts, ranks, at, best = rows[go], parts[go], ranks[go], at[go], best[go]
                every = np.arange(len(rows))
            # Delete the boundary inside the best pair: what lies right of it moves up by one.
            moves = column[:-1] > at[:, None]
            parts[:, :-1] = np.where(moves, parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(moves, ranks[:, 1:], ranks[:, :-1])
            parts[:, -1], ranks[:, -1] = NO_PART, NO_RANK
            parts[every, at] = self.merged[best]
            # Refresh the ranks on both sides of the new part.
            right = np.minimum(at + 1, width - 1)
            ranks[every, at] = np.where(at + 1 < width, self.rank(parts[every, at], parts[every, right]), NO_RANK)
            left = np.maximum(at - 1, 0)
            ranks[every, left] = np.where(at > 0, self.rank(parts[every, left], parts[every, at]), ranks[every, left])
        there = done != NO_PART
        ids = done[there].astype("<u4").tobytes()
        ends = np.cumsum(there.sum(axis=1) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _long_word(self, raw: bytes) -> bytes:
        """The same merges in the same order for a word of any length, by a
        heap of (rank, position), in n log n."""
        n = len(raw)
        part = [*self.inner[list(raw[:-1])].tolist(), int(self.final[raw[-1]])]
        after, before, heap = [*range(1, n + 1)], [*range(-1, n - 1)], []
        rank = dict(zip(self.keys.tolist(), self.ranks.tolist())) if not hasattr(self, "_rank") else self._rank
        self._rank = rank

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (r := rank.get(part[a] << 32 | part[b])) is not None:
                heapq.heappush(heap, (r, a, part[a], part[b]))

        for i in range(n):
            offer(i)
        while heap:
            r, a, left, right = heapq.heappop(heap)
            b = after[a]
            if part[a] != left or b >= n or part[b] != right:
                continue                                    # one of the two has changed
            part[a], part[b], after[a] = int(self.merged[r]), NO_PART, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return np.array([p for p in part if p != NO_PART], "<u4").tobytes()

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by spaces (the file names no decoder)."""
        return " ".join(map(self.token_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def tokenizer(path: str) -> WordBpe:
    """One instance per Python worker and file, with its caches."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  decode: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers)
    and, with ``decode``, decoded: the text those ids decode to. ``path`` is
    the tokenizer's file, present on every executor."""
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokenizer(path)
        ids = t.encode(batch.column(1).to_pylist())
        columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        if decode:
            columns.append(pa.array([t.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"][:len(columns)])

    return map_slices(id_and_text(docs, id_col, text_col), run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded from a table of doc_id and ids as ``encode_decode`` makes
    them; null ids decode to ''."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokenizer(path)
        texts = [t.decode(x or b"") for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return map_slices(encoded.select("doc_id", "ids"), run, "doc_id long, decoded string")
