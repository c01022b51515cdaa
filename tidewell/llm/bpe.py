"""Byte-pair encoding with word ends: batched merge rounds over many words at once."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse
from operator import add

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.storage import ship

#: Pieces of text, and words, whose ids a worker remembers; a full memory is dropped.
REMEMBERED = 500_000
#: Texts whose unseen words go through the merge rounds together.
TOGETHER = 2_000
#: The most symbols in the flat array.
ROUND = 2_000_000

NO_RANK = np.int64(2**62)

# How the tokenizer splits words, and white space as Unicode has it.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return [out[b] for b in range(256)]


class Bpe:
    """Encoder and decoder for a tokenizers file of this kind: BPE with a suffix at word ends."""

    def __init__(self, path: str):
        self._path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE file with an end-of-word suffix is needed")
        end, vocab = model["end_of_word_suffix"], model["vocab"]
        symbols = byte_symbols()
        self._inner = np.array([vocab[s] for s in symbols], np.int64)
        self._final = np.array([vocab[s + end] for s in symbols], np.int64)
        self._special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self._marks = re.compile(
            "|".join(re.escape(t) for t in sorted(self._special, key=len, reverse=True)) or r"(?!)"
        )
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._base = int(max(len(vocab), merged.max() + 1 if len(merged) else 0)) + 1
        key = left * self._base + right
        # A pair that is listed twice counts with its last rank.
        order = np.lexsort((-np.arange(len(key)), key))
        order = order[np.concatenate([[True], np.diff(key[order]) != 0])] if len(order) else order
        self._keys, self._ranks, self._merged = key[order], order.astype(np.int64), merged[order]
        size = max([*vocab.values(), *self._special.values()]) + 1
        self._token = [b""] * size
        for text, k in [*vocab.items(), *self._special.items()]:
            self._token[k] = text.encode()
        self._split = regex.compile(_WORDS)
        self._special_ids = {t: k.to_bytes(4, "little") for t, k in self._special.items()}
        self._ids: dict[str, bytes] = dict(self._special_ids)
        self._word_ids: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word ends among them.

        Symbols of all words lie in one flat array. In a round every word merges its pair of least
        rank, wherever it occurs from left to right; ranks are found by binary search over the sorted
        keys of the pairs. Words without such a pair leave the array.
        """
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbol = self._inner[flat]
        last = np.cumsum(size)[size > 0] - 1
        symbol[last] = self._final[flat[last]]
        word = np.repeat(np.arange(len(words)), size)
        left_words, left_symbols = [], []
        while len(symbol):
            key = symbol[:-1] * self._base + symbol[1:]
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            known = (self._keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self._ranks[at], NO_RANK), NO_RANK)
            at = np.append(at, 0)
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(symbol))))
            done = least == NO_RANK
            left_words.append(word[done])
            left_symbols.append(symbol[done])
            hit = (rank == least)[~done]
            symbol, word, at = symbol[~done], word[~done], at[~done]
            # In a run of hits that overlap, as in "aaaa", every other one merges.
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(hit))
                first = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
                hit &= (place - first) % 2 == 0
            symbol = np.where(hit, self._merged[at], symbol)
            keep = ~np.append(False, hit[:-1])[: len(hit)]
            symbol, word = symbol[keep], word[keep]
        word = np.concatenate(left_words) if left_words else word
        order = np.argsort(word, kind="stable")
        ids = np.concatenate(left_symbols)[order] if left_symbols else symbol
        return ids, np.cumsum(np.bincount(word, minlength=len(words)))

    def _kind(self, c: str) -> str:
        """A stand-in of the same class for a code point that Python's Unicode tables lack."""
        if self._library is None:
            self._library = Tokenizer.from_file(self._path)
        cut = self._library.pre_tokenizer.pre_tokenize_str
        if len(cut(f"a{c}a")) == 1:
            return "a"
        return "0" if len(cut(c + c)) == 2 else "\ufffd"

    def _words(self, text: str) -> list[str]:
        lower = text.lower()
        if lower.isascii():
            return self._split.findall(lower)
        # Case goes by single characters, so a final sigma is an ordinary one.
        lower = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        new = {c: self._kind(c) for c in set(lower) if unicodedata.category(c) == "Cn"}
        if new:
            lower = "".join(self._library.normalizer.normalize_str(c) if c in new else c for c in lower)
            new |= {c: self._kind(c) for c in set(lower) if unicodedata.category(c) == "Cn"}
        known = lower.translate(str.maketrans(new))
        return [lower[m.start() : m.end()] for m in self._split.finditer(known)]

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pieces not met before."""
        # Most pieces are a word, or a word and a mark; below U+0300 letters are composed already.
        plain, plain_words, marked, marked_words, marks, others = [], [], [], [], [], []
        for p in pieces:
            w = p.lower()
            if w.isascii() or max(w) < "\u0300":
                if w.isalpha():
                    plain.append(p)
                    plain_words.append(w)
                    continue
                if w[:-1].isalpha() and w[-1] in ".,;:!?":
                    marked.append(p)
                    marked_words.append(w[:-1])
                    marks.append(w[-1])
                    continue
            others.append(p)
        split = [self._words(p) for p in others]
        ids = self._word_ids
        words = chain(plain_words, marked_words, marks, chain.from_iterable(split))
        unseen = [*set(filterfalse(ids.__contains__, words))]
        at = 0
        while at < len(unseen):
            upto, symbols = at, 0
            while upto < len(unseen) and symbols < ROUND:
                symbols += len(unseen[upto])
                upto += 1
            part = unseen[at:upto]
            merged, ends = self.merge([w.encode() for w in part])
            flat, ends = merged.astype("<u4").tobytes(), (4 * ends).tolist()
            ids.update(zip(part, (flat[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
            at = upto
        get = ids.__getitem__
        self._ids.update(zip(plain, map(get, plain_words), strict=True))
        self._ids.update(zip(marked, map(add, map(get, marked_words), map(get, marks)), strict=True))
        self._ids.update((p, b"".join(map(get, own))) for p, own in zip(others, split, strict=True))

    def _parts(self, text: str) -> list[str]:
        """Text between blanks; special tokens, which are cut out of the raw text, are parts too."""
        if "<|" not in text:
            return text.split(" ")
        out, at = [], 0
        for mark in self._marks.finditer(text):
            out += [*text[at : mark.start()].split(" "), mark.group()]
            at = mark.end()
        return out + text[at:].split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Text between blanks is encoded apart, since no word reaches over white space.
        """
        out: list[bytes] = []
        for at in range(0, len(texts), TOGETHER):
            parts = [self._parts(text) for text in texts[at : at + TOGETHER]]
            if len(self._ids) > REMEMBERED:
                self._ids = dict(self._special_ids)
            if len(self._word_ids) > REMEMBERED:
                self._word_ids.clear()
            unseen: set[str] = set()
            for own in parts:
                unseen.update(filterfalse(self._ids.__contains__, own))
            self._learn(unseen)
            get = self._ids.__getitem__
            out.extend(b"".join(map(get, own)) for own in parts)
        return out

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids: the file names no decoder, so tokens are put a blank apart."""
        return b" ".join(map(self._token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def _digests(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = bpe(path)
        for batch in batches:
            ids = coder.encode(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(coder.decode(x)).hexdigest() for x in ids],
                }
            )

    return run


def _encoded(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = bpe(path)
        for batch in batches:
            ids = coder.encode(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "ids": [np.frombuffer(x, "<u4").astype(np.int64) for x in ids],
                    "decoded": [coder.decode(x).decode() for x in ids],
                }
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text; ``path`` names the tokenizer on each executor.

    A null text counts as empty, which has no ids and decodes to an empty text. Null and repeated
    ids stay as they are, one row for each row of ``docs``. Other columns are ignored.
    """
    return _texts(docs).mapInPandas(_encoded(path), "doc_id long, ids array<long>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): :func:`encode_decode` as digests.

    Digests are taken where the ids are, so that neither ids nor decoded texts are moved.
    """
    return _texts(docs).mapInPandas(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
