"""Packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, pairwise

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.bpe import byte_symbols
from tidewell.llm.storage import ship, stored

#: Pieces packed together in one task; more of them make more groups.
GROUP = 100_000
#: Pieces of text whose ids a worker remembers; a full memory is dropped.
REMEMBERED = 300_000

# How the tokenizer splits words, and white space as Unicode has it.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_TWO_SPACES = re.compile(f"[{_SPACE}][{_SPACE}]")

_PIECES = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long"
_PLACED = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long, bin int, offset long"


class _Remembered(dict):
    """Ids of words with a blank before them, encoded when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self._encode(" " + word)
        return ids


class ByteBpe:
    """Ids by a tokenizers file of byte-level BPE, remembered by what lies between blanks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        raw = {s: bytes([b]) for b, s in enumerate(byte_symbols())}
        special = {t["content"] for t in file["added_tokens"]}
        vocab = {t: k for t, k in file["model"]["vocab"].items() if t not in special}
        self.ranks = {b"".join(map(raw.__getitem__, t)): k for t, k in vocab.items()}
        self._fast = tiktoken.Encoding(path, pat_str=_WORDS, mergeable_ranks=self.ranks, special_tokens={})
        self._library = Tokenizer.from_file(path)
        self._special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self._ids = _Remembered(self._encode)

    def ordinary(self, text: str) -> list[int]:
        """Ids of a text in which special tokens are plain text."""
        return self._fast.encode_ordinary(text)

    def _encode(self, text: str) -> bytes:
        return array("I", self._fast.encode_ordinary(text)).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for text in texts:
            if self._special.search(text):
                ids = self._library.encode(text, add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()
            elif _TWO_SPACES.search(text):
                yield self._encode(text)
            else:
                # White space that stands alone belongs to the word behind it, if it is a blank.
                first, *rest = text.split(" ")
                yield self._encode(first) + b"".join(map(self._ids.__getitem__, rest))
                if len(self._ids) > REMEMBERED:
                    self._ids.clear()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _cut(path: str, end_id: int, length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, end = byte_bpe(path), end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, key, ids in zip(batch["doc_id"], batch["text_key"], coder.encode(batch["text"].tolist()), strict=True):
                ids += end
                n = len(ids) // 4
                at, upto = 0, n % length or length  # only the first piece may be shorter
                piece = 0
                while at < n:
                    crc = zlib.crc32(memoryview(ids)[4 * at : 4 * upto])
                    rows.append((doc, key, piece, at, upto - at, crc))
                    at, upto, piece = upto, upto + length, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "text_key", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64" if out["doc_id"].isna().any() else "int64"})

    return run


class Bins:
    """Bins of one capacity: best fit by decreasing size, then an exchange of members."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = [int(s) for s in sizes], capacity
        self.members: list[list[int]] = []
        self.free: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        # Bins by free space; a bit is set for each free space that some bin has.
        by_free: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        have = 0
        for item in sorted(range(len(self.sizes)), key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[item]
            fitting = have >> size
            if fitting:
                free = size + (fitting & -fitting).bit_length() - 1
                bin_ = by_free[free].pop()
                if not by_free[free]:
                    have &= ~(1 << free)
                self.members[bin_].append(item)
            else:
                bin_, free = len(self.members), self.capacity
                self.members.append([item])
                self.free.append(free)
            free -= size
            self.free[bin_] = free
            by_free[free].append(bin_)
            have |= 1 << free

    def search(self) -> None:
        """Exchanges between underfull bins that increase the sum of squared fills.

        The emptiest bins give first. A member goes to another bin in exchange for none, one or two
        members that are smaller together, wherever that leaves the other bin with less room
        than the giver had; of all such exchanges the one that adds most is made. A bin without
        members is gone. The search ends when all underfull bins in turn find no exchange.
        """
        # A bin can hold a member instead of members of size x if that is at most x and its room
        # together. So bins are listed by this total and by x; a bit is set for each x of a total.
        self._holders: list[dict[int, set[int]]] = [defaultdict(set) for _ in range(self.capacity + 1)]
        self._given = [0] * (self.capacity + 1)
        givers = [b for b, free in enumerate(self.free) if free]
        for b in givers:
            self._list(b, True)
        changed = True
        while changed:
            changed = False
            givers = [b for b in givers if self.free[b] and self.members[b]]
            for giver in sorted(givers, key=self.free.__getitem__, reverse=True):
                self._list(giver, False)
                while self._improved(giver):
                    changed = True
                self._list(giver, True)

    def _list(self, b: int, there: bool) -> None:
        """Put an underfull bin on the lists, or take it off before it changes."""
        room = self.free[b]
        if not room or not self.members[b]:
            return
        sizes = sorted(self.sizes[item] for item in self.members[b])
        sums = {0, *sizes, *(x + y for x, y in combinations(sorted({*sizes}), 2))}
        sums.update(2 * x for x, y in pairwise(sizes) if x == y)
        for x in sums:
            holders = self._holders[x + room]
            if there:
                holders[x].add(b)
                self._given[x + room] |= 1 << x
            else:
                holders[x].discard(b)
                if not holders[x]:
                    self._given[x + room] ^= 1 << x

    def _improved(self, giver: int) -> bool:
        """The exchange of this giver that adds most to the squares, if one adds to them."""
        free, best = self.free[giver], (0, 0, 0, 0)
        for size in {self.sizes[item] for item in self.members[giver]}:
            smaller = (1 << size) - 1
            for total in range(size, min(size + free, self.capacity + 1)):
                given = self._given[total] & smaller
                if given:
                    x = (given & -given).bit_length() - 1
                    gain = (size - x) * (free - (total - size))
                    best = max(best, (gain, size, total, x))
        gain, size, total, x = best
        if gain:
            self._exchange(giver, size, next(iter(self._holders[total][x])), x)
        return gain > 0

    def _exchange(self, giver: int, size: int, b: int, x: int) -> None:
        """A member of ``size`` for none, one or two members of ``b`` with size ``x`` in all."""
        self._list(b, False)
        item = next(i for i in self.members[giver] if self.sizes[i] == size)
        for source, target, moved in ((giver, b, (item,)), (b, giver, self._of_size(b, x))):
            for i in moved:
                self.members[source].remove(i)
                self.members[target].append(i)
                self.free[source] += self.sizes[i]
                self.free[target] -= self.sizes[i]
        self._list(b, True)

    def _of_size(self, b: int, x: int) -> tuple[int, ...]:
        if not x:
            return ()
        seen: dict[int, int] = {}
        pair: tuple[int, ...] = ()
        for i in self.members[b]:
            size = self.sizes[i]
            if size == x:
                return (i,)
            if x - size in seen:
                pair = (seen[x - size], i)
            seen[size] = i
        return pair


def _packed(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "text_key", "piece"], ignore_index=True)
        sizes = group["length"].to_numpy()
        part = np.flatnonzero(sizes < length)
        bin_, offset = np.empty(len(group), np.int32), np.zeros(len(group), np.int64)
        full = np.flatnonzero(sizes >= length)
        bins = Bins(sizes[part], length)
        bins.search()
        n = 0
        for members in bins.members:
            at = 0
            for item in members:
                bin_[part[item]], offset[part[item]] = n, at
                at += bins.sizes[item]
            n += bool(members)
        bin_[full] = n + np.arange(len(full))
        group["bin"], group["offset"] = bin_, offset
        return group[["doc_id", "text_key", "piece", "start", "length", "ids_crc32", "bin", "offset", "part"]]

    return run


def pack(docs: DataFrame, path: str, end_id: int = 2, length: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, text_key) for every piece.

    A document is its ids and ``end_id``. Only longer ones are cut, into pieces of ``length``
    ids with the shorter piece first. Pieces are dealt into groups of about GROUP by a hash,
    packed by best fit, and improved by a local search that moves or exchanges documents between
    underfull sequences, one for one or two for one, while the sum of squared fills grows, until
    sequences empty. A group wastes little more than its last sequence.

    Ids are encoded once; what is stored and moved is a row per piece. A null text counts as
    empty, which is one piece of ``end_id`` alone. Null and repeated ids are documents of their
    own. No rows give no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    pieces = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
        ).mapInPandas(_cut(path, end_id, length), _PIECES),
        "pieces",
    )
    groups = max(1, -(-pieces.count() // GROUP))
    dealt = F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.lit(groups)).cast("int")
    placed = pieces.withColumn("part", dealt).groupBy("part").applyInPandas(_packed(length), _PLACED + ", part int")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.shiftleft(F.col("part").cast("long"), 32) + F.col("bin")).alias("sequence_id"),
        "offset", "text_key",
    )
