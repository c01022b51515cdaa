"""Alignment of the tokens that two tokenizers cut from the same text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.packing import byte_bpe
from tidewell.llm.storage import ship, stored

#: Chunks of text that a worker remembers; a full memory is dropped.
REMEMBERED = 400_000
#: Code points of the texts that are aligned together.
TOGETHER = 1_000_000
#: The most frequent irregular groups, and pairs, that are sent to all tasks: at most so many.
FREQUENT = 2**17

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: A blank or line end with what follows, up to the next one that follows a character.
_CHUNK = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
_BLANK = "▁"

DOCUMENT, GROUP, VECTOR = range(3)
_ALIGNED = (
    "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "single array<int>, single_n array<int>, pairs array<long>, keys array<long>, keys_n array<long>"
)
_SCORED = "row long, n_best long, count_sum long, keys array<long>, keys_n array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[0]
    return x ^ (x >> np.uint64(32))


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indices of the ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


class Aligner:
    """Both tokenizers, and what is known of the chunks that were met.

    A chunk is encoded apart from its neighbours: A never puts white space behind another character
    into one token, and B has no piece in which a blank follows another character or that holds a
    line end (looked up when the files are read; B encodes whole texts otherwise).
    """

    def __init__(self, a_path: str, b_path: str):
        self._a = byte_bpe(a_path)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self._b.get_piece_size()
        pieces = [self._b.id_to_piece(k) for k in range(n)]
        self.a_bytes = [b""] * (max(self._a.ranks.values()) + 1)
        for own, k in self._a.ranks.items():
            self.a_bytes[k] = own
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(k) else p.replace(_BLANK, " ").encode()
            for k, p in enumerate(pieces)
        ]
        self._lone = self._b.piece_to_id(_BLANK)
        self._chunked = not any(re.search(f"[^{_BLANK}]{_BLANK}|\n", p) for p in pieces)
        #: For each id of A, the id of B with the same bytes; -1 where there is none.
        by_bytes = {own: k for k, own in enumerate(self.b_bytes) if self._b.is_byte(k)}
        by_bytes |= {own: k for k, own in enumerate(self.b_bytes) if not (self._b.is_byte(k) or self._b.is_control(k))}
        self.same = np.array([by_bytes.get(own, -1) if own else -1 for own in self.a_bytes], np.int64)
        self._a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self._b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        a_text = [f"{k}{end}" for end in ",|" for k in range(len(self.a_bytes))]
        b_text = [f"{k}{end}" for end in (",", ";", "\n") for k in range(n)]
        self._texts = a_text + b_text
        self.forget()

    def forget(self) -> None:
        self._code: dict[str, int] = {}  # -1 where the bytes differ
        self._text: list[str] = []  # the groups of each chunk as text
        self._counts = np.empty((0, 5), np.int64)  # tokens of A, of B, groups, single groups, others
        self._single, self._keys = np.empty(0, np.int32), np.empty(0, np.int64)  # chunk after chunk
        self._pairs: dict[int, np.ndarray] = {}

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(" " + text) if self._chunked else [" " + text]

    def _ids(self, chunks: list[str], raw: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunks whose bytes both give, the ids of A and B one after the other, and their numbers."""
        # A cuts before white space that follows a character, so one call does for all such chunks.
        joined = [k for k, c in enumerate(chunks) if not c[-1].isspace()]
        apart = [k for k, c in enumerate(chunks) if c[-1].isspace()]
        a = [self._a.ordinary("".join(chunks[k] for k in joined)), *(self._a.ordinary(chunks[k]) for k in apart)]
        chunks, raw = [chunks[k] for k in joined + apart], [raw[k] for k in joined + apart]
        a = np.fromiter(chain.from_iterable(a), np.int64)
        size = np.array([*map(len, raw)], np.int64)
        n_a = np.diff(np.searchsorted(np.cumsum(self._a_size[a]), np.cumsum(size), "right"), prepend=0)
        b_ids = self._b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        b_ids = [ids[1:] if c[0] != " " else ids if len(c) > 1 else [self._lone] for c, ids in zip(chunks, b_ids, strict=True)]
        n_b = np.array([*map(len, b_ids)], np.int64)
        b = np.fromiter(chain.from_iterable(b_ids), np.int64)
        own = np.bincount(np.repeat(np.arange(len(chunks)), n_b), self._b_size[b], len(chunks))
        if (own == size).all() and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == b"".join(raw):
            return chunks, a, b, n_a, n_b
        ok = np.array([b"".join(map(self.b_bytes.__getitem__, ids)) == r for ids, r in zip(b_ids, raw, strict=True)])
        for k in np.flatnonzero(~ok).tolist():
            self._code[chunks[k]] = -1
        chunks = [chunks[k] for k in np.flatnonzero(ok).tolist()]
        return chunks, a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)], n_a[ok], n_b[ok]

    def _learn(self, chunks: list[str]) -> None:
        """Align chunks not met before."""
        chunks, a, b, n_a, n_b = self._ids(chunks, [c.encode() for c in chunks])
        if not chunks:
            return
        a_end, b_end = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        total = int(a_end[-1])
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[a_end], at_b[b_end] = True, True
        # A token's group is the number of common ends before it.
        a_last, b_last = at_b[a_end], at_a[b_end]
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        groups = int(a_last.sum())
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_first, b_first = np.cumsum(a_in) - a_in, np.cumsum(b_in) - b_in
        one = (a_in == 1) & (b_in == 1)
        one[one] = self.same[a[a_first[one]]] == b[b_first[one]]
        # Text: of each group the ids of A, then those of B.
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + b_first[a_group]] = a + len(self.a_bytes) * a_last
        end = 2 * len(self.a_bytes) + len(self.b_bytes) * b_last
        end[np.cumsum(n_b) - 1] += len(self.b_bytes)
        order[np.arange(len(b)) + (a_first + a_in)[b_group]] = b + end
        text = "".join(map(self._texts.__getitem__, order.tolist())).split("\n")
        # Links: at every end of a token, the two tokens that lie before it.
        ends = np.flatnonzero(at_a | at_b)
        link_a, link_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        pair, link_group = a[link_a] << 32 | b[link_b], a_group[link_a]
        links = np.bincount(link_group, minlength=groups)
        link_first = np.cumsum(links) - links
        place = np.arange(len(pair)) - link_first[link_group]
        hashed = _mixed(_mixed(pair.astype(np.uint64)) + place.astype(np.uint64) * _MIX[0])
        key = _mixed(np.add.reduceat(hashed, link_first)).view(np.int64)
        for k, g in zip(*(x.tolist() for x in np.unique(np.where(one, 0, key), return_index=True)), strict=True):
            if not one[g] and k not in self._pairs:
                self._pairs[k] = pair[link_first[g] : link_first[g] + links[g]].copy()
        # What each chunk holds.
        of_chunk = np.repeat(np.arange(len(chunks)), n_a)[a_first]
        n_groups = np.bincount(of_chunk, minlength=len(chunks))
        n_one = np.bincount(of_chunk[one], minlength=len(chunks))
        self._code.update(zip(chunks, range(len(self._text), len(self._text) + len(chunks)), strict=True))
        self._text += text[:-1]
        self._counts = np.concatenate([self._counts, np.stack([n_a, n_b, n_groups, n_one, n_groups - n_one], axis=1)])
        self._single = np.concatenate([self._single, a[a_first[one]].astype(np.int32)])
        self._keys = np.concatenate([self._keys, key[~one]])

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, digest, single ids, their numbers, keys, their numbers) for each text.

        Then the vector of single groups by ids of A over all texts, and all keys with their numbers.
        """
        split = [self.chunks(t) if t else [] for t in texts]
        new = {c for own in split for c in own if c not in self._code}
        if new:
            self._learn(list(new))
        counts, single, keys = self._counts, self._single, self._keys
        first = np.cumsum(counts[:, 3:], axis=0) - counts[:, 3:]
        vector = np.zeros(len(self.a_bytes), np.int64)
        seen_keys, out = [], []
        get = self._code.__getitem__
        for own in split:
            codes = np.fromiter(map(get, own), np.int64, len(own))
            if not len(own) or codes.min() < 0:
                out.append((0, 0, 0, "", [], [], [], []))
                continue
            digest = hashlib.sha256(";".join(map(self._text.__getitem__, codes.tolist())).encode()).hexdigest()
            code, times = np.unique(codes, return_counts=True)
            held = counts[code]
            ids = single[_spread(first[code, 0], held[:, 3])]
            np.add.at(vector, ids, np.repeat(times, held[:, 3]))
            ids, n_ids = _summed(ids, np.repeat(times, held[:, 3]))
            own_keys = keys[_spread(first[code, 1], held[:, 4])]
            own_keys, n_keys = _summed(own_keys, np.repeat(times, held[:, 4]))
            seen_keys.append((own_keys, n_keys))
            out.append((*(times @ held[:, :3]).tolist(), digest, ids, n_ids, own_keys, n_keys))
        if seen_keys:
            seen, n_seen = _summed(*map(np.concatenate, zip(*seen_keys, strict=True)))
        else:
            seen, n_seen = np.empty(0, np.int64), np.empty(0, np.int64)
        return out, vector, seen, n_seen

    def pairs(self, key: int) -> np.ndarray:
        """Pairs of ids linked in an irregular group, a link each, as A's id << 32 | B's id."""
        return self._pairs[key]

    @property
    def full(self) -> bool:
        return len(self._code) > REMEMBERED


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, code = np.unique(keys, return_inverse=True)
    return out, np.bincount(code, counts, len(out)).astype(np.int64)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _frame(**columns: list) -> pd.DataFrame:
    n = len(next(iter(columns.values())))
    out = {}
    for name, kind in map(str.split, _ALIGNED.split(", ")):
        own = columns.get(name, [None] * n)
        if kind == "long":
            out[name] = pd.array(own, dtype="Int64")
        else:  # arrays stay apart, also if all are of one length
            out[name] = np.empty(n, object)
            for k, x in enumerate(own):
                out[name][k] = x
    return pd.DataFrame(out)


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = aligner(a_path, b_path)
        both.forget()
        vector = np.zeros(len(both.a_bytes), np.int64)
        seen: dict[int, int] = {}

        def groups() -> pd.DataFrame:
            return _frame(
                kind=[GROUP] * len(seen),
                pairs=[both.pairs(k) for k in seen],
                keys=[[k] for k in seen],
                keys_n=[[n] for n in seen.values()],
            )

        for batch in batches:
            size = np.cumsum([len(t) for t in batch["text"]]) // TOGETHER
            for _, part in batch.groupby(size, sort=False):
                rows, found, keys, numbers = both.align(part["text"].tolist())
                vector += found
                for k, n in zip(keys.tolist(), numbers.tolist(), strict=True):
                    seen[k] = seen.get(k, 0) + n
                n_a, n_b, n_groups, digest, single, single_n, own, own_n = zip(*rows, strict=True)
                yield _frame(
                    kind=[DOCUMENT] * len(part), row=part["row"], doc_id=part["doc_id"], n_a=n_a, n_b=n_b,
                    n_groups=n_groups, groups_sha256=digest, single=single, single_n=single_n, keys=own, keys_n=own_n,
                )
                if both.full:
                    yield groups()
                    seen.clear()
                    both.forget()
        yield groups()
        held = np.flatnonzero(vector)
        if len(held):
            yield _frame(
                kind=[VECTOR], pairs=[held << 32 | both.same[held]], keys_n=[vector[held]],
            )

    return run


def _at_most(df: DataFrame, number: str, most: int) -> Column:
    """Condition that holds for the rows with the greatest ``number``, at most ``most`` of them.

    The bound follows from counts by the number's logarithm; rows of the class that would go
    beyond ``most`` all stay out.
    """
    level = F.floor(F.log2(number) * 8).cast("int")
    classes = df.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, held = None, 0
    for c in classes:  # at most 8 * 63 rows
        held += c["count"]
        if held > most:
            break
        least = c["level"]
    return F.lit(False) if least is None else level >= least


def _scored(single, groups):
    """Sums over single groups by the vector and over frequent groups by search; other groups are left."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, top = single.value
        frequent, sums, best = groups.value
        for batch in batches:
            rows = []
            for row, ids, n_ids, own, n_own in zip(
                *(batch[name] for name in ("row", "single", "single_n", "keys", "keys_n")), strict=True
            ):
                at = np.searchsorted(frequent, own)
                at[at == len(frequent)] = 0
                hit = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
                at, n_hit = at[hit], n_own[hit]
                rows.append(
                    (
                        row,
                        int((top[ids] * n_ids).sum() + (best[at] * n_hit).sum()),
                        int((count[ids] * n_ids).sum() + (sums[at] * n_hit).sum()),
                        own[~hit],
                        n_own[~hit],
                    )
                )
            yield pd.DataFrame(rows, columns=["row", "n_best", "count_sum", "keys", "keys_n"])

    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row.

    The text behind a blank is cut by A, a byte-level BPE file, and the text by B, a sentencepiece
    model that adds the blank. Offsets where tokens of both end cut them into groups; tokens whose
    bytes overlap are linked. ``n_best`` counts links whose pair of ids is the most frequent one of
    its B id over all texts, ties included; ``count_sum`` adds up those frequencies.
    ``groups_sha256`` is the digest of all groups as ``a1,a2|b1;a3|b2``.

    A group of one token each, with the same bytes, is looked up in an array from ids of A to ids of
    B and counted in a vector as long as A's vocabulary. Only other groups are counted as such: each
    task adds up equal ones, and Spark adds up their pairs. Numbers of pairs come back to the
    documents by a vector for the former and, for the latter, by arrays for the FREQUENT most
    frequent groups; all others are joined by their key.

    Null and empty texts, and those whose tokens do not join to the text (a character U+2581, say),
    have no tokens: zeros and an empty digest. Null and repeated ids stay, a row for each row.
    Special tokens in a text are plain text. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    both = aligner(a_path, b_path)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = stored(texts.mapInPandas(_aligned(a_path, b_path), _ALIGNED), "aligned")
    documents = rows.where(F.col("kind") == DOCUMENT)
    groups = stored(
        rows.where(F.col("kind") == GROUP)
        .groupBy(F.col("keys")[0].alias("key"))
        .agg(F.sum(F.col("keys_n")[0]).alias("n"), F.first("pairs").alias("pairs")),
        "groups",
    )
    singles = (
        rows.where(F.col("kind") == VECTOR)
        .select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("keys_n").alias("n"))))
        .select("pair", "n", F.lit(0).alias("held"))
    )
    linked = groups.select(F.explode("pairs").alias("pair"), "n", F.lit(1).alias("held"))
    pairs = singles.union(linked).groupBy("pair").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
    pairs = stored(pairs, "pairs").withColumn("b", F.col("pair").bitwiseAND(F.lit(2**32 - 1)))
    # At most a row per id of B.
    most = F.broadcast(pairs.groupBy("b").agg(F.max("n").alias("most")))
    pairs = stored(
        pairs.join(most, "b").select("pair", "n", "held", (F.col("n") == F.col("most")).cast("long").alias("best")),
        "scores",
    )

    # A pair held by many groups goes to all tasks, the others meet their groups by the pair.
    held = pairs.where("held > 0")
    hot = _at_most(held, "held", FREQUENT)
    held = held.select("pair", "held", F.col("n").alias("pair_n"), "best")
    few = F.broadcast(held.where(hot))
    wanted = groups.select("key", "n", F.explode("pairs").alias("pair"))
    scores = (
        wanted.join(few, "pair")
        .unionByName(wanted.join(few, "pair", "left_anti").join(held.where(~hot), "pair"))
        .groupBy("key")
        .agg(F.max("n").alias("n"), F.sum("pair_n").alias("sum"), F.sum("best").alias("best"))
    )
    scores = stored(scores, "group_scores")

    often = scores.where(_at_most(scores, "n", FREQUENT))
    sent = often.orderBy("key").toPandas()
    keys = sent["key"].to_numpy(np.int64), sent["sum"].to_numpy(np.int64), sent["best"].to_numpy(np.int64)
    known = np.flatnonzero(both.same >= 0)
    same = spark.createDataFrame(pd.DataFrame({"pair": known << 32 | both.same[known]}))
    own = pairs.join(F.broadcast(same), "pair").select("pair", "n", "best").toPandas()  # a row per id of A
    count, top = np.zeros(len(both.a_bytes), np.int64), np.zeros(len(both.a_bytes), np.int64)
    count[own["pair"].to_numpy() >> 32], top[own["pair"].to_numpy() >> 32] = own["n"], own["best"]
    context = spark.sparkContext
    scored = stored(
        documents.select("row", "single", "single_n", "keys", "keys_n").mapInPandas(
            _scored(context.broadcast((count, top)), context.broadcast(keys)), _SCORED
        ),
        "scored",
    )
    left = (
        scored.select("row", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("keys_n").alias("times"))))
        .join(scores.select("key", "sum", "best"), "key")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("sum")).alias("more_sum"), F.sum(F.col("times") * F.col("best")).alias("more_best"))
    )

    def added(name: str, more: str) -> Column:
        return (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)

    return (
        documents.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
        .join(scored.drop("keys", "keys_n"), "row")
        .join(left, "row", "left")
        .select(
            "doc_id", "n_a", "n_b", "n_groups",
            (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
            added("n_best", "more_best"), added("count_sum", "more_sum"), "groups_sha256",
        )
    )
