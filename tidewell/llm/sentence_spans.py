"""Passages that repeat across texts, found as runs of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import ship, stored

#: A run has at least so many sentences and so many words.
SENTENCES, WORDS = 2, 20
#: Among so many words on end there is a cut: the end of a sentence or, where there is none, the
#: word of least hash. That makes 4 * GAP + WORDS - 2 words on end hold a run wherever they stand.
GAP = 8

_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?\n]+\s*|$)")
_WORD = re.compile(r"\S+\s*")
_RUNS = "doc long, text_key long, n int, own boolean, runs array<long>"
#: Bits of the map that tells runs that may repeat; 8 MB whatever the table is.
BITS = 2**26


@lru_cache(1 << 16)
def _word_hash(word: str) -> int:
    return xxhash.xxh32_intdigest(word.strip().lower().encode())


def _pieces(sentence: str) -> Iterator[str]:
    """A sentence, or if it is long, its parts between content-defined cuts.

    Of any GAP words before the last, a cut follows the one of least hash, of equal ones the last.
    Whether a word is cut after depends on fewer than GAP words on each side of it, so a shared
    passage is cut alike wherever it stands, but for that many words at its edges.
    """
    words = _WORD.findall(sentence)
    if len(words) <= GAP:
        yield sentence
        return
    hashed = [_word_hash(word) for word in words[:-1]]
    lead = len(sentence) - sum(map(len, words))
    held, begin, least = sentence[:lead], 0, -1
    for upto in range(GAP, len(words)):
        low = upto - GAP
        if least < low:
            own = hashed[upto - 1 : low - 1 if low else None : -1]
            new = upto - 1 - own.index(min(own))
        elif hashed[upto - 1] <= hashed[least]:
            new = upto - 1
        else:
            continue
        yield held + "".join(words[begin : new + 1])
        held, begin, least = "", new + 1, new
    yield "".join(words[begin:])


def sentences(text: str) -> list[str]:
    """Sentences that together are the text: up to ``.``, ``!``, ``?`` or a line end."""
    out = []
    for found in _SENTENCE.findall(text):
        if found:
            # More than 2 * GAP characters, as shorter ones cannot have more than GAP words.
            if len(found) > 2 * GAP and len(found.split()) > GAP:
                out.extend(_pieces(found))
            else:
                out.append(found)
    return out


def runs(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, end (exclusive) and hash of the shortest run from each sentence on.

    Sentences count by their lower-case words. Those without words take no part: a run
    neither starts nor ends with one.
    """
    keys, counts, at = [], [], []
    for k, part in enumerate(parts):
        words = part.lower().split()
        if words:
            keys.append(xxhash.xxh3_64_intdigest(" ".join(words)))
            counts.append(len(words))
            at.append(k)
    n = len(keys)
    if n < SENTENCES:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    end = np.searchsorted(total, total[:-1] + WORDS)  # first end with enough words
    end = np.maximum(end, np.arange(n) + SENTENCES)
    first = np.flatnonzero(end <= n)
    end = end[first]
    key = np.array(keys, np.uint64)
    hashed = np.zeros(len(first), np.uint64)
    longest = int((end - first).max()) if len(first) else 0
    for k in range(longest):
        inside = first + k < end
        hashed[inside] = hashed[inside] * np.uint64(0x9E3779B97F4A7C15) + key[first[inside] + k] + np.uint64(1)
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0xD6E8FEB86659FD93)
    hashed ^= hashed >> np.uint64(29)
    place = np.array(at, np.int64)
    return place[first], place[end - 1] + 1, hashed.view(np.int64)


def _run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts, own, found = [], [], []
        for text in batch["text"]:  # the sentences of one text at a time
            parts = sentences(text)
            keys = runs(parts)[2]
            counts.append(len(parts))
            found.append(np.unique(keys))
            own.append(len(found[-1]) < len(keys))
        yield pd.DataFrame(
            {"doc": batch["doc"], "text_key": batch["text_key"], "n": counts, "own": own, "runs": found}
        )


def _may_repeat(bits):
    """Places of runs whose bit is set, out of the runs of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            held = batch["runs"].map(len).to_numpy()
            key = np.concatenate([*batch["runs"], np.empty(0, np.int64)]).astype(np.int64)
            slot = key & (BITS - 1)
            hit = (known[slot >> 3] >> (slot & 7)) & 1 == 1
            yield pd.DataFrame({"doc": np.repeat(batch["doc"].to_numpy(), held)[hit], "run": key[hit]})

    return run


def _bit_map(runs_: DataFrame) -> bytes:
    """The bits of all runs; put together by Spark in pieces of 4 KB, of which there are BITS / 2**15."""
    slot = F.col("run").bitwiseAND(F.lit(BITS - 1))
    pieces = runs_.groupBy(F.shiftright(slot, 15).alias("piece")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit(2**15 - 1))).alias("bits")
    )
    out = bytearray(BITS // 8)
    for r in pieces.toLocalIterator():
        out[4096 * r["piece"] : 4096 * (r["piece"] + 1)] = r["bits"]
    return bytes(out)


def _without(text: str, repeated) -> tuple[str, int, int, list[tuple[int, int]]]:
    """The text without sentences of repeated runs; sentences, removed ones, removed spans."""
    parts = sentences(text)
    covered = np.zeros(len(parts) + 1, np.int64)
    first, end, key = runs(parts)
    hit = np.isin(key, np.asarray(repeated, np.int64))
    own = np.zeros(len(key), bool)  # the first place in this text
    own[np.unique(key, return_index=True)[1]] = True
    hit |= ~own
    np.add.at(covered, first[hit], 1)
    np.add.at(covered, end[hit], -1)
    gone = np.cumsum(covered)[:-1] > 0
    spans, at = [], 0
    for part, drop in zip(parts, gone, strict=True):
        if drop:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(part))
            else:
                spans.append((at, at + len(part)))
        at += len(part)
    kept = "".join(part for part, drop in zip(parts, gone, strict=True) if not drop)
    return kept, len(parts), int(gone.sum()), spans


def _removed(names: list[str]):
    """``__kept`` is null where the text stays as it is, so that no text is moved twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, parts, gone, spans = [], [], [], []
            for text, repeated, own, parts_ in zip(
                batch["text"].fillna(""), batch["__repeated"], batch["__own"], batch["__parts"], strict=True
            ):
                if repeated is None and not own:  # no run of it is removed
                    kept, n, k, found = None, parts_, 0, []
                else:
                    kept, n, k, found = _without(text, [] if repeated is None else repeated)
                texts.append(kept)
                parts.append(n)
                gone.append(k)
                spans.append([{"start": a, "end": b} for a, b in found])
            out = batch[names].copy()
            out["__kept"], out["__n"], out["__gone"], out["__spans"] = texts, parts, gone, spans
            yield out

    return run


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` and kept_text, n_sentences, n_removed, removed_spans (code points, end exclusive).

    A run is the shortest stretch of whole sentences, two at least, with WORDS words or more,
    from each sentence on. Of all places of a run in all texts, the first by (doc_id, position)
    stays; sentences covered by a run at any other place are removed, wherever the run's first
    place is. A sentence of over GAP words counts as several, between cuts that its words determine.
    Any 4 * GAP + WORDS - 2 words on end, 50, hold a run wherever they begin and end. What is removed of a
    passage are whole pieces, so words at its edges, before its first common cut and after its
    last run, may stay.

    Each text gives its different runs once; a later place in the same text is not the first
    whatever other texts hold. Over all texts a run is aggregated to the number of documents and
    the first one, which is reduced before the shuffle, and repeated runs are joined back. Only
    runs whose bit is set in a map of the repeated ones meet them, and only texts that lose something
    are cut again.

    A null text counts as empty and gives an empty ``kept_text``. Texts of one sentence or of
    fewer than WORDS words have no runs and stay. Rows that repeat an id are one document: what
    they share stays in all of them. A row with a null id is a document by its text and comes after
    those with ids. Other columns are kept.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    by_text = F.lit(2**62) + F.pmod(F.xxhash64(text), F.lit(2**62))
    keyed = (
        docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), by_text))
        .withColumn("__key", F.xxhash64(text))
    )
    spans = stored(
        keyed.select(F.col("__id").alias("doc"), F.col("__key").alias("text_key"), text.alias("text"))
        .mapInPandas(_run_batches, _RUNS),
        "runs",
    )
    places = spans.select("doc", F.explode("runs").alias("run"))
    repeated = places.groupBy("run").agg(F.count("*").alias("n"), F.min("doc").alias("first_doc"))
    repeated = stored(repeated.where("n > 1").select("run", "first_doc"), "repeated")
    # Most runs stand in one document: they need not be moved again.
    bits = spark.sparkContext.broadcast(_bit_map(repeated))
    places = spans.select("doc", "runs").mapInPandas(_may_repeat(bits), "doc long, run long")
    flagged = (
        places.join(repeated, "run").where("doc != first_doc")
        .groupBy("doc").agg(F.collect_set("run").alias("repeated"))
    )
    states = stored(spans.select("doc", "text_key", "n", "own").distinct().join(flagged, "doc", "left"), "states")
    states = states.toDF(*(f"__{c}" for c in ("doc", "text_key", "parts", "own", "repeated")))
    names = docs.columns
    # Merged at any size, so that what is shuffled grows as the texts do.
    joined = keyed.join(
        states.hint("merge"), (F.col("__id") == F.col("__doc")) & (F.col("__key") == F.col("__text_key"))
    )
    joined = joined.drop("__doc", "__id", "__key", "__text_key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = joined.mapInPandas(
        _removed(names),
        f"{schema}, __kept string, __n int, __gone int, __spans array<struct<start:int,end:int>>",
    )
    # Names that a caller already uses are replaced.
    return out.select(
        *(F.col(f"`{n}`") for n in names if n not in ("kept_text", "n_sentences", "n_removed", "removed_spans")),
        F.coalesce("__kept", "text", F.lit("")).alias("kept_text"),
        F.col("__n").alias("n_sentences"),
        F.col("__gone").alias("n_removed"),
        F.col("__spans").alias("removed_spans"),
    )
