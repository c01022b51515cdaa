"""Quality rules on words and lines, with line frequencies counted across documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import ship, stored

#: A line is removed if more distinct texts of its host have it than this share of the host's
#: distinct texts, and more than this number.
HOST_SHARE, HOST_TEXTS = 0.02, 20
#: A document is depleted if less than this share of its words is left.
WORDS_LEFT = 0.3
MIN_WORDS, REPEAT_PERCENT = 50, 50

_SYMBOL = re.compile(r"[#*$%&|<>]+")
_SPACE = " \t\n\x0b\x0c\r"
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_MEASURED = (
    f"row long, doc_id long, host string, text_key long, {_COUNTS}, "
    "lines array<long>, line_words array<int>"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    # Pairs are numbered anew, so that the key of a window fits 64 bits for any text.
    _, pair = np.unique(code[:-1] * len(seen) + code[1:], return_inverse=True)
    window = pair[:-1] * len(seen) + code[2:]
    _, which, count = np.unique(window, return_inverse=True, return_counts=True)
    hit = count[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= hit
    return int(covered.sum())


def measure(text: str) -> tuple[tuple[int, int, int, int, int], list[int], list[int]]:
    """The base counts, and hash and words of every line with a word.

    For the hash a line is lower case with single blanks between its words.
    """
    words = text.encode().split()
    lines, sizes, plain, dup = [], [], set(), 0
    for line in text.split("\n"):
        parts = line.lower().encode().split()
        if parts:
            if line in plain:
                dup += 1
            plain.add(line)
            lines.append(xxhash.xxh3_64_intdigest(b" ".join(parts)) - 2**63)
            sizes.append(len(parts))
    chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(len, _SYMBOL.findall(text)))
    return (len(words), chars, symbols, dup, repeated_words(words)), lines, sizes


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [measure(text) for text in batch["text"]]
        counts = np.array([x[0] for x in found], np.int64).reshape(-1, 5)
        out = batch[["row", "doc_id", "host", "text_key"]].copy()
        for k, name in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")):
            out[name] = counts[:, k]
        out["lines"] = [x[1] for x in found]
        out["line_words"] = [x[2] for x in found]
        yield out


def line_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row: doc_id, base counts, base_failed, n_lines_removed, words_left, kept.

    Words lie between ASCII white space. ``base_failed``: fewer than 50 words, or more than half
    of them in three-word windows that occur twice. A line counts once for each distinct text of
    a host, so exact copies do not make a line frequent; lines above both limits are removed
    wherever they stand in the host, and a document left with too few of its words is rejected.

    Lines are counted by hash in two aggregates, (host, line, text) and (host, line), both
    reduced before their shuffle. Frequent lines, a table without texts, are then joined to the
    lines of documents.

    A null text has no words and fails. A null host is a host of its own. Rows that repeat an
    id are measured each on their own. Other columns are ignored; no rows give no rows.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("")).alias("host"),
            F.xxhash64(text).alias("text_key"),
            text.alias("text"),
        ).mapInPandas(_measured, _MEASURED),
        "measured",
    )
    texts = measured.groupBy("host", "text_key").agg(F.count("*").alias("n")).groupBy("host").agg(
        F.count("*").alias("host_texts")
    )
    line = F.explode(F.arrays_zip("lines", "line_words")).alias("x")
    lines = measured.select("row", "host", "text_key", line).select(
        "row", "host", "text_key", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")
    )
    counted = (
        lines.groupBy("host", "line", "text_key").agg(F.count("*").alias("n"))
        .groupBy("host", "line").agg(F.count("*").alias("texts"))
        .where(F.col("texts") > HOST_TEXTS)
    )
    frequent = stored(
        counted.join(texts, "host").where(F.col("texts") > HOST_SHARE * F.col("host_texts"))
        .select("host", "line"),
        "frequent",
    )
    removed = lines.join(frequent, ["host", "line"]).groupBy("row").agg(
        F.count("*").alias("n_lines_removed"), F.sum("words").alias("removed")
    )
    base = measured.drop("lines", "line_words", "host", "text_key")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = base.join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.coalesce("n_lines_removed", F.lit(0)).cast("long").alias("n_lines_removed"),
        (F.col("n_words") - F.coalesce("removed", F.lit(0))).cast("long").alias("words_left"),
    )
    return out.withColumn(
        "kept", ~F.col("base_failed") & (F.col("words_left") >= WORDS_LEFT * F.col("n_words"))
    )
