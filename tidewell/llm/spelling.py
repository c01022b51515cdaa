"""Spelling variants of words, found by an index of grams of variable length."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import ship, stored

#: Fewest code points and occurrences of a word, and how much more frequent its form has to be.
LENGTH, OCCURRENCES, TIMES = 7, 2, 10
#: Shortest and longest gram. A word of LENGTH keeps a gram through any edit: LENGTH - Q_MIN + 1 > Q_MAX.
Q_MIN, Q_MAX = 2, 5
#: Occurrences from which on a gram's list is not merged as one but split by words less a letter.
LIST = 2_000
#: Grams of a length that are made longer: at most so many, the most frequent ones.
EXTENDED = 4_096
#: A run's document is dropped a letter where this divides the checksum.
DROPPED = 31
#: Different words that a task counts before it passes them on, and pairs that it compares together.
COUNTED, TOGETHER = 500_000, 200_000
#: Words up to this length are compared as rows of a matrix.
WIDE = 64

# Letters as Latin-1 has them; A-Z become small, all other characters blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

_POSTINGS = "key long, word string, n long, place int, size int"


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[bytes] = Counter()

    def out() -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in total], "n": [*total.values()]})

    for batch in batches:
        for mark, text in zip(batch["mark"], batch["text"], strict=True):
            begin = zlib.crc32(f"{mark}:".encode())
            own = Counter([run for run in runs(text) if len(run) >= LENGTH])
            for run, n in own.items():
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
                if h % DROPPED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LENGTH:
                        continue
                total[run] += n
            if len(total) > COUNTED:
                yield out()
                total.clear()
    if total:
        yield out()


def words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters of all texts, each less a letter where its checksum says so.

    A null text has none; a null id counts as an empty text in the checksum.
    """
    ship(docs.sparkSession)
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("mark"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    counted = named.mapInPandas(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[str] = Counter()
    for batch in batches:
        for word in batch["word"]:
            for q in range(Q_MIN, Q_MAX + 1):
                total.update([word[k : k + q] for k in range(len(word) - q + 1)])
            if len(total) > COUNTED:
                yield pd.DataFrame({"gram": [*total], "n": [*total.values()]})
                total.clear()
    if total:
        yield pd.DataFrame({"gram": [*total], "n": [*total.values()]})


def dictionary(found: DataFrame) -> dict[str, int]:
    """Grams and their occurrences in all different words.

    All grams of Q_MIN letters; a longer one is kept if the one less its last letter is kept and
    frequent. At most EXTENDED grams of a length are made longer, so with 90 letters the
    dictionary has a bound whatever the table is.
    """
    grams = stored(
        found.select("word").mapInPandas(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams"
    )
    size = F.length("gram")
    kept = grams.where(size == Q_MIN)
    out = {r["gram"]: r["n"] for r in kept.collect()}
    for q in range(Q_MIN, Q_MAX):
        total = grams.where(size == q).agg(F.sum("n")).first()[0] or 0
        least = max(LIST // 4, total // EXTENDED)
        frequent = grams.where((size == q) & (F.col("n") > least)).select(F.col("gram").alias("begin"))
        longer = grams.where(size == q + 1).join(F.broadcast(frequent), F.substring("gram", 1, q) == F.col("begin"))
        out |= {r["gram"]: r["n"] for r in longer.collect() if r["gram"][:q] in out}
    return out


def decompose(word: str, grams: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """The longest gram from each place on, as (place, size), and the most of them one edit affects.

    A gram stays as it is if the edit lies before it, or behind all letters that were read to
    choose it: its own, and the one it could not be made longer by (which may be the word's end).
    """
    n = len(word)
    out, change = [], [0] * (n + 2)
    for k in range(n - Q_MIN + 1):
        q = Q_MIN
        while q < Q_MAX and k + q < n and word[k : k + q + 1] in grams:
            q += 1
        out.append((k, q))
        change[k] += 1
        change[k + q if q == Q_MAX else k + q + 1] -= 1
    most = now = 0
    for c in change:
        now += c
        most = max(most, now)
    return out, most


def _posted(grams):
    def key(kind: bytes, text: str) -> int:
        return xxhash.xxh3_64_intdigest(kind + text.encode("latin-1")) - 2**63

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = grams.value
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"], strict=True):
                parts, most = decompose(word, known)
                named = [(known[g], g, k) for k, q in parts for g in (word[k : k + q],)]
                named.sort()
                free: set[int] = set()
                for f, g, k in named[: most + 1]:
                    if f <= LIST:
                        rows.append((key(b"g", g), word, n, k, len(g)))
                    else:  # the edit lies outside the gram, so words less a letter there are equal
                        free.update(range(k), range(k + len(g), len(word)))
                if free:
                    less = {word, *(word[:k] + word[k + 1 :] for k in free)}
                    rows.extend((key(b"w", x), word, n, -1, 0) for x in less)
            if rows:
                yield pd.DataFrame(rows, columns=["key", "word", "n", "place", "size"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _together(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with equal codes, in parts."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    at, step = np.arange(len(code) - 1), 1
    while len(at):
        at = at[at + step < len(code)]
        at = at[code[at] == code[at + step]]
        for k in range(0, len(at), TOGETHER):
            part = at[k : k + TOGETHER]
            yield order[part], order[part + step]
        step += 1


def _compared(words_: list[str]):
    """A function that says which pairs of rows are one edit apart."""
    size = np.array([*map(len, words_)], np.int64)
    short = np.where(size <= WIDE, size, 0)
    wide = int(short.max(initial=1)) or 1
    raw = [w.encode("latin-1") if len(w) <= WIDE else b"" for w in words_]
    left = np.array(raw, f"S{wide}").view(np.uint8).reshape(-1, wide)
    right = np.array([w[::-1] for w in raw], f"S{wide}").view(np.uint8).reshape(-1, wide)

    def common(side: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = side[a] != side[b]
        return np.where(differ.any(axis=1), differ.argmax(axis=1), wide)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        begin = common(left, a, b)
        out = np.minimum(begin, low) + np.minimum(common(right, a, b), low) >= high - 1
        out &= (high - low <= 1) & (begin < high)
        for k in np.flatnonzero(high > WIDE):
            out[k] = one_edit(words_[a[k]], words_[b[k]])
        return out

    return near


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs one edit apart within whole lists, each with the lesser word first.

    Where a list is of a gram, words on it are compared if what stands before the gram, or what
    stands behind it, is equal too, as one edit leaves one side alone.
    """
    rows = rows[rows["key"].duplicated(keep=False)].reset_index(drop=True)
    words_, n = rows["word"].tolist(), rows["n"].to_numpy()
    key = pd.factorize(rows["key"])[0]
    gram = rows["place"].to_numpy() >= 0
    cut = list(zip(words_, rows["place"], rows["size"], strict=True))
    near = _compared(words_)
    out_a, out_b = [], []
    sides = [w[: k + q] if k >= 0 else "" for w, k, q in cut], [w[k:] if k >= 0 else "" for w, k, q in cut]
    for turn, side in enumerate(sides):
        chosen = np.arange(len(key)) if turn == 0 else np.flatnonzero(gram)
        code = key[chosen] * (len(key) + 1) + pd.factorize(np.array(side, object)[chosen])[0]
        for a, b in _together(code):
            a, b = chosen[a], chosen[b]
            hit = near(a, b)
            out_a.append(a[hit])
            out_b.append(b[hit])
    a, b = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (out_a, out_b))
    text = np.array(words_, object)
    swap = text[a] > text[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    return pd.DataFrame({"a": text[a], "n_a": n[a], "b": text[b], "n_b": n[b]}).drop_duplicates(["a", "b"])


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lists come one after the other; the last one of a batch may go on in the next."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = rows["key"].to_numpy() == rows["key"].iloc[-1] if len(rows) else np.empty(0, bool)
        held = rows[last]
        found = _merged(rows[~last])
        if len(found):
            yield found
    if held is not None and len(found := _merged(held)):
        yield found


def near_words(found: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) for every two words of ``found`` (word, n) that are one edit apart, a < b.

    Each word is decomposed into the longest grams of the dictionary. One edit affects at most so
    many of a word's grams, by a bound of its own; so of two words one edit apart one gram that
    both hold is among the rarest of each, as many as the bound and one more. Only those are
    listed, and the lists merged: words on a list are compared if one side of the gram is equal.
    A list holds at most as many entries as the gram has occurrences; a gram with over LIST of them
    has a list for each word less a letter outside the gram, which 90 letters bound.
    """
    spark = found.sparkSession
    ship(spark)
    grams = spark.sparkContext.broadcast(dictionary(found))
    posted = found.select("word", "n").mapInPandas(_posted(grams), _POSTINGS)
    lists = posted.repartition("key").sortWithinPartitions("key")
    return lists.mapInPandas(_merge, "a string, n_a long, b string, n_b long").distinct()


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text).

    Words are those of :func:`words` with at least LENGTH code points. ``n_near`` counts words
    exactly one edit apart. ``form`` is the most frequent of them (ties: least in code-point order) if it
    has at least TIMES as many occurrences, ``form_n`` its number; ``root`` is where forms of forms lead, the word
    itself where it has none.

    Null and empty texts have no words; null ids count as empty in the checksum, repeated rows as
    rows. Other columns are ignored. No rows give no rows.
    """
    found = stored(words(docs), "words")
    pairs = stored(near_words(found), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a")
    )
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    judged = stored(
        found.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # A form has TIMES as many occurrences, so few steps reach the root, and each doubles its way.
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots"
        )
        roots = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            break
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
