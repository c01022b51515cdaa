"""Similarity join of texts by the Jaccard index of their word n-grams (chosen-path join)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.storage import ship, stored

#: Sampled tokens kept for each set.
TOKENS = 64
#: Buckets up to this size are compared without another split.
BUCKET = 200
#: Larger ones that no split made small are compared in chunks of this size.
CHUNK = 2_000
#: Buckets up to this size are compared pair by pair, larger ones with leaders.
PAIRWISE = 32
#: Estimate from which on a set stands for another one: what links with the one is near the other.
SETTLED = 0.9
#: Splits below the first one, and sampled tokens by which each of them splits.
DEEPER, BRANCHES = 2, 2
#: How far below the threshold an estimate from sampled tokens may lie: five deviations.
SLACK = 0.25
#: Shingles, and sets, in a block of candidates compared exactly in one task.
BLOCK, SETS = 200_000, 2_000

_ODD = np.random.default_rng(20_011).integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FEATURES = "doc_id long, text_key long, set_id long, n_shingles int, tokens array<int>"
_NEAR = "path long, more boolean, set_id long, root long, leads boolean"
_LINKS = "set_id long, root long, n_docs long, n_texts long"


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    A run meets such a pair if its first sampled token is shared and, at each deeper level,
    at least one of the branches leads on.
    """
    met = 1.0
    for _ in range(DEEPER):
        met = 1 - (1 - threshold * met) ** BRANCHES
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * met))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; all words where there are fewer."""
    words = (text or "").lower().encode().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    runs = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        runs *= np.uint64(0x9E3779B97F4A7C15)
        runs += h[k : len(h) - width + 1 + k]
    runs ^= runs >> np.uint64(33)
    runs *= np.uint64(0xFF51AFD7ED558CCD)
    runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def sampled(hashes: np.ndarray) -> np.ndarray:
    """For each of the random orders, the first token of the set, as 32 bits."""
    least = np.full(TOKENS, 2**32 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = (hashes[at : at + 4096, None] * _ODD) >> np.uint64(32)
        np.minimum(least, part.min(axis=0), out=least)
    return least.astype(np.uint32).view(np.int32)


def _feature_batches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, counts, tokens = [], [], []
            for text in batch["text"]:
                found = shingles(text, width)
                ids.append(xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63 if len(found) else None)
                counts.append(len(found))
                tokens.append(sampled(found) if len(found) else None)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "set_id": pd.array(ids, dtype="Int64"),
                    "n_shingles": counts,
                    "tokens": tokens,
                }
            )

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the first row that it can reach."""
    n = len(linked)
    label, reach = np.arange(n), linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(reach, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least one that links between ``a`` and ``b`` lead to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        moved = label.copy()
        np.minimum.at(moved, a, low)
        np.minimum.at(moved, b, low)
        moved = moved[moved]
        if (moved == label).all():
            break
        label = moved
    return label


def _near(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Roots of the candidates in whole buckets, and which sets lead.

    In a small bucket all pairs are estimated. In a larger one, sets are taken in turn: one that none
    before stands for leads, and is compared with all that are left; those near to it are candidates, and
    those so near that it stands for them are left out from then on. All sets of a small bucket lead.
    """
    bucket = rows["key"].to_numpy()
    tokens = np.stack(rows["tokens"].to_list())
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(begin, len(bucket)))
    a, b = [], []
    at, step = np.flatnonzero(np.repeat(size <= PAIRWISE, size)), 1
    while len(at):
        at = at[at + step < len(bucket)]
        at = at[bucket[at] == bucket[at + step]]
        for k in range(0, len(at), 65_536):
            part = at[k : k + 65_536]
            part = part[(tokens[part] == tokens[part + step]).mean(axis=1) >= least]
            a.append(part)
            b.append(part + step)
        step += 1
    leads = np.ones(len(bucket), bool)
    for first, n in zip(begin[size > PAIRWISE].tolist(), size[size > PAIRWISE].tolist(), strict=True):
        left = np.arange(first, first + n)
        while len(left):
            one, left = left[0], left[1:]
            like = (tokens[left] == tokens[one]).mean(axis=1)
            near = left[like >= least]
            a.append(np.full(len(near), one))
            b.append(near)
            leads[left[like >= SETTLED]] = False
            left = left[like < SETTLED]
    ends = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (a, b))
    root = _least_linked(len(bucket), *ends)
    out = rows[["path", "more", "set_id"]].copy()
    out["root"], out["leads"] = rows["set_id"].to_numpy()[root], leads
    return out[(out["root"] != out["set_id"]) | (out["more"] & leads)]


def _near_buckets(least: float):
    """Buckets come one after the other; the last one of a batch may go on in the next."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            last = rows["key"].to_numpy() == rows["key"].iloc[-1]
            held = rows[last]
            if not last.all():
                yield _near(rows[~last].reset_index(drop=True), least)
        if held is not None and len(held):
            yield _near(held.reset_index(drop=True), least)

    return run


def _estimated(least: float):
    """Candidates between two blocks of the sets that lead in a bucket, as edges to a root."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("set_id").sort_values("set_id")
        ids = group["set_id"].to_numpy()
        tokens = np.stack(group["tokens"].to_list())
        n = len(ids)
        close = np.zeros((n, n), bool)
        for i in range(n):
            close[i] = (tokens == tokens[i]).mean(axis=1) >= least
        return pd.DataFrame({"a": ids, "b": ids[_forest(close)]}).query("a != b")

    return run


def _candidates(buckets: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): edges from sets to a root of those near to them in some bucket.

    A bucket above CHUNK is cut into chunks by a hash. What leads in its chunks is a bucket again, of
    which near copies make up little; only where most sets of a bucket lead are its blocks
    compared two by two. Sets that stand for others may each be that far from those they stand
    for, so between them the bound is lower by as much.
    """
    edges, rows = None, buckets.select("path", "set_id", "size")
    tokens = sets.select("set_id", "tokens")
    while True:
        chunks = F.ceil(F.col("size") / CHUNK)
        chunk = F.when(F.col("size") > CHUNK, F.xxhash64("path", F.pmod(F.xxhash64("set_id", F.lit(7)), chunks)))
        dealt = rows.select(
            F.coalesce(chunk, "path").alias("key"), "path", (F.col("size") > CHUNK).alias("more"), "set_id"
        ).join(tokens, "set_id")
        near = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(_near_buckets(least), _NEAR)
        near = stored(near, "near")
        found = near.where("set_id != root").select(F.col("set_id").alias("a"), F.col("root").alias("b"))
        edges = found if edges is None else edges.union(found)
        leaders = near.where("more and leads")
        before = rows.where(F.col("size") > CHUNK).select("path", F.col("size").alias("was")).distinct()
        sizes = leaders.groupBy("path").agg(F.count("*").alias("size"))
        sizes = stored(sizes.join(before, "path"), "leaders")
        if sizes.isEmpty():
            return edges
        least -= 1 - SETTLED
        many = (F.col("size") > CHUNK) & (F.col("size") > F.col("was") / 2)
        if not sizes.where(many).isEmpty():
            crowded = leaders.join(sizes.where(many), "path").withColumn("n", F.ceil(F.col("size") / CHUNK))
            compared = (
                _blocked(crowded.select("path", "set_id", "n"), "path", "n")
                .join(tokens, "set_id").groupBy("path", "i", "j").applyInPandas(_estimated(least), "a long, b long")
            )
            edges = edges.union(stored(compared, "crowded"))
        rows = leaders.select("path", "set_id").join(sizes.where(~many).select("path", "size"), "path")


def _shared_counts(rows: list[np.ndarray]) -> np.ndarray:
    """Numbers of tokens that each two of the sets share.

    Only tokens held by two sets at least, and not by all, enter the product.
    """
    n = len(rows)
    _, code, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(x) for x in rows])
    shared = np.full((n, n), int((count == n).sum()) if n > 1 else 0, np.float64)
    some = (count > 1) & (count < n)
    column = np.cumsum(some) - 1
    held = some[code]
    row, column, width = row[held], column[code[held]], int(some.sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    step = max(1024, 8_000_000 // n)
    for at in range(0, width, step):
        lo, hi = np.searchsorted(column, (at, at + step))
        dense = np.zeros((n, min(step, width - at)), np.float32)
        dense[row[lo:hi], column[lo:hi] - at] = 1
        shared += dense @ dense.T
    return shared


def _verified(width: int, threshold: float):
    """Exact links within a block of candidates, or between two blocks."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("set_id").sort_values("set_id")
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        ids, copies = group["set_id"].to_numpy(), group["copies"].to_numpy()
        block = group["block"].to_numpy()
        sets = [shingles(text, width) for text in group["text"]]
        size = np.array([len(x) for x in sets], np.float64)
        shared = _shared_counts(sets)
        union = size[:, None] + size[None, :] - shared
        linked = shared >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= block[:, None] != block[None, :]
        return pd.DataFrame(
            {
                "set_id": ids,
                "root": ids[_forest(linked)],
                "n_docs": linked @ copies,
                "n_texts": linked.sum(axis=1),
            }
        )

    return run


def _blocked(df: DataFrame, key: str, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its own block belongs to: (i, j), i <= j."""
    block = F.pmod(F.xxhash64("set_id", F.lit(7)), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    return (
        df.withColumn("block", block)
        .withColumn("other", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other", blocks)
    )


def _buckets(sets: DataFrame, runs: int) -> DataFrame:
    """(path, set_id): buckets that need no further split, or that no split made small."""
    token = F.posexplode(F.slice("tokens", 1, runs)).alias("run", "token")
    rows = sets.select("set_id", token).select(
        "set_id", F.xxhash64(F.lit(1), "run", "token").alias("path")
    )
    leaves = []
    for level in range(DEEPER + 1):
        rows = stored(rows.distinct() if level else rows, "paths")
        sizes = rows.groupBy("path").agg(
            F.count("*").alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("members")
        ).where("size > 1")
        sizes = stored(sizes, "sizes")
        small = sizes if level == DEEPER else sizes.where(F.col("size") <= BUCKET)
        # Buckets with the same members are compared once.
        small = small.groupBy("size", "members").agg(F.min("path").alias("path"))
        leaves.append(rows.join(small.select("path", "size"), "path"))
        large = sizes.where(F.col("size") > BUCKET)
        if level == DEEPER or large.isEmpty():
            break
        rows = (
            rows.join(large.select("path"), "path")
            .join(sets.select("set_id", "tokens"), "set_id")
            .select(
                "set_id",
                F.explode(
                    F.array(
                        *(
                            F.xxhash64(
                                "path",
                                (at := F.pmod(F.xxhash64("path", F.lit(b)), F.lit(TOKENS)).cast("int")),
                                F.element_at("tokens", at + 1),
                            )
                            for b in range(BRANCHES)
                        )
                    )
                ).alias("path"),
            )
        )
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def jaccard_classes(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, recall: float = 0.9999
) -> DataFrame:
    """(doc_id, text_key, class_id, n_links, n_text_links, n_copies, class_key) for each row.

    Two texts are linked if the Jaccard index of their sets of ``width``-word runs (lower
    case, words between ASCII white space) is at least ``threshold``. A class is what links
    connect; ``class_id`` is its least ``doc_id``. ``n_links`` counts other rows linked
    directly, copies included, ``n_text_links`` other sets. ``class_key`` tells classes apart
    where rows repeat an id; it is null for texts without words.

    Chosen-path join: rows with equal sets are one set. In each run a set falls in a bucket by
    a sampled token; large buckets are split again by tokens sampled for their path; small
    ones are compared by brute force on the sampled tokens, and in buckets that no split made
    small sets are compared with those that lead. Runs repeat up to ``recall``, which has to
    take no more runs than a set has sampled tokens. Candidates connected this way are then
    compared exactly on their whole texts, block by block, each pair once, so no false link
    stays and none between candidates is lost. No pairs are emitted, only counts and edges to
    roots.

    A null text counts as empty; a text without words links with nothing and is its own
    class. Texts of fewer than ``width`` words are one run of all their words. Null ids stay
    null and rank last for ``class_id``. Repeated rows are copies. Other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    features = stored(
        docs.select("doc_id", "text_key", "text").mapInPandas(_feature_batches(width), _FEATURES),
        "features",
    )
    sets = stored(
        features.where("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("rep"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("tokens").alias("tokens"),
        ),
        "sets",
    )
    runs = runs_for(recall, threshold)
    if runs > TOKENS:
        raise ValueError(f"a recall of {recall} takes {runs} runs, and a set has {TOKENS} sampled tokens")
    buckets = stored(_buckets(sets, runs), "buckets")
    groups = stored(components(_candidates(buckets, sets, threshold - SLACK), "a", "b"), "groups")
    members = groups.join(
        sets.select(F.col("set_id").alias("node"), "rep", "copies", "n_shingles"), "node"
    )
    weights = groups.join(
        sets.select(F.col("set_id").alias("node"), "n_shingles"), "node"
    ).groupBy("root").agg(
        F.ceil(F.greatest(F.sum("n_shingles") / BLOCK, F.count("*") / SETS)).alias("n")
    )
    members = _blocked(
        members.join(weights, "root").select(
            F.col("node").alias("set_id"), "root", "copies", "n",
            F.col("rep.doc_id").alias("rep_doc"), F.col("rep.text_key").alias("rep_key"),
        ),
        "root",
        "n",
    )
    members = stored(members, "members")
    # Merged at any size, so that what is shuffled grows as the texts do.
    texts = docs.join(
        members.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("rep_doc")) & (F.col("text_key") == F.col("rep_key")),
    ).select("root", "i", "j", "block", "set_id", "copies", "text")
    links = stored(
        texts.groupBy("root", "i", "j").applyInPandas(_verified(width, threshold), _LINKS), "links"
    )
    roots = components(links.select("set_id", "root"), "set_id", "root")
    counts = links.groupBy("set_id").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_texts").alias("n_texts")
    )
    joined = (
        sets.select("set_id", "rep.doc_id", "copies")
        .join(counts, "set_id", "left")
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    joined = stored(joined, "joined")
    least = joined.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = stored(
        joined.join(least, "root").select(
            "set_id",
            "class_id",
            F.col("root").alias("class_key"),
            (F.coalesce("n_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("n_texts", F.lit(0)).alias("n_text_links"),
            F.col("copies").alias("n_copies"),
        ),
        "classes",
    )
    alone = features.where("set_id is null").select(
        "doc_id", "text_key", F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(None).cast("long").alias("class_key"),
    )
    return (
        features.join(classes, "set_id")
        .select("doc_id", "text_key", "class_id", "n_links", "n_text_links", "n_copies", "class_key")
        .union(alone)
    )


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of :func:`jaccard_classes`, all columns kept.

    The row with the least id stays (nulls last), among rows with that id the one with the
    least text key, once. Texts without words all stay.
    """
    classes = stored(
        jaccard_classes(docs, **options).select("doc_id", "text_key", "class_key"), "classes"
    )
    kept = (
        classes.where("class_key is not null")
        .groupBy("class_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("rep"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_key") == F.col("rep.text_key"))
    # Fewer rows go than stay, so these are the ones to meet the texts.
    gone = stored(
        classes.where("class_key is not null").join(kept, "class_key").where(~same)
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__gone")).distinct(),
        "gone",
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    named = docs.withColumn("__key", F.xxhash64(text))
    out = named.where(worded).join(
        gone,
        F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__gone")),
        "left_anti",
    )
    repeated = classes.groupBy("doc_id", "text_key").count().where("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates(["doc_id", "__key"])
    return out.union(named.where(~worded)).drop("__key")
