"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.storage import ship, some_rows, stored

#: Trees, vectors wanted in a leaf, and the share of a node's vectors that go to both sides.
TREES, LEAF, SPILL = 12, 512, 0.12
#: Vectors on which the splits are fitted, and the fewest of them in a node that is split.
SAMPLE, NODE = 20_000, 32
#: A larger leaf is compared in blocks of this size.
BLOCK = 1_024
#: Vectors that are routed together.
TOGETHER = 500

_ROUTED = "key long, tree int, leaf long"
_LINKS = "key long, root long, n_rows long, n_vectors long"


class Tree:
    """Splits of one tree: a direction and the bounds of the overlap around the median.

    Where the sample gets too small to be split, each further level has one direction for the
    whole tree, and every node of the fitted part has bounds of its own for it, the quantiles of its
    sample. So the depth follows the table, while a tree's size follows the sample.
    """

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.nodes: list[tuple[np.ndarray, float, float, int, int] | None] = []
        self.more = rng.standard_normal((depth, sample.shape[1]))
        self.bounds: list[np.ndarray | None] = []  # of a node that the sample does not split: (level, low and high)
        self._grow(sample, depth, rng)
        self.levels = max((len(x) for x in self.bounds if x is not None), default=0)

    def _grow(self, sample: np.ndarray, depth: int, rng: np.random.Generator) -> int:
        here = len(self.nodes)
        self.nodes.append(None)
        self.bounds.append(None)
        around = (0.5 - SPILL / 2, 0.5 + SPILL / 2)
        if depth == 0 or len(sample) < 2 * NODE:
            self.bounds[here] = np.quantile(sample @ self.more[:depth].T, around, axis=0).T.reshape(depth, 2)
            return here
        way = rng.standard_normal(sample.shape[1])
        at = sample @ way
        low, high = np.quantile(at, around)
        left = self._grow(sample[at <= high], depth - 1, rng)
        right = self._grow(sample[at >= low], depth - 1, rng)
        self.nodes[here] = (way, low, high, left, right)
        return here

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves they fall in; a row may fall in several."""
        todo, rows, nodes = [(0, np.arange(len(vectors)))], [], []
        while todo:
            node, own = todo.pop()
            split = self.nodes[node]
            if split is None:
                rows.append(own)
                nodes.append(np.full(len(own), node))
                continue
            way, low, high, left, right = split
            at = vectors[own] @ way
            todo.append((left, own[at <= high]))
            todo.append((right, own[at >= low]))
        rows, nodes = np.concatenate(rows), np.concatenate(nodes)
        code = nodes.astype(np.int64)
        if self.levels:
            side = vectors @ self.more[: self.levels].T
            table = np.full((len(self.nodes), self.levels, 2), np.nan)
            for k, own in enumerate(self.bounds):
                if own is not None:
                    table[k, : len(own)] = own
            for level in range(self.levels):
                low, high = table[nodes, level].T
                at = side[rows, level]
                # a node that ends above this level keeps its rows on one side
                left, right = ~(at > high), at >= low
                rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([nodes[left], nodes[right]])
                code = np.concatenate([2 * code[left], 2 * code[right] + 1])
        return rows, code


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; the largest part first, so nothing overflows."""
    out = vectors.astype(np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _leaves(trees: list[Tree], unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, trees and leaves, in this order."""
    found = [tree.route(unit) for tree in trees]
    rows = np.concatenate([r for r, _ in found])
    tree = np.repeat(np.arange(len(trees)), [len(r) for r, _ in found])
    leaf = np.concatenate([x for _, x in found])
    order = np.lexsort((leaf, tree, rows))
    return rows[order], tree[order], leaf[order]


def _route(trees):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.iloc[at : at + TOGETHER]
                rows, tree, leaf = _leaves(trees.value, _unit(np.stack(part["vector"].to_list())))
                yield pd.DataFrame({"key": part["key"].to_numpy()[rows], "tree": tree, "leaf": leaf})

    return run


def _met_before(trees: list[Tree], unit: np.ndarray, a: np.ndarray, b: np.ndarray, here: tuple[int, int]) -> np.ndarray:
    """Whether the vectors of each pair share a leaf that comes before this one.

    Only linked vectors are routed again, so a row carries none of its other leaves.
    """
    out = np.zeros(len(a), bool)
    linked = np.unique(np.concatenate([a, b]))
    leaves = {}
    for at in range(0, len(linked), TOGETHER):
        part = linked[at : at + TOGETHER]
        rows, tree, leaf = _leaves(trees, unit[part])
        before = (tree < here[0]) | ((tree == here[0]) & (leaf < here[1]))
        for row, t, x in zip(part[rows[before]].tolist(), tree[before].tolist(), leaf[before].tolist(), strict=True):
            leaves.setdefault(row, set()).add((t, x))
    none: set[tuple[int, int]] = set()
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        out[k] = not leaves.get(x, none).isdisjoint(leaves.get(y, none))
    return out


def _compare(trees, threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        key, block = group["key"].to_numpy(), group["block"].to_numpy()
        here = int(group["tree"].iloc[0]), int(group["leaf"].iloc[0])
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        unit = _unit(np.stack(group["vector"].to_list()))
        close = unit @ unit.T >= threshold
        np.fill_diagonal(close, False)
        if i != j:
            close &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(close))
        new = ~_met_before(trees.value, unit, a, b, here)
        a, b = a[new], b[new]
        n, copies = len(key), group["copies"].to_numpy()
        label = np.arange(n)
        while len(a):  # the least row that links lead to
            low = np.minimum(label[a], label[b])
            moved = label.copy()
            np.minimum.at(moved, a, low)
            np.minimum.at(moved, b, low)
            moved = moved[moved]
            if (moved == label).all():
                break
            label = moved
        rows = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        found = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        out = pd.DataFrame({"key": key, "root": key[label], "n_rows": rows.astype(np.int64), "n_vectors": found})
        return out[found > 0]

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding).

    Rows are linked if the cosine of their embeddings, in double precision, is at least
    ``threshold``; ``n_links`` counts the other rows linked directly and ``component_id`` is the
    least id that links lead to. Equal embeddings are one vector with copies.

    Forest: each tree splits by random directions at the median, with an overlap that goes to both
    sides. Splits are fitted on SAMPLE vectors (those of least hash); every vector is routed by
    every tree. Vectors that share a leaf are compared exactly, a large leaf in blocks. A pair is
    counted in the first leaf both fall in, so no pairs are emitted, only counts and edges to roots.
    A pair parted by all trees is missed; the README has the recall that was measured.

    Embeddings that are null, empty, zero, or hold null or non-finite parts link with nothing, and
    vectors of different lengths do not link with each other. Null ids rank last for
    ``component_id``; a component of null ids only has a null one, and its rows are kept. Rows that
    repeat an id count as rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    sound = (
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    key = F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("vector"))
    rows = stored(rows.select("vec_id", "vector", key.alias("key")), "vectors")
    distinct = stored(
        rows.where("key is not null").groupBy("key").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector")
        ),
        "distinct",
    )
    sizes = [r["d"] for r in distinct.select(F.size("vector").alias("d")).distinct().orderBy("d").collect()]
    links = None
    for size in sizes:
        own = distinct.where(F.size("vector") == size)
        found = _links(own, threshold)
        links = found if links is None else links.union(found)
    if links is None:
        links = spark.createDataFrame([], _LINKS)
    links = stored(links, "links")
    counts = links.groupBy("key").agg(F.sum("n_rows").alias("n_rows"))
    roots = components(links, "key", "root").withColumnRenamed("node", "key")
    joined = stored(
        distinct.select("key", "copies", "least_id").join(counts, "key", "left").join(roots, "key", "left")
        .withColumn("root", F.coalesce("root", "key")),
        "joined",
    )
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    result = stored(
        joined.join(least, "root").select(
            "key", "component_id", (F.coalesce("n_rows", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "result",
    )
    linked = rows.where("key is not null").select("vec_id", "key").join(result, "key")
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def forest(sample: np.ndarray, rows: int, seed: int = 17) -> list[Tree]:
    """Trees deep enough for leaves of about LEAF of ``rows`` vectors."""
    grow = (1 + SPILL) / 2
    depth, left = 0, float(rows)
    while left > LEAF:
        left *= grow
        depth += 1
    rng = np.random.default_rng(seed)
    return [Tree(sample, depth, rng) for _ in range(TREES)]


def _links(distinct: DataFrame, threshold: float) -> DataFrame:
    n = distinct.count()
    chosen = some_rows(distinct, SAMPLE, "key").select("vector").toPandas()
    grown = forest(_unit(np.stack(chosen["vector"].to_list())), n)
    trees = distinct.sparkSession.sparkContext.broadcast(grown)  # bounded by the sample
    routed = stored(distinct.select("key", "vector").mapInPandas(_route(trees), _ROUTED), "routed")
    blocks = routed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n")).where("n > 1")
    routed = routed.join(stored(blocks, "blocks"), ["tree", "leaf"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    block = F.pmod(F.xxhash64("key", F.lit(5)), F.col("n")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    dealt = (
        routed.withColumn("block", block).withColumn("other", other)
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .drop("other", "n")
    )
    dealt = dealt.join(distinct.select("key", "vector", "copies"), "key")
    return dealt.groupBy("tree", "leaf", "i", "j").applyInPandas(_compare(trees, threshold), _LINKS)
