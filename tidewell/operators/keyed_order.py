"""Ordered per-key work (previous row, next row, running sum) that survives hot keys.

A window partitioned by key puts all rows of a key into one task. Where a key can
hold a large part of the table, its rows are cut into chunks along the order
columns first. The windows then run per (key, chunk). Of each chunk a summary is kept: its first
and last row, the first row that a filter is sure to leave, and its sums. Summaries of
one key are put in order, and one row per chunk says what enters it from both sides, for all
steps of a chain at once.

Which keys are large is found inside the plan, and only their rows are cut: the others take the plain
window. Without large keys adaptive execution leaves out their side of the plan, as it sees that
there are none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.bounds import (
    bound_bits,
    bounds_below,
    has_quantiles,
    quantile_bounds,
    require_quantiles,
)

# a key below this many rows is never split: one task sorts it in about a second
SPLIT_FLOOR = 1_000_000
# a key above this many rows is always split, however large a share of one task is
SPLIT_CEILING = 16_000_000

_CHUNK = "__chunk"


def join_same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on equal ``names`` where NULL equals NULL, keeping the names of ``left`` only.

    ``right`` is often derived from ``left``, so its key columns are renamed first.
    """
    right = right.withColumnsRenamed({n: f"__key_{n}" for n in names})
    same = reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__key_{n}")) for n in names]
    )
    return left.join(right, same, how).drop(*[f"__key_{n}" for n in names])


def heavy_keys(df: DataFrame, keys: Sequence[str], floor: int = SPLIT_FLOOR) -> DataFrame | None:
    """Keys with more rows than a fair share of one task, or None if there are none.

    At most ``spark.sql.shuffle.partitions`` keys can hold more than 1 / partitions of the
    rows, and one for every SPLIT_CEILING rows more than that, so the result is small
    whatever the data is. Only two numbers come to the driver.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(floor, min((total or 0) // partitions, SPLIT_CEILING))
    if largest is None or largest <= limit:
        return None
    return counts.filter(F.col("n") > limit).select(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], floor: int = SPLIT_FLOOR) -> DataFrame:
    """The :func:`heavy_keys` as a plan of their own, which has no rows if there are none."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    share = F.call_function("div", counts.agg(F.sum("n")).scalar(), F.lit(partitions))
    limit = F.greatest(F.lit(floor), F.least(share, F.lit(SPLIT_CEILING)))
    return counts.filter(F.col("n") > limit).select(*keys)


def _chunk_number(cut: Mapping[str, Column], bits: int) -> Column:
    """Ascending numbers: NULL, then by turns the gaps between bounds and the bounds themselves.

    A value that stands 2**j times among the bounds has about that share of the rows. It is cut
    in 2**j by the tie-break, so there are never more than about two chunks per bound.
    """
    value, below = cut["cut"], F.col("__below_cut")

    def is_bound(further: int) -> Column:
        return F.coalesce(F.get(F.col("__bounds")["cut"], below + further) == value, F.lit(False))

    place = F.when(value.isNull(), 0).otherwise(1 + 2 * below + is_bound(0).cast("int")).cast("bigint")
    if "tie" not in cut:
        return place
    part = F.when(value.isNull(), F.col("__below_tie")).otherwise(0)
    for j in range(1, bits):
        part = F.when(is_bound(2**j - 1), F.shiftright("__below_tie", bits - j)).otherwise(part)
    return place * 2**bits + part


def _plus(a: Column, b: Column) -> Column:
    """A sum that leaves out NULLs, as sums of columns do."""
    return F.coalesce(a + b, a, b)


@dataclass(frozen=True)
class _Chain:
    """Steps that one pass and one table of summaries settle.

    At most one look back comes first, then columns and filters made from it, then one look ahead and
    running sums in any order. So only the first row of a chunk can depend on what is before it.
    """

    back: dict[str, str] = field(default_factory=dict)
    between: tuple[dict[str, Column] | Column, ...] = ()
    ahead: dict[str, str] = field(default_factory=dict)
    sums: dict[str, str] = field(default_factory=dict)
    names: tuple[str, ...] = ()  # of what looks ahead or sums up, as it was called for

    def looked_back(self, df: DataFrame, near: Column) -> DataFrame:
        """The values of the row before and what is made from them; filters go to ``__alive``."""
        df = df.withColumns({dst: near[dst] for dst in self.back})
        alive = F.lit(True)
        for step in self.between:
            if isinstance(step, dict):
                df = df.withColumns(step)
            else:
                df = df.withColumn("__alive", alive & F.coalesce(step, F.lit(False)))
                alive = F.col("__alive")
        return df.withColumn("__alive", alive)

    def probed(self) -> dict[str, Column]:
        """What a row gives to others, under names of our own."""
        sums = {f"__part_{i}": F.col(c) for i, c in enumerate(self.sums.values())}
        if not self.ahead:
            return sums
        return {"__given": F.struct(*[F.col(c).alias(n) for n, c in self.ahead.items()]), **sums}


class KeyedOrder:
    """Rows of each key in ascending order of ``order``.

    ``order`` must be unique within a key apart from its later columns acting as
    tie-breaks. Chunks are cut on its first column; rows of a frequent value are cut on the
    second one if quantiles can order it. Ties never straddle an edge.

    Steps are collected and put in one plan by :meth:`rows`. A step that cannot join the ones before
    it (a second look back, say, or a filter after a running sum) begins a new chain on their result.
    ``chunked`` are the rows of hot keys with the chunk of each, ``df`` all others.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        chunked: DataFrame | None = None,
        chain: _Chain | None = None,
    ):
        self.df = df
        self.keys = list(keys)
        self.order = list(order)
        self.chunked = chunked
        self._chain = chain or _Chain()

    @classmethod
    def bounded(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> KeyedOrder:
        """For groups with a known small size, such as one row per key and day."""
        return cls(df, keys, order)

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        floor: int = SPLIT_FLOOR,
        sized_by: DataFrame | None = None,
        merge_copies: bool = False,
    ) -> KeyedOrder:
        """Splits hot keys only, which the plan looks for itself: no job runs here.

        ``sized_by`` is a cheaper table to count keys in, such as the one that ``df`` was
        made of: what counts is that no hot key is missed. Say ``merge_copies`` if the
        result is the same when identical rows are merged: a chunk cannot split them, so
        those of hot keys are then reduced before the shuffle.
        """
        # at any size, so that growing data does not change what is accepted
        require_quantiles(df, order[:1])
        # at most one for each shuffle partition and for every SPLIT_CEILING rows
        hot = F.broadcast(hot_keys(df if sized_by is None else sized_by, keys, floor))
        hot_rows = join_same(df, hot, keys, "left_semi")

        bits = bound_bits(df.sparkSession)
        cut = {"cut": F.col(order[0])}
        if len(order) > 1 and has_quantiles(df, order[1]):
            cut["tie"] = F.col(order[1])
        bounds = quantile_bounds(hot_rows, cut, bits)
        chunked = bounds_below(hot_rows.distinct() if merge_copies else hot_rows, cut, bounds, bits)
        chunked = chunked.select(*df.columns, _chunk_number(cut, bits).alias(_CHUNK))
        return cls(join_same(df, hot, keys, "left_anti"), keys, order, chunked)

    def previous(self, **columns: str) -> KeyedOrder:
        """Add ``new=column`` holding the column's value on the key's previous row."""
        return self._settled()._chained(back=columns)

    def following(self, **columns: str) -> KeyedOrder:
        """Add ``new=column`` holding the column's value on the key's next row."""
        at = self._settled() if self._chain.ahead or set(columns.values()) & set(self._chain.names) else self
        return at._chained(ahead=columns, names=(*at._chain.names, *columns))

    def running_sum(self, name: str, column: str) -> KeyedOrder:
        """Add the sum of ``column`` over the key's rows up to and including this one."""
        at = self._settled() if column in self._chain.names else self
        return at._chained(sums={**at._chain.sums, name: column}, names=(*at._chain.names, name))

    def with_columns(self, columns: Mapping[str, Column]) -> KeyedOrder:
        """Add columns; neither keys nor the order may change by them."""
        return self._between(dict(columns), lambda df: df.withColumns(dict(columns)))

    def filter(self, condition: Column) -> KeyedOrder:
        return self._between(condition, lambda df: df.filter(condition))

    def rows(self) -> DataFrame:
        done = self._settled()
        return done.df if done.chunked is None else done.df.unionByName(done.chunked.drop(_CHUNK))

    def _chained(self, **changes) -> KeyedOrder:
        return KeyedOrder(self.df, self.keys, self.order, self.chunked, replace(self._chain, **changes))

    def _between(self, step, applied) -> KeyedOrder:
        if self._chain.back and not self._chain.names:
            return self._chained(between=(*self._chain.between, step))
        at = self._settled()
        chunked = None if at.chunked is None else applied(at.chunked)
        return KeyedOrder(applied(at.df), self.keys, self.order, chunked)

    def _settled(self) -> KeyedOrder:
        """The result of the steps so far, without steps to come."""
        if self._chain == _Chain():
            return self
        chunked = None if self.chunked is None else self._over_chunks()
        return KeyedOrder(self._plain(), self.keys, self.order, chunked)

    def _window(self, *more: str):
        return Window.partitionBy(*self.keys, *more).orderBy(*[F.col(c).asc() for c in self.order])

    def _given_back(self) -> Column:
        return F.struct(*[F.col(src).alias(dst) for dst, src in self._chain.back.items()])

    def _plain(self) -> DataFrame:
        chain, window, df = self._chain, self._window(), self.df
        if chain.back:
            df = df.withColumn("__near", F.lag(self._given_back(), 1).over(window))
            df = chain.looked_back(df, F.col("__near"))
            df = (df.filter("__alive") if chain.between else df).drop("__near", "__alive")
        ahead = {n: F.lead(c, 1).over(window) for n, c in chain.ahead.items()}
        sums = {n: F.sum(c).over(window) for n, c in chain.sums.items()}
        return df.withColumns({n: {**ahead, **sums}[n] for n in chain.names}) if chain.names else df

    def _local(self) -> DataFrame:
        """Rows with the one before them in their chunk and what they give to others.

        The first row of a chunk is ``__open``: what it gives may depend on the chunk before.
        """
        chain, gives, df = self._chain, self._chain.probed(), self.chunked
        if not chain.back:
            return df.withColumns({**gives, "__open": F.lit(False), "__alive": F.lit(True)})
        df = df.withColumn("__near", F.lag(self._given_back(), 1).over(self._window(_CHUNK)))
        # a step may replace columns: it does so for good only when the whole row is known
        row = F.struct(*df.columns).alias("__row")
        seen = chain.looked_back(df.select("*", row), F.col("__near")).withColumns(gives)
        # NULL only on the outermost row of a chunk: a struct of NULLs is not NULL
        return seen.select("__row.*", "__alive", *gives).withColumn("__open", F.isnull("__near"))

    def _carried(self) -> DataFrame:
        """What enters each chunk from those of its key before and after it."""
        chain, group = self._chain, [*self.keys, _CHUNK]
        parts = [f"__part_{i}" for i in range(len(chain.sums))]
        place, sure = F.struct(*self.order), ~F.col("__open") & F.col("__alive")
        summary = [F.sum(F.when(sure, F.col(c))).alias(c) for c in parts]
        if chain.ahead:
            summary.append(F.min_by("__given", F.when(sure, place)).alias("__given"))
        if chain.back:
            rest = F.struct(*[c for c in self.chunked.columns if c not in group])
            summary.append(F.max_by(self._given_back(), place).alias("__last"))
            summary.append(F.first(F.when(F.col("__open"), rest), ignorenulls=True).alias("__row"))
        edges = self._local().groupBy(*group).agg(*summary)

        # at most one row per bound and key
        by_chunk = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*self.keys).orderBy(F.col(_CHUNK).desc())
        after = after.rowsBetween(Window.unboundedPreceding, -1)
        carry = {}
        if chain.back:
            carry["__near"] = F.col("__near")
            held = [*parts, *(["__given"] if chain.ahead else [])]
            edges = edges.withColumn("__near", F.lag("__last", 1).over(by_chunk))
            edges = edges.select(*group, "__near", F.struct(F.lit(0), *held).alias("__held"), "__row.*")
            edges = chain.looked_back(edges, F.col("__near"))
            gives = {c: F.when(F.col("__alive"), v) for c, v in chain.probed().items()}
            edges = edges.select(*group, "__near", "__held", *[v.alias(c) for c, v in gives.items()])
            own = {c: F.col(c) for c in parts}
            edges = edges.withColumns(
                {f"__all{c}": _plus(v, F.col("__held")[c]) for c, v in own.items()}
                | ({"__given": F.coalesce("__given", F.col("__held")["__given"])} if chain.ahead else {})
            )
            # the first row counts for all rows of its chunk
            carry |= {c: _plus(F.sum(f"__all{c}").over(before), v) for c, v in own.items()}
        else:
            carry |= {c: F.sum(c).over(before) for c in parts}
        if chain.ahead:
            carry["__given"] = F.last("__given", ignorenulls=True).over(after)
        entering = edges.select(*group, *[v.alias(c) for c, v in carry.items()])
        return entering.select(*group, F.struct(*carry).alias("__carry"))

    def _over_chunks(self) -> DataFrame:
        chain, window = self._chain, self._window(_CHUNK)
        df = self._local()
        if chain.between:
            df = df.filter(F.col("__open") | F.col("__alive"))
        inner = {
            f"__part_{i}": F.sum(F.when(~F.col("__open"), F.col(f"__part_{i}"))).over(window)
            for i in range(len(chain.sums))
        }
        if chain.ahead:
            inner["__given"] = F.lead("__given", 1).over(window)
        if inner:
            df = df.withColumns(inner)
        types = {n: df.schema[f"__part_{i}"].dataType for i, n in enumerate(chain.sums)}
        helpers = [*inner, *(["__near"] if chain.back else []), "__open", "__alive", "__carry"]

        df = join_same(df, self._carried(), [*self.keys, _CHUNK], "left")
        carry = F.col("__carry")
        known = {}
        if chain.back:
            known["__near"] = F.coalesce("__near", carry["__near"])
        if chain.ahead:
            known["__given"] = F.coalesce("__given", carry["__given"])
        for i in range(len(chain.sums)):
            known[f"__part_{i}"] = _plus(F.col(f"__part_{i}"), carry[f"__part_{i}"])
        df = df.withColumns(known)
        if chain.back:
            df = chain.looked_back(df, F.col("__near"))
            df = df.filter("__alive") if chain.between else df
        out = {n: F.col("__given")[n] for n in chain.ahead}
        out |= {n: F.col(f"__part_{i}").cast(types[n]) for i, n in enumerate(chain.sums)}
        if chain.names:
            df = df.withColumns({n: out[n] for n in chain.names})
        return df.drop(*helpers)
