"""Ordered per-key operators with and without split keys, and global ranks."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.operators.keyed_order import KeyedOrder, heavy_keys
from tidewell.operators.membership import membership_flag
from tidewell.operators.quality import decreases, inconsistent_history
from tidewell.operators.ranking import RankBy, global_ranks, highest, last_per_group
from tidewell.operators.streaks import numbered_streaks


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and the NULL key hold most rows; order and values repeat across keys."""
    rng = random.Random(7)
    data = []
    for key, n in [("hot", 900), (None, 700), *[(f"k{i}", rng.randint(1, 9)) for i in range(60)]]:
        places = rng.sample(range(5000), n)
        data += [(key, p, rng.choice([None, 1, 1, 2])) for p in places]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, o int, v int").repartition(5).cache()


def test_only_large_keys_are_heavy(skewed):
    assert {r.k for r in heavy_keys(skewed, ["k"], floor=100).collect()} == {"hot", None}
    assert heavy_keys(skewed, ["k"], floor=10_000) is None


@pytest.mark.parametrize("floor", [100, 10**6])
def test_neighbours_and_running_sum_equal_plain_windows(skewed, floor):
    ordered = KeyedOrder.of(skewed, ["k"], ["o"], floor)
    # what is split shows in the rows: the plan looks for it, not the call
    assert {r.k for r in ordered.chunked.collect()} == ({"hot", None} if floor == 100 else set())
    got = ordered.previous(was="v").following(next_v="v", next_o="o").running_sum("total", "o").rows()
    w = Window.partitionBy("k").orderBy("o")
    want = skewed.select(
        "k",
        "o",
        "v",
        F.lag("v").over(w).alias("was"),
        F.lead("v").over(w).alias("next_v"),
        F.lead("o").over(w).alias("next_o"),
        F.sum("o").over(w).alias("total"),
    )
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize("floor", [100, 10**6])
def test_long_chains_equal_plain_windows(skewed, floor):
    """Sums with NULL, columns replaced on the way, filters after each kind of step."""

    def steps(ordered):
        ordered = ordered.running_sum("all_v", "v").previous(was="v", was_o="o")
        ordered = ordered.with_columns({"v": F.col("v") + F.coalesce("was", F.lit(1))})
        ordered = ordered.filter(F.col("v").isNull() | (F.col("v") > 2)).with_columns({"w": F.col("v") * 2})
        ordered = ordered.running_sum("some_w", "w").following(then="w", then_sum="some_w")
        ordered = ordered.filter("then is null or then > 2").previous(was_sum="some_w").running_sum("n", "was_o")
        return ordered.rows()

    got, want = (steps(o) for o in (KeyedOrder.of(skewed, ["k"], ["o"], floor), KeyedOrder.bounded(skewed, ["k"], ["o"])))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows(got) == rows(want) and got.count() > 100


def test_chunks_that_lose_all_rows_to_a_filter(spark):
    """One change in the middle of a hot key: most chunks keep no row at all."""
    data = [("hot", i, i // 700) for i in range(1000)] + [("cold", 1, None), ("cold", 2, 1)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(5)
    changed = ~F.col("was").eqNullSafe(F.col("v"))

    def changes(ordered):
        return rows(ordered.previous(was="v").filter(changed).following(until="o").running_sum("s", "o").rows())

    got = changes(KeyedOrder.of(df, ["k"], ["o"], floor=100))
    assert got == changes(KeyedOrder.bounded(df, ["k"], ["o"]))
    assert ("hot", 0, 0, None, 700, 0) in got and ("hot", 700, 1, 0, None, 700) in got


def test_split_key_is_spread_over_chunks(skewed):
    ordered = KeyedOrder.of(skewed, ["k"], ["o"], floor=100)
    sizes = [r["count"] for r in ordered.chunked.groupBy("k", "__chunk").count().collect()]
    assert max(sizes) < 300


@pytest.mark.parametrize("stamp", [3, None, 2.5])
def test_key_with_one_stamp_is_cut_by_the_tie_break(spark, stamp):
    kind = "double" if isinstance(stamp, float) else "int"
    data = [("hot", stamp, (i * 37) % 1000, i % 3) for i in range(1000)]
    data += [("hot", 1, 5, 1), ("hot", 9, 5, 1), ("hot", 9, None, 2), ("cold", 1, 1, 1)]
    data = [(k, None if o is None else type(stamp or 0)(o), t, v) for k, o, t, v in data]
    df = spark.createDataFrame(data, f"k string, o {kind}, t int, v int").repartition(5)
    split = KeyedOrder.of(df, ["k"], ["o", "t"], floor=100)
    sizes = [r["count"] for r in split.chunked.groupBy("k", "__chunk").count().collect()]
    assert max(sizes) < 300

    def steps(ordered):
        return rows(ordered.previous(was="v").running_sum("total", "v").following(then="t").rows())

    assert steps(split) == steps(KeyedOrder.bounded(df, ["k"], ["o", "t"]))


def test_large_keys_are_heavy_on_any_number_of_rows(skewed, monkeypatch):
    from tidewell.operators import keyed_order

    monkeypatch.setattr(keyed_order, "SPLIT_CEILING", 6)
    heavy = {r.k for r in heavy_keys(skewed, ["k"], floor=1).collect()}
    assert {"hot", None} < heavy and len(heavy) <= skewed.count() // 6


def test_filtering_between_steps_keeps_the_order_right(skewed):
    plain = KeyedOrder.bounded(skewed, ["k"], ["o"])
    split = KeyedOrder.of(skewed, ["k"], ["o"], floor=100)

    def changes(ordered):
        changed = ordered.previous(was="v").filter(~F.col("was").eqNullSafe(F.col("v")))
        return rows(changed.following(until="o").rows())

    assert changes(split) == changes(plain)


@pytest.mark.parametrize("floor", [100, 10**6])
def test_streaks_and_decreases_on_hot_keys(skewed, floor):
    df = skewed.fillna({"k": "none"})
    w = Window.partitionBy("k").orderBy("o")
    first = F.row_number().over(w) == 1
    change = F.when(first, F.col("v").isNotNull()).otherwise(
        ~F.lag("v").over(w).eqNullSafe(F.col("v"))
    )
    want = df.withColumn("is_change", change.cast("int"))
    want = want.withColumn("streak_id", F.sum("is_change").over(w))
    assert rows(numbered_streaks(df, "k", ["o"], ["v"], floor)) == rows(want)

    lower = df.withColumn("previous_value", F.lag("v").over(w)).filter("v < previous_value")
    assert rows(decreases(df, ["k"], ["o"], "v", floor)) == rows(lower)


@pytest.mark.parametrize("floor", [100, 10**6])
def test_many_copies_of_a_lower_row_are_found_once(spark, floor):
    data = [("hot", 1, 9)] + [("hot", 2, 5)] * 600 + [("hot", 3, 5), ("hot", 4, 2), ("k", 1, 3)]
    df = spark.createDataFrame(data, "k string, o int, v int")
    got = decreases(df, ["k"], ["o", "v"], "v", floor)
    assert rows(got) == [("hot", 2, 5, 9), ("hot", 4, 2, 5)]


@pytest.mark.parametrize("floor", [100, 10**6])
def test_faults_of_histories_with_hot_keys_and_copies(spark, floor):
    rng = random.Random(3)
    data = [("hot", rng.randint(0, 400), rng.choice([None, 1, 2, 3]), i == 5) for i in range(1500)]
    data += [("copies", 7, 4, False)] * 400 + [("copies", 8, 3, True)] * 2
    data += [(k, o, o % 4, o == 3) for k in "abc" for o in range(rng.randint(2, 6))]
    data += [(None, 1, 5, True), (None, None, 9, False), ("fine", 1, 1, False), ("fine", 2, 1, True)]
    df = spark.createDataFrame(data, "k string, at int, v int, now boolean").repartition(5)

    want, versions = [], {}
    for k, at, v, now in data:
        versions.setdefault(k, []).append((at, v, now))
    for k, found in versions.items():
        want += [(k, "not exactly one current version")] * (sum(now for *_, now in found) != 1)
        times = [at for at, *_ in found]
        want += [(k, "duplicate version") for at in set(times) if times.count(at) > 1]
        lowest = lambda x: (x is not None, x or 0)
        line = sorted({(at, v) for at, v, _ in found}, key=lambda row: (lowest(row[0]), lowest(row[1])))
        for (_, was), (_, v) in zip(line, line[1:]):
            want += [(k, "playtime went down")] * (None not in (was, v) and v < was)
    got = inconsistent_history(df, ["k"], "at", "now", "v", floor)
    assert rows(got) == sorted(want, key=repr)
    assert not any(k == "fine" for k, _ in want) and len(want) > 100


@pytest.mark.parametrize("floor", [100, 10**6])
def test_membership_of_hot_and_null_keys(spark, skewed, floor):
    members = spark.createDataFrame([("hot",), ("hot",), ("k1",), (None,)], "k string")
    got = membership_flag(skewed, members, ["k"], "hit", unique=False, floor=floor)
    want = skewed.withColumn("hit", F.coalesce(F.col("k").isin("hot", "k1"), F.lit(False)))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("bits", [2, 4, 7])
@pytest.mark.parametrize("kind", ["ties", "distinct", "constant", "nulls", "empty"])
def test_global_ranks_equal_plain_ranks(spark, kind, bits):
    rng = random.Random(bits)
    make = {
        "ties": lambda i: rng.choice([1.5, 2.0, 2.0, 2.0, 3.0, -1.0, None]),
        "distinct": lambda i: float((i * 7919) % 1009),
        "constant": lambda i: 4.0,
        "nulls": lambda i: None,
        "empty": None,
    }[kind]
    data = [(i, make(i)) for i in range(500)] if make else []
    df = spark.createDataFrame(data, "i int, v double").repartition(4)
    got = global_ranks(df, {"a": RankBy("v"), "b": RankBy("v", "last"), "c": RankBy("i")}, bits)
    want = df.select(
        "i",
        "v",
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).cast("bigint").alias("a"),
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint").alias("b"),
        F.rank().over(Window.orderBy(F.col("i").desc())).cast("bigint").alias("c"),
    )
    assert rows(got) == rows(want)


def test_highest_takes_null_first_and_the_lowest_tie(spark):
    data = [("x", 1, 5, "a"), ("x", 2, None, "b"), ("x", 3, None, "c"), ("y", 5, 9, "d"), ("y", 4, 9, "e")]
    df = spark.createDataFrame(data, "g string, id int, ccu int, name string")
    got = df.groupBy("g").agg(highest("name", by="ccu", tie="id").alias("top"))
    assert rows(got) == [("x", "b"), ("y", "e")]


def test_last_per_group_keeps_one_whole_row(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 3, None), ("y", None, "c")], "g string, o int, v string")
    assert rows(last_per_group(df, ["g"], ["o"])) == [("x", 3, None), ("y", None, "c")]


def test_null_stamps_lose_or_win(spark):
    data = [("x", 1, 1, "a"), ("x", None, 1, "b"), ("x", None, 2, "c"), ("x", None, None, "d")]
    df = spark.createDataFrame(data, "g string, o int, tie int, v string")
    assert rows(last_per_group(df, ["g"], ["o", "tie"])) == [("x", 1, 1, "a")]
    assert rows(last_per_group(df, ["g"], ["o", "tie"], nulls="highest")) == [("x", None, None, "d")]


@pytest.mark.parametrize("floor", [1, 10**6])
def test_texts_are_refused_at_any_size(spark, floor):
    df = spark.createDataFrame([("a", "9"), ("a", "10")], "k string, o string")
    with pytest.raises(TypeError, match="o is string"):
        KeyedOrder.of(df, ["k"], ["o"], floor)
    with pytest.raises(TypeError, match="o is string"):
        global_ranks(df, {"r": RankBy("o")})


def test_ranks_leave_columns_of_any_name_alone(spark):
    df = spark.createDataFrame([(1, 5, 7), (2, 6, 7)], "bucket int, shift int, n int")
    got = global_ranks(df, {"r": RankBy("shift"), "count": RankBy("n")})
    assert rows(got) == [(1, 5, 7, 2, 1), (2, 6, 7, 1, 1)]


@pytest.fixture
def large_cluster(spark):
    """Settings of a large cluster, failing where generated code does not compile."""
    settings = {"spark.sql.shuffle.partitions": "4000", "spark.sql.codegen.fallback": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_thousands_of_chunks(skewed, large_cluster):
    plain = KeyedOrder.bounded(skewed, ["k"], ["o"])
    split = KeyedOrder.of(skewed, ["k"], ["o"], floor=100)

    def steps(ordered):
        changed = ordered.previous(was="v").filter(~F.col("was").eqNullSafe(F.col("v")))
        return rows(changed.following(until="o").running_sum("total", "o").rows())

    assert steps(split) == steps(plain)


def test_ranks_over_thousands_of_buckets(spark, skewed, large_cluster):
    got = global_ranks(skewed, {"a": RankBy("v"), "b": RankBy("o", "last")})
    want = skewed.select(
        "*",
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).cast("bigint").alias("a"),
        F.rank().over(Window.orderBy(F.col("o").desc_nulls_last())).cast("bigint").alias("b"),
    )
    assert rows(got) == rows(want)
    assert got.filter("a <= 3 and k = 'hot'").count() == want.filter("a <= 3 and k = 'hot'").count()
