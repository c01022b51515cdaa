"""What the physical plans of the queries must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tidewell.operators.keyed_order import KeyedOrder
from tidewell.plans import marts, staging
from tidewell.workload import tables

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def bare(line: str) -> str:
    return re.sub(r"^[\s:+\-]*(\*\(\d+\) )?", "", line)


@pytest.mark.parametrize("name", list(queries()))
def test_no_row_moves_to_a_single_task_and_no_python(spark, sf, name):
    lines = plan(queries()[name](spark, sf)).splitlines()
    for i, line in enumerate(lines):
        assert not any(word in line for word in FORBIDDEN), line
        if "Exchange SinglePartition" in line:
            # only the partial results of a global aggregate, one row per task
            assert "Aggregate" in bare(lines[i + 1]) and "keys=[]" in re.sub(
                r"\bkey=", "keys=", lines[i + 1]
            ), lines[i + 1]


def scans(df) -> list[str]:
    return re.findall(r"FileScan parquet .*", plan(df))


def test_filter_and_columns_reach_the_scan(spark, sf):
    found = scans(queries()["membership_join"](spark, sf))
    [orders] = [s for s in found if "orders.parquet" in s]
    assert "EqualTo(o_orderpriority,1-URGENT)" in orders
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in orders


def test_ranking_reads_only_the_columns_it_uses(spark, sf):
    found = scans(queries()["card_top10_games"](spark, sf))
    for scan in found:
        assert "l_extendedprice" not in scan and "p_retailprice" not in scan


def test_streaks_use_one_shuffle_after_the_daily_rows(spark, sf):
    history = tables.game_log(spark, sf).withColumnRenamed("loaded_at", "valid_from")
    daily = marts.game_daily_stats(staging.stg_games_history(history))
    # the plan is a line of nodes; a subquery hangs off it on the left
    main = re.findall(r"^\s*\+- .*", plan(marts.game_freshness(daily)), re.M)
    # by (game, day) for the daily rows, then by game for all windows and groups
    assert sum("Exchange hashpartitioning" in line for line in main) == 2


def test_global_rank_shuffles_once_per_ranked_column(spark, sf):
    text = plan(queries()["global_rank"](spark, sf))
    # three ranks of two columns
    assert len(re.findall(r"Exchange hashpartitioning\(__bucket_\w+#\d+, __lane", text)) == 2


def chained(spark, sf, steps: int, floor: int):
    """One or three steps on events, where a user in three is the same, and the jobs they start."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    events = events.select((F.col("user_id") % 3).alias("k"), "event_id", "value")
    context = spark.sparkContext
    context.setJobGroup(f"building {steps}", "")
    ordered = KeyedOrder.of(events, ["k"], ["event_id"], floor).previous(was="value")
    if steps == 3:
        ordered = ordered.running_sum("total", "value").following(then="value")
    df = ordered.rows()
    jobs = context.statusTracker().getJobIdsForGroup(f"building {steps}")
    context.setJobGroup("", "")
    return df, jobs


def test_steps_share_their_reads_and_start_no_job(spark, sf):
    one, jobs_of_one = chained(spark, sf, 1, floor=100)
    three, jobs_of_three = chained(spark, sf, 3, floor=100)
    assert not jobs_of_one and not jobs_of_three
    assert len(scans(three)) == len(scans(one))


def test_without_hot_keys_the_plan_is_the_plain_window(spark, sf):
    df, _ = chained(spark, sf, 3, floor=10**6)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "Join" not in final and "Union" not in final
    assert final.count("Exchange hashpartitioning") == final.count("FileScan") == 1
