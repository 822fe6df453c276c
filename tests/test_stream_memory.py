import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.sinks import land
from lakeloom.sources.files import file_stream
from lakeloom.streaming import dedup, memory
from lakeloom.streaming.runs import drain, drain_batches, stored_late_rows
from tests.conftest import plan_of, rows_of

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, v int"


def _events(spark, rows):
    return spark.createDataFrame([(k, None if d is None else DAY + dt.timedelta(days=d), v) for k, d, v in rows], SCHEMA)


RUNS = [
    [("hot", i % 3, i) for i in range(200)] + [("a", 0, 1), (None, 0, 2), (None, 0, 3)],
    [("hot", 1, 900), ("hot", 4, 1), ("a", 0, 5), ("b", 5, 1), (None, 0, 4)],
    [("a", 40, 1), ("hot", 4, 3)],
    [("a", 0, 7), ("a", 0, 8), ("a", 40, 9), ("c", 35, 1)],
    [("hot", 41, 1), ("c", 35, 2), ("c", 42, 2)],
]


def _own(spark, folder, within):
    landing, out, held, state = (folder(name) for name in ("landing", "out", "memory", "state"))
    handle = memory.dedup_batches(out, held, ["k"], "ts", dt.timedelta(days=10), within=within)
    for run, rows in enumerate(RUNS):
        land(_events(spark, rows), landing, str(run))
        drain_batches(file_stream(spark, f"{landing}/*", _events(spark, []).schema), state, handle)
    return out, held


def _sparks(spark, folder, make):
    landing, out, state = folder("landing"), folder("out"), folder("state")
    for run, rows in enumerate(RUNS):
        land(_events(spark, rows), landing, str(run))
        stream = file_stream(spark, f"{landing}/*", _events(spark, []).schema)
        drain(make(stream), out, state, {"spark.sql.shuffle.partitions": "2"})
    return out, state


def test_keeps_what_sparks_operator_keeps(spark, folder):
    out, held = _own(spark, folder, within=False)
    theirs, state = _sparks(spark, folder, lambda s: dedup.dedup_by_event_time(s, ["k"], "ts", "10 days"))
    keys = rows_of(spark.read.parquet(out).select("k", "ts"))
    assert keys == rows_of(spark.read.parquet(theirs).select("k", "ts")) and len(set(keys)) == len(keys)
    late = {row["batch_id"]: row["late"] for row in spark.read.parquet(f"{held}/batches").collect()}
    assert sum(late.values()) == stored_late_rows(spark, state).agg(F.sum("late")).first()[0] == 2


def test_within_the_watermark_a_key_comes_once(spark, folder):
    out, _ = _own(spark, folder, within=True)
    rows = rows_of(spark.read.parquet(out).select("k", F.datediff("ts", F.lit(DAY)).alias("day")))
    assert rows == sorted([("hot", 0), ("a", 0), (None, 0), ("b", 5), ("a", 40), ("c", 35), ("hot", 41)], key=repr)


def test_memory_that_the_watermark_has_passed_is_deleted(spark, folder):
    _, held = _own(spark, folder, within=False)
    days = spark.read.parquet(f"{held}/keys").agg(F.min("ts")).first()[0]
    assert days >= DAY + dt.timedelta(days=29)


def test_a_replayed_batch_replaces_its_rows(spark, folder):
    out, held = folder("out"), folder("memory")
    handle = memory.dedup_batches(out, held, ["k"], "ts", dt.timedelta(days=10))
    for turn in range(2):
        handle(_events(spark, RUNS[0]), 0)
    for turn in range(3):
        handle(_events(spark, RUNS[1]), 1)
    want = [(k, d) for k, d in {(k, d) for k, d, _ in RUNS[0] + RUNS[1]}]
    assert rows_of(spark.read.parquet(out).select("k", F.datediff("ts", F.lit(DAY)).alias("d"))) == sorted(want, key=repr)
    assert spark.read.parquet(f"{held}/batches").count() == 2
    handle(_events(spark, []), 2)
    assert spark.read.parquet(f"{held}/batches").count() == 2


def test_copies_of_a_hot_key_are_combined_before_the_shuffle(spark, folder):
    """Half of 40,000 rows have one key: each map task sends one row of it."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(DAY).alias("ts"), F.col("id").cast("int").alias("v"))
    kept = memory.latest_per_key(rows, ["k", "ts"], ["v"])
    plan = plan_of(kept)
    assert plan.index("WindowGroupLimit [k") < plan.index("Exchange hashpartitioning(k") < plan.rindex("WindowGroupLimit [k")
    sizes = [row["count"] for row in kept.repartition(4, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert kept.count() == 20_001 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_late_rows_outlive_the_driver(spark, folder):
    """The numbers are read from files, also in another session, and add up over runs."""
    _, state = _sparks(spark, folder, lambda s: dedup.dedup_by_event_time(s, ["k"], "ts", "10 days"))
    other = spark.newSession()
    assert stored_late_rows(other, state).agg(F.sum("late")).first()[0] == 2
    assert stored_late_rows(other, folder("none")).count() == 0
