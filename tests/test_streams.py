import datetime as dt

import pytest

from lakeloom.functions.events import EVENT_ID
from lakeloom.operators.sinks import land
from lakeloom.operators.upsert import KeyedTable
from lakeloom.plans import medallion, unify
from lakeloom.sources.files import file_stream, persisted_schema
from lakeloom.streaming import dedup
from lakeloom.streaming.runs import (
    append_batches, drain, drain_batches, insert_absent_batches, late_by_batch, late_rows, state_settings,
)
from tests.conftest import rows_of

DAY = dt.datetime(2024, 1, 1)
MOMENT = dt.datetime(2024, 2, 1)


def _events(spark, rows):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=d), v) for k, d, v in rows], "k string, ts timestamp, v int")


def _run(spark, df_schema, landing, out, state, make):
    stream = file_stream(spark, f"{landing}/*", df_schema)
    return drain(make(stream), out, state, {"spark.sql.shuffle.partitions": "2"})


def test_hot_key_gives_one_row(spark, folder):
    landing, out, state = folder("landing"), folder("out"), folder("state")
    rows = _events(spark, [("hot", i % 3, i) for i in range(300)] + [(f"k{i}", 0, i) for i in range(30)])
    land(rows.repartition(6), landing, "1")
    _run(spark, rows.schema, landing, out, state, lambda s: dedup.dedup_by_key(s, ["k"], "ts", "7 days"))
    keys = [row["k"] for row in spark.read.parquet(out).select("k").collect()]
    assert sorted(keys) == sorted(["hot"] + [f"k{i}" for i in range(30)])


def test_every_late_copy_is_counted(spark, folder):
    landing, out, state = folder("landing"), folder("out"), folder("state")
    schema, late = _events(spark, []).schema, {}
    for run, rows in enumerate(([("a", 50, 1)], [("b", 51, 1)], [("late", 3, i) for i in range(10)])):
        land(_events(spark, rows), landing, str(run))
        query = _run(spark, schema, landing, out, state, lambda s: dedup.dedup_by_event_time(s, ["k"], "ts", "1 day"))
        late |= {batch: count for batch, count in late_by_batch(query).items() if count}
    assert late_rows(query) == 10 and sum(late.values()) == 10


def test_table_as_dedup_state(spark, folder):
    landing, path, state = folder("landing"), folder("silver"), folder("state")
    for run, rows in enumerate(([("a", 0, 1), ("a", 1, 2), ("b", 0, 3)], [("a", 2, 4), ("c", 0, 5)])):
        land(_events(spark, rows), landing, str(run))
        stream = file_stream(spark, f"{landing}/*", _events(spark, []).schema)
        drain_batches(stream, state, insert_absent_batches(path, ["k"], 2, newest=["ts"]))
    assert [(row[0], row[2]) for row in rows_of(KeyedTable(spark, path).rows())] == [("a", 2), ("b", 3), ("c", 5)]


def test_key_is_remembered_for_good_but_bounded_mode_forgets(spark, folder):
    def two_runs(make):
        landing, out, state = folder("landing"), folder("out"), folder("state")
        schema = _events(spark, []).schema
        for run, rows in enumerate(([("a", 0, 1), ("z", 60, 1)], [("z", 61, 2)], [("a", 90, 2)])):
            land(_events(spark, rows), landing, str(run))
            _run(spark, schema, landing, out, state, make)
        return spark.read.parquet(out).where("k = 'a'").count()

    assert two_runs(lambda s: dedup.dedup_by_key(s, ["k"], "ts", "7 days")) == 1
    assert two_runs(lambda s: dedup.dedup_within_watermark(s, ["k"], "ts", "7 days")) == 2


def test_late_rows_are_dropped_and_counted(spark, folder):
    landing, out, state = folder("landing"), folder("out"), folder("state")
    schema = _events(spark, []).schema
    make = lambda s: dedup.dedup_by_event_time(s, ["k"], "ts", "1 day")
    dropped = 0
    for run, rows in enumerate(([("a", 50, 1)], [("b", 51, 1)], [("late", 3, 1), ("c", 52, 1)])):
        land(_events(spark, rows), landing, str(run))
        dropped += late_rows(_run(spark, schema, landing, out, state, make))
    assert dropped == 1
    assert sorted(row["k"] for row in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_files_are_taken_once_and_replay_adds_nothing(spark, folder):
    landing, out, state = folder("landing"), folder("out"), folder("state")
    rows = _events(spark, [("a", 0, 1), ("b", 0, 2)])
    land(rows, landing, "1")
    log = []
    handle = append_batches(out, lambda batch, count: log.append((batch, count)))

    def crash_after_write(batch, batch_id):
        handle(batch, batch_id)
        raise RuntimeError("lost")

    stream = file_stream(spark, f"{landing}/*", rows.schema)
    with pytest.raises(Exception, match="lost"):
        drain_batches(stream, state, crash_after_write)
    drain_batches(stream, state, handle)
    assert spark.read.parquet(out).count() == 2 and log == [(0, 2), (0, 2)]
    land(_events(spark, [("c", 0, 3)]), landing, "2")
    drain_batches(file_stream(spark, f"{landing}/*", rows.schema), state, handle)
    drain_batches(file_stream(spark, f"{landing}/*", rows.schema), state, handle)
    assert spark.read.parquet(out).count() == 3


def test_schema_is_stored_once(spark, folder):
    path, schema_path = folder("data"), folder("schema")
    spark.range(3).write.parquet(path)
    first = persisted_schema(spark, path, "parquet", schema_path)
    spark.range(3).selectExpr("id", "1 as extra").write.mode("append").parquet(path)
    assert persisted_schema(spark, path, "parquet", schema_path) == first


def _envelope(spark, rows):
    return spark.createDataFrame(
        [(bytearray(body.encode()), MOMENT, offset, int(offset), "0") for body, offset in rows],
        "body binary, enqueuedTime timestamp, offset string, sequenceNumber bigint, partition string",
    )


def _batch(spark, rows):
    return spark.createDataFrame(rows, "deviceId string, timestamp string, sequence bigint")


def _unified(spark, folder, order):
    path, state, bus = folder("unified"), folder("state"), folder("bus")
    messages = _envelope(spark, [('{"deviceId": "a", "sequence": 1}', "1"), ('{"deviceId": "b", "sequence": 2}', "2")])
    land(messages, bus, "1")
    files = _batch(spark, [("a", "t1", 1), ("c", "t2", 3)])
    for route in order:
        if route == "batch":
            unify.load_batch(spark, files, path, 2, moment=MOMENT)
        else:
            unify.load_stream(file_stream(spark, f"{bus}/*", messages.schema), path, state, 2, moment=MOMENT)
    return rows_of(KeyedTable(spark, path).rows().select(EVENT_ID, "deviceId", "sequence", "offset"))


def test_batch_and_stream_order_does_not_matter(spark, folder):
    assert _unified(spark, folder, ["batch", "stream"]) == _unified(spark, folder, ["stream", "batch"])
    assert len(_unified(spark, folder, ["batch", "stream", "batch", "stream"])) == 4


def test_chain_takes_only_new_files(spark, folder):
    landing, bronze, silver, state = folder("landing"), folder("bronze"), folder("silver"), folder("state")
    table = "chain_bronze"
    counts = []
    for run, rows in enumerate(([("a", 0, 1), ("a", 0, 1), ("b", 0, 2)], [("c", 0, 3)], None)):
        if rows:
            land(_events(spark, rows), landing, str(run))
        medallion.ingest_files(spark, f"{landing}/*", f"{state}/in", table, bronze, MOMENT)
        medallion.refine_table(spark, table, bronze, silver, f"{state}/silver", ["k"], "ts")
        counts.append((spark.table(table).count(), spark.read.parquet(silver).count()))
    assert counts == [(3, 2), (4, 3), (4, 3)]
    top = medallion.serve_top(spark, silver, "chain_top", "k", 2)
    assert [row["k"] for row in top.collect()] == ["a", "b"]
    spark.sql(f"DROP TABLE {table}")


def test_state_settings_grow_with_the_source(spark, folder, monkeypatch):
    import lakeloom.streaming.runs as runs

    monkeypatch.setattr(runs, "stored_bytes", lambda *_: 100 << 30)
    assert state_settings(spark, "x")["spark.sql.shuffle.partitions"] == "800"
