import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeloom.operators.upsert import KeyedTable, bucket_count, insert_absent, merged, replace_listed, set_where
from lakeloom.session import conf_scope
from tests.conftest import plan_of, rows_of

SCHEMA = "k int, v string, t int"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, folder, rows, buckets=4):
    table = KeyedTable(spark, folder("keyed"))
    table.create(_frame(spark, rows), ["k"], buckets, newest=["t"])
    return table


def _files(table):
    return {
        os.path.join(base, name) for base, _, names in os.walk(table.path) for name in names
        if name.endswith(".parquet")
    }


def test_update_insert_and_metrics(spark, folder):
    table = _table(spark, folder, [(1, "a", 0), (2, "b", 0), (3, "c", 0)])
    metrics = table.upsert(_frame(spark, [(2, "B", 1), (9, "z", 1)]), newest=["t"])
    assert rows_of(table.rows()) == [(1, "a", 0), (2, "B", 1), (3, "c", 0), (9, "z", 1)]
    assert (metrics.source_rows, metrics.inserted, metrics.updated, metrics.deleted) == (2, 1, 1, 0)


def test_upsert_is_idempotent(spark, folder):
    table = _table(spark, folder, [(k, "a", 0) for k in range(20)])
    batch = _frame(spark, [(k, "b", 1) for k in range(10, 30)])
    table.upsert(batch)
    before = rows_of(table.rows())
    again = table.upsert(batch)
    assert rows_of(table.rows()) == before and again.inserted == 0 and again.updated == 20


def test_source_copies_collapse_to_the_newest(spark, folder):
    table = _table(spark, folder, [(1, "a", 0)])
    table.upsert(_frame(spark, [(1, "late", 5), (1, "early", 2), (2, "x", 1), (2, "y", 3)]), newest=["t"])
    assert rows_of(table.rows()) == [(1, "late", 5), (2, "y", 3)]


def test_only_newer_keeps_later_rows(spark, folder):
    table = _table(spark, folder, [(1, "a", 5), (2, "b", 5), (3, "c", None), (4, "d", 5)])
    batch = _frame(spark, [(1, "old", 4), (2, "new", 6), (3, "x", 0), (4, "none", None), (5, "e", None)])
    metrics = table.upsert(batch, newest=["t"], only_newer=True)
    assert rows_of(table.rows()) == [(1, "a", 5), (2, "new", 6), (3, "x", 0), (4, "d", 5), (5, "e", None)]
    assert (metrics.inserted, metrics.updated) == (1, 2)


def test_null_values_overwrite(spark, folder):
    table = _table(spark, folder, [(1, "a", 0)])
    table.upsert(_frame(spark, [(1, None, None)]))
    assert rows_of(table.rows()) == [(1, None, None)]


def test_only_inserts_leave_stored_files_alone(spark, folder):
    table = _table(spark, folder, [(k, "a", 0) for k in range(50)])
    before = _files(table)
    metrics = table.upsert(_frame(spark, [(k, "n", 0) for k in range(100, 120)]))
    assert before <= _files(table) and metrics.inserted == 20 and metrics.copied == 0
    assert table.rows().count() == 70


def test_only_hit_buckets_are_rewritten(spark, folder):
    table = _table(spark, folder, [(k, "a", 0) for k in range(200)], buckets=16)
    before = _files(table)
    table.upsert(_frame(spark, [(7, "hit", 1)]))
    gone = before - _files(table)
    assert {os.path.basename(os.path.dirname(path)) for path in gone} and len(gone) < len(before) / 2
    assert rows_of(table.rows().where("v = 'hit'")) == [(7, "hit", 1)]


@pytest.mark.parametrize("lost_at", ["write", "record", "first move", "between delete and move", "after moves"])
@pytest.mark.parametrize("replay", [True, False])
def test_driver_lost_within_a_commit(spark, folder, monkeypatch, lost_at, replay):
    """Before the record the old rows stand; after it the new ones do, as soon as the
    table is opened. Replaying the batch gives the same rows and the same metrics."""
    old = [(k, "a", 0) for k in range(40)]
    table = _table(spark, folder, old, buckets=16)
    batch = _frame(spark, [(1, "hit", 1), (2, "hit", 1)] + [(k, "new", 1) for k in range(500, 520)])
    new = [row for row in old if row[0] not in (1, 2)] + [(1, "hit", 1), (2, "hit", 1)] + [(k, "new", 1) for k in range(500, 520)]
    steps = []

    def lose(*_, **__):
        raise RuntimeError("driver lost")

    def lose_later(original, after):
        def step(*args):
            steps.append(args)
            if len(steps) > after:
                lose()
            return original(*args)
        return step

    with monkeypatch.context() as patch:
        if lost_at == "write":
            patch.setattr(table, "_set_record", lose)
        elif lost_at == "record":
            patch.setattr(table, "_move", lose)
        elif lost_at == "after moves":
            original = table._set_record
            patch.setattr(table, "_set_record", lose_later(original, 1))
        else:
            patch.setattr(table, "_rename", lose_later(table._rename, 0 if lost_at == "first move" else 1))
        with pytest.raises(RuntimeError, match="driver lost"):
            table.upsert(batch, tag="b7")
    reopened = KeyedTable(spark, table.path)
    if replay:
        metrics = reopened.upsert(batch, tag="b7")
        assert (metrics.inserted, metrics.updated, metrics.source_rows) == (20, 2, 22)
        assert reopened.upsert(batch, tag="b7") == metrics
    expected = new if replay or lost_at != "write" else old
    assert rows_of(reopened.rows()) == sorted(expected, key=repr)
    assert rows_of(KeyedTable(spark, table.path).rows()) == sorted(expected, key=repr)


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_a_reader_between_the_steps_of_a_move(spark, folder, monkeypatch, steps):
    """It sees the committed rows and changes no file; the next writer ends the move."""
    old = [(k, "a", 0) for k in range(40)]
    table = _table(spark, folder, old, buckets=4)
    batch = _frame(spark, [(k, "hit", 1) for k in range(30)] + [(k, "new", 1) for k in range(500, 520)])
    new = [(k, "hit", 1) for k in range(30)] + old[30:] + [(k, "new", 1) for k in range(500, 520)]
    original, calls = table._rename, []

    def lose(*args):
        calls.append(args)
        if len(calls) > steps:
            raise RuntimeError("driver lost")
        return original(*args)

    with monkeypatch.context() as patch:
        patch.setattr(table, "_rename", lose)
        with pytest.raises(RuntimeError, match="driver lost"):
            table.upsert(batch)
    files = _files(table)
    reader = KeyedTable(spark, table.path)
    assert rows_of(reader.rows()) == sorted(new, key=repr) and _files(table) == files
    KeyedTable(spark, table.path).upsert(_frame(spark, [(900, "z", 2)]))
    assert rows_of(reader.rows()) == sorted([*new, (900, "z", 2)], key=repr)
    assert not [name for name in os.listdir(table.path) if name.startswith("_staged") or name == "_pending"]


def test_what_an_incomplete_commit_left_is_removed(spark, folder, monkeypatch):
    table = _table(spark, folder, [(1, "a", 0)])
    with monkeypatch.context() as patch:
        patch.setattr(table, "_set_record", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            table.upsert(_frame(spark, [(2, "b", 0)]))
    assert [name for name in os.listdir(table.path) if name.startswith("_staged")]
    KeyedTable(spark, table.path).append(_frame(spark, [(3, "c", 0)]))
    assert not [name for name in os.listdir(table.path) if name.startswith("_staged")]
    assert rows_of(table.rows()) == [(1, "a", 0), (3, "c", 0)]


def test_further_columns_raise_or_evolve(spark, folder):
    table = _table(spark, folder, [(1, "a", 0), (2, "b", 0)])
    more = spark.createDataFrame([(2, "B", 1, 9.5), (3, "c", 1, 1.5)], "k int, v string, t int, price double")
    for write in (table.upsert, table.append, table.insert_if_absent):
        with pytest.raises(ValueError, match="price"):
            write(more)
    metrics = table.upsert(more, evolve=True)
    assert (metrics.updated, metrics.inserted) == (1, 1)
    assert rows_of(KeyedTable(spark, table.path).rows()) == [(1, "a", 0, None), (2, "B", 1, 9.5), (3, "c", 1, 1.5)]
    with pytest.raises(ValueError, match="stored as double"):
        table.upsert(spark.createDataFrame([(1, "a", 0, "x", "y")], "k int, v string, t int, price string, other string"), evolve=True)


def test_a_replayed_append_adds_nothing(spark, folder):
    table = _table(spark, folder, [(1, "a", 0)])
    first = table.append(_frame(spark, [(2, "b", 0), (2, "c", 0)]), tag="b1")
    assert first.inserted == 2 and table.append(_frame(spark, [(2, "b", 0), (2, "c", 0)]), tag="b1") == first
    assert table.rows().count() == 3


def test_buckets_grow(spark, folder):
    rows = [(k, "a", 0) for k in range(300)]
    table = _table(spark, folder, rows, buckets=4)
    with pytest.raises(ValueError):
        table.grow(6)
    table.grow(16)
    assert KeyedTable(spark, table.path).buckets == 16 and rows_of(table.rows()) == sorted(rows, key=repr)
    assert len([name for name in os.listdir(table.path) if name.startswith("bkt=")]) == 16
    metrics = KeyedTable(spark, table.path).upsert(_frame(spark, [(7, "hit", 1), (999, "new", 1)]))
    assert (metrics.updated, metrics.inserted) == (1, 1) and metrics.copied < 60
    assert table.rows().count() == 301


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_driver_lost_while_buckets_grow(spark, folder, monkeypatch, steps):
    """Few rows, so that some buckets lose all of theirs."""
    rows = [(k, "a", 0) for k in range(5)]
    table = _table(spark, folder, rows, buckets=2)
    original, calls = table._rename, []

    def lose(*args):
        calls.append(args)
        if len(calls) > steps:
            raise RuntimeError("driver lost")
        return original(*args)

    with monkeypatch.context() as patch:
        patch.setattr(table, "_rename", lose)
        try:
            table.grow(32)
        except RuntimeError:
            pass
    assert rows_of(KeyedTable(spark, table.path).rows()) == rows
    metrics = KeyedTable(spark, table.path).upsert(_frame(spark, [(3, "hit", 1)]))
    assert (metrics.updated, metrics.inserted) == (1, 0)
    assert rows_of(table.rows()) == [(0, "a", 0), (1, "a", 0), (2, "a", 0), (3, "hit", 1), (4, "a", 0)]


def test_compact_rewrites_only_crowded_buckets(spark, folder):
    table = _table(spark, folder, [(k, "a", 0) for k in range(100)], buckets=4)
    for step in range(3):
        table.append(_frame(spark, [(1_000 + step, "n", 0)] * 2))
    before, rows = _files(table), rows_of(table.rows())
    crowded = {base for base in map(os.path.dirname, before) if sum(os.path.dirname(f) == base for f in before) > 1}
    assert table.compact(max_files=1) == len(crowded) > 0
    assert rows_of(table.rows()) == rows and len(_files(table)) == 4


def test_copies_kept_by_append_mode_are_all_updated(spark, folder):
    table = _table(spark, folder, [(1, "a", 0), (2, "b", 0)])
    table.append(_frame(spark, [(1, "a2", 0)]))
    metrics = table.upsert(_frame(spark, [(1, "new", 1)]))
    assert rows_of(table.rows()) == [(1, "new", 1), (1, "new", 1), (2, "b", 0)] and metrics.updated == 2


def test_null_key_stops_the_job(spark, folder):
    table = _table(spark, folder, [(1, "a", 0)])
    with pytest.raises(Exception, match="null in key"):
        table.upsert(_frame(spark, [(None, "x", 1)]))
    assert rows_of(table.rows()) == [(1, "a", 0)]


def test_first_run_creates_then_modes(spark, folder):
    table = KeyedTable(spark, folder("keyed"))
    assert not table.exists()
    table.write(_frame(spark, [(1, "a", 0), (1, "b", 1)]), ["k"], 2, newest=["t"])
    assert rows_of(table.rows()) == [(1, "b", 1)]
    table.write(_frame(spark, [(1, "c", 2)]), ["k"], 2, mode="append")
    assert table.rows().count() == 2
    table.write(_frame(spark, [(1, "d", 3)]), ["k"], 2)
    assert {row["v"] for row in table.rows().collect()} == {"d"}
    with pytest.raises(ValueError):
        table.write(_frame(spark, [(1, "d", 3)]), ["k"], 2, mode="replace")


def test_insert_if_absent(spark, folder):
    table = _table(spark, folder, [(1, "a", 0)])
    table.insert_if_absent(_frame(spark, [(1, "z", 9), (2, "b", 0)]))
    assert rows_of(table.rows()) == [(1, "a", 0), (2, "b", 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=10),
       st.dictionaries(st.integers(0, 9), st.integers(0, 99), min_size=1, max_size=10))
def test_merged_matches_dict_update(spark, target, source):
    schema = "k int, v int"
    out = merged(spark.createDataFrame(list(target.items()), schema),
                 spark.createDataFrame(list(source.items()), schema), ["k"])
    assert dict(map(tuple, out.collect())) == {**target, **source} and out.columns == ["k", "v"]


def test_frame_level_changes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    assert rows_of(insert_absent(df, df.where("k = 1").unionByName(df.sparkSession.createDataFrame([(5, "e")], df.schema)), ["k"])) \
        == [(1, "a"), (2, "b"), (5, "e"), (None, "n")]
    assert rows_of(replace_listed(df, "k", [1], spark.createDataFrame([(1, "new")], df.schema))) \
        == [(1, "new"), (2, "b"), (None, "n")]
    assert rows_of(set_where(df, F.col("k") == 2, {"v": F.lit("set")})) == [(1, "a"), (2, "set"), (None, "n")]


def test_bucket_count():
    assert bucket_count(0) == 1 and bucket_count((256 << 20) + 1) == 2


def test_upsert_shuffles_the_source_once(spark, folder, monkeypatch):
    """The source is dealt by key when its latest rows are found; the joins take it so."""
    table, plans, stage = KeyedTable(spark, folder("keyed")), [], KeyedTable._stage

    def noted(self, df, *args):
        plans.append(plan_of(df))
        return stage(self, df, *args)

    monkeypatch.setattr(KeyedTable, "_stage", noted)
    rows = spark.range(400).selectExpr("cast(id AS string) AS k", "id AS v")
    with conf_scope(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        table.create(rows.where("v < 300"), ["k"], 8)
        metrics = table.upsert(rows.where("v >= 100").withColumn("v", F.col("v") + 1000), ["v"])
        table.insert_if_absent(rows.selectExpr("cast(v + 200 AS string) AS k", "v"), ["v"])
    assert (metrics.updated, metrics.inserted, metrics.copied) == (200, 100, 100)
    assert len(plans) == 2 and not any("hashpartitioning(bkt" in plan for plan in plans)
    wanted = {str(v): v if v < 100 else v + 1000 for v in range(400)} | {str(v + 200): v for v in range(200, 400)}
    assert rows_of(table.rows()) == sorted(wanted.items(), key=repr)
