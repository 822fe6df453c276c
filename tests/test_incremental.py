import datetime as dt

from lakeloom.plans.incremental import BEGINNING, FAILED, NEVER_RAN, SUCCESS, IncrementalLoader
from lakeloom.sources.jdbc import FrameTable
from tests.conftest import rows_of

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 3, 1)
SOURCE = "s.t"


def _hours(*hours):
    return [(i, T0 + dt.timedelta(hours=h)) for i, h in enumerate(hours)]


def _source(spark, rows):
    return FrameTable(spark.createDataFrame(rows, "id int, modified timestamp"))


def _loader(spark, folder, lookback=0, sources=(SOURCE,), enabled=True):
    loader = IncrementalLoader(spark, folder("control"), folder("bronze"))
    loader.configure([
        ("s", "t", name, "modified", "incremental", enabled, None, "b", name.replace(".", "_"), lookback, NOW, NOW)
        for name in sources
    ], NOW)
    return loader


def _state(loader, source=SOURCE):
    return loader.watermarks.rows().where(f"source_table_fqn = '{source}'").first()


def _bronze(spark, loader, source=SOURCE):
    return spark.read.parquet(loader.bronze("b", source.replace(".", "_")))


def test_seeded_state(spark, folder):
    state = _state(_loader(spark, folder))
    assert state["status"] == NEVER_RAN and state["last_successful_watermark"] == BEGINNING


def test_new_rows_then_no_change_then_more(spark, folder):
    loader = _loader(spark, folder)
    first = loader.run({SOURCE: _source(spark, _hours(1, 2, 3))}, "r1", NOW)
    assert (first[0].status, first[0].rows) == (SUCCESS, 3)
    same = loader.run({SOURCE: _source(spark, _hours(1, 2, 3))}, "r2", NOW)
    assert same[0].rows == 0 and _state(loader)["last_row_count"] == 0
    more = loader.run({SOURCE: _source(spark, _hours(1, 2, 3, 4))}, "r3", NOW)
    assert more[0].rows == 1
    state = _state(loader)
    assert state["last_successful_watermark"] == T0 + dt.timedelta(hours=4) and state["last_run_id"] == "r3"
    assert rows_of(_bronze(spark, loader).groupBy("_run_id").count()) == [("r1", 3), ("r3", 1)]


def test_lookback_reads_again(spark, folder):
    loader = _loader(spark, folder, lookback=61)
    loader.run({SOURCE: _source(spark, _hours(1, 2, 3))}, "r1", NOW)
    assert loader.run({SOURCE: _source(spark, _hours(1, 2, 3))}, "r2", NOW)[0].rows == 2


def test_empty_source_keeps_the_watermark(spark, folder):
    loader = _loader(spark, folder)
    loader.run({SOURCE: _source(spark, _hours(5))}, "r1", NOW)
    loader.run({SOURCE: _source(spark, [])}, "r2", NOW)
    state = _state(loader)
    assert state["last_successful_watermark"] == T0 + dt.timedelta(hours=5)
    assert state["current_batch_max_watermark"] is None and state["status"] == SUCCESS


class Broken(FrameTable):
    def read_between(self, *_):
        raise RuntimeError("source is gone")


def test_failure_is_recorded_and_others_run(spark, folder):
    loader = _loader(spark, folder, sources=("s.bad", "s.good"))
    good = _source(spark, _hours(1))
    results = loader.run({"s.bad": Broken(good.df), "s.good": good}, "r1", NOW)
    assert [(r.source, r.status) for r in results] == [("s.bad", FAILED), ("s.good", SUCCESS)]
    state = _state(loader, "s.bad")
    assert state["status"] == FAILED and state["last_successful_watermark"] == BEGINNING
    retried = loader.run({"s.bad": good}, "r2", NOW)
    assert retried[0].status == SUCCESS and _bronze(spark, loader, "s.bad").count() == 1


def test_retry_of_one_run_replaces_its_rows(spark, folder):
    """A crash after the append and before the watermark: the same run id again."""
    loader = _loader(spark, folder)
    setting = loader.metadata.rows().first()
    source = {SOURCE: _source(spark, _hours(1, 2))}
    for _ in range(2):
        loader._load(setting, None, source, "r1", NOW)
    assert _bronze(spark, loader).count() == 2


def test_states_of_one_run_enter_in_one_commit(spark, folder, monkeypatch):
    loader = _loader(spark, folder, sources=("s.a", "s.b", "s.c"))
    commits = []
    upsert = loader.watermarks.upsert
    monkeypatch.setattr(loader.watermarks, "upsert", lambda df, **more: commits.append(df.count()) or upsert(df, **more))
    loader.run({f"s.{name}": _source(spark, _hours(1, 2)) for name in "abc"}, "r1", NOW)
    assert commits == [3]
    assert {row["status"] for row in loader.watermarks.rows().collect()} == {SUCCESS}
    loader.settle()
    assert commits == [3]


def test_notes_of_a_lost_run_are_taken_in(spark, folder, monkeypatch):
    places = {name: folder(name) for name in ("control", "bronze")}
    loader = _loader(spark, places.get, sources=("s.a", "s.b"))
    monkeypatch.setattr(loader, "settle", lambda: None)
    loader.run({"s.a": _source(spark, _hours(1, 2))}, "r1", NOW)
    assert _state(loader, "s.a")["status"] == NEVER_RAN
    again = IncrementalLoader(spark, places["control"], places["bronze"])
    results = again.run({"s.a": _source(spark, _hours(1, 2, 3)), "s.b": _source(spark, _hours(4))}, "r2", NOW)
    assert [(r.source, r.rows) for r in results] == [("s.a", 1), ("s.b", 1)]
    assert rows_of(_bronze(spark, again, "s.a").groupBy("_run_id").count()) == [("r1", 2), ("r2", 1)]


def test_settling_twice_changes_nothing(spark, folder, monkeypatch):
    """A loss after the commit and before the notes are emptied."""
    loader = _loader(spark, folder)
    settle = loader.settle
    monkeypatch.setattr(loader, "settle", lambda: None)
    loader.run({SOURCE: _source(spark, _hours(1, 2))}, "r1", NOW)
    loader.watermarks.upsert(spark.read.parquet(loader.notes_path))
    before = rows_of(loader.watermarks.rows())
    settle()
    assert rows_of(loader.watermarks.rows()) == before
    assert spark.read.parquet(loader.notes_path).count() == 0


def test_disabled_source_is_left_out(spark, folder):
    loader = _loader(spark, folder, enabled=False)
    assert loader.run({SOURCE: _source(spark, _hours(1))}, "r1", NOW) == []


def test_configure_again_keeps_progress(spark, folder):
    loader = _loader(spark, folder)
    loader.run({SOURCE: _source(spark, _hours(1))}, "r1", NOW)
    loader.configure([("s", "t", SOURCE, "modified", "incremental", True, None, "b", "s_t", 30, NOW, NOW)], NOW)
    assert _state(loader)["status"] == SUCCESS
    assert loader.metadata.rows().first()["lookback_minutes"] == 30
