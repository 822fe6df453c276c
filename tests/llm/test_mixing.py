"""Pfair schedules against their definition, and whole, ordered mixes."""

import random
from fractions import Fraction
from itertools import islice

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import mixing


def test_less_than_one_block_away_at_every_slot():
    """Three periods of many draws, while no source has run out."""
    random.seed(2)
    for _ in range(60):
        weights = {f"s{k}": random.randint(1, 60) for k in range(random.randint(1, 9))}
        total, used = sum(weights.values()), dict.fromkeys(weights, 0)
        for name, _, slot, _, _ in islice(mixing.schedule(dict.fromkeys(weights, 10 ** 9), weights), 3 * total):
            used[name] += 1
            assert all(abs(used[one] - Fraction(weights[one] * (slot + 1), total)) < 1 for one in weights)
        assert used == {one: 3 * weight for one, weight in weights.items()}


def test_exact_weights():
    assert mixing.exact_weights({"a": 1, "b": 1, "c": 2}) == {"a": 1, "b": 1, "c": 2}
    assert mixing.exact_weights({"a": Fraction(1, 3), "b": 0.25}) == {"a": 4, "b": 3}
    with pytest.raises(ValueError):
        mixing.exact_weights({"a": 0})


def _check(mixed, count, block):
    rows = mixed.toPandas()
    assert len(rows) == count
    assert rows.position.is_unique
    assert ((rows.release <= rows.slot) & (rows.slot < rows.deadline)).all()
    assert rows.groupby("slot").source.nunique(dropna=False).max() == 1
    assert sorted(rows.slot.unique()) == list(range(rows.slot.nunique()))
    assert rows.groupby("slot").size().max() <= block
    return rows


def test_query_is_a_whole_schedule(documents):
    rows = _check(mixing.mix(documents), documents.count(), 8)
    assert sorted(rows.doc_id) == sorted(row.doc_id for row in documents.select("doc_id").collect())


def test_weights_hold_while_sources_last(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    rows = _check(mixing.mix(docs, {"a": 1, "b": 1}, block=4, cell=100), 4000, 4)
    early = rows[rows.slot < 400]
    assert abs((early.source == "a").mean() - 0.5) < 0.01


def test_order_does_not_depend_on_cells(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    assert len({tuple(_check(mixing.mix(docs.repartition(n), cell=10), 500, 8).sort_values("position").doc_id) for n in (1, 5)}) == 1


def test_files_follow_the_mix(spark, documents, folder):
    path = folder("mix")
    mixed = mixing.mix(documents)
    mixing.in_order(mixed).write.parquet(path)
    place = {row.doc_id: row.position for row in mixed.select("doc_id", "position").collect()}
    written = spark.read.parquet(path).select("doc_id", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    rows = written.toPandas().sort_values(["file", "n"])
    found = [place[i] for i in rows.doc_id]
    assert found == sorted(found)


def test_odd_rows(odd_docs, no_docs):
    rows = _check(mixing.mix(odd_docs), odd_docs.count(), 8)
    assert set(odd_docs.columns) <= set(rows.columns)
    assert mixing.mix(no_docs).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd_docs, {"s0": 1})
    with pytest.raises(ValueError):
        mixing.mix(odd_docs, most_sources=1)


def test_the_bound_holds_for_the_weights_as_given():
    """Exact shares, far beyond a thousand slots, and of sources under a thousandth."""
    targets = {"hot": Fraction(202_861, 10 ** 6), "tiny": Fraction(1, 5_000), **{f"s{k}": Fraction(k + 7, 300) for k in range(19)}}
    weights, used = mixing.exact_weights(targets), dict.fromkeys(targets, 0)
    total = sum(targets.values())
    for name, _, slot, release, deadline in mixing.schedule(dict.fromkeys(targets, 10 ** 9), weights):
        used[name] += 1
        assert release <= slot < deadline
        if slot % 97 == 0 or slot > 29_900:
            assert all(abs(used[one] - targets[one] / total * (slot + 1)) < 1 for one in targets)
        if slot == 30_000:
            break


def test_schedule_uses_every_block_once():
    random.seed(5)
    for _ in range(40):
        blocks = {f"s{k}": random.randint(0, 30) for k in range(random.randint(1, 7))}
        rows = list(mixing.schedule(blocks, mixing.exact_weights({name: random.random() + 0.01 for name in blocks})))
        assert [row[2] for row in rows] == list(range(sum(blocks.values())))
        assert sorted(row[:2] for row in rows) == sorted((name, k) for name, n in blocks.items() for k in range(n))
        assert all(release <= slot < deadline for _, _, slot, release, deadline in rows)


def test_more_than_512_sources(spark):
    docs = spark.range(1400).select(F.col("id").alias("doc_id"), (F.col("id") % 700).cast("string").alias("source"))
    _check(mixing.mix(docs, block=2), 1400, 2)
