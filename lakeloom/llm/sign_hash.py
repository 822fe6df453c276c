"""Near-duplicate vectors by random-hyperplane sign hashing, verified by cosine.

Each table of the hash cuts space by some random hyperplanes through the origin; the
signs of a vector name its cell. Vectors that share a cell in any table are compared
exactly. A cell that holds many vectors is dealt into blocks, and each pair of blocks
is compared in a task of its own, which returns counts and a forest of links, never
the pairs. Equal vectors are folded into one beforehand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import groups, list_column, mix, require, stored
from lakeloom.llm.near_dedup import components
from lakeloom.session import conf_scope

#: Vectors that a cell would hold if they were spread evenly; planes follow from it.
CELL = 1024
#: Members of a cell compared at once.
BLOCK = 2048
#: Chance that a pair exactly at the threshold shares no cell; tables follow from it.
MISS = 1e-6
SEED = 20_240_511


def plan(rows: int, threshold: float, cell: int = CELL, miss: float = MISS) -> tuple[int, int]:
    """Planes a table and tables: cells stay about as large whatever the number of
    rows, and a pair at the threshold is missed with the same small chance."""
    planes = min(max(6, math.ceil(math.log2(max(rows, 1) / cell))), 32)
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(miss) / math.log1p(-same))


def usable(vector: Column) -> Column:
    """Not null, not all zero, every component finite."""
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(wide.isNotNull() & ~odd & F.exists(wide, lambda x: x != 0), F.lit(False))


def _unit(data: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so that no square
    leaves the range of doubles."""
    data = data / np.abs(data).max(axis=1, keepdims=True)
    return data / np.sqrt((data * data).sum(axis=1, keepdims=True))


def signs(unit: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """The cell of each vector in each table, as the number its signs spell."""
    normals = np.random.default_rng([SEED, unit.shape[1]]).standard_normal((unit.shape[1], tables * planes))
    bits = (unit @ normals >= 0).reshape(len(unit), tables, planes)
    return bits @ (np.uint64(1) << np.arange(planes, dtype=np.uint64))


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as a matrix, with their places."""
    sizes = np.asarray(pa.compute.list_value_length(lists))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.asarray(lists.take(pa.array(at)).flatten(), np.float64).reshape(len(at), size)


def _hash(planes: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.zeros((batch.num_rows, tables), np.uint64)
            cells = np.zeros((batch.num_rows, tables), np.uint64)
            units: list = [None] * batch.num_rows
            for at, data in _by_length(batch.column(3)):
                unit = _unit(data)
                code[at] = signs(unit, planes, tables)
                salt = mix(np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(data.shape[1]))
                cells[at] = mix(code[at] + salt)
                for place, row in zip(at.tolist(), unit):
                    units[place] = row.tobytes()
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(units, pa.binary()),
                pa.array([row.tobytes() for row in code.astype(np.uint32)], pa.binary()),
                list_column(cells.view(np.int64).reshape(-1), np.full(batch.num_rows, tables), pa.int64()),
            ], ["head", "mark", "size", "unit", "code", "cells"])
    return run


def _compare(threshold: float):
    """Per pair of blocks of a cell: for each vector the number of others it links
    with for the first time in this table, and a forest of the links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 4):
            lengths = pa.compute.binary_length(group.column(8)).to_numpy()
            for length in np.unique(lengths):  # one, unless two lengths meet by their hash
                part = group.filter(pa.array(lengths == length))
                if part.num_rows < 2:
                    continue
                table = part.column(1)[0].as_py()
                low, high = part.column(2)[0].as_py(), part.column(3)[0].as_py()
                block, head, mark, size = (part.column(c).to_numpy() for c in (4, 5, 6, 7))
                unit = np.frombuffer(b"".join(part.column(8).to_pylist()), np.float64).reshape(len(head), -1)
                code = np.frombuffer(b"".join(part.column(9).to_pylist()), np.uint32).reshape(len(head), -1)
                ones = np.flatnonzero(block == low)
                twos = ones if low == high else np.flatnonzero(block == high)
                one, two = np.nonzero(unit[ones] @ unit[twos].T >= threshold)
                one, two = ones[one], twos[two]
                if low == high:
                    one, two = one[one < two], two[one < two]
                if not len(one):
                    continue
                root = _forest(len(head), one, two)
                for earlier in range(table):
                    fresh = code[one, earlier] != code[two, earlier]
                    one, two = one[fresh], two[fresh]
                links = np.zeros(len(head), np.int64)
                np.add.at(links, one, size[two])
                np.add.at(links, two, size[one])
                seen = np.flatnonzero((links > 0) | (root != np.arange(len(head))))
                yield pa.RecordBatch.from_arrays([
                    pa.array(head[seen]), pa.array(mark[seen]), pa.array(links[seen]), pa.array(head[root[seen]])],
                    ["head", "mark", "links", "root"])
    return run


def _forest(count: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row."""
    root = np.arange(count)
    while True:
        before = root.copy()
        least = np.minimum(root[one], root[two])
        np.minimum.at(root, one, least)
        np.minimum.at(root, two, least)
        root = root[root]
        if (root == before).all():
            return root


def near_vectors(rows: DataFrame, threshold: float = 0.9, vector: str = "embedding", cell: int = CELL,
                 block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """Components of vectors whose cosine reaches ``threshold``.

    Returns one row a row of ``rows``: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable), kept. Cosine is computed in double
    precision; vectors of different length are unlike. A vector that is null, empty,
    all zero or holds a null or non-finite component links with nothing, as does a
    null vec_id, whose component_id is null; such rows are kept. A row that repeats
    vec_id and vector counts once; rows that repeat a vec_id with other vectors are
    vectors of their own in one component. Other columns are ignored.
    """
    require(rows, "vec_id", vector)
    with conf_scope(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}):
        return _near_vectors(rows, threshold, vector, cell, block, miss)


def _near_vectors(rows: DataFrame, threshold: float, vector: str, cell: int, block: int, miss: float) -> DataFrame:
    # Equal vectors have equal marks: -0.0 is turned to 0.0 first.
    wide = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(F.col(vector)), wide).alias("v"))
    marked = stored(given.select("vec_id", "v", F.when(F.col("vec_id").isNotNull() & F.col("v").isNotNull(), F.xxhash64("v"))
                                 .alias("mark"), F.xxhash64(F.lit(1), "v").alias("mark2")), "cosine-marked")
    whole = marked.where("mark is not null")
    entries = whole.groupBy("mark", "mark2", "vec_id").agg(F.any_value("v").alias("v"))
    classes = stored(entries.groupBy("mark", "mark2").agg(
        F.min("vec_id").alias("head"), F.count("*").alias("size"), F.any_value("v").alias("v")), "cosine-classes")
    planes, tables = plan(classes.count(), threshold, cell, miss)
    hashed = stored(classes.select("head", "mark", "size", "v").mapInArrow(
        _hash(planes, tables), "head long, mark long, size long, unit binary, code binary, cells array<long>"), "cosine-hashed")
    found = stored(_cell_links(hashed, threshold, block), "cosine-links")

    # An id that stands for several vectors joins their classes.
    several = whole.groupBy("vec_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).where(
        "low <> high").select("vec_id")
    bridges = whole.join(several, "vec_id").join(classes.select("mark", "mark2", "head"), ["mark", "mark2"]).select(
        F.col("vec_id").alias("a"), F.col("head").alias("b"))
    edges = found.where("root <> head").select(F.col("root").alias("a"), F.col("head").alias("b")).union(bridges)
    placed = components(stored(edges.where("a <> b").distinct(), "cosine-edges"))
    counts = found.groupBy("head", "mark").agg(F.sum("links").alias("links"))
    verdicts = stored(
        classes.select("mark", "mark2", "head", "size").join(counts, ["head", "mark"], "left")
        .join(placed.withColumnRenamed("id", "head"), "head", "left").select(
            "mark", "mark2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "head").alias("component_id")), "cosine-verdicts")
    # Both sides are read from files, so that a mark shared by many rows can be split.
    judged = whole.select("vec_id", "mark", "mark2").join(verdicts, ["mark", "mark2"]).select(
        "vec_id", "n_links", "component_id")
    alone = marked.where("mark is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return judged.union(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _cell_links(hashed: DataFrame, threshold: float, block: int) -> DataFrame:
    spread = hashed.select(F.posexplode("cells").alias("table", "cell"), "head", "mark", "size", "unit", "code")
    sizes = hashed.select(F.explode("cells").alias("cell")).groupBy("cell").count()
    large = stored(sizes.where(F.col("count") > block).select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
                   "cosine-large")
    # Only members of large cells are repeated, once for each block they meet.
    dealt = spread.join(large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("head", "mark"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", "table", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "head", "mark", "size", "unit", "code")
    return dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "table", "low", "high").mapInArrow(
        _compare(threshold), "head long, mark long, links long, root long")
