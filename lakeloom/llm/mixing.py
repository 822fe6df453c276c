"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed random order, form blocks. With weight w a
share of the slots, the source's block j (from 0) may run from slot floor(j / w)
and must have run by slot ceil((j + 1) / w); of the blocks that may run, the one
with the earliest deadline does. At every slot a source is then less than one block
away from its share. Shares are exact fractions, so release and deadline hold for the
weights as given; where a source runs out, the others go on in proportion, counted
from the next slot.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeloom.llm.common import require, stored

#: Slots of the schedule that are written at once.
BATCH = 20_000


def exact_weights(weights: Mapping) -> dict:
    """Whole numbers in exactly the proportions of ``weights``."""
    parts = {name: Fraction(weight) for name, weight in weights.items()}
    if any(part <= 0 for part in parts.values()):
        raise ValueError("a target weight has to be positive")
    scale = math.lcm(*(part.denominator for part in parts.values()))
    return {name: int(part * scale) for name, part in parts.items()}


def schedule(blocks: Mapping, weights: Mapping) -> Iterator[tuple]:
    """(source, block, slot, release, deadline) of every block, in order of slots.

    ``weights`` are whole numbers. When a source's last block has run, the others
    start anew from the next slot, by their weights among those that are left."""
    names = sorted((name for name, count in blocks.items() if count > 0), key=lambda name: (name is not None, name))
    used, start = dict.fromkeys(names, 0), 0
    while names:
        total, first, slot = sum(weights[name] for name in names), dict(used), start
        waiting, ready = [(0, k, 0) for k in range(len(names))], []  # release, source, block
        over = False
        while not over:
            while waiting and waiting[0][0] <= slot - start:
                _, k, block = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(block + 1) * total // weights[names[k]]), k, block))
            deadline, k, block = heapq.heappop(ready)
            name = names[k]
            share = weights[name]
            yield name, first[name] + block, slot, start + block * total // share, start + deadline
            used[name] += 1
            slot += 1
            over = used[name] == blocks[name]
            if not over:
                heapq.heappush(waiting, ((block + 1) * total // share, k, block + 1))
        start = slot
        names.remove(name)


def _slots(spark: SparkSession, blocks: Mapping, weights: Mapping) -> DataFrame:
    kind = "__name string, __block long, __slot long, __release long, __deadline long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), *[pa.int64()] * 4)
        names = ["__name", "__block", "__slot", "__release", "__deadline"]
        for batch in batches:
            if batch.num_rows:
                rows = schedule(blocks, weights)
                while part := list(islice(rows, BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(column, one) for column, one in zip(zip(*part), types)], names)

    return stored(spark.range(0, 1, 1, 1).mapInArrow(run, kind), "mix-slots")


def mix(docs: DataFrame, weights: Mapping | None = None, block: int = 8, by: str = "source", seed: int = 7,
        tempering: float = 0.7, most_sources: int | None = None, cell: int = 2_000) -> DataFrame:
    """``docs`` with source block, slot, release, deadline and ``position`` added; all rows.

    ``position`` counts from 0 without gaps within a source's block; sorting by it
    gives the mix. Without ``weights`` a source weighs its size to the power
    ``tempering``. Every source needs a weight; a null source is one of its own. A
    source's order is by a hash of doc_id and text, ties by doc_id; repeated rows
    stand together in any order. Sources are a list that weights are given for and
    reach the driver with their sizes; more than ``most_sources``, if given, are a
    ValueError. Other columns pass through; those of the added names are replaced.

    Ranks within a source come from counts of hash cells of about ``cell`` rows, so a
    source that holds most rows is still dealt over many tasks.
    """
    require(docs, "doc_id", by)
    added = ("block", "slot", "release", "deadline", "position", "__cell", "__order")
    plain = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name not in added])
    counted = plain.groupBy(F.col(by).cast("string")).count()
    sizes = {row[0]: row[1] for row in (counted if most_sources is None else counted.limit(most_sources + 1)).collect()}
    if most_sources is not None and len(sizes) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    if weights is None:
        weights = {name: Fraction(size ** tempering) for name, size in sizes.items()}
    lacking = [name for name in sizes if name not in weights]
    if lacking:
        raise ValueError(f"no weight for sources {lacking[:5]}")
    slots = _slots(docs.sparkSession, {name: -(-size // block) for name, size in sizes.items()},
                   exact_weights({name: weights[name] for name in sizes}))

    texts = ["text"] if "text" in plain.columns else []
    cells = max(1, -(-max(sizes.values(), default=1) // cell))
    rows = plain.withColumn("__order", F.xxhash64("doc_id", F.lit(seed), *texts))
    rows = rows.withColumn("__cell", F.pmod(F.shiftrightunsigned("__order", 24), F.lit(cells)).cast("int"))
    counts = rows.groupBy(F.col(by).alias("__of"), F.col("__cell").alias("__in")).agg(F.count("*").alias("__n"))
    upto = Window.partitionBy("__of").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select("__of", "__in", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before")), "mix-cells")
    here = F.row_number().over(Window.partitionBy(by, "__cell").orderBy("__order", "doc_id")) - 1
    ranked = rows.withColumn("__rank", here).join(
        F.broadcast(offsets) if cells * len(sizes) < 10_000 else offsets,
        F.col(by).eqNullSafe(F.col("__of")) & (F.col("__cell") == F.col("__in"))).withColumn(
        "__rank", F.col("__rank") + F.col("__before")).withColumn("block", F.floor(F.col("__rank") / block))
    placed = ranked.join(slots, F.col(by).cast("string").eqNullSafe(F.col("__name")) & (F.col("block") == F.col("__block")))
    return placed.withColumn("position", F.col("__slot") * block + F.col("__rank") % block).select(
        *[F.col(f"`{name}`") for name in plain.columns], "block", F.col("__slot").alias("slot"),
        F.col("__release").alias("release"), F.col("__deadline").alias("deadline"), "position")


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows in order of the mix, over partitions that follow one another, so that
    files written from them hold the mix; the added columns are dropped."""
    parts = max(1, int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = mixed.repartitionByRange(parts, "position").sortWithinPartitions("position")
    return ordered.drop("block", "slot", "release", "deadline", "position")
