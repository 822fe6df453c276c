"""Nearest neighbours by inner product: an NN-descent graph and greedy search on it.

Equal vectors are one node. Vectors get one more component that gives all of them
the same norm, so that the largest inner product is also the smallest angle. Their own
components travel as bytes with a scale a vector; what the added one gives to a product,
less the largest norm's square, comes from two floats beside them, as the component
itself is by far the largest where few vectors are long. Random hyperplanes deal nodes into leaves for a first graph; each
round then joins the neighbours of every node with each other and keeps the best
for each. A search expands the best unexpanded nodes of its beam until none is left;
scores that are returned come from the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.llm.common import binary_column, groups, list_column, require, stored
from lakeloom.session import conf_scope

DEGREE = 32
TREES = 8
LEAF = 1024
#: Best members of a leaf that each member keeps.
LEAF_DEGREE = 16
#: Reverse neighbours of one node that are joined with each other in one block.
BLOCK = 512
_CANDIDATES = "array<struct<sim:float,node:bigint>>"
_NOTHING = -1e30


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors of the most common length that are finite and not zero,
    as doubles. Rows without vec_id take no part."""
    require(vectors, "vec_id", "embedding")
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        whole & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0)).distinct()


def fold(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: node, v, and the ``keep`` smallest vec_ids that have it."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= keep)
    return stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumn(
        "node", F.monotonically_increasing_id()), "ann-nodes")


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1), np.float32)
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1).astype(np.float32)


def _rows_matrix(q: pa.Array, scale: pa.Array, fall: pa.Array, lack: pa.Array) -> np.ndarray:
    """Own components, lack and fall of each vector, as floats."""
    x = _bytes_matrix(q) * np.asarray(scale, np.float32)[:, None]
    return np.hstack([x, np.asarray(lack, np.float32)[:, None], np.asarray(fall, np.float32)[:, None]])


def _alike(x: np.ndarray) -> np.ndarray:
    """Products of all pairs with the added component, less the largest norm's square."""
    return x[:, :-1] @ x[:, :-1].T - x[:, -1][:, None] - x[:, -1][None, :]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            norm = (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(x.sum(axis=0)),
                pa.array(np.full(x.shape[1], norm.max()))], ["place", "total", "norm"])


def _quantized(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.maximum(np.abs(x).max(axis=1), 1e-300) / 127
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def pack(nodes: DataFrame, count: int) -> DataFrame:
    """node, bytes q, scale, fall, lack, and one leaf code a tree. The added component is
    the largest norm less ``lack``, and ``fall`` is lack times the largest norm. What
    reaches the driver is a mean vector; hyperplanes are drawn from a fixed seed."""
    totals = nodes.select("v").mapInArrow(_sums, "place int, total double, norm double").groupBy("place").agg(
        F.sum("total").alias("total"), F.max("norm").alias("norm")).orderBy("place").collect()
    mean = np.array([row["total"] / max(count, 1) for row in totals])
    most = max((row["norm"] for row in totals), default=0.0)
    bits = max(0, int(np.ceil(np.log2(max(1, count) / LEAF))))
    planes = np.random.default_rng(11).standard_normal((TREES, bits, len(mean)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            norm = (x * x).sum(axis=1)
            lack = norm / (np.sqrt(most) + np.sqrt(np.maximum(most - norm, 0)))
            q, scale = _quantized(x)
            codes = np.zeros((len(x), TREES), np.int32)
            for tree in range(TREES):
                codes[:, tree] = ((x - mean) @ planes[tree].T > 0) @ (1 << np.arange(bits, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), binary_column(q.reshape(-1), np.full(len(x), q.shape[1])),
                pa.array(scale.astype(np.float32)), pa.array((lack * np.sqrt(most)).astype(np.float32)), pa.array(lack.astype(np.float32)),
                list_column(codes.reshape(-1), np.full(len(x), TREES), pa.int32())],
                ["node", "q", "scale", "fall", "lack", "codes"])

    return stored(nodes.select("node", "v").mapInArrow(
        run, "node long, q binary, scale float, fall float, lack float, codes array<int>"), "ann-packed")


def _best(owner: np.ndarray, sim: np.ndarray, node: np.ndarray, keep: int,
          rows: np.ndarray | None = None) -> pa.RecordBatch:
    """The ``keep`` best distinct candidates of each owner, as one row an owner; of
    equal nodes the best. ``rows`` are the owners to return, in order, if not those
    that have candidates."""
    order = np.lexsort((-sim, node, owner))
    owner, sim, node = owner[order], sim[order], node[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (node[1:] != node[:-1])
    owner, sim, node = owner[new], sim[new], node[new]
    order = np.lexsort((node, -sim, owner))
    owner, sim, node = owner[order], sim[order], node[order]
    rows = np.unique(owner) if rows is None else rows
    first = np.searchsorted(owner, rows)
    count = np.minimum(np.searchsorted(owner, rows, "right") - first, keep)
    top = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    pairs = pa.StructArray.from_arrays([pa.array(sim[top].astype(np.float32)), pa.array(node[top])], ["sim", "node"])
    return pa.RecordBatch.from_arrays([pa.array(rows), list_column(pairs, count, pairs.type)], ["owner", "found"])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of each list of candidates, and all sims and nodes end to end."""
    count = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
    flat = column.flatten()
    return count, np.asarray(flat.field(0), np.float64), np.asarray(flat.field(1), np.int64)


def merged(found: DataFrame, keep: int) -> DataFrame:
    """(owner, found) with one row an owner: the best of all its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                count, sim, node = _lists(batch.column(1))
                rows = np.asarray(batch.column(0))
                yield _best(np.repeat(rows, count), sim, node, keep, np.sort(rows))

    return found.groupBy("owner").agg(F.flatten(F.collect_list("found")).alias("found")).mapInArrow(
        run, f"owner long, found {_CANDIDATES}")


def _leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, 3):
        node = group.column(3).to_numpy()
        x = _rows_matrix(*(group.column(c).combine_chunks() for c in (4, 5, 6, 7)))
        sim = _alike(x)
        np.fill_diagonal(sim, -np.inf)
        keep = min(LEAF_DEGREE, len(node) - 1)
        if keep:
            near = np.argpartition(-sim, keep - 1, axis=1)[:, :keep]
            rows = np.repeat(np.arange(len(node)), keep)
            yield _best(node[rows], sim[rows, near.reshape(-1)], node[near.reshape(-1)], keep)


def _join_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (v, block, u, q, scale, fall, lack, least) sorted by v and block: all u of one v are
    compared, and pairs better than what an end has so far are returned."""
    held = None
    for batch in batches:
        now = [np.asarray(batch.column(c)) for c in (0, 1, 2, 7)] + [_rows_matrix(*batch.columns[3:7])]
        if held is not None:
            now = [np.concatenate([old, new]) if len(new) else old for old, new in zip(held, now)]
        if not len(now[0]):
            continue
        cuts = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        held = [part[last:] for part in now]
        if last:
            yield from _local(now, [0, *cuts.tolist()])
    if held is not None:
        yield from _local(held, [0, len(held[0])])


def _local(now: list[np.ndarray], cuts: list[int]) -> Iterator[pa.RecordBatch]:
    _, _, node, least, x = now
    owners, sims, others = [], [], []
    for low, high in zip(cuts, cuts[1:]):
        one, at = np.unique(node[low:high], return_index=True)
        at += low
        sim = _alike(x[at])
        np.fill_diagonal(sim, -np.inf)
        left, right = np.nonzero(sim > least[at][:, None])
        owners.append(one[left])
        sims.append(sim[left, right])
        others.append(one[right])
    yield _best(np.concatenate(owners), np.concatenate(sims), np.concatenate(others), DEGREE)


def _least(found: str, keep: int) -> Column:
    return F.when(F.size(found) >= keep, F.get(F.col(found), F.lit(keep - 1))["sim"]).otherwise(F.lit(_NOTHING)).cast("float")


def both_ways(graph: DataFrame) -> DataFrame:
    """(v, block, u): v's neighbours and the nodes it is a neighbour of. Block 0 has
    the former; where the latter are very many, they are dealt into blocks."""
    links = graph.select(F.col("owner").alias("v"), F.explode("found.node").alias("u"))
    many = links.groupBy(F.col("u").alias("v")).agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    back = links.select(F.col("u").alias("v"), F.col("v").alias("u")).join(many, "v", "left").select(
        "v", F.coalesce(F.pmod(F.xxhash64("u"), F.ceil(F.col("size") / BLOCK)), F.lit(0)).cast("int").alias("block"), "u")
    return links.select("v", F.lit(0).alias("block"), "u").union(back).distinct()


def descend(packed: DataFrame, rounds: int = 3, still: float = 0.02) -> DataFrame:
    """The neighbour graph: node, and its ``DEGREE`` nearest found, nearest first.

    Ends after ``rounds``, or when a round changes less than ``still`` of the links."""
    spread = packed.select("node", "q", "scale", "fall", "lack", F.posexplode("codes").alias("tree", "code"))
    sizes = stored(spread.groupBy("tree", "code").agg(F.count("*").alias("size")), "ann-leaves")
    part = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("size") / LEAF)).cast("int")
    leaves = spread.join(sizes, ["tree", "code"]).select("tree", "code", part.alias("part"), "node", "q", "scale", "fall", "lack")
    first = leaves.repartition("tree", "code", "part").sortWithinPartitions("tree", "code", "part").mapInArrow(
        _leaf, f"owner long, found {_CANDIDATES}")
    alone = packed.select(F.col("node").alias("owner"), F.array().cast(_CANDIDATES).alias("found"))
    graph = stored(merged(first.union(alone), DEGREE), "ann-graph")
    for _ in range(rounds):
        same = graph.select(F.col("owner").alias("v"), F.lit(0).alias("block"), F.col("owner").alias("u"))
        edges = both_ways(graph).union(same)
        known = packed.select(F.col("node").alias("u"), "q", "scale", "fall", "lack").join(
            graph.select(F.col("owner").alias("u"), _least("found", DEGREE).alias("least")), "u")
        new = edges.join(known, "u").select("v", "block", "u", "q", "scale", "fall", "lack", "least").repartition("v", "block").sortWithinPartitions(
            "v", "block").mapInArrow(_join_neighbours, f"owner long, found {_CANDIDATES}")
        better = stored(merged(new.union(graph), DEGREE), "ann-graph")
        moved = better.join(graph.select("owner", F.col("found").alias("old")), "owner").agg(
            F.sum(F.size(F.array_except("found.node", "old.node"))).alias("moved"), F.sum(F.size("found")).alias("links")).first()
        graph = better
        if (moved["moved"] or 0) < still * max(1, moved["links"] or 0):
            break
    return graph


def _score(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Rows (query, q, scale, least, near): neighbours that are better than the beam's last."""
    for batch in batches:
        near = batch.column(4)
        flat = near.flatten()
        if not len(flat):
            continue
        count = np.asarray(pa.compute.list_value_length(near), np.int64)
        row = np.repeat(np.arange(batch.num_rows), count)
        q, other = _bytes_matrix(batch.column(1)), _bytes_matrix(flat.field(1))
        sim = np.einsum("ij,ij->i", q[row], other) * np.asarray(batch.column(2))[row] * np.asarray(flat.field(2))
        good = sim > np.asarray(batch.column(3))[row]
        yield _best(np.asarray(batch.column(0))[row[good]], sim[good], np.asarray(flat.field(0))[good], keep)


def search(queries: DataFrame, graph: DataFrame, packed: DataFrame, beam: int = 256, expand: int = 64,
           steps: int = 12, entries: int = 8) -> DataFrame:
    """The beam of each query (query, v, entry): query and its best nodes found.

    A step expands up to ``expand`` of the best ``beam`` nodes that have not been, for
    all queries at once; it ends when all of a beam are expanded, at the latest after
    ``steps``. ``entry`` may be null: then only ``entries`` fixed nodes start it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if len(x):
                q, scale = _quantized(x)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), binary_column(q.reshape(-1), np.full(len(x), q.shape[1])),
                    pa.array(scale.astype(np.float32)), batch.column(2)], ["query", "q", "scale", "entry"])

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column(0))
            old, gained = _lists(batch.column(3)), _lists(batch.column(5))
            owner, sim, node = (np.concatenate(pair) for pair in zip(
                (np.repeat(np.arange(len(rows)), old[0]), *old[1:]), (np.repeat(np.arange(len(rows)), gained[0]), *gained[1:])))
            found = _best(owner, sim, node, beam, np.arange(len(rows))).column(1)
            done = [np.asarray(one.values, np.int64) for one in batch.column(4)]
            ahead = [nodes[~np.isin(nodes, seen)][:expand] for nodes, seen in zip(
                np.split(np.asarray(found.flatten().field(1)), np.cumsum(_lists(found)[0])[:-1]), done)]
            done = [np.concatenate(pair) for pair in zip(done, ahead)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found, *(
                list_column(np.concatenate(lists) if lists else np.zeros(0, np.int64), np.array([len(one) for one in lists], np.int64),
                            pa.int64()) for lists in (done, ahead))], ["query", "q", "scale", "found", "done", "next"])

    kind = f"query long, q binary, scale float, found {_CANDIDATES}, done array<long>, next array<long>"
    doors = [row["node"] for row in packed.select("node").orderBy(F.xxhash64("node")).limit(entries).collect()]
    start = F.filter(F.concat(F.array("entry"), F.array(*[F.lit(door).cast("long") for door in doors])), lambda x: x.isNotNull())
    none = F.array().cast(_CANDIDATES)
    state = stored(queries.select("query", "v", "entry").mapInArrow(run, "query long, q binary, scale float, entry long").select(
        "query", "q", "scale", F.transform(F.array_distinct(start), lambda node: F.struct(
            F.lit(_NOTHING).cast("float").alias("sim"), node.alias("node"))).alias("found"),
        F.array().cast("array<bigint>").alias("done"), none.alias("gained")).mapInArrow(advance, kind), "ann-state")
    # Links lead both ways, so that a node few others are near to can be reached.
    near = both_ways(graph).select(F.col("v").alias("owner"), "block", F.col("u").alias("node")).join(
        packed.select("node", "q", "scale"), "node")
    pages = stored(near.groupBy("owner", "block").agg(F.collect_list(F.struct("node", "q", "scale")).alias("near")), "ann-pages")
    for _ in range(steps):
        front = state.select("query", "q", "scale", _least("found", beam).alias("least"), F.explode("next").alias("owner"))
        if not front.limit(1).count():
            break
        hits = front.join(pages, "owner").select("query", "q", "scale", "least", "near").mapInArrow(
            lambda batches: _score(batches, beam), f"owner long, found {_CANDIDATES}")
        gained = hits.groupBy(F.col("owner").alias("query")).agg(F.flatten(F.collect_list("found")).alias("gained"))
        # Entries get their true score once they are met as a neighbour.
        state = stored(state.drop("next").join(gained, "query", "left").select(
            "query", "q", "scale", "found", "done", F.coalesce("gained", none).alias("gained")).mapInArrow(advance, kind), "ann-state")
    return state.select("query", "found")


def nearest(vectors: DataFrame, chosen: Column, top: int = 20, rounds: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each chosen row.

    All usable rows are candidates but the query's own vec_id. Ties go to the smaller
    vec_id. Vectors that are null, zero, not finite throughout or of another length
    than most take no part; repeated rows count once; a vec_id with several vectors
    is a row for each. Other columns are ignored.
    """
    with conf_scope(vectors.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}):
        rows = stored(usable(vectors), "ann-rows")
        nodes = fold(rows, top + 1)
        packed = pack(nodes, nodes.count())
        graph = descend(packed, rounds)
        asked = stored(rows.where(chosen).join(nodes.select("v", "node"), "v").select("vec_id", "node"), "ann-asked")
        queries = nodes.join(asked.select("node").distinct(), "node").select(
            F.col("node").alias("query"), "v", F.col("node").alias("entry"))
        found = search(queries, graph, packed)
        # Bytes order the beam; the doubles of more than are asked for decide.
        few = F.array_union(F.array("query"), F.slice("found.node", 1, 2 * top + 10))
        pairs = stored(found.select("query", F.explode(few).alias("node")), "ann-pairs")
        left = nodes.select(F.col("node").alias("query"), F.col("v").alias("one"))
        dot = F.aggregate(F.zip_with("one", "v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
        scored = pairs.join(nodes.select("node", "v", "members"), "node").join(left, "query").select(
            "query", dot.alias("score"), F.explode("members").alias("vec_id"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top + 1)
        lists = stored(best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")), "ann-best")
    rows = asked.join(lists, asked["node"] == lists["query"]).select(
        F.col("vec_id").alias("query_id"), F.slice(F.filter(
            "best", lambda one: one["vec_id"] != F.col("vec_id")), 1, top).alias("best"))
    return rows.select("query_id", F.posexplode("best").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"),
        F.col("one.score").alias("score"))
