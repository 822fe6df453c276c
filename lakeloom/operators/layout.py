"""Physical layout jobs: compaction, Z-order clustering, partitioning, statistics.

Each job writes a new folder and leaves the old one in place; ``swap_location``
then points a catalog table at the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from lakeloom.session import conf_scope
from lakeloom.sources.files import path_exists, stored_bytes, subfolders

TARGET_FILE_BYTES = 256 << 20
#: A task that sorts whole rows, or shuffles them to many tasks, holds about ten times
#: their stored bytes, so files that are written sorted are smaller.
SORTED_FILE_BYTES = 64 << 20
#: Rows that cut points are taken from.
SAMPLE_ROWS = 20_000
Z_VALUE = "_z"
_SPREAD = "_spread"
_FOLDER = "_folder"
#: A writing task keeps up to so many partition folders open and sorts its rows only
#: beyond them, so that it need not hold all of its rows.
OPEN_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def files_for(total_bytes: int, file_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, -(-total_bytes // file_bytes))


def compact(spark: SparkSession, path: str, target: str, file_bytes: int = TARGET_FILE_BYTES,
            partition_by: Sequence[str] = ()) -> None:
    """Rewrite many small files as few of about ``file_bytes``, without a shuffle:
    the scan itself packs small files into splits of that size. Name the columns of
    a partitioned folder: its rows are rebalanced by them and the folders kept."""
    if partition_by:
        with conf_scope(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes)}):
            write_partitioned(spark.read.parquet(path), target, partition_by)
        return
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", "0")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    packing.read.parquet(path).write.mode("overwrite").parquet(target)


def write_partitioned(df: DataFrame, target: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Hive-style partition folders. Rows are rebalanced by the partition columns:
    few files per folder, and a folder with a large share is split."""
    with conf_scope(df.sparkSession, OPEN_FOLDERS):
        df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(target)


def one_file_each(df: DataFrame, target: str, column: str, staged: str) -> None:
    """Store ``df`` as one file per value of ``column`` (few values, null is one).
    All tasks first cut their rows into a folder per value below ``staged``; then one
    task per value packs its folder, so none reads rows of another value."""
    with conf_scope(df.sparkSession, OPEN_FOLDERS):
        df.withColumn(_FOLDER, F.col(column)).write.partitionBy(_FOLDER).option("compression", "zstd").parquet(staged)
    each = [df.sparkSession.read.schema(df.schema).parquet(folder).coalesce(1)
            for folder in subfolders(df.sparkSession, staged) if f"/{_FOLDER}=" in folder]
    with conf_scope(df.sparkSession, {"spark.sql.unionOutputPartitioning": "false"}):  # else one task takes all
        reduce(DataFrame.union, each).write.parquet(target)


def write_partitioned_table(df: DataFrame, table: str, path: str, columns: Sequence[str]) -> None:
    """As ``write_partitioned``, as an external catalog table. The catalog knows
    the partitions, so a filtered read lists only the folders it needs; reading
    the bare path lists all of them."""
    with conf_scope(df.sparkSession, OPEN_FOLDERS):
        (
            df.hint("rebalance", *columns)
            .write.mode("overwrite").format("parquet").option("path", path).partitionBy(*columns).saveAsTable(table)
        )


def spread_by(df: DataFrame, partitions: int, *columns: str, salts: int = 1) -> DataFrame:
    """Hash repartition by columns. With ``salts`` above 1, rows of one key go to
    up to that many partitions, for keys that are too few or too hot."""
    if salts <= 1:
        return df.repartition(partitions, *columns)
    return df.withColumn(_SPREAD, _row_salt(df, salts)).repartition(partitions, *columns, _SPREAD).drop(_SPREAD)


def _row_salt(df: DataFrame, salts: int) -> Column:
    """A number per row from its columns, the same when a task is run again."""
    plain = [field.name for field in df.schema.fields if not isinstance(field.dataType, (MapType, VariantType))]
    return F.pmod(F.xxhash64(*plain), F.lit(salts))


def cut_points(df: DataFrame, columns: Sequence[str], parts: int, sample_rows: int = SAMPLE_ROWS) -> list[list]:
    """Up to ``parts - 1`` ascending cut points of each column, in its own type and
    full length, from a sample of about ``sample_rows`` rows. They steer placement
    only, so a sample does; its size bounds what is collected."""
    for name in columns:
        if isinstance(df.schema[name].dataType, (ArrayType, MapType, StructType, VariantType)):
            raise TypeError(f"cannot cluster by {name}: {df.schema[name].dataType.simpleString()}")
    rows = df.select(*columns)
    share = min(1.0, sample_rows / max(1, rows.count()))
    held = rows if share == 1.0 else rows.sample(share, seed=17)
    sample = held.limit(2 * sample_rows).collect()
    cuts = []
    for place in range(len(columns)):
        values = sorted(row[place] for row in sample if row[place] is not None and row[place] == row[place])
        picked = [values[len(values) * part // parts] for part in range(1, parts)] if values else []
        cuts.append(picked)
    return cuts


def _rank_steps(df: DataFrame, column: str, cuts: Sequence, bits: int, rank: str) -> DataFrame:
    """Number of cut points not above the column, by binary search over a literal
    array: one comparison per bit, all in generated code. A null is below all."""
    ranked = df.withColumn(rank, F.lit(0))
    if not cuts:
        return ranked
    kind = df.schema[column].dataType
    points = F.array(*[F.lit(cut).cast(kind) for cut in cuts])
    for bit in reversed(range(bits)):
        step = 1 << bit
        above = F.col(column) >= F.element_at(points, F.col(rank) + F.lit(step))
        ranked = ranked.withColumn(rank, F.col(rank) + F.when(above, F.lit(step)).otherwise(F.lit(0)))
    return ranked


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """Add the Morton code of the columns' ranks among sampled quantiles, so that
    skewed columns still use the whole code range without a global ranking."""
    coded, code, ranks = df, F.lit(0).cast("bigint"), []
    for i, (name, cuts) in enumerate(zip(columns, cut_points(df, columns, 1 << bits))):
        rank = f"_r{i}"
        coded = _rank_steps(coded, name, cuts, bits, rank)
        ranks.append(rank)
        for bit in range(bits):
            part = F.shiftright(F.col(rank), bit).bitwiseAND(F.lit(1)).cast("bigint")
            code = code.bitwiseOR(F.shiftleft(part, bit * len(columns) + i))
    return coded.withColumn(Z_VALUE, code).drop(*ranks)


def cluster(df: DataFrame, target: str, columns: Sequence[str], files: int, bits: int = 8,
            mode: str = "overwrite") -> None:
    """Write ``df`` so that files cover small ranges of every given column.

    The range shuffle is by (code, spread), so rows sharing one code, such as a
    hot key, can be cut into several files. Rows equal in all columns stay together.
    """
    (
        with_z_value(df, columns, bits)
        .withColumn(_SPREAD, _row_salt(df, 1024))
        .repartitionByRange(files, Z_VALUE, _SPREAD)
        .sortWithinPartitions(Z_VALUE)
        .drop(Z_VALUE, _SPREAD)
        .write.mode(mode).parquet(target)
    )


def cluster_files(spark: SparkSession, path: str, target: str, columns: Sequence[str],
                  file_bytes: int = SORTED_FILE_BYTES, modified_after: str | None = None) -> None:
    """Cluster a stored table, or with ``modified_after`` only its newer files,
    which are added to the already clustered target."""
    reader = spark.read
    total = stored_bytes(spark, path) if not modified_after else 0
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
        newer = spark.read.format("binaryFile").option("modifiedAfter", modified_after).option(
            "recursiveFileLookup", "true").load(path)
        total = newer.agg(F.sum("length")).first()[0] or 0
    files = files_for(total, file_bytes)
    cluster(reader.parquet(path), target, columns, files, mode="append" if modified_after else "overwrite")


def file_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per data file: row count and the range of each column."""
    ranges = [
        f(name).alias(f"{label}_{name}")
        for name in columns for label, f in (("min", F.min), ("max", F.max))
    ]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("row_count"), *ranges)


def swap_location(spark: SparkSession, table: str, path: str) -> None:
    """Point an external catalog table at a new folder. A partition keeps a location
    of its own, so those of a partitioned table are repointed one by one: a reader in
    between finds old or new files of each partition, never none. Partitions that only
    the new folder has are then added, and those that it lacks dropped from the catalog
    (their files stay). Every step may be repeated; call it again after a failure."""
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        gone = []
        for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
            folder = f"{path}/{row[0]}"
            if path_exists(spark, folder):
                spark.sql(f"ALTER TABLE {table} PARTITION {_partition(row[0])} SET LOCATION '{_quoted(folder)}'")
            else:
                gone.append(_partition(row[0]))
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(path)}'")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        for start in range(0, len(gone), 200):
            parts = ", ".join(f"PARTITION {spec}" for spec in gone[start:start + 200])
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(path)}'")
    spark.catalog.refreshTable(table)


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _partition(spec: str) -> str:
    """``a=1/b=x`` as a SQL partition spec."""
    pairs = (part.split("=", 1) for part in spec.split("/"))
    return "(" + ", ".join("`{}` = '{}'".format(
        unquote(name).replace("`", "``"), unquote(value).replace("\\", "\\\\").replace("'", "\\'"))
        for name, value in pairs) + ")"


def collect_statistics(spark: SparkSession, table: str, columns: Sequence[str] | str | None = None) -> None:
    """Table statistics, and column statistics for some columns or ``"all"``."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns == "all":
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    elif columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


@contextmanager
def cached(df: DataFrame, warm: bool = True) -> Iterator[DataFrame]:
    """Keep a frame cached within a block, spilling to disk when memory is short.
    Cache only the columns and rows the block needs."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if warm:
            held.count()
        yield held
    finally:
        held.unpersist()


@contextmanager
def cached_table(spark: SparkSession, table: str, warm: bool = True) -> Iterator[DataFrame]:
    """As ``cached``, for a catalog table: every query of the session that reads
    it in the block uses the cache."""
    spark.catalog.cacheTable(table, StorageLevel.MEMORY_AND_DISK)
    try:
        if warm:
            spark.table(table).count()
        yield spark.table(table)
    finally:
        spark.catalog.uncacheTable(table)


def clear_cache(spark: SparkSession) -> None:
    """Drop every cached table and frame of the session's application."""
    spark.catalog.clearCache()


def timed(make: Callable[[], DataFrame], runs: int = 3) -> list[float]:
    """Seconds of each full execution; the no-op sink keeps every column and the
    sort, which a count would let the optimizer drop."""
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - started)
    return seconds
