"""Line dedup by overlapping three-line windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require, stored

WINDOW = 3


def _windows(text: Column) -> Column:
    """(position, two 64-bit hashes) of each run of three lines that is not all blank."""
    lines = F.split(text, "\n", -1)
    hashed = F.transform(lines, lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"), (F.trim(line) == "").alias("blank")))

    def window(at: Column) -> Column:
        parts = [F.get(F.col("hashed"), at + step) for step in range(WINDOW)]
        blank = parts[0]["blank"] & parts[1]["blank"] & parts[2]["blank"]
        return F.struct(at.alias("pos"), F.xxhash64(*[part["a"] for part in parts]).alias("a"),
                        F.xxhash64(*[part["b"] for part in parts]).alias("b"), blank.alias("blank"))

    starts = F.when(F.size("hashed") >= WINDOW, F.sequence(F.lit(0), F.size("hashed") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    return hashed, F.transform(starts, window)


def _spread(docs: DataFrame) -> DataFrame:
    hashed, windows = _windows(F.col("text"))
    return docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("version"), hashed.alias("hashed")).select(
        "doc_id", "version", F.explode(windows).alias("w")).where("not w.blank").select(
        F.col("w.a").alias("a"), F.col("w.b").alias("b"), F.struct("doc_id", "version", F.col("w.pos").alias("pos")).alias("at"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` shortened, and ``n_lines`` and ``n_removed`` added.

    Every run of three consecutive lines (cut at newlines, compared exactly) that
    stands anywhere before, in order of doc_id and then of lines, is a later
    occurrence; all lines that later occurrences cover go. Runs of blank lines do
    not count, nor do texts of fewer than three lines. Null texts stay null (no
    lines). Null doc_ids come first. Rows equal in doc_id and text are one
    occurrence and get the same result; rows that share only doc_id are told apart
    by their text. Other columns pass through; ``n_lines`` and ``n_removed`` replace
    columns of these names.
    """
    require(docs, "doc_id", "text")
    narrow = docs.select("doc_id", "text")
    spread = _spread(narrow)
    # Hot windows are combined where they are read.
    repeated = stored(spread.groupBy("a", "b").agg(F.min("at").alias("first"), F.max("at").alias("last")).where(
        "first < last").select("a", "b", "first"), "lines-repeated")
    covered = spread.join(repeated, ["a", "b"]).where("at > first").groupBy(
        F.col("at.doc_id").alias("cut_id"), F.col("at.version").alias("cut_version")).agg(
        F.collect_list("at.pos").alias("cuts")).hint("shuffle_hash")
    here = docs.withColumn("__version", F.xxhash64("text"))
    joined = here.join(covered, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("__version") == F.col("cut_version")), "left")
    lines = F.split("text", "\n", -1)
    gone = F.flatten(F.transform("cuts", lambda at: F.array(at, at + 1, at + 2)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.transform(F.col("__left"), lambda at: F.get(F.col("__lines"), at))
    cut = joined.withColumn("__left", F.when(F.col("cuts").isNotNull(), left)).withColumn(
        "__lines", F.when(F.col("cuts").isNotNull(), lines))
    return cut.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.coalesce(F.size("__lines") - F.size("__left"), F.lit(0)).cast("long"),
        "text": F.coalesce(F.when(F.col("cuts").isNotNull(), F.array_join(kept, "\n")), F.col("text")),
    }).select(*[F.col(f"`{name}`") for name in docs.columns if name not in ("n_lines", "n_removed")], "n_lines", "n_removed")


SQL = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
spread AS (
  SELECT doc_id, unnest(range(0, len(ls) - 2)) AS pos, ls FROM lines WHERE text IS NOT NULL AND len(ls) >= 3),
keyed AS (
  SELECT doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] AS key FROM spread),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS nth FROM keyed
  WHERE trim(replace(key, chr(10), ' ')) <> ''),
cuts AS (
  SELECT DISTINCT doc_id, pos + step AS line FROM ranked, (SELECT unnest([0, 1, 2]) AS step) WHERE nth > 1),
gone AS (SELECT doc_id, list(line) AS ats FROM cuts GROUP BY doc_id)
SELECT l.doc_id,
  CASE WHEN ats IS NULL THEN text ELSE coalesce(array_to_string(
    list_transform(list_filter(range(0, len(ls)), lambda i: NOT list_contains(ats, i)), lambda i: ls[i + 1]), chr(10)), '') END AS text,
  CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines, coalesce(len(ats), 0)::BIGINT AS n_removed
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id
"""
