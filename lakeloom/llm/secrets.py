"""Secret scan with corpus-wide ownership, with DataFrame functions only.

Base patterns are found in every text. Long mixed tokens are candidates too; how
many owners and repositories hold a candidate's hash tells widely copied examples
from credentials of one owner, and tokens of one owner are added as spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require, stored

ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: Runs are maximal, so the least length can be part of these patterns. It cannot for
#: an assignment: a short one uses up its characters.
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}", "token": "[A-Za-z0-9_-]{20,}"}
KINDS = tuple(PATTERNS)
BASE = KINDS[:3]
_SPAN = "array<struct<start:int,kind:int,end:int,hash:string>>"
#: Matches that are placed together; a text's matches are cut into such blocks.
BLOCK = 256


def _spans(text: Column, kind: str) -> Column:
    """Spans of one kind in order, from the lengths of matches and of what is between.

    An array that grows by one is copied each time, so matches are placed block by
    block: the starts of blocks first, then the matches within each."""
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    number = KINDS.index(kind)
    empty = F.array().cast(_SPAN)

    def place(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["hit"])
        value = F.regexp_extract(pair["hit"], pattern, 2) if kind == "assign" else pair["hit"]
        one = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), F.sha2(value, 256).alias("hash"))
        if kind == "assign":
            good = F.length(value) >= 12
        elif kind == "token":
            good = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
        else:
            good = F.lit(True)
        found = F.when(good, F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def begin(state: Column, block: Column) -> Column:
        size = F.aggregate(block, F.lit(0), lambda total, pair: total + pair["gap"] + F.length(pair["hit"]))
        one = F.struct(state["at"].alias("at"), block.alias("pairs"))
        return F.struct((state["at"] + size).alias("at"), F.concat(state["blocks"], F.array(one)).alias("blocks"))

    pairs = F.filter(F.transform(
        F.arrays_zip(between.alias("before"), hits.alias("hit")),
        lambda pair: F.struct(F.length(pair["before"]).alias("gap"), pair["hit"].alias("hit"))), lambda pair: pair["hit"].isNotNull())
    none = F.array().cast("array<struct<at:int,pairs:array<struct<gap:int,hit:string>>>>")

    def in_blocks(pairs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")),
                             lambda number: F.slice(pairs, number * BLOCK + 1, BLOCK))
        begun = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), none.alias("blocks")), begin, lambda end: end["blocks"])
        return F.flatten(F.transform(begun, lambda block: F.aggregate(
            block["pairs"], F.struct(block["at"].alias("at"), empty.alias("found")), place, lambda end: end["found"])))

    # An array of one binds the pairs, which are then not computed again for each block.
    placed = F.get(F.transform(F.array(pairs), in_blocks), F.lit(0))
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "lang", few: int = 1) -> DataFrame:
    """doc_id, base and added spans, and how widely their values are copied; a row a row.

    ``base`` and ``added`` are arrays of (start, kind, end, hash), positions in code
    points; kinds count in the order of ``KINDS``. A repository is an owner with the
    value of ``repository``; a null owner or repository is a value of its own. A
    token is added if it overlaps no base span and at most ``few`` owners hold its
    value. ``n_copied`` and ``n_owned`` count base and token spans found with more,
    or at most so many, owners. Null and empty texts have no spans. Rows that repeat
    are scanned each and count as one holder. Other columns are ignored.
    """
    require(docs, "doc_id", "text", owner, repository)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(
        "doc_id", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.concat(*[_spans(text, kind) for kind in BASE]).alias("base"), _spans(text, "token").alias("tokens"))
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    # The numbers are safe to use as keys because they are written down here.
    rows = stored(found.withColumn("tokens", apart).withColumn("row", F.monotonically_increasing_id()), "secrets-found")
    spans = rows.select("row", "owner", "repository", F.explode(F.concat("base", "tokens")).alias("span")).withColumn(
        "hash", F.col("span.hash"))
    holders = spans.select("hash", "owner", "repository").distinct().groupBy("hash", "owner").agg(
        F.count("*").alias("repositories"))
    spread = stored(holders.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")), "secrets-owners")
    owned = F.col("owners") <= few
    judged = spans.join(spread, "hash").groupBy("row").agg(
        F.collect_list(F.when(owned & (F.col("span.kind") == len(BASE)), F.col("span"))).alias("added"),
        F.count(F.when(owned, 1)).alias("n_owned"), F.count(F.when(~owned, 1)).alias("n_copied"),
        F.max("repositories").alias("most_repositories"))
    return rows.join(judged, "row", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(_SPAN)).alias("added"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_owned", "n_copied", "most_repositories")])


def digest(scanned: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *map(count, BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), "n_owned", "n_copied", "most_repositories")


def _sql_spans(kind: str) -> str:
    pattern = PATTERNS[kind].replace("'", "''")
    good = {"assign": "length(v) >= 12", "token": "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')"}
    value = f"regexp_extract(hit, '{pattern}', 2)" if kind == "assign" else "hit"
    return f"""
  SELECT doc_id, owner, repository, '{kind}' AS kind, {KINDS.index(kind)} AS k, s, s + length(hit) AS e, v FROM (
    SELECT doc_id, owner, repository, hit, {value} AS v,
      sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM (SELECT doc_id, owner, repository, unnest(range(1, len(hits) + 1)) AS i, hits[i] AS hit, gaps[i] AS gap FROM (
      SELECT doc_id, owner, repository, regexp_extract_all(text, '{pattern}', 0) AS hits,
        string_split_regex(text, '{pattern}') AS gaps FROM docs))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE {good.get(kind, 'true')}"""


SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(lang, '') AS repository FROM documents),
found AS ({' UNION ALL '.join(_sql_spans(kind) for kind in KINDS)}),
spans AS (
  SELECT * FROM found f WHERE k < 3 OR NOT EXISTS (
    SELECT 1 FROM found b WHERE b.doc_id = f.doc_id AND b.k < 3 AND b.s < f.e AND f.s < b.e)),
spread AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repository)) AS repositories FROM spans GROUP BY v),
judged AS (SELECT s.*, owners, repositories FROM spans s JOIN spread USING (v)),
texts AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) FILTER (k < 3 OR owners <= 1) AS spans,
    count(*) FILTER (owners <= 1) AS n_owned, count(*) FILTER (owners > 1) AS n_copied, max(repositories) AS most
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_owned, 0)::BIGINT AS n_owned, coalesce(n_copied, 0)::BIGINT AS n_copied,
  coalesce(most, 0)::BIGINT AS most_repositories
FROM docs d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""
