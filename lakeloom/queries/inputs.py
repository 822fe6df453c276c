"""Stand-in inputs for the queries: the given tables in the shapes the operators
expect, with edge cases (missing keys, blank text, broken JSON) derived from row
values, and the same shapes as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.upsert import bucket_count
from lakeloom.sources.files import fixture, fixture_glob, stored_bytes

LOAD_TIME = datetime(2024, 2, 1)
RUN_TIME = datetime(2024, 2, 2)


def buckets_for(spark: SparkSession, sf_dir: str, name: str) -> int:
    return max(8, bucket_count(stored_bytes(spark, fixture_glob(sf_dir, name))))


def iso_text(column: str):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as bronze device events, some of them broken."""
    key = F.col("event_id")
    return fixture(spark, sf_dir, "events").select(
        F.when(key % 60 == 2, "").otherwise(iso_text("ts")).alias("timestamp"),
        F.when(key % 61 == 3, -1).otherwise(F.get_json_object("props", "$.k").cast("bigint")).alias("sequence"),
        F.when(key % 50 == 0, None).when(key % 50 == 1, "  ")
        .otherwise(F.concat(F.lit(" device-"), "user_id", F.lit(" "))).alias("deviceId"),
        F.col("value").alias("temperatureC"),
        F.concat(F.lit(" "), "event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
        key.cast("string").alias("offset"),
        key.alias("sequenceNumber"),
        (key % 4).cast("string").alias("partitionId"),
        F.lit(LOAD_TIME).cast("timestamp").alias("etlLoadTs"),
    )


DEVICE_EVENTS_SQL = """
  SELECT CASE WHEN event_id % 60 = 2 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
         CASE WHEN event_id % 61 = 3 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS sequence,
         CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN '  '
              ELSE ' device-' || user_id || ' ' END AS deviceId,
         value AS temperatureC, ' ' || event_type AS status, ts AS enqueuedTime,
         CAST(event_id AS VARCHAR) AS "offset", event_id AS sequenceNumber,
         CAST(event_id % 4 AS VARCHAR) AS partitionId,
         TIMESTAMP '2024-02-01 00:00:00' AS etlLoadTs
  FROM events
"""


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as bus messages with a binary JSON body, a few of them not JSON."""
    body = F.to_json(F.struct(
        iso_text("ts").alias("timestamp"),
        F.col("event_id").alias("sequence"),
        F.concat(F.lit("device-"), "user_id").alias("deviceId"),
        F.col("value").alias("temperatureC"),
        F.col("event_type").alias("status"),
    ))
    return fixture(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 == 5, "{broken").otherwise(body).cast("binary").alias("body"),
        F.col("ts").cast("timestamp").alias("enqueuedTime"),
        F.col("event_id").cast("string").alias("offset"),
        F.col("event_id").alias("sequenceNumber"),
        (F.col("event_id") % 4).cast("string").alias("partition"),
    )


def _decoded_sql() -> str:
    fields = {
        '"timestamp"': "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
        "sequence": "event_id",
        "deviceId": "'device-' || user_id",
        "temperatureC": "value",
        "status": "event_type",
    }
    payload = ", ".join(
        f"CASE WHEN event_id % 97 <> 5 THEN {value} END AS {name}" for name, value in fields.items()
    )
    return f"""
  SELECT {payload}, ts AS enqueuedTime, CAST(event_id AS VARCHAR) AS "offset",
         event_id AS sequenceNumber, CAST(event_id % 4 AS VARCHAR) AS partitionId,
         TIMESTAMP '2024-02-01 00:00:00' AS etlLoadTs
  FROM events
"""


DECODED_SQL = _decoded_sql()

EVENT_ID_SQL = """
  CASE WHEN partitionId IS NOT NULL AND "offset" IS NOT NULL
       THEN sha256(concat_ws('||', 'eh', partitionId, "offset"))
       ELSE sha256(concat_ws('||', 'batch', deviceId, "timestamp", CAST(sequence AS VARCHAR))) END
"""


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as rows of batch files: payload columns only, no bus position."""
    return fixture(spark, sf_dir, "events").select(
        iso_text("ts").alias("timestamp"),
        F.col("event_id").alias("sequence"),
        F.concat(F.lit("device-"), "user_id").alias("deviceId"),
        F.col("value").alias("temperatureC"),
        F.col("event_type").alias("status"),
    )


BATCH_FILES_SQL = """
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_id AS sequence,
         'device-' || user_id AS deviceId, value AS temperatureC, event_type AS status,
         CAST(NULL AS TIMESTAMP) AS enqueuedTime, CAST(NULL AS VARCHAR) AS "offset",
         CAST(NULL AS BIGINT) AS sequenceNumber, CAST(NULL AS VARCHAR) AS partitionId,
         TIMESTAMP '2024-02-01 00:00:00' AS etlLoadTs
  FROM events
"""


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as order detail; some keys missing, some values out of range."""
    return fixture(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 500 != 0, F.col("l_orderkey")).alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        (F.col("l_quantity") - 2).alias("OrderQty"),
        (F.col("l_extendedprice") / F.col("l_quantity") - 905).alias("UnitPrice"),
        (F.col("l_discount") - 0.01).alias("UnitPriceDiscount"),
        (F.col("l_extendedprice") - 1000).alias("LineTotal"),
        F.col("l_shipdate").alias("ModifiedDate"),
    )


ORDER_DETAIL_SQL = """
  SELECT CASE WHEN l_partkey % 500 <> 0 THEN l_orderkey END AS SalesOrderID,
         l_linenumber AS SalesOrderDetailID, l_quantity - 2 AS OrderQty,
         l_extendedprice / l_quantity - 905 AS UnitPrice,
         l_discount - 0.01 AS UnitPriceDiscount, l_extendedprice - 1000 AS LineTotal,
         l_shipdate AS ModifiedDate
  FROM lineitem
"""


def order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as order headers."""
    key = F.col("o_orderkey")
    return fixture(spark, sf_dir, "orders").select(
        key.alias("SalesOrderID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.date_add("o_orderdate", (key % 10 - 1).cast("int")).alias("DueDate"),
        F.when(F.col("o_orderstatus") != "P", F.date_add("o_orderdate", (key % 7 - 1).cast("int"))).alias("ShipDate"),
        (F.col("o_totalprice") - 5000).alias("SubTotal"),
        (F.col("o_totalprice") * 0.08).alias("TaxAmt"),
        (F.col("o_totalprice") - 2000).alias("Freight"),
        F.col("o_totalprice").alias("TotalDue"),
    )


ORDER_HEADER_SQL = """
  SELECT o_orderkey AS SalesOrderID, o_orderdate AS OrderDate,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 - 1 AS INTEGER) AS DueDate,
         CASE WHEN o_orderstatus <> 'P'
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 - 1 AS INTEGER) END AS ShipDate,
         o_totalprice - 5000 AS SubTotal, o_totalprice * 0.08 AS TaxAmt,
         o_totalprice - 2000 AS Freight, o_totalprice AS TotalDue
  FROM orders
"""


def transaction_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as transactions, keyed by (order, line, part, supplier)."""
    return fixture(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("TransactionID"),
        F.col("l_partkey").alias("ProductID"),
        F.translate("l_returnflag", "AR", "WS").alias("TransactionType"),
        (F.col("l_quantity") - 1).alias("Quantity"),
        (F.col("l_extendedprice") - 1500).alias("ActualCost"),
    )


TRANSACTION_HISTORY_SQL = """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS TransactionID,
         l_partkey AS ProductID, translate(l_returnflag, 'AR', 'WS') AS TransactionType,
         l_quantity - 1 AS Quantity, l_extendedprice - 1500 AS ActualCost
  FROM lineitem
"""
