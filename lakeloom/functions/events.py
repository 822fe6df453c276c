"""Device events: envelope decoding, event time, event identity, common columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.shaping import conform, load_time

# Schema of the JSON payload.
PAYLOAD_SCHEMA = "timestamp string, sequence bigint, deviceId string, temperatureC double, status string"

# Columns and types shared by the batch and the streaming route.
EVENT_COLUMNS = {
    "timestamp": "string",
    "sequence": "bigint",
    "deviceId": "string",
    "temperatureC": "double",
    "status": "string",
    "enqueuedTime": "timestamp",
    "offset": "string",
    "sequenceNumber": "bigint",
    "partitionId": "string",
    "etlLoadTs": "timestamp",
}
EVENT_ID = "eventId"

# The recipe of the event identity, which stored identities share.
ID_SEPARATOR = "||"
BUS_MARK, BATCH_MARK, MISSING_PART = "eh", "batch", "\u0000"
BUS_PARTS, NATURAL_PARTS = ("partitionId", "offset"), ("deviceId", "timestamp", "sequence")


def decode_envelope(df: DataFrame, moment: datetime | None = None) -> DataFrame:
    """Bus envelope (body, enqueuedTime, offset, sequenceNumber, partition) to the
    common event columns. A body that is not valid JSON yields null payload
    fields; the envelope columns survive, so no event is lost."""
    payload = F.from_json(F.col("body").cast("string"), PAYLOAD_SCHEMA)
    parsed = df.select(
        "enqueuedTime", "offset", "sequenceNumber", F.col("partition").alias("partitionId"), payload.alias("payload"))
    return conform(parsed.select("*", "payload.*"), EVENT_COLUMNS, defaults={"etlLoadTs": load_time(moment)})


def conform_events(df: DataFrame, moment: datetime | None = None) -> DataFrame:
    """Any batch file layout to the common event columns."""
    return conform(df, EVENT_COLUMNS, defaults={"etlLoadTs": load_time(moment)})


def event_time(column: Column | str) -> Column:
    """ISO-8601 text, with or without fraction, ``Z`` or offset; null if junk."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def without_zulu(column: Column | str) -> Column:
    return F.regexp_replace(column, "Z$", "")


def event_id(strict: bool = False) -> Column:
    """SHA-256 identity: bus position if known, else device, time and sequence.

    Strict mode keeps a placeholder for every missing part, so rows that differ
    only in which part is missing stay apart, and is null when all are missing.
    """
    def digest(mark: str, parts: list[Column]) -> Column:
        return F.sha2(F.concat_ws(ID_SEPARATOR, F.lit(mark), *parts), 256)

    bus = [F.col(name) for name in BUS_PARTS]
    natural = [F.col(name).cast("string") for name in NATURAL_PARTS]
    if strict:
        filled = [F.coalesce(part, F.lit(MISSING_PART)) for part in natural]
        fallback = F.when(F.coalesce(*natural).isNotNull(), digest(BATCH_MARK, filled))
    else:
        fallback = digest(BATCH_MARK, natural)
    known_position = bus[0].isNotNull() & bus[1].isNotNull()
    return F.when(known_position, digest(BUS_MARK, bus)).otherwise(fallback)


def with_event_id(df: DataFrame, strict: bool = False) -> DataFrame:
    """Lead with eventId; rows without an identity (strict mode) are left out."""
    identified = df.withColumn(EVENT_ID, event_id(strict)).where(F.col(EVENT_ID).isNotNull())
    return identified.select(EVENT_ID, *EVENT_COLUMNS)


