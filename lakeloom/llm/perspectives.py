"""Multi-party chats from every speaker's side, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require

END = "<|end|>\n"
#: Turn numbers in one part of a rendered dialogue.
PART = 1024


def _plain(value: Column, otherwise: str) -> Column:
    """Text in which no marker can stand."""
    return F.replace(F.coalesce(value.cast("string"), F.lit(otherwise)), F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, part_turns: int = PART) -> DataFrame:
    """One row a conversation, speaker and part: text, masks, n_turns.

    Each speaker in turn is the assistant; other speakers are users named by role,
    and ``system`` turns stay system turns and have no side of their own. ``masks``
    are the (start, end) code points of what the assistant says, end marker
    included. A dialogue is cut into parts of ``part_turns`` turn numbers, so one
    row stays bounded; parts joined in order give the whole dialogue.

    Turns go by number, ties by role and text; null numbers are part -1. Repeated
    rows are one turn. A null role speaks as user "unknown" and has no side. Null
    texts are empty. Rows without conv_id belong to no dialogue and are left out.
    "<|" in a text is written "< |". Other columns are ignored.
    """
    require(turns, "conv_id", "turn", "role", "text")
    said = turns.where("conv_id is not null").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    sides = said.where("role is not null and role <> 'system'").select("conv_id", F.col("role").alias("speaker")).distinct()
    mine = F.coalesce(F.col("role") == F.col("speaker"), F.lit(False))
    head = F.when(mine, F.lit("<|assistant|>\n")).when(F.col("role") == "system", F.lit("<|system|>\n")).otherwise(
        F.concat(F.lit("<|user:"), _plain(F.col("role"), "unknown"), F.lit("|>\n")))
    rows = said.join(sides, "conv_id").select(
        "conv_id", "speaker", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long").alias("part"),
        F.struct("turn", "role", "text", mine.alias("mine"), head.alias("head"),
                 F.concat(_plain(F.col("text"), ""), F.lit(END)).alias("body")).alias("turn"))
    dialogues = rows.groupBy("conv_id", "speaker", "part").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def place(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(turn["head"])
        end = start + F.length(turn["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["mine"], F.concat(state["masks"], span)).otherwise(state["masks"]).alias("masks"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    masks = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("masks")), place, lambda state: state["masks"])
    return dialogues.select(
        "conv_id", "speaker", "part",
        F.array_join(F.transform("turns", lambda turn: F.concat(turn["head"], turn["body"])), "").alias("text"),
        masks.alias("masks"), F.size("turns").cast("long").alias("n_turns"))


def digest(dialogues: DataFrame) -> DataFrame:
    return dialogues.withColumn("masks", F.array_join(F.transform("masks", lambda span: F.concat_ws(
        ":", span["start"].cast("string"), span["end"].cast("string"))), ","))


SQL = f"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
sides AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role IS NOT NULL AND role <> 'system'),
cut AS (
  SELECT conv_id, speaker, coalesce(floor(turn / {PART}), -1)::BIGINT AS part, turn, role, text,
    coalesce(role = speaker, false) AS mine,
    CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
      ELSE '<|user:' || replace(coalesce(role, 'unknown'), '<|', '< |') || '|>' || chr(10) END AS head,
    replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM said JOIN sides USING (conv_id)),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER w AS stop FROM cut
  WINDOW w AS (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role NULLS FIRST, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, speaker, part, string_agg(head || body, '' ORDER BY stop) AS text,
  string_agg((stop - length(body))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY stop) FILTER (mine) AS masks,
  count(*)::BIGINT AS n_turns
FROM placed GROUP BY conv_id, speaker, part
"""
