"""Group-aware column masks and row filters.

Open-source Spark has no policy enforcement on tables: these functions and views
shape what their readers see, and a reader of the files bypasses them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: what a caller outside the group sees.
MASK_TEXT = "*****"


class MaskPolicy(NamedTuple):
    column: str
    group: str


class RowPolicy(NamedTuple):
    group: str
    otherwise: Column


def groups_of(memberships: DataFrame, user: str) -> frozenset[str]:
    """Groups of one user, from a table (user_name, group_name)."""
    mine = memberships.where(F.col("user_name") == user).select("group_name").distinct()
    return frozenset(row["group_name"] for row in mine.collect())


def mask(df: DataFrame, policies: Iterable[MaskPolicy], groups: Iterable[str]) -> DataFrame:
    """Masked columns become strings, readable to members of the policy's group."""
    held = frozenset(groups)
    return df.withColumns({
        policy.column: F.col(policy.column).cast("string") if policy.group in held else F.lit(MASK_TEXT)
        for policy in policies
    })


def row_filter(df: DataFrame, policy: RowPolicy, groups: Iterable[str]) -> DataFrame:
    """Members of the group see every row; others those meeting the predicate.
    Membership is settled before planning, so the predicate is pushed down."""
    return df if policy.group in frozenset(groups) else df.where(policy.otherwise)


def _text(value: str) -> str:
    """A SQL string literal; backslashes and quotes are taken as they are."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(value: str) -> str:
    """A SQL identifier of one part."""
    return "`" + value.replace("`", "``") + "`"


def _path(value: str) -> str:
    """A table, view or function name of parts joined by dots."""
    return ".".join(_name(part) for part in value.split("."))


def member_test(group: str, memberships: str) -> str:
    """SQL test, evaluated per read, whether the current user is in a group."""
    return (
        f"(SELECT count(*) > 0 FROM {_path(memberships)} m "
        f"WHERE m.user_name = current_user() AND m.group_name = {_text(group)})"
    )


def create_mask_function(spark: SparkSession, name: str, argument: str, kind: str,
                         temporary: bool = True) -> None:
    """A SQL function ``name(member, value)``: the value as text, or the mask."""
    scope = "TEMPORARY " if temporary else ""
    spark.sql(
        f"CREATE OR REPLACE {scope}FUNCTION {_path(name)}(is_member BOOLEAN, {_name(argument)} {kind}) RETURNS STRING "
        f"RETURN CASE WHEN is_member THEN CAST({_name(argument)} AS STRING) ELSE {_text(MASK_TEXT)} END"
    )


def create_masked_view(spark: SparkSession, view: str, source: str, masked: Mapping[str, str],
                       member: str, temporary: bool = True) -> None:
    """A view whose columns in ``masked`` (column to function name) go through
    their mask function; ``member`` is a SQL boolean expression."""
    columns = [
        f"{_path(masked[name])}({member}, {_name(name)}) AS {_name(name)}" if name in masked else _name(name)
        for name in spark.table(_path(source)).columns
    ]
    scope = "TEMPORARY " if temporary else ""
    spark.sql(f"CREATE OR REPLACE {scope}VIEW {_path(view)} AS SELECT {', '.join(columns)} FROM {_path(source)}")


def create_filtered_view(spark: SparkSession, view: str, source: str, member: str,
                         predicate: str, temporary: bool = True) -> None:
    """A view showing all rows to members and matching rows to others."""
    scope = "TEMPORARY " if temporary else ""
    spark.sql(
        f"CREATE OR REPLACE {scope}VIEW {_path(view)} AS SELECT * FROM {_path(source)} "
        f"WHERE CASE WHEN {member} THEN TRUE ELSE {predicate} END"
    )
