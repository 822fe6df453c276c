"""Computed tables: a row's id turned into columns by a specification.

A column is a function of the id: a cycle, a day, a repeatable draw or a label. Draws
come from a fixed integer mix of the id, so that runs repeat and retried tasks produce
the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the linear mix.
MIX_MULTIPLIER = 1103515245
MIX_INCREMENT = 12345
MIX_MODULUS = 2147483648

# Labels of the demo tables.
REGIONS = ("NA", "EMEA", "APAC", "LATAM")
TIERS = ("Bronze", "Silver", "Gold", "Platinum")

Computed = Callable[[Column], Column]


def mixed(id_column: Column, modulus: int, salt: int = 0) -> Column:
    """A repeatable draw from 0 .. modulus-1."""
    reduced = F.pmod(id_column + F.lit(salt), F.lit(MIX_MODULUS))
    draw = F.pmod(reduced * F.lit(MIX_MULTIPLIER) + F.lit(MIX_INCREMENT), F.lit(MIX_MODULUS))
    return F.pmod(F.shiftright(draw, 8), F.lit(modulus))


def pick(labels: tuple[str, ...], position: Column) -> Column:
    """Label at a 0-based position that cycles through the labels."""
    index = (F.pmod(position, F.lit(len(labels))) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(label) for label in labels]), index)


def cycle(count: int, first: int = 0) -> Computed:
    return lambda key: F.pmod(key, F.lit(count)) + F.lit(first)


def days(first: str, count: int) -> Computed:
    return lambda key: F.date_add(F.lit(first).cast("date"), F.pmod(key, F.lit(count)).cast("int"))


def drawn(count: int, kind: str, per: float = 1, first: int = 0, salt: int = 0) -> Computed:
    """A draw below ``count``, raised by ``first`` and divided by ``per``, cast to a type."""
    def column(key: Column) -> Column:
        value = mixed(key, count, salt) + F.lit(first)
        return (value if per == 1 else value / F.lit(per)).cast(kind)

    return column


def cases(labels: Sequence[str]) -> Computed:
    """Labels in turn, by a searched CASE."""
    def column(key: Column) -> Column:
        place = F.pmod(key, F.lit(len(labels)))
        chosen = F.when(place == 0, labels[0])
        for number, label in enumerate(labels[1:-1], start=1):
            chosen = chosen.when(place == number, label)
        return chosen.otherwise(labels[-1])

    return column


def computed(ids: DataFrame, columns: Mapping[str, Computed], key: str = "id") -> DataFrame:
    """One row an id, with a column for each entry."""
    return ids.select(*[make(F.col(key)).alias(name) for name, make in columns.items()])
