"""Column helpers shared by the operators.  All return SQL text or Columns."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unnest(rows: DataFrame, *keep: str, **array: Column) -> DataFrame:
    """One row per element of the array named by the keyword, with its position ``pos``.

    The outer form plus a NULL test gives the same rows as a plain explode, but
    keeps the optimizer from inferring a ``size(array) > 0`` filter, which it
    would push below the projection that builds the array and so build it twice.
    """
    (name, value), = array.items()
    out = rows.select(*keep, F.posexplode_outer(value).alias("pos", name))
    return out.where(F.col(name).isNotNull())


def sql_in(column: str, values: Iterable[str | int]) -> str:
    return f"{column} IN (" + ", ".join(sql_text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def half_even(column: Column | str) -> Column:
    """Round to the nearest integer, halves to even, as a BIGINT; values beyond its range are held to it, NaN gives NULL."""
    value = F.bround(column, 0).cast("double")
    held = F.greatest(F.lit(-9.2e18), F.least(F.lit(9.2e18), value))
    return F.when(~F.isnan(value), held).cast("bigint")


def finite(column: Column | str) -> Column:
    """Neither NULL, NaN nor infinite."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def whole(column: Column | str) -> Column:
    """The integer part as a BIGINT, held to its range; NULL if not finite."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(finite(value), F.greatest(F.lit(-9.2e18), F.least(F.lit(9.2e18), value))).cast("bigint")


def to_int(column: Column | str, default: int | None = 0) -> Column:
    """Integer text or ``default``; never raises under ANSI mode."""
    column = F.col(column) if isinstance(column, str) else column
    value = F.trim(column).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def to_float(column: Column | str, default: float | None = 0.0) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    value = F.trim(column).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def pairs(column: str, delimiter: str) -> Column:
    return F.expr(pairs_sql(column, delimiter))


def pairs_sql(column: str, delimiter: str) -> str:
    """Alternating ``k<d>v<d>k<d>v`` text as parallel arrays ``(k, v)``, last pair first; an odd tail is dropped.

    The text is split once.  Storing the pairs in reverse makes a plain
    ``array_position`` find the last duplicate of a key.
    """
    # A delimiter without regex meaning takes the literal split path.
    plain = not set(delimiter) & set("\\^$.|?*+()[]{}")
    pattern = delimiter if plain else chr(92) + "Q" + delimiter + chr(92) + "E"
    parts = f"split({column}, {sql_text(pattern)})"
    back = "sequence(size(p) div 2 - 1, 0, -1)"
    return (
        f"element_at(transform(array({parts}), p -> CASE WHEN size(p) < 2 "
        f"THEN named_struct('k', CAST(array() AS array<string>), 'v', CAST(array() AS array<string>)) "
        f"ELSE named_struct('k', transform({back}, i -> p[2 * i]), 'v', transform({back}, i -> p[2 * i + 1])) END), 1)")


def pick(pairs_column: str, key: str) -> Column:
    """Value of the last pair with this key, NULL when absent."""
    return F.expr(pick_sql(pairs_column, key))


def pick_sql(pairs_column: str, key: str) -> str:
    return f"get({pairs_column}.v, int(array_position({pairs_column}.k, {sql_text(key)})) - 1)"


def pairs_map(pairs_column: str) -> Column:
    """The pairs as a map in which the last duplicate wins.

    Written without relying on ``spark.sql.mapKeyDedupPolicy`` so the result is
    the same on every session.
    """
    keys = f"array_distinct({pairs_column}.k)"
    return F.expr(f"map_from_arrays({keys}, transform({keys}, x -> get({pairs_column}.v, int(array_position({pairs_column}.k, x)) - 1)))")
