"""Checks Spark does not enforce on Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """Rows break a constraint of the table they are meant for."""


def constraint_report(
    df: DataFrame,
    key: str | None = None,
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    numeric: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """``rule``, ``column_name`` and ``violations``, one row per constraint.

    ``unique`` counts the rows that repeat a key. ``numeric`` counts values too
    large for their precision, and those that are no number or infinite; spare
    decimals are rounded on storing and are no violation. One scan serves all: rows are counted per key where they lie,
    then the counts are added up.
    """
    rules: dict[tuple[str, str], Column] = {}
    for name in not_null:
        rules["not_null", name] = F.col(name).isNull()
    for name, length in (max_length or {}).items():
        rules["max_length", name] = F.char_length(name) > length
    for name, (precision, scale) in (numeric or {}).items():
        exact = F.col(name).try_cast("decimal(38,10)")
        rounded = F.round(F.abs(exact), scale)
        large = rounded >= F.lit(f"1e{precision - scale}").cast("decimal(38,10)")
        # What no decimal can hold, like infinity, does not fit either.
        rules["numeric", name] = F.col(name).isNotNull() & F.coalesce(large, F.lit(True))

    counted = {rule: f"c{i}" for i, rule in enumerate(rules)}
    counts = [F.count_if(broken).alias(counted[rule]) for rule, broken in rules.items()]
    if key is None:
        sums = df.agg(*counts)
    else:
        repeats = F.when(F.col(key).isNotNull(), F.col("n") - 1)
        sums = (
            df.groupBy(key)
            .agg(F.count("*").alias("n"), *counts)
            .agg(
                F.coalesce(F.sum(repeats), F.lit(0)).alias("repeats"),
                *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.values()),
            )
        )
        counted = {("unique", key): "repeats", **counted}
    lines = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(name).alias("column_name"),
            F.col(column).alias("violations"),
        )
        for (rule, name), column in counted.items()
    ]
    return sums.select(F.inline(F.array(*lines)))


def require_constraints(df: DataFrame, **constraints) -> None:
    """Raise ``ConstraintViolation`` if ``df`` breaks any of the constraints."""
    broken = constraint_report(df, **constraints).where("violations > 0").collect()
    if broken:
        listed = ", ".join(f"{r.rule}({r.column_name}): {r.violations}" for r in broken)
        raise ConstraintViolation(listed)
