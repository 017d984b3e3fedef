"""Declared parameters of SQL statements: kinds, defaults, choices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from daymill.plans.sql_files import run_file, run_query

# The names of kinds, and what may stand for them.
KINDS: dict[str, tuple[type, ...]] = {
    "string": (str,),
    "integer": (int,),
    "number": (int, float, Decimal),
    "boolean": (bool,),
    "date": (date,),
    "moment": (date, datetime),
}
_NONE = object()


class ParameterError(ValueError):
    """A parameter is unknown, left out, or not what was declared."""


@dataclass(frozen=True)
class Param:
    """What a parameter may be: a kind, values to choose from, bounds, and whether null will do.

    Without a default it must be given.
    """

    kind: str
    default: object = _NONE
    choices: Sequence | None = None
    minimum: object = None
    maximum: object = None
    nullable: bool = False

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ParameterError(f"{self.kind!r} is none of {', '.join(KINDS)}")
        if self.default is not _NONE:
            self.check("default", self.default)

    def check(self, name: str, value: object) -> object:
        if value is None:
            if not self.nullable:
                raise ParameterError(f"{name} must not be null")
            return value
        # True is a whole number and a datetime a date in Python, but not here.
        odd = isinstance(value, bool) and self.kind != "boolean" or isinstance(value, datetime) and self.kind == "date"
        if odd or not isinstance(value, KINDS[self.kind]):
            raise ParameterError(f"{name} is to be a {self.kind}, not {value!r}")
        if self.choices is not None and value not in self.choices:
            raise ParameterError(f"{name} is to be one of {', '.join(map(repr, self.choices))}, not {value!r}")
        try:
            beyond = self.minimum is not None and value < self.minimum or self.maximum is not None and value > self.maximum
        except TypeError as different:
            raise ParameterError(f"{name} {value!r} cannot be compared with its bounds") from different
        if beyond:
            raise ParameterError(f"{name} {value!r} is out of bounds")
        return value


def resolved(declared: Mapping[str, Param], given: Mapping[str, object]) -> dict[str, object]:
    """The values of all declared parameters: given ones that fit, and defaults for the rest."""
    if unknown := sorted(set(given) - set(declared)):
        raise ParameterError(f"not declared: {', '.join(unknown)}")
    if missing := sorted(n for n, p in declared.items() if p.default is _NONE and n not in given):
        raise ParameterError(f"left out: {', '.join(missing)}")
    return {n: p.check(n, given.get(n, p.default)) for n, p in declared.items()}


def run_declared(
    spark: SparkSession, sql: str, declared: Mapping[str, Param], instants: bool = False, **given
) -> DataFrame:
    """As ``run_query``, with parameters that are checked before the statement is.

    The zone may be declared like any other, or be given without that.
    """
    zone, values = _zone_apart(declared, given)
    return run_query(spark, sql, zone, instants, **values)


def _zone_apart(declared: Mapping[str, Param], given: dict) -> tuple[str | None, dict]:
    if "zone" in declared:
        values = resolved(declared, given)
        return values.pop("zone"), values
    return given.pop("zone", None), resolved(declared, given)


def run_declared_file(
    spark: SparkSession,
    name: str,
    declared: Mapping[str, Param],
    search_path: Sequence[str | Path] = (),
    instants: bool = False,
    **given,
) -> DataFrame:
    """As ``run_file``, with parameters that are checked before the statement is."""
    zone, values = _zone_apart(declared, given)
    return run_file(spark, name, search_path, zone, instants, **values)
