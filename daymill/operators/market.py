"""Price feed: three parallel series joined into one frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions import clock

# The arrays of a payload and the columns they become.
SERIES = {"prices": "price", "total_volumes": "volume", "market_caps": "market_cap"}


def _series(field: str) -> Column:
    """The array of a payload; a payload without it is an error, an empty one is not."""
    missing = F.raise_error(F.lit(f"payload without {field}")).cast("array<array<double>>")
    return F.when(F.col(field).isNull(), missing).otherwise(F.col(field))


def explode_series(
    payloads: DataFrame, field: str, value: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows ``timestamp_ms`` and ``value`` from an array of ``[ms, value]`` pairs."""
    points = F.transform(
        _series(field),
        lambda p: F.struct(p[0].cast("bigint").alias("timestamp_ms"), p[1].alias(value)),
    )
    return payloads.select(*keys, F.inline(points))


def _tagged(field: str, kind: int) -> Column:
    def point(p: Column) -> Column:
        ms = p[0].cast("bigint").alias("ms")
        return F.struct(ms, F.lit(kind).alias("kind"), p[1].alias("value"))

    return F.transform(_series(field), point)


def _of_kind(points: Column, kind: int) -> Column:
    return F.filter(points, lambda p: p["kind"] == kind)


def _moments(points: Column) -> Column:
    """The combinations of the three series at each moment of sorted, tagged points."""

    def at(run: Column) -> Column:
        of = [_of_kind(run, kind) for kind in range(len(SERIES))]

        def row(a: Column, b: Column, c: Column) -> Column:
            named = (x["value"].alias(name) for x, name in zip((a, b, c), SERIES.values()))
            return F.struct(a["ms"].alias("timestamp_ms"), *named)

        return F.flatten(F.transform(of[0], lambda a: F.flatten(F.transform(
            of[1], lambda b: F.transform(of[2], lambda c: row(a, b, c))
        ))))

    def runs(starts: Column) -> Column:
        return F.flatten(F.transform(starts, lambda i, k: at(F.slice(
            points, i + 1, F.coalesce(F.get(starts, k + 1), F.size(points)) - i
        ))))

    places = F.transform(points, lambda p, i: F.struct(i.alias("at"), p["ms"].alias("ms")))
    first = F.filter(
        places, lambda p: F.coalesce(F.get(points, p["at"] - 1)["ms"] != p["ms"], F.lit(True))
    )
    return F.flatten(F.transform(F.array(F.transform(first, lambda p: p["at"])), runs))


def build_coin_frame(payloads: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``datetime``, ``price``, ``volume`` and ``market_cap`` of each moment of each payload.

    A moment missing in any series is left out, and one repeated in a series
    repeats. The series of a payload are sorted together and joined within its
    row, so payloads never meet and nothing is shuffled. ``keys`` are carried
    along.
    """
    tagged = F.concat(*(_tagged(field, kind) for kind, field in enumerate(SERIES)))
    points = F.sort_array(F.filter(tagged, lambda p: p["ms"].isNotNull()))
    joined = F.flatten(F.transform(F.array(points), _moments))
    instant = clock.epoch_ms_to_instant("timestamp_ms").alias("datetime")
    return payloads.select(*keys, F.inline(joined)).select(*keys, instant, *SERIES.values())
