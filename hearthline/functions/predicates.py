"""Predicates and small column expressions used to choose rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def in_any(values: dict[str, list]) -> Column:
    """A listed value in any of the columns."""
    return any_of([F.col(c).isin(list(v)) for c, v in values.items() if v])


def keyphrase_match(fields: list[str], phrases: list[str]) -> Column:
    """Any phrase inside any field, ignoring case."""
    return any_of([F.lower(F.col(f)).contains(p.lower()) for f in fields for p in phrases])


def regex_match(fields: list[str], spec: dict) -> Column:
    """A pattern specification: ``filter`` lists, ``must_contain``, ``must_not_contain``.

    Each inner list is a set of alternatives; all lists must hold. A text field
    that is null never matches and never excludes.
    """

    def found(alternatives: list[str]) -> Column:
        pattern = "|".join(alternatives)
        return any_of([F.coalesce(F.col(f).rlike(pattern), F.lit(False)) for f in fields])

    wanted = [F.col(c).isin(list(v)) for c, v in spec.get("filter", {}).items()]
    wanted += [found(group) for group in spec.get("must_contain", [])]
    wanted += [~found(group) for group in spec.get("must_not_contain", [])]
    return all_of(wanted)


def like_any(fields: list[str], pattern: str) -> Column:
    return any_of([F.col(f).like(pattern) for f in fields])


def exclude_categories(values: dict[str, list]) -> Column:
    """No restricted value in any column; a null category is dropped too."""
    return all_of([~F.col(c).isin(list(v)) for c, v in values.items()])


def in_bounds(bounds: dict[str, tuple]) -> Column:
    return all_of([F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()])


def any_flag(columns: list[str]) -> Column:
    """At least one of the flags is ``Y``."""
    return F.coalesce(F.array_contains(F.array(*columns), "Y"), F.lit(False))


def relabel(column: str, mapping: dict[str, str]) -> Column:
    """Replace listed values and keep the others."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col(column)], F.col(column))


def store_key(division: str, store: str) -> Column:
    return F.concat(F.col(division).cast("string"), F.lit("_"), F.col(store).cast("string"))


def market_label(division: str, prefixes: list[str]) -> Column:
    """``new market`` for a listed three-letter prefix on a longer division code."""
    is_new = F.substring(F.col(division), 1, 3).isin(prefixes) & (F.length(division) > 3)
    return F.when(is_new, "new market").otherwise("existing")


def trim_check_digit(code) -> Column:
    """Product code without its last character."""
    code = F.col(code) if isinstance(code, str) else code
    return code.substr(F.lit(1), F.length(code) - 1)


def in_square(x: str, y: str, x_range: tuple, y_range: tuple) -> Column:
    return F.col(x).between(*x_range) & F.col(y).between(*y_range)


def in_radius(x: str, y: str, centre: tuple, radius: float) -> Column:
    dx, dy = F.col(x) - centre[0], F.col(y) - centre[1]
    return dx * dx + dy * dy <= radius * radius


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance between two points given in degrees, in km."""
    a_lat, a_lon, b_lat, b_lon = (
        F.radians(F.col(c) if isinstance(c, str) else c) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((b_lat - a_lat) / 2), 2)
    half = half + F.cos(a_lat) * F.cos(b_lat) * F.pow(F.sin((b_lon - a_lon) / 2), 2)
    return F.lit(6371.0) * 2 * F.atan2(F.sqrt(half), F.sqrt(1 - half))
