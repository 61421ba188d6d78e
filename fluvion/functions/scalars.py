"""Scalar functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEET = 0.3048


def strip_quotes(s: Column) -> Column:
    """Takes matching quotes and the blanks around them off, however many layers there are: each takes two characters."""
    layers = F.sequence(F.lit(0), F.floor(F.length(s) / 2).cast("int"))
    return F.aggregate(layers, F.trim(s), lambda x, _: F.trim(F.regexp_replace(x, r"^(['\"])([\s\S]*)\1$", "$2")))


def forecast_hour(s: Column) -> Column:
    """An hour from 0 to 23 as two digits, else null."""
    h = s.cast("string").try_cast("int")
    return F.when(h.between(0, 23), F.lpad(h.cast("string"), 2, "0"))


def forecast_day(s: Column) -> Column:
    """A date as yyyymmdd, or a timestamp with its zone, else null."""
    return F.coalesce(F.try_to_timestamp(s, F.lit("yyyyMMdd")), F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss z"))).cast("date")


def forecast_issue(now: Column, source: str) -> tuple[Column, Column]:
    """Date (yyyymmdd) and hour (two digits, null if daily) of the forecast that a source has issued by a time: daily; short, two hours
    back; medium, the last of 00, 06, 12, 18; long, 00."""
    at = now - F.expr("INTERVAL 2 HOURS") if source == "short" else now
    hour = {"daily": F.lit(None).cast("string"), "long": F.lit("00"), "medium": F.lpad(cycle_hour(F.hour(now)).cast("string"), 2, "0"), "short": F.lpad(F.hour(at).cast("string"), 2, "0")}
    return F.date_format(at, "yyyyMMdd"), hour[source]


# Kilometres of a degree of latitude and of longitude at both ends of each band of ten degrees.
LATITUDE_KM = [(110.57, 110.61), (110.61, 110.70), (110.70, 110.85), (110.85, 111.03), (111.03, 111.23), (111.23, 111.41), (111.41, 111.56), (111.56, 111.66), (111.66, 111.69)]
LONGITUDE_KM = [(111.32, 109.64), (109.64, 104.64), (104.65, 96.49), (96.49, 85.39), (85.39, 71.70), (71.70, 55.80), (55.80, 38.19), (38.19, 19.39), (19.39, 0.0)]


def banded_metres(cell: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Width and height of a cell in metres, and metres for a unit of the map, at a latitude. Cells above 0.5 are in metres already."""
    up = F.abs(lat)
    band = F.greatest(F.ceil(up / 10) - 1, F.lit(0)).cast("int")

    def km(ends: list) -> Column:
        low = F.element_at(F.array(*[F.lit(a) for a, _ in ends]), band + 1)
        high = F.element_at(F.array(*[F.lit(b) for _, b in ends]), band + 1)
        return low + (high - low) * (up - band * 10) / 10

    projected, north, east = cell > 0.5, km(LATITUDE_KM), km(LONGITUDE_KM)
    pick = lambda a, b: F.when(projected, a).otherwise(b)
    return pick(cell, cell * east * 1000), pick(cell, cell * north * 1000), pick(F.lit(1.0), 1000 * (north + east) / 2)


def segment_length(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def usgs_tile(lat: Column, lon: Column) -> Column:
    """n40w106 and the like: the tile's north-west corner."""
    top, left = F.ceil(lat), F.floor(lon)
    return F.format_string("%s%02d%s%03d", F.when(top >= 0, "n").otherwise("s"), F.abs(top).cast("int"), F.when(left >= 0, "e").otherwise("w"), F.abs(left).cast("int"))


def cycle_hour(hour: Column, every: int = 6) -> Column:
    """The latest issue hour not after an hour."""
    return (F.floor(hour / every) * every).cast("int")


def forecast_date(name: Column) -> Column:
    """The date in a forecast's file name, or null."""
    d = F.regexp_extract(name, r"Forecast_(\d{8})", 1)
    return F.try_to_timestamp(d, F.lit("yyyyMMdd")).cast("date")


def half_floor(z: Column) -> Column:
    return F.floor(z * 2) / 2


def feet(z: Column) -> Column:
    return z / FEET


def to_cell(x: Column, y: Column, x0: float, dx: float, y0: float, dy: float) -> tuple[Column, Column]:
    """Row and column of a point in a north-up grid."""
    return F.floor((y - y0) / dy).cast("int"), F.floor((x - x0) / dx).cast("int")


def centre(r: Column, c: Column, x0: float, dx: float, y0: float, dy: float) -> tuple[Column, Column]:
    return x0 + (c + 0.5) * dx, y0 + (r + 0.5) * dy


def metres_per_degree(lat: Column) -> tuple[Column, Column]:
    """Metres of a degree of latitude and of longitude: the first terms of the usual series (fixed values)."""
    p = F.radians(lat)
    north = 111132.92 - 559.82 * F.cos(2 * p) + 1.175 * F.cos(4 * p)
    east = 111412.84 * F.cos(p) - 93.5 * F.cos(3 * p)
    return north, east


def reflected(i: Column, n: int) -> Column:
    """An index mirrored at both ends, the edge repeated."""
    m = F.pmod(i, F.lit(2 * n))
    return F.least(m, 2 * n - 1 - m)


def power_scaled(c: Column, e: Column) -> Column:
    """The coefficient of c * q^e for flows in another unit (a million times larger)."""
    return c * F.pow(F.lit(1e-6), e)
