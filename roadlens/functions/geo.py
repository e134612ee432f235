"""Cells for density maps, and the colour and label of a severity."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres, and the latitude the map is centred on.
EARTH_RADIUS = 6371008.8
CENTRE_LATITUDE = 39.5
# RGBA per severity, and the colour of any other value.
SEVERITY_COLOURS = {
    1: (0, 200, 100, 180),
    2: (255, 220, 0, 180),
    3: (255, 140, 0, 200),
    4: (220, 30, 30, 220),
}
OTHER_COLOUR = (150, 150, 150, 180)
# Names of the severities.
SEVERITY_LABELS = {1: "Minor", 2: "Moderate", 3: "Serious", 4: "Critical"}


def metres_per_degree(latitude: float = CENTRE_LATITUDE) -> tuple[float, float]:
    """Metres per degree of longitude and of latitude, on a plane tangent at ``latitude``."""
    north = EARTH_RADIUS * math.pi / 180
    return north * math.cos(math.radians(latitude)), north


def hex_cell(lat: Column, lng: Column, radius: float, latitude: float = CENTRE_LATITUDE) -> tuple[Column, Column]:
    """Axial coordinates (q, r) of the pointy-top hexagon of ``radius`` metres holding a point.

    The plane is an equirectangular one scaled at ``latitude``. Cube rounding:
    of the three rounded coordinates the one that moved most is replaced so
    that they add up to zero.
    """
    east, north = metres_per_degree(latitude)
    x, y = lng * F.lit(east / radius), lat * F.lit(north / radius)
    q = x * F.lit(math.sqrt(3) / 3) - y * F.lit(1 / 3)
    r = y * F.lit(2 / 3)
    s = -q - r

    def near(c: Column) -> Column:
        return F.floor(c + F.lit(0.5))

    moved_q, moved_r, moved_s = F.abs(near(q) - q), F.abs(near(r) - r), F.abs(near(s) - s)
    q_worst = (moved_q > moved_r) & (moved_q > moved_s)
    r_worst = ~q_worst & (moved_r > moved_s)
    return (
        F.when(q_worst, -near(r) - near(s)).otherwise(near(q)),
        F.when(r_worst, -near(q) - near(s)).otherwise(near(r)),
    )


def hex_centre(q: Column, r: Column, radius: float, latitude: float = CENTRE_LATITUDE) -> tuple[Column, Column]:
    """Latitude and longitude of a hexagon's centre."""
    east, north = metres_per_degree(latitude)
    lat = r * F.lit(1.5 * radius / north)
    lng = (q + r / 2) * F.lit(math.sqrt(3) * radius / east)
    return lat, lng


def grid_cell(lat: Column, lng: Column, step: float) -> tuple[Column, Column]:
    """Row and column of the square cell of ``step`` degrees holding a point."""
    return F.floor(lat / F.lit(step)), F.floor(lng / F.lit(step))


def morton(numbers: Sequence[Column], bits: int) -> Column:
    """One number of the lowest ``bits`` bits of several, in turn: near in it is near in all of them.

    Shifted right by as many bits as there are numbers, it is that of the numbers shifted by one.
    """
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, n in enumerate(numbers):
            own = F.shiftright(n.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(own, bit * len(numbers) + i))
    return code


def from_morton(code: Column, of: int, bits: int) -> list[Column]:
    """The ``of`` numbers of ``bits`` bits that ``morton`` made one of."""
    out = []
    for i in range(of):
        n = F.lit(0).cast("bigint")
        for bit in range(bits):
            own = F.shiftright(code, bit * of + i).bitwiseAND(F.lit(1).cast("bigint"))
            n = n.bitwiseOR(F.shiftleft(own, bit))
        out.append(n)
    return out


def severity_colour(severity: Column) -> Column:
    colour = F.when(F.lit(False), F.array().cast("array<int>"))
    for level, rgba in SEVERITY_COLOURS.items():
        colour = colour.when(severity == level, F.array(*[F.lit(v) for v in rgba]))
    return colour.otherwise(F.array(*[F.lit(v) for v in OTHER_COLOUR]))


def severity_label(severity: Column) -> Column:
    """The name of a severity; NULL for any other value."""
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for level, name in SEVERITY_LABELS.items():
        label = label.when(severity == level, F.lit(name))
    return label
