"""Scalar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import finite, holds


def number_label(value: float) -> str:
    """A number in a column name: 25 for 25.0, 2p5 for 2.5."""
    return f"{value:g}".replace(".", "p")


def close(a: Column, b: Column | float, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    b = F.lit(b) if not isinstance(b, Column) else b
    return holds(F.abs(a - b) <= absolute + relative * F.abs(b))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where the division or its result is not finite."""
    return finite(F.try_divide(a, b))


def normalised_difference(a: Column, b: Column) -> Column:
    return ratio(a - b, a + b)


def canonical_depth(value: Column, sign: str = "positive_down", zero_is_valid: bool = True) -> Column:
    """Depth below the surface, positive down; null above the surface, and at zero unless zero is valid."""
    if sign not in ("positive_down", "negative_elevation"):
        raise ValueError(f"unknown depth sign: {sign}")
    depth = finite(value)
    depth = -depth if sign == "negative_elevation" else depth
    depth = depth + F.lit(0.0)
    return F.when(depth >= 0 if zero_is_valid else depth > 0, depth)


def reflectance(digital: Column, scale: float = 0.0001, offset: float = 0.0, nodata: float | None = None) -> Column:
    value = finite(digital)
    value = value if nodata is None else F.when(value != nodata, value)
    return value * scale + offset


def version_key(version: Column) -> Column:
    """A dotted version as an array of numbers, ordered as versions are; [0] if a part is not a number."""
    parts = F.transform(F.split(version, "\\."), lambda x: x.try_cast("int"))
    return F.when(F.exists(parts, lambda x: x.isNull()) | version.isNull(), F.array(F.lit(0))).otherwise(parts)


def resolution_class(ratio_: Column, minimum: float = 1.0) -> Column:
    """How well a distance is resolved, from its ratio to the native resolution."""
    return F.when(finite(ratio_).isNull(), "unavailable").when(ratio_ < minimum, "below_native_resolution").when(ratio_ < 2 * minimum, "marginally_resolved").otherwise("well_resolved")


def format_value(value: Column, kind: str = "number", unit: str = "", missing: str = "Not available") -> Column:
    """A value as a reader sees it: two decimals and a unit, Yes or No, or words in title case."""
    if kind == "boolean":
        shown = F.when(value, "Yes").otherwise("No")
    elif kind == "category":
        shown = F.initcap(F.replace(value.cast("string"), F.lit("_"), F.lit(" ")))
    else:
        shown = F.concat(F.format_string("%.2f", finite(value)), F.lit(f" {unit}" if unit else ""))
    present = value.isNotNull() if kind != "number" else finite(value).isNotNull()
    return F.when(present, shown).otherwise(missing)


def palette_position(value: Column, low: Column, high: Column) -> Column:
    """Where a value lies between low and high, clipped to 0 and 1; the middle if they are equal."""
    return F.when(value.isNull(), None).when(high == low, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - low) / (high - low))))


def palette_colour(position: Column, palette: list[tuple[int, int, int]], missing: tuple[int, int, int, int] = (150, 150, 150, 120), alpha: int = 210) -> Column:
    """[r, g, b, a] between the stops of a palette, rounded half to even; the missing colour for null."""
    at = position * (len(palette) - 1)
    low = F.least(F.floor(at).cast("int"), F.lit(len(palette) - 2))
    channel = lambda i: F.bround(F.element_at(F.array(*[F.lit(float(c[i])) for c in palette]), low + 1) * (1 - (at - low)) + F.element_at(F.array(*[F.lit(float(c[i])) for c in palette]), low + 2) * (at - low)).cast("int")
    return F.when(position.isNull(), F.array(*[F.lit(c) for c in missing])).otherwise(F.array(channel(0), channel(1), channel(2), F.lit(alpha)))


def great_circle_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6371.0088) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def fitting_zoom(lon_span: Column, lat_span: Column, width: int = 1200, height: int = 650, fill: float = 0.72) -> Column:
    """The Web Mercator zoom at which spans of degrees fill so much of a view, from 1 to 16."""
    of = lambda pixels, turn, span: F.log2(F.lit(pixels * fill * turn / 256.0) / F.greatest(span, F.lit(1e-6)))
    return F.least(F.lit(16.0), F.greatest(F.lit(1.0), F.least(of(width, 360.0, lon_span), of(height, 170.0, lat_span))))


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres from degrees."""
    radius = 6378137.0
    return F.radians(lon) * radius, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * radius


def transverse_mercator(lon: Column, lat: Column, zone: int = 31) -> tuple[Column, Column]:
    """UTM metres (northern, GRS80) from degrees, by Krueger's series to the third order of the flattening (well under a millimetre within a zone)."""
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    mean_radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3)
    e = 2 * math.sqrt(n) / (1 + n)
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    shift = F.radians(lon - (6 * zone - 183))
    xi, eta = F.atan2(t, F.cos(shift)), F.atanh(F.sin(shift) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, c in enumerate(alpha, 1):
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return 500000.0 + 0.9996 * mean_radius * east, 0.9996 * mean_radius * north


def web_mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees from EPSG:3857 metres."""
    radius = 6378137.0
    return F.degrees(x / radius), F.degrees(2 * F.atan(F.exp(y / radius)) - F.lit(math.pi / 2))


def transverse_mercator_inverse(x: Column, y: Column, zone: int = 31) -> tuple[Column, Column]:
    """Degrees from UTM metres (northern, GRS80), by the inverse of Krueger's series to the third order."""
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    scale = 0.9996 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    north, east = y / scale, (x - 500000.0) / scale
    xi, eta = north, east
    for j, c in enumerate(beta, 1):
        xi = xi - c * F.sin(2 * j * north) * F.cosh(2 * j * east)
        eta = eta - c * F.cos(2 * j * north) * F.sinh(2 * j * east)
    conformal = F.asin(F.sin(xi) / F.cosh(eta))
    lat = conformal
    for j, c in enumerate(delta, 1):
        lat = lat + c * F.sin(2 * j * conformal)
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + float(6 * zone - 183), F.degrees(lat)


def _utm_zone(crs: str) -> int | None:
    code = crs.removeprefix("EPSG:")
    zone = int(code[3:]) if len(code) == 5 and code[:3] in ("326", "258") and code.isdigit() else 0
    return zone if 1 <= zone <= 60 else None


def degrees_of(x: Column, y: Column, crs: str) -> tuple[Column, Column]:
    """Longitude and latitude of coordinates in EPSG:4326, EPSG:3857 or a northern UTM zone (EPSG:326zz, EPSG:258zz); their datums are taken as one."""
    if crs == "EPSG:4326":
        return x, y
    if crs == "EPSG:3857":
        return web_mercator_inverse(x, y)
    if zone := _utm_zone(crs):
        return transverse_mercator_inverse(x, y, zone)
    raise ValueError(f"unknown coordinates: {crs}")


def metres_of(lon: Column, lat: Column, crs: str) -> tuple[Column, Column]:
    """The inverse of degrees_of."""
    if crs == "EPSG:4326":
        return lon, lat
    if crs == "EPSG:3857":
        return web_mercator(lon, lat)
    if zone := _utm_zone(crs):
        return transverse_mercator(lon, lat, zone)
    raise ValueError(f"unknown coordinates: {crs}")


def interpretation(relief: Column, gradient: Column, valid_share: Column, high_relief: float = 20.0, steep: float = 0.01, shoaling: float = -0.0025) -> Column:
    """A sentence or two on a segment, by fixed rules: land, then sea; what is not known is said to be."""
    land = F.when(relief.isNull(), "Terrain is not available.").when(relief >= high_relief, "High land relief near the coast.").otherwise("Low land relief near the coast.")
    sea = (
        F.when(~holds(valid_share > 0), "Depth is not available.").when(gradient.isNull(), "Depth is known, its gradient is not.")
        .when(gradient > steep, "The sea floor deepens fast.").when(gradient < shoaling, "The sea floor shoals seawards.").otherwise("The sea floor deepens gently.")
    )
    return F.concat_ws(" ", land, sea)


def stretched(value: Column, low: Column, high: Column) -> Column:
    """A value between two quantiles as 0 to 255, for display."""
    return F.bround(palette_position(value, low, high) * 255).cast("int")
