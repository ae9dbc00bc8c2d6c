"""Geographic column expressions (all JVM-side, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..params import CITY_LAT, CITY_LON, EARTH_RADIUS_KM, WEATHER_GRID_DEG, WEATHER_GRID_OFFSET


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (R = 6371)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin(F.radians((lat2 - lat1) / 2.0)), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians((lon2 - lon1) / 2.0)), 2))
    return F.asin(F.sqrt(h)) * 2 * EARTH_RADIUS_KM


def equirect_km(lat1, lon1, lat2, lon2, km_per_deg: float = 111.0, lon_scale: float = 0.7) -> Column:
    """Flat-earth distance used by the live window: 111 km per degree, lon x 0.7."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = (lat1 - lat2) * km_per_deg
    dlon = (lon1 - lon2) * km_per_deg * lon_scale
    return F.sqrt(dlat * dlat + dlon * dlon)


def sq_deg_dist(lat1, lon1, lat2, lon2) -> Column:
    """Squared distance in degrees (nearest weather zone in the live window)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = lat1 - lat2
    dlon = lon1 - lon2
    return dlat * dlat + dlon * dlon


def grid_index(c, centre: float, step: float = WEATHER_GRID_DEG, offset: int = WEATHER_GRID_OFFSET) -> Column:
    # rint = half-to-even, the rounding a double gets in the reference warehouse.
    return (F.rint((_c(c) - F.lit(centre)) / F.lit(step)) + F.lit(offset)).cast("int")


def weather_zone(lat, lon, city_lat: float = CITY_LAT, city_lon: float = CITY_LON) -> Column:
    """Zone id 'Z' || ix || iy on a 0.03 degree grid around the city centre.

    Outside 0..4 the id is ambiguous by design (no separator) and matches no
    weather zone.
    """
    return F.concat(F.lit("Z"), grid_index(lat, city_lat).cast("string"),
                    grid_index(lon, city_lon).cast("string"))


def cell_coord(c, digits: int = 2) -> Column:
    """Grid-cell coordinate: value rounded half-up to ``digits`` as a decimal."""
    return F.round(_c(c).cast("decimal(18,6)"), digits).cast(f"decimal(9,{digits})")


def grid_cell(lat, lon, digits: int = 2) -> Column:
    """Text key 'lat|lon' keeping trailing zeros (52.50|13.40)."""
    return F.concat(cell_coord(lat, digits).cast("string"), F.lit("|"), cell_coord(lon, digits).cast("string"))


def heading_deg(lat1, lon1, lat2, lon2) -> Column:
    """Bearing of a segment in degrees, 0..360 (atan2 of lon delta over lat delta)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    return F.pmod(F.degrees(F.atan2(lon2 - lon1, lat2 - lat1)), F.lit(360.0))


def congestion_level(delay) -> Column:
    """1 / (1 + max(0, delay) / 180)."""
    return F.lit(1.0) / (F.lit(1.0) + F.greatest(_c(delay), F.lit(0.0)) / F.lit(180.0))


def city_bbox(lat: float, radius_km: float):
    """Half-extent (lat_delta, lon_delta) of a square box of ``radius_km``."""
    import math
    lat_delta = radius_km / 111.0
    lon_delta = radius_km / (111.0 * max(math.cos(math.radians(lat)), 0.2))
    return lat_delta, lon_delta


def event_load_factor(dist_km, radius_km, impact) -> Column:
    """Per event contribution (1 - d / r) * impact inside the impact radius, else 0."""
    dist_km, radius_km, impact = map(_c, (dist_km, radius_km, impact))
    r = F.coalesce(radius_km, F.lit(3.0))
    return F.when(dist_km < r, (F.lit(1.0) - dist_km / F.greatest(r, F.lit(0.1))) * F.coalesce(impact, F.lit(0.0))) \
        .otherwise(F.lit(0.0))
