"""Geographic column expressions (native Spark math, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the great-circle weight.
EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres between two (lat, lon) points in degrees.

    ``a = sin²(Δφ/2) + cos φ1 · cos φ2 · sin²(Δλ/2)``,
    ``c = 2 · atan2(√a, √(1−a))``, distance ``= R · c · 1000``. The points are
    taken as (lat1, lon1) -> (lat2, lon2); the height term is zero, so the
    Euclidean combination with it is the identity and is omitted.
    """
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    s_lat = F.sin(dlat / 2)
    s_lon = F.sin(dlon / 2)
    a = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    # rounding may take a over 1 near antipodes
    a = F.least(a, F.lit(1.0))
    c = F.atan2(F.sqrt(a), F.sqrt(1 - a)) * 2
    return F.lit(EARTH_RADIUS_KM) * c * 1000
