"""Great-circle distance as a native column expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schema import EARTH_RADIUS_MILES


def haversine_miles(lat1, lon1, lat2, lon2, earth_radius: float = EARTH_RADIUS_MILES) -> Column:
    """Haversine distance; null when any coordinate is null (unknown zone)."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = phi2 - phi1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2.0), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2.0), 2)
    return F.lit(earth_radius) * 2 * F.asin(F.sqrt(a))
