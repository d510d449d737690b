"""Great-circle distance as a column expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    north = F.sin((lat2 - lat1) / 2)
    east = F.sin((lon2 - lon1) / 2)
    chord = north * north + F.cos(lat1) * F.cos(lat2) * east * east
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)
