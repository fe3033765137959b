"""Geocoding by lookup join and company coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import coord_part
from .clean import enrich_subset, known_platforms

# Platforms whose postings carry no coordinate and are geocoded.
GEOCODED_PLATFORMS = ["jobplanet", "jumpit"]


def geocode(df: DataFrame, addresses: DataFrame, platforms: list[str] | None = None,
            known_only: bool = True, fixed_size: bool = False) -> DataFrame:
    """C10 + G2: replace ``coordinate`` of the listed platforms by the
    address table's (lat, lon); a miss gives NULL, as a failed lookup did.
    Other platforms keep their own coordinate. With ``known_only`` rows of
    unknown or NULL platforms are dropped, like the reference's split/union.

    A location that ``addresses`` repeats counts once (its smallest
    coordinate), so no posting is duplicated. A ``fixed_size`` table (literal
    rows) is broadcast as is; for any other the join is left to AQE, which
    broadcasts by measured bytes and splits a hot location.
    """
    platforms = platforms or GEOCODED_PLATFORMS
    dim = addresses.select("location", "lat", "lon")
    if not fixed_size:
        one = dim.where("location IS NOT NULL").groupBy("location").agg(F.min(F.struct("lat", "lon")).alias("_geo"))
        dim = one.select("location", "_geo.lat", "_geo.lon")
    dim = dim.toDF("_geo_location", "_geo_lat", "_geo_lon")
    dim = F.broadcast(dim) if fixed_size else dim
    # Not a plain equality: see _util.lookup_join (NULL locations are in no table, so they match nothing either way).
    same = df["location"] == dim["_geo_location"] if fixed_size else df["location"].eqNullSafe(dim["_geo_location"])
    joined = df.join(dim, same, "left")
    pred = F.col("platform").isin(platforms)

    def enrich(_):
        lat, lon = F.col("_geo_lat"), F.col("_geo_lon")
        return {"coordinate": F.when(lat.isNotNull() & lon.isNotNull(), F.array(lat, lon))}

    out = enrich_subset(joined, pred, enrich, keep=known_platforms() if known_only else None)
    return out.drop("_geo_location", "_geo_lat", "_geo_lon")


def company_detail(df: DataFrame) -> DataFrame:
    """DISTINCT company, lat, lon (NULL-guarded, 1-based, as DOUBLE),
    company_description."""
    return df.select(
        "company",
        coord_part("coordinate", 1).alias("lat"),
        coord_part("coordinate", 2).alias("lon"),
        "company_description",
    ).distinct()


def has_coordinates(df: DataFrame) -> DataFrame:
    """B6."""
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
