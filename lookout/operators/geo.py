"""Geography around places: enrichment by postal code, name fallbacks,
lookups still to do, price per region and map-marker rows (G1..G6, J3..J6).

The geocoder itself (a network service) is not part of the library; its
results arrive as a table ``(postal_code, address map, latitude, longitude)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .search import price_ordinal

CITY_KEYS = ("city", "town", "village", "municipality")
REGION_KEYS = ("region", "state")


def first_present(address: Column, keys) -> Column:
    """G1: first non-empty value among ``keys`` of a map (an empty string
    falls through, as Python's ``or`` does)."""
    return F.coalesce(*[F.nullif(address.getItem(k), F.lit("")) for k in keys])


def resolve_geo(geo: DataFrame) -> DataFrame:
    """G1 applied to a geocoder table: ``(postal_code, city, region,
    latitude, longitude)``."""
    return geo.select("postal_code",
                      first_present(F.col("address"), CITY_KEYS).alias("geo_city"),
                      first_present(F.col("address"), REGION_KEYS).alias("geo_region"),
                      "latitude", "longitude")


def enrich(places: DataFrame, geo: DataFrame, keep_parsed_city: bool = True) -> DataFrame:
    """Left join places to resolved geocoder rows on postal code.

    Places without a match keep null coordinates. A postal code with several
    geocoder rows takes one of them (located rows first, then the smallest), so
    no place is doubled; the planner broadcasts the table only when its
    measured size is under the broadcast threshold. With
    ``keep_parsed_city`` the parsed city is the fallback when the geocoder
    has none (the original overwrote it)."""
    row = F.struct((F.col("latitude").isNull() | F.col("longitude").isNull()).alias("unlocated"),
                   "geo_city", "geo_region", "latitude", "longitude")
    g = resolve_geo(geo).groupBy("postal_code").agg(F.min(row).alias("g")) \
        .select("postal_code", "g.geo_city", "g.geo_region", "g.latitude", "g.longitude")
    j = places.join(g, places.postal_code == g.postal_code, "left").drop(g.postal_code)
    city = F.coalesce(F.col("geo_city"), F.col("city")) if keep_parsed_city else F.col("geo_city")
    return (j.withColumn("city", city)
            .withColumn("region", F.col("geo_region"))
            .drop("geo_city", "geo_region"))


def known_coordinates(df: DataFrame) -> DataFrame:
    """Drop rows without latitude or longitude."""
    return df.na.drop(subset=["latitude", "longitude"])


def missing_keys(places: DataFrame, known: DataFrame, key: str = "postal_code") -> DataFrame:
    """Distinct non-null keys not yet in the ``known`` table."""
    keys = places.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.join(known.select(key), key, "left_anti")


def avg_price_by_region(places: DataFrame, price_col: str = "price_range") -> DataFrame:
    """Mean price ordinal per region; null ordinals are skipped and the
    null region is dropped (as a pandas group-by does)."""
    return (places.where(F.col("region").isNotNull())
            .groupBy("region")
            .agg(F.avg(price_ordinal(F.col(price_col))).alias("price_numeric")))


def region_price_table(regions: DataFrame, averages: DataFrame, name_col: str) -> DataFrame:
    """Region dimension joined to the averages on differently named
    keys (inner)."""
    return regions.join(averages, regions[name_col] == averages["region"], "inner")


def marker_rows(places: DataFrame) -> DataFrame:
    """One map marker per place: coordinates, popup
    ``name<br>address<br>city<br>region`` (nulls printed as in the
    original's f-string) and tooltip."""
    def show(c):
        return F.coalesce(F.col(c), F.lit("nan"))
    popup = F.concat_ws("<br>", show("name"), show("address"), show("city"), show("region"))
    return places.select("doc_id", "latitude", "longitude", popup.alias("popup"),
                         F.col("name").alias("tooltip"))


def semi_by_text(places: DataFrame, result: DataFrame, col: str = "text") -> DataFrame:
    """Rows whose text equals the text of any result row (so every copy
    of a matching text is returned).

    Texts are wide, so only a 64-bit hash of each result text meets the corpus.
    The hashes are written first, so ``result`` is not evaluated for its size
    and the planner broadcasts them only below its threshold; the few candidates
    that share a hash are then compared on the full text, so the result is exact."""
    texts = result.select(F.xxhash64(col).alias("_h"), col).distinct()
    hashes = materialize(texts.select("_h").distinct(), "text-hashes")
    candidates = places.withColumn("_h", F.xxhash64(col)).join(hashes, "_h", "left_semi")
    return candidates.join(texts, ["_h", col], "left_semi").drop("_h")


def semi_by_id(places: DataFrame, result: DataFrame, col: str = "doc_id") -> DataFrame:
    """Rows whose id is in the result, whose ids are written first (broadcast by measured size only)."""
    return places.join(materialize(result.select(col).distinct(), "result-ids"), col, "left_semi")
