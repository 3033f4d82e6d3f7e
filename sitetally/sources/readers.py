"""Readers with explicit schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..dictionaries.fixed import SOURCE_1, SOURCE_2
from ..functions.cells import address
from ..operators.skew import lookup_join


def read_csv(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = True,
             required: Sequence[str] = ()) -> DataFrame:
    """CSV by the names in the header line, whatever their order.

    Columns that ``schema`` does not name are left out, missing ones are NULL, and a missing ``required`` one is an error; so
    is a folder whose files have different headers. A cell that does not fit its type is NULL. A byte-order mark is skipped,
    quoted line breaks are kept, blank cells are NULL. Files that may hold line breaks in cells are read whole, one per task;
    with ``line_breaks=False`` they are split.
    """
    options = {"header": True, "multiLine": line_breaks, "nullValue": "", "escape": '"', "encoding": "UTF-8"}
    found = spark.read.csv(path, **options).columns  # the header of one file; no rows are read
    names = StructType([StructField(n, StringType()) for n in found])
    rows = spark.read.schema(names).csv(path, enforceSchema=False, **options)
    by_name = {n.strip().lstrip("\ufeff").lower(): n for n in found}
    if lacking := [n for n in required if n.lower() not in by_name]:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    return rows.select(*[
        (F.col(f"`{by_name[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in by_name else
         F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_seeds(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Seed cities, trimmed, blanks left out, each city once."""
    city = F.trim("city")
    return read_csv(spark, path, schemas.SEED, line_breaks, ["city"]).where(city != "").select(city.alias("city")).distinct()


def read_listings(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.PRACTICE, line_breaks, ["name"])


def read_detections(spark: SparkSession, path: str, extra: str = "", line_breaks: bool = True) -> DataFrame:
    """Flat detections; ``extra`` names further columns in DDL, such as ``pms_clues_jobs string``."""
    schema = StructType(list(schemas.DETECTION_CSV.fields))
    if extra:
        schema = StructType(schema.fields + StructType.fromDDL(extra).fields)
    return read_csv(spark, path, schema, line_breaks, ["id"])


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CAPTURE).parquet(path)


def normalize_feed_a(pages: DataFrame, details: DataFrame) -> DataFrame:
    """Listings of the first feed. The website is the business's own if given, else its page at the feed."""
    b = pages.select("city", F.explode("businesses").alias("b"))
    rows = b.select(
        F.col("b.id").alias("id"), F.col("b.name").alias("name"), F.col("city").alias("seed_city"),
        address(F.col("b.location.address1"), F.col("b.location.city"), F.col("b.location.state")).alias("address"),
        F.col("b.display_phone").alias("phone"))
    own = F.nullif(F.col("d.website"), F.lit(""))
    once = details.groupBy("id").agg(F.min(F.struct("website", "url")).alias("d"))
    joined = lookup_join(rows, once, "id")
    return joined.select(
        F.col("seed_city").alias("city"), "name", "address", F.coalesce(own, F.col("d.url"), F.lit("")).alias("website"),
        F.when(own.isNotNull(), "own").when(F.col("d.url").isNotNull(), "listing").otherwise("none").alias("website_kind"),
        "phone", F.lit(SOURCE_1).alias("source"))


def normalize_feed_b(pages: DataFrame, details: DataFrame) -> DataFrame:
    """Listings of the second feed; website and phone come from the details."""
    r = pages.select("city", F.explode("results").alias("r"))
    rows = r.select(
        F.col("r.place_id").alias("place_id"), F.col("r.name").alias("name"), F.col("city").alias("city"),
        F.col("r.formatted_address").alias("address"))
    once = details.groupBy("place_id").agg(F.min("result").alias("d"))
    joined = lookup_join(rows, once, "place_id")
    return joined.select(
        "city", "name", "address", F.coalesce("d.website", F.lit("")).alias("website"),
        F.coalesce("d.formatted_phone_number", F.lit("")).alias("phone"), F.lit(SOURCE_2).alias("source"))
