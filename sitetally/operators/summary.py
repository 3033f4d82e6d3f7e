"""Adoption percentages and distributions over detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import parse_list, pct

FLAGS = {"pct_online_booking": "has_online_booking", "pct_online_payments": "has_online_payments",
         "pct_online_forms": "has_online_forms"}
CLUES = {"pct_third_party_booking": "third_party_booking_clues", "pct_third_party_forms": "third_party_forms_clues",
         "pct_third_party_payments": "third_party_payments_clues"}


def _count() -> Column:
    return F.count(F.lit(1))


def items(df: DataFrame, column: str) -> Column:
    """A multi-valued column as an array, whether stored as one or as a ``;`` cell."""
    if df.schema[column].dataType.typeName() == "array":
        return F.coalesce(F.col(column), F.array().cast("array<string>"))
    return parse_list(F.col(column))


def adoption(df: DataFrame) -> DataFrame:
    """Row count and percent of rows with each capability, in one pass."""
    return df.agg(_count().alias("num_practices"), *[pct(F.count_if(c), _count()).alias(m) for m, c in FLAGS.items()])


def third_party(df: DataFrame) -> DataFrame:
    """Percent of rows with at least one clue per category; NULL and blank cells have none."""
    return df.agg(*[pct(F.count_if(F.size(items(df, c)) > 0), _count()).alias(m) for m, c in CLUES.items()])


def pms_distribution(df: DataFrame) -> DataFrame:
    """Percent of rows per software guess."""
    total = df.agg(_count()).scalar()
    return df.groupBy(F.coalesce("likely_pms", F.lit("unknown")).alias("software")).agg(_count().alias("n")).select(
        "software", "n", pct(F.col("n"), total).alias("pct"))


def phone_distribution(df: DataFrame) -> DataFrame:
    """Rows per phone provider text and their percent of all rows, most frequent first."""
    total = df.agg(_count()).scalar()
    found = df.select(F.explode_outer(items(df, "phone_clues_site")).alias("provider")).where(
        F.col("provider").isNotNull())
    return found.groupBy(F.lower("provider").alias("provider")).agg(_count().alias("n")).select(
        "provider", "n", pct(F.col("n"), total).alias("pct")).orderBy(F.desc("n"), "provider")


def distributions(df: DataFrame) -> DataFrame:
    """Both distributions as ``metric, key, value`` rows with the count for ordering."""
    pms = pms_distribution(df).select(
        F.lit("pms_distribution_pct").alias("metric"), F.col("software").alias("key"), F.col("pct").alias("value"), "n")
    phone = phone_distribution(df).select(
        F.lit("phone_providers_pct").alias("metric"), F.col("provider").alias("key"), F.col("pct").alias("value"), "n")
    return pms.unionByName(phone)


def _maps(df: DataFrame) -> Column:
    """Per metric a map in order of falling counts. There is one entry per vendor name, not per row of input."""
    entries = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("key"), F.col("value"))))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def summary_row(df: DataFrame) -> DataFrame:
    """The whole summary as one row: scalars and two maps."""
    maps = distributions(df).groupBy("metric").agg(_maps(df).alias("m"))
    empty = F.create_map().cast("map<string,double>")

    def of(metric: str) -> Column:
        return F.coalesce(maps.where(F.col("metric") == metric).select("m").scalar(), empty).alias(metric)

    scalars = df.agg(
        _count().alias("num_practices"), *[pct(F.count_if(c), _count()).alias(m) for m, c in FLAGS.items()],
        *[pct(F.count_if(F.size(items(df, c)) > 0), _count()).alias(m) for m, c in CLUES.items()])
    return scalars.select("num_practices", *FLAGS, of("pms_distribution_pct"), *CLUES, of("phone_providers_pct"))


def summary_json(df: DataFrame) -> DataFrame:
    """One JSON document in a column ``value``."""
    one = summary_row(df)
    return one.select(F.to_json(F.struct(*one.columns)).alias("value"))


def summary_rows(df: DataFrame) -> DataFrame:
    """Tall ``metric, value`` rows; maps as JSON text."""
    one = summary_row(df)
    cells = [F.struct(F.lit(f.name).alias("metric"),
                      (F.to_json(f.name) if f.dataType.typeName() == "map" else F.col(f.name).cast("string")).alias("value"))
             for f in one.schema.fields]
    return one.select(F.inline(F.array(*cells)))
