"""Business listings: union of sources, limits per city, top-up, de-duplication, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions.urls import target_urls
from .skew import OrderedRows, lookup_join, top_k


def label_source(listings: DataFrame, source: str) -> DataFrame:
    return listings.withColumn("source", F.lit(source))


def union_sources(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def expand_targets(practices: DataFrame) -> DataFrame:
    """One row per practice and candidate page."""
    return practices.select("*", F.posexplode(target_urls(F.col("website"))).alias("path_no", "target"))


def limit_per_city(listings: DataFrame, order: Sequence[str], n: int = params.LIMIT_PER_CITY,
                   rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per city."""
    return top_k(listings, ["city"], [F.col(c) for c in order], n, rank)


def city_need(seeds: DataFrame, got: DataFrame, target: int = params.FILL_TARGET_PER_CITY) -> DataFrame:
    """Rows already there per seed city and how many are missing to the target."""
    counts = got.groupBy("city").agg(F.count(F.lit(1)).alias("got"))
    out = seeds.join(counts, "city", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long")))
    return out.withColumn("need", F.greatest(F.lit(0).cast("long"), F.lit(target) - F.col("got")))


def city_topup(seeds: DataFrame, first: DataFrame, second: DataFrame, order: Sequence[str],
               limit: int = params.LIMIT_PER_CITY, target: int = params.FILL_TARGET_PER_CITY) -> DataFrame:
    """Rows of the first source, and of the second only what a city lacks to the target.

    Both sources are cut to the limit per city before any join, so no city is large when it meets the seeds.
    ``seeds`` holds each city once.
    """
    own = limit_per_city(first, order, limit).join(seeds, "city", "left_semi")
    need = city_need(seeds, own, target).where(F.col("need") > 0).select("city", "need")
    asked = F.least(F.lit(limit), F.greatest(F.lit(params.MIN_TOPUP_LIMIT), F.col("need")))
    extra = limit_per_city(second, order, limit).join(need, "city").where(
        (F.col("rank") <= asked) & (F.col("rank") <= F.col("need"))).drop("need")
    return union_sources(own, extra).drop("rank")


def dedup_key() -> list[Column]:
    """Name and address, lower-cased; missing counts as empty."""
    return [F.lower(F.coalesce(F.col(c), F.lit(""))).alias(f"{c}_key") for c in ("name", "address")]


def known_rows(existing: DataFrame) -> DataFrame:
    """Existing rows with both name and address; the others are dropped."""
    return existing.where((F.coalesce("name", F.lit("")) != "") & (F.coalesce("address", F.lit("")) != ""))


def _by_key(existing: DataFrame, new: DataFrame, order: Sequence[str], complete: bool = True) -> DataFrame:
    """Per key: is it known, how many new rows, and the first of them. Copies are combined before the shuffle."""
    columns = new.columns
    known = (known_rows(existing) if complete else existing).select(*dedup_key(), F.lit(True).alias("known"))
    fresh = new.select(*dedup_key(), F.lit(False).alias("known"), F.struct(*order).alias("at"), F.struct(*columns).alias("row"))
    return known.unionByName(fresh, allowMissingColumns=True).groupBy("name_key", "address_key").agg(
        F.bool_or("known").alias("known"), F.count("row").alias("n_new"), F.min_by("row", "at").alias("row"))


def new_listings(existing: DataFrame, new: DataFrame, order: Sequence[str], complete: bool = True) -> DataFrame:
    """First new row of every key that is not among the existing ones (only the ``complete`` ones of them count, if asked)."""
    return _by_key(existing, new, order, complete).where(~F.col("known") & F.col("row").isNotNull()).select("row.*")


def dedup_listings(existing: DataFrame, new: DataFrame, order: Sequence[str],
                   dedup_existing: bool = False) -> DataFrame:
    """Existing rows first, then the new keys. Existing rows are not compared among themselves unless asked to."""
    kept = known_rows(existing)
    if dedup_existing:
        kept = kept.groupBy(*dedup_key()).agg(
            F.min_by(F.struct(*existing.columns), F.struct(*order)).alias("row")).select("row.*")
    return kept.withColumn("prio", F.lit(0)).unionByName(
        new_listings(existing, new, order).withColumn("prio", F.lit(1)), allowMissingColumns=True)


def dedup_stats(existing: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Counts of new rows read, added and skipped."""
    keys = _by_key(existing, new.select("name", "address", *order), order)
    added = F.count_if(~F.col("known") & (F.col("n_new") > 0))
    total = F.coalesce(F.sum("n_new"), F.lit(0).cast("long"))
    return keys.agg(total.alias("n_input"), added.alias("n_added"), (total - added).alias("n_skipped"))


def with_ids(listings: DataFrame, group: str, order: Sequence[str], segments: int | None = None) -> DataFrame:
    """Dense ids from 1 in the order ``group``, ``order``; NULL groups come first.

    Rows are numbered inside each group segment by segment, then shifted by the rows of the groups before. The groups are
    counted once; their number decides how much the small table of offsets has to sort.
    """
    numbered = OrderedRows.of(listings, [group], order, segments).running_sum({"n": F.lit(1).cast("long")}).rows()
    counts = numbered.groupBy(group).agg(F.max("n").alias("size"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_group"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset"))
    joined = numbered.join(offsets, numbered[group].eqNullSafe(offsets["_group"]))
    return joined.withColumn("id", F.col("n") + F.col("_offset")).drop("n", "_group", "_offset")


def practice_captures(practices: DataFrame, captures: DataFrame) -> DataFrame:
    """Captures of each practice's site, summed up per site before the join so that a busy site stays one row."""
    pages = captures.groupBy("site").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("status") < 400).alias("n_ok"),
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    return lookup_join(practices, pages, "site", "inner")


def cap_pages(captures: DataFrame, n: int = params.PAGES_PER_HOST) -> DataFrame:
    """At most ``n`` pages per site, the first ones."""
    return top_k(captures, ["site"], [F.col("seq")], n)
