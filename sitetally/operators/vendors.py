"""Vendors behind service URLs: counts, shares, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..dictionaries.fixed import PORTAL_SOFTWARE, VENDOR_MAP
from ..functions.cells import parse_list
from ..functions.urls import authority
from .skew import top_k


def vendor_from_url(url: Column, vendor_map=VENDOR_MAP) -> Column:
    """Vendor of a service URL: first key found in its authority; NULL for ignored keys; else the authority itself."""
    host = authority(url)
    vendor = host
    for key, name in reversed(list(vendor_map)):
        vendor = F.when(host.contains(key), F.lit(name)).otherwise(vendor)
    return vendor


def mapped_only(url: Column, vendor_map=PORTAL_SOFTWARE) -> Column:
    """Like :func:`vendor_from_url`, but NULL where no key is found."""
    host = authority(url)
    vendor = F.lit(None).cast("string")
    for key, name in reversed(list(vendor_map)):
        vendor = F.when(host.contains(key), F.lit(name)).otherwise(vendor)
    return vendor


def cell_urls(detections: DataFrame, cells: dict[str, str]) -> DataFrame:
    """``;`` cells unfolded to ``id, category, url``. ``cells``: category -> column."""
    def rows(category: str, column: str) -> Column:
        return F.transform(
            parse_list(F.col(column)), lambda u: F.struct(F.lit(category).alias("category"), u.alias("url")))

    both = F.flatten(F.array(*[rows(category, column) for category, column in cells.items()]))
    return detections.select("id", F.inline_outer(both)).where(F.col("url").isNotNull())


def vendor_counts(urls: DataFrame, vendor_map=VENDOR_MAP) -> DataFrame:
    """URLs per category and vendor."""
    named = urls.withColumn("vendor", vendor_from_url(F.col("url"), vendor_map)).where(F.col("vendor").isNotNull())
    return named.groupBy("category", "vendor").agg(F.count(F.lit(1)).alias("n_urls"))


def top_counts(counts: DataFrame, label: str, n: str, k: int) -> DataFrame:
    """The ``k`` most frequent labels per category; ties in label order."""
    return top_k(counts, ["category"], [F.desc(n), F.col(label)], k)


def clue_counts(detections: DataFrame, cells: dict[str, str]) -> DataFrame:
    """Frequency of each clue text per category; spelling variants of case count together."""
    clues = cell_urls(detections, cells)
    return clues.groupBy("category", F.lower("url").alias("clue")).agg(F.count(F.lit(1)).alias("n"))


def market_share(counts: DataFrame, k: int) -> DataFrame:
    """Share of the ``k`` largest vendors of each category and of all others together."""
    top = top_counts(counts, "vendor", "n_urls", k).select("category", "vendor", "rank")
    # at most k rows per category, so the broadcast has a fixed bound
    ranked = counts.join(F.broadcast(top), ["category", "vendor"], "left")
    label = F.when(F.col("rank").isNotNull(), F.col("vendor")).otherwise("Others")
    merged = ranked.groupBy("category", label.alias("vendor"), F.coalesce("rank", F.lit(k + 1)).alias("rank")).agg(
        F.sum("n_urls").alias("n_urls"))
    totals = merged.groupBy("category").agg(F.sum("n_urls").alias("total"))
    return merged.join(totals, "category").select(
        "category", "vendor", F.col("rank").cast("long").alias("rank"), "n_urls",
        F.round(F.lit(100.0) * F.col("n_urls") / F.col("total"), 1).alias("share_pct"))


def vendor_matrix(counts: DataFrame, categories: Sequence[str]) -> DataFrame:
    """URLs per vendor and category side by side, for vendors in at least two categories."""
    cells = [F.sum(F.when(F.col("category") == c, F.col("n_urls")).otherwise(0)).alias(c) for c in categories]
    wide = counts.groupBy("vendor").agg(*cells, F.count(F.lit(1)).alias("n_categories"))
    return wide.where(F.col("n_categories") >= 2)


def vendor_consolidation(services: DataFrame) -> DataFrame:
    """Per site: one vendor for several categories, several vendors, or one of each. ``services``: site, category, vendor."""
    once = services.select("site", "category", "vendor").distinct()
    vendors = once.groupBy("site", "vendor").agg(F.count(F.lit(1)).alias("n"))
    sites = vendors.groupBy("site").agg(F.count(F.lit(1)).alias("n_vendors"), F.max("n").alias("widest"))
    cats = once.groupBy("site", "category").agg(F.lit(1).alias("x")).groupBy("site").agg(
        F.count(F.lit(1)).alias("n_categories"))
    kind = F.when(F.col("n_vendors") > 1, "several vendors").when(
        F.col("n_categories") > 1, "all-in-one").otherwise("single service")
    return sites.join(cats, "site").select("site", "n_vendors", "n_categories", kind.alias("kind"))


def share_shift(runs: DataFrame) -> DataFrame:
    """Share of each vendor in two runs (``run`` 0 and 1) and the change; absent from a run is 0."""
    n = runs.groupBy("vendor").agg(*[
        F.count_if(F.col("run") == r).alias(f"n_{name}") for r, name in ((0, "before"), (1, "after"))])
    totals = runs.agg(*[F.count_if(F.col("run") == r).alias(f"t_{name}") for r, name in ((0, "before"), (1, "after"))])

    def share(name: str) -> Column:
        total = totals.select(f"t_{name}").scalar()
        return F.lit(100.0) * F.col(f"n_{name}") / F.greatest(total, F.lit(1))
    return n.withColumns({"before": share("before"), "after": share("after")}).select(
        "vendor", F.round("before", 2).alias("share_before"), F.round("after", 2).alias("share_after"),
        F.round(F.col("after") - F.col("before"), 2).alias("shift"))


def software_from_urls(urls: DataFrame, portals=PORTAL_SOFTWARE) -> DataFrame:
    """Distinct sites per software that the host of a captured service URL points to. ``urls``: site, url."""
    once = urls.select("site", mapped_only(F.col("url"), portals).alias("vendor")).where(
        F.col("vendor").isNotNull()).distinct()
    return once.groupBy("vendor").agg(F.count(F.lit(1)).alias("n_sites"))


def full_stack_by_vendor(rows: DataFrame, detections: DataFrame) -> DataFrame:
    """Share of sites with all three capabilities among the sites of each vendor, beside the overall share.

    ``rows``: ``id, vendor, integration_count``, any number of rows per pair; ``detections`` has ``integration_count``.
    """
    full = F.count_if(F.col("integration_count") == 3)
    pairs = rows.groupBy("vendor", "id").agg(F.max("integration_count").alias("integration_count"))
    overall = detections.agg(F.lit(100.0) * full / F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    return pairs.groupBy("vendor").agg(F.count(F.lit(1)).alias("n_sites"), full.alias("n_full")).select(
        "vendor", "n_sites", "n_full",
        F.round(F.lit(100.0) * F.col("n_full") / F.col("n_sites"), 2).alias("full_pct"),
        F.round(overall, 2).alias("overall_pct"))


def capture_rate(detections: DataFrame, cells: dict[str, str], flags: dict[str, str]) -> DataFrame:
    """Per category: sites with the flag, URLs captured, flagged sites without any URL, and URLs per flagged site."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("category"), F.coalesce(F.col(flags[c]), F.lit(False)).alias("flag"),
                 F.size(parse_list(F.col(cells[c]))).cast("long").alias("n")) for c in cells])
    flat = detections.select(F.inline(rows))
    return flat.groupBy("category").agg(
        F.count_if("flag").alias("flagged"), F.sum("n").alias("urls"),
        F.count_if(F.col("flag") & (F.col("n") == 0)).alias("flagged_without_url")).withColumn(
        "rate_pct", F.round(F.lit(100.0) * F.col("urls") / F.greatest("flagged", F.lit(1)), 2))


def integration_count() -> Column:
    """Number of capabilities a row has; missing flags count as absent."""
    parts = [F.coalesce(F.col(f"has_online_{c}"), F.lit(False)).cast("int") for c in ("booking", "payments", "forms")]
    return (parts[0] + parts[1] + parts[2]).cast("long")


def top_integrated(detections: DataFrame, k: int = params.TOP_SITES) -> DataFrame:
    """The ``k`` sites with most capabilities, at least two, with a label per capability."""
    def label(c: str, text: Column) -> Column:
        return F.when(F.col(f"has_online_{c}"), text).alias(c)
    found = F.lit("detected")
    rows = detections.withColumn("integration_count", integration_count()).where(F.col("integration_count") >= 2)
    return rows.orderBy(F.desc("integration_count"), "id").limit(k).select(
        "id", "name", "website", "integration_count",
        label("booking", F.coalesce("likely_booking_vendor", found)), label("payments", found), label("forms", found))


def answered(found: DataFrame) -> DataFrame:
    """How many detections there are, and how many of them have a page with status 200."""
    return found.agg(F.count("*").alias("sites"), F.count_if(F.col("http_status") == 200).alias("answered"))
