"""Job-ad evidence: vendors in search snippets, consensus, left join to the detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..dictionaries.fixed import JOB_TEXT_VENDORS, SNIPPET_VENDORS
from ..functions.cells import ensure_column
from .skew import lookup_join, top_k


def normalize_search(first: DataFrame, second: DataFrame) -> DataFrame:
    """Hits of both providers as ``id, rank, name, url, snippet``; the second counts only where the first found none.

    Inputs are result pages, ``id`` being the search and ``offset`` the number of hits before the page. The choice
    between providers is made on pages, before hits are unfolded.
    """
    answered = first.where(F.size("webPages.value") > 0)
    a = answered.select("id", "offset", F.posexplode("webPages.value").alias("pos", "hit"))
    rest = lookup_join(second, answered.select("id").distinct(), "id", "left_anti")
    b = rest.select("id", "offset", F.posexplode("organic_results").alias("pos", "r"))
    rank = (F.col("offset") + F.col("pos")).alias("rank")
    return a.select("id", rank, "hit.name", "hit.url", "hit.snippet").unionByName(b.select(
        "id", rank, F.col("r.title").alias("name"), F.col("r.link").alias("url"), F.col("r.snippet").alias("snippet")))


def snippet_vendors(hits: DataFrame, vendors=SNIPPET_VENDORS) -> DataFrame:
    """One row per hit and vendor named in its snippet, with the tag ``vendor:JOBS:url``."""
    low = F.lower("snippet")

    def named(words):
        test = low.contains(words[0])
        for word in words[1:]:
            test = test | low.contains(word)
        return test

    found = F.array(*[
        F.when(named(words), F.struct(F.lit(i).alias("vendor_no"), F.lit(vendor).alias("vendor")))
        for i, (vendor, words) in enumerate(vendors, 1)])
    return hits.select("id", "rank", "url", F.inline_outer(F.array_compact(found))).where(F.col("vendor").isNotNull()).withColumn(
        "tag", F.concat_ws(":", "vendor", F.lit("JOBS"), F.coalesce("url", F.lit(""))))


def job_mentions(texts: DataFrame, vendors=JOB_TEXT_VENDORS) -> DataFrame:
    """Whole-word vendor mentions in job texts (``id, text``), tagged ``vendor:JOBS:mention``."""
    found = F.array(*[
        F.when(F.col("text").rlike(rf"(?iU)\b{words}\b"), F.lit(vendor)) for vendor, words in vendors])
    return texts.select("id", F.explode_outer(F.array_compact(found)).alias("vendor")).where(
        F.col("vendor").isNotNull()).withColumn(
        "tag", F.concat(F.col("vendor"), F.lit(":JOBS:mention")))


def job_clues(mentions: DataFrame, limit: int = params.JOB_CLUES_PER_ROW) -> DataFrame:
    """First clues per id in rank order, and the vendor if they all name the same one."""
    kept = top_k(mentions, ["id"], [F.col("rank"), F.col("vendor_no")], limit, "n")
    clues = kept.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "tag", "vendor"))).alias("c"))
    vendors = F.array_distinct(F.transform("c", lambda x: x["vendor"]))
    return clues.select("id", F.transform("c", lambda x: x["tag"]).alias("pms_clues_jobs"),
                        F.when(F.size(vendors) == 1, vendors[0]).alias("agreed"))


def enrich(detections: DataFrame, clues: DataFrame, confidence: float = params.JOB_CONFIDENCE) -> DataFrame:
    """Adds ``pms_clues_jobs``; where the clues agree, they decide the software and raise the confidence.

    Rows with a blank name were never searched for and keep their values.
    """
    base = ensure_column(detections, "name").drop("pms_clues_jobs")
    joined = base.join(clues.withColumnRenamed("pms_clues_jobs", "found"), "id", "left")
    searched = F.trim(F.coalesce("name", F.lit(""))) != ""
    agreed = F.when(searched, F.col("agreed"))
    old = F.coalesce("pms_confidence", F.lit(0.0))
    return joined.withColumns({
        "pms_clues_jobs": F.when(searched, F.coalesce("found", F.array().cast("array<string>"))).otherwise(
            F.array().cast("array<string>")),
        "likely_pms": F.coalesce(agreed, "likely_pms", F.lit("unknown")),
        "pms_confidence": F.when(agreed.isNotNull(), F.greatest(old, F.lit(confidence))).otherwise(old),
    }).drop("found", "agreed")
