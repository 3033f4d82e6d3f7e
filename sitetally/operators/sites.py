"""From page hits to one feature row per site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..dictionaries.fixed import CHALLENGE_MARKERS, EVIDENCE_PATTERN, LINK_PATTERNS
from ..functions.cells import join_list
from ..functions.html import is_challenge
from ..functions.urls import authority, is_external, norm_url
from ..sources.dictionary import Pattern
from . import patterns as P
from .skew import lookup_join, top_k

CAPABILITIES = ("booking", "forms", "payments")


def usable(captures: DataFrame, markers: tuple[str, ...] = CHALLENGE_MARKERS) -> DataFrame:
    """Captures that answered and are not challenge pages."""
    return captures.where((F.col("status") < 400) & ~is_challenge(F.col("html"), markers))


def site_hits(page_hits: DataFrame) -> DataFrame:
    """Per site and pattern the first hit in search order: section, then page. Combined before the shuffle."""
    first = F.min(F.struct("section", "seq", "hit")).alias("f")
    return page_hits.groupBy("site", "prio", "category", "strength", "vendor").agg(first).select(
        "site", "prio", "category", "strength", "vendor", F.col("f.section").alias("section"),
        F.col("f.seq").alias("seq"), F.col("f.hit").alias("hit"))


def distinct_hits(hits: DataFrame) -> DataFrame:
    """A text found by several patterns of one list counts once; it keeps the earliest pattern."""
    return hits.groupBy("site", "category", "strength", "vendor", "hit").agg(F.min("prio").alias("prio"))


def site_flags(sites: DataFrame, hits: DataFrame) -> DataFrame:
    """Capability flags: an intent phrase or any vendor hit. ``sites``: one row per site to report on."""
    flags = hits.groupBy("site").agg(*[
        F.bool_or(F.col("category").isin(c, f"intent_{c}")).alias(f"has_{c}") for c in CAPABILITIES])
    return sites.join(flags, "site", "left").select(
        "site", *[F.coalesce(f"has_{c}", F.lit(False)).alias(f"has_{c}") for c in CAPABILITIES])


def likely(hits: DataFrame) -> DataFrame:
    """First booking and phone text per site, in dictionary order."""
    def first(category: str):
        return F.min(F.when(F.col("category") == category, F.struct("prio", "hit")))["hit"]
    return hits.where(F.col("category").isin("booking", "phone")).groupBy("site").agg(
        first("booking").alias("likely_booking_vendor"), first("phone").alias("likely_phone_provider"))


def software_tags(hits: DataFrame) -> DataFrame:
    """Evidence tags ``vendor:STRONG:text``, one per distinct hit of a vendor and strength."""
    found = distinct_hits(hits.where(F.col("category") == "pms"))
    return found.select(
        "site", "vendor", "strength", "prio", "hit", F.concat_ws(":", "vendor", F.upper("strength"), "hit").alias("tag"))


def software_scores(hits: DataFrame) -> DataFrame:
    """Weighted score per site and vendor: strong hits count 5, weak hits 1."""
    weight = F.when(F.col("strength") == "strong", params.STRONG_WEIGHT).otherwise(params.WEAK_WEIGHT)
    found = distinct_hits(hits.where(F.col("category") == "pms"))
    return found.groupBy("site", "vendor").agg(
        F.sum(weight).cast("long").alias("score"), F.min("prio").alias("vendor_prio"))


def vendor_order(patterns: Sequence[Pattern]) -> dict[str, int]:
    """Position of each software vendor in the dictionary: ties go to the earlier one."""
    order: dict[str, int] = {}
    for p in patterns:
        if p.category == "pms":
            order.setdefault(p.vendor, len(order) + 1)
    return order


def software_guess(sites: DataFrame, scores: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """Best-scoring vendor and its share of all points; ``unknown`` and 0.0 without hits."""
    order = vendor_order(patterns)
    place = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("vendor")]
    best = F.max(F.struct(F.col("score"), (-place).alias("place"), F.col("vendor")))
    guess = scores.groupBy("site").agg(best.alias("b"), F.sum("score").alias("total"))
    return sites.join(guess, "site", "left").select(
        "site", F.coalesce("b.vendor", F.lit("unknown")).alias("likely_pms"),
        F.coalesce(F.round(F.col("b.score") / F.col("total"), 3), F.lit(0.0)).alias("pms_confidence"))


def first_pages(captures: DataFrame) -> DataFrame:
    """Address and status of the first page of a site that answered, challenge or not."""
    first = F.min(F.struct("seq", "final_url", "status")).alias("f")
    ok = captures.where(F.col("status") < 400).groupBy("site").agg(first)
    return ok.select("site", F.col("f.final_url").alias("final_url"), F.col("f.status").alias("http_status"))


def evidence_sample(evidence: DataFrame, per_site: int = params.EVIDENCE_PER_SITE,
                    per_host: int = params.EVIDENCE_PER_HOST) -> DataFrame:
    """Up to ``per_site`` evidence URLs of each site, of those up to ``per_host`` different ones per host."""
    ranked = top_k(evidence, ["site"], [F.col("seq")], per_site, "n")
    once = ranked.withColumn("host", F.col("site")).groupBy("host", F.col("final_url").alias("url")).agg(
        F.min(F.struct("seq", "n")).alias("at"))
    return top_k(once, ["host"], [F.col("at"), F.col("url")], per_host, "pos").select(
        "host", F.col("pos").cast("long").alias("pos"), "url")


def _facts(captures: DataFrame, patterns: Sequence[Pattern], evidence: str, rules: dict, mode: str,
           markers: tuple[str, ...]) -> DataFrame:
    """Everything a page contributes to its site, as rows ``kind, key, section, pos, value``, in one pass over the bodies.

    A hit's value starts with its section. Pages that failed only show that the site exists; challenge pages only count
    as pages.
    """
    ok = F.coalesce(F.col("status") < 400, F.lit(False))
    pages = P.with_candidates(P.with_sections(captures.withColumn("ok", ok)), patterns)
    cited = P.found_in("html", evidence) | P.found_in("joined", evidence)
    outside = F.filter(F.transform("links", lambda u, i: F.struct(u.alias("url"), i.alias("pos"))), lambda x: (
        is_external(x["url"], F.col("site"), mode) & authority(x["url"]).isNotNull()))
    matched = pages.select(
        "site", "seq", "status", "final_url", "ok", (F.col("ok") & ~is_challenge(F.col("html"), markers)).alias("read"),
        cited.alias("cited"), outside.alias("outside"), P.matches(patterns).alias("hits"))

    def fact(kind, key, value, pos=None):
        return F.struct(kind.alias("kind"), key.alias("key"), (F.lit(0) if pos is None else pos).alias("pos"),
                        value.alias("value"))

    none, url = F.lit("").alias("key"), F.col("final_url")
    hits = F.transform("hits", lambda h: fact(F.lit("hit"), h["prio"].cast("string"), h["found"]))
    links = F.flatten(F.transform("outside", lambda x: F.transform(
        P.link_categories(x["url"], rules), lambda c: fact(c, x["url"], x["url"], x["pos"]))))
    page, seen = fact(F.lit("page"), none, url), fact(F.lit("seen"), none, F.lit(""))
    proof = fact(F.lit("evidence"), url, F.when(F.col("cited"), url))
    rows = F.when(F.col("read"), F.concat(F.array(page, proof), hits, links)).otherwise(
        F.array(F.when(F.col("ok"), page).otherwise(seen)))
    facts = matched.select("site", "seq", "status", F.inline_outer(rows)).where(F.col("value").isNotNull())
    is_hit = F.col("kind") == "hit"
    return facts.withColumn("section", F.when(is_hit, F.substring("value", 1, 1).cast("int")).otherwise(0)).withColumn(
        "value", F.when(is_hit, F.expr("substring(value, 2)")).otherwise(F.col("value")))


def _points(software, vendor: str, place: int):
    """Score of one vendor from a site's distinct software hits, with its place for ties."""
    def count(strength: str):
        return F.size(F.filter(software, lambda x: (x["vendor"] == vendor) & (x["strength"] == strength)))
    score = params.STRONG_WEIGHT * count("strong") + params.WEAK_WEIGHT * count("weak")
    return F.struct(score.alias("score"), F.lit(place).alias("place"), F.lit(vendor).alias("vendor"))


def site_features(captures: DataFrame, patterns: Sequence[Pattern], evidence: str = EVIDENCE_PATTERN,
                  rules: dict = LINK_PATTERNS, mode: str = "domain",
                  markers: tuple[str, ...] = CHALLENGE_MARKERS) -> DataFrame:
    """One row per site with every detection column.

    Facts are combined per (site, kind, key) before any list is built. A list then holds at most one entry per pattern and
    five URLs per category (a limit of the output format); the evidence list has every evidence URL of the site once.
    """
    facts = _facts(captures, patterns, evidence, rules, mode, markers)
    once = facts.groupBy("site", "kind", "key").agg(F.min(F.struct("section", "seq", "pos", "value", "status")).alias("f"))
    most = max(len(patterns), params.URLS_PER_CELL)
    is_evidence = F.col("kind") == "evidence"
    allowed = F.when(F.col("kind").isin(*rules), params.URLS_PER_CELL).otherwise(most)
    kept = top_k(once.where(~is_evidence), ["site", "kind"], [F.col("f"), F.col("key")], most).where(F.col("rank") <= allowed)
    kept = kept.unionByName(once.where(is_evidence).withColumn("rank", F.lit(0)))
    prio = F.when(F.col("kind") == "hit", F.col("key").cast("int"))
    kept = kept.select("site", "kind", "rank", prio.alias("prio"), "f.seq", "f.value", "f.status").withColumns(
        P.describe(F.col("prio"), patterns))

    def listed(condition, *order):
        items = F.collect_list(F.when(condition, F.struct(*order, F.col("value"))))
        return F.array_distinct(F.transform(F.array_sort(items), lambda x: x["value"]))

    kind, category = F.col("kind"), F.col("category")
    software = F.collect_list(F.when(category == "pms", F.struct("prio", "vendor", "strength", "value")))
    one = kept.groupBy("site").agg(
        F.max(F.when(kind == "page", F.struct("value", "status"))).alias("first"),
        *[F.coalesce(F.bool_or(category.isin(c, f"intent_{c}")), F.lit(False)).alias(f"has_online_{c}")
          for c in CAPABILITIES],
        *[listed(category == c, "prio").alias(f"{c}_hits") for c in ("booking", "forms", "payments", "other", "phone")],
        F.array_distinct(F.transform(F.array_sort(software), lambda x: F.struct(
            x["vendor"].alias("vendor"), x["strength"].alias("strength"), x["value"].alias("value")))).alias("software"),
        listed(kind == "evidence", "seq").alias("evidence_urls"),
        *[listed(kind == c, "rank").alias(f"{c}_urls") for c in rules])
    order = vendor_order(patterns)
    scores = F.array(*[_points(F.col("software"), v, -place) for v, place in order.items()])
    one = one.withColumn("best", F.array_max(scores)).withColumn(
        "total", F.aggregate(scores, F.lit(0), lambda acc, x: acc + x["score"]))
    tag = lambda x: F.concat_ws(":", x["vendor"], F.upper(x["strength"]), x["value"])
    scored = F.col("total") > 0
    return one.select(
        "site", F.col("first.value").alias("final_url"), F.col("first.status").alias("http_status"),
        *[f"has_online_{c}" for c in CAPABILITIES],
        F.col("booking_hits").alias("third_party_booking_clues"), F.col("forms_hits").alias("third_party_forms_clues"),
        F.col("payments_hits").alias("third_party_payments_clues"), F.col("other_hits").alias("third_party_other_clues"),
        F.try_element_at("booking_hits", F.lit(1)).alias("likely_booking_vendor"),
        F.col("phone_hits").alias("phone_clues_site"),
        F.try_element_at("phone_hits", F.lit(1)).alias("likely_phone_provider"),
        F.transform("software", tag).alias("pms_clues_site"),
        F.when(scored, F.col("best.vendor")).otherwise("unknown").alias("likely_pms"),
        F.when(scored, F.round(F.col("best.score") / F.col("total"), 3)).otherwise(0.0).alias("pms_confidence"),
        "evidence_urls", *[f"{c}_urls" for c in rules])


def detections(practices: DataFrame, features: DataFrame) -> DataFrame:
    """Feature rows of the practices that have a website; a practice without any capture keeps empty features."""
    own = practices.withColumn("website", norm_url(F.col("website"))).where(F.col("website").isNotNull())
    keyed = own.select("id", "name", "website", authority(F.col("website")).alias("site"))
    out = lookup_join(keyed, features, "site")
    return out.drop("site").withColumns({
        **{f"has_online_{c}": F.coalesce(f"has_online_{c}", F.lit(False)) for c in CAPABILITIES},
        "likely_pms": F.coalesce("likely_pms", F.lit("unknown")),
        "pms_confidence": F.coalesce("pms_confidence", F.lit(0.0))})


def with_success(found: DataFrame) -> DataFrame:
    """A detection succeeds if it has a status or a software, booking or phone clue."""
    some = [F.coalesce(F.size(c), F.lit(0)) > 0
            for c in ("pms_clues_site", "third_party_booking_clues", "phone_clues_site")]
    return found.withColumn("success", F.col("http_status").isNotNull() | some[0] | some[1] | some[2])


def flat(found: DataFrame) -> DataFrame:
    """Multi-valued cells joined by ``;``, as in the flat files."""
    lists = [f.name for f in found.schema.fields if f.dataType.typeName() == "array"]
    return found.withColumns({c: join_list(F.col(c)) for c in lists})
