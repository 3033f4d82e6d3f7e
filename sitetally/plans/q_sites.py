"""Pages and sites: sections, hits, flags, guesses, detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import is_challenge, page_links, page_text
from ..operators import hostlog, patterns, sites, summary, vendors
from ..sources.dictionary import patterns_table
from . import adapters as A
from .adapters import with_ctes
from .registry import query


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.page_hits(A.captures(spark, sf_dir), A.fixture_patterns())


def _site_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.site_hits(_hits(spark, sf_dir))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.captures(spark, sf_dir).select("site").distinct()


@query("page_links", with_ctes(A.SECTIONS) + """
SELECT site, seq, CAST(len(links) AS BIGINT) AS n_links, array_to_string(links, ' ') AS links FROM bodies""")
def page_links_query(spark, sf_dir):
    pages = A.captures(spark, sf_dir).select("site", "seq", page_links(F.col("html")).alias("l"))
    return pages.select("site", "seq", F.size("l").cast("long").alias("n_links"), F.array_join("l", " ").alias("links"))


@query("page_text", with_ctes(A.SECTIONS) + "SELECT site, seq, text FROM bodies")
def page_text_query(spark, sf_dir):
    return A.captures(spark, sf_dir).select("site", "seq", page_text(F.col("html")).alias("text"))


@query("page_sections", with_ctes(A.SECTIONS) + """
SELECT site, seq, CAST(section AS BIGINT) AS section, CAST(length(body) AS BIGINT) AS n_chars, md5(body) AS digest
FROM sections""")
def page_sections(spark, sf_dir):
    return patterns.page_sections(A.captures(spark, sf_dir)).select(
        "site", "seq", F.col("section").cast("long").alias("section"),
        F.length("body").cast("long").alias("n_chars"), F.md5("body").alias("digest"))


@query("challenge_pages", with_ctes(A.CAPTURES) + """
SELECT site, seq, contains(lower(html), 'onlyth') OR contains(lower(html), 'spam-farm') AS is_challenge FROM captures""")
def challenge_pages(spark, sf_dir):
    return A.captures(spark, sf_dir).select("site", "seq", is_challenge(F.col("html"), A.MARKERS).alias("is_challenge"))


@query("pattern_hits", with_ctes(A.HITS) + """
SELECT site, seq, CAST(prio AS BIGINT) AS prio, category, strength, vendor, CAST(section AS BIGINT) AS section, hit
FROM page_hits""")
def pattern_hits(spark, sf_dir):
    return _hits(spark, sf_dir).select(
        "site", "seq", F.col("prio").cast("long").alias("prio"), "category", "strength", "vendor",
        F.col("section").cast("long").alias("section"), "hit")


@query("src_patterns", with_ctes(A.HITS) + """
SELECT CAST(p.prio AS BIGINT) AS prio, p.category, p.strength, p.vendor, p.regex,
  CAST(count(h.seq) AS BIGINT) AS n_pages
FROM patterns p LEFT JOIN page_hits h ON h.prio = p.prio
GROUP BY p.prio, p.category, p.strength, p.vendor, p.regex""")
def src_patterns(spark, sf_dir):
    table = patterns_table(spark, A.fixture_patterns())
    pages = _hits(spark, sf_dir).groupBy("prio").agg(F.count(F.lit(1)).alias("n"))
    return table.join(pages, "prio", "left").select(
        F.col("prio").cast("long").alias("prio"), "category", "strength", "vendor", "regex",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_pages"))


@query("intent_flags", with_ctes(A.SECTIONS) + """
SELECT site, seq, bool_or(regexp_matches(body, '(?i)thanin')) AS intent_booking,
  bool_or(regexp_matches(body, '(?i)%%%')) AS intent_forms, bool_or(regexp_matches(body, '(?i)onlyth')) AS intent_payments
FROM sections GROUP BY site, seq""")
def intent_flags(spark, sf_dir):
    return patterns.page_intents(A.captures(spark, sf_dir), A.fixture_patterns()).select(
        "site", "seq", "intent_booking", "intent_forms", "intent_payments")


@query("site_hits", with_ctes(A.HITS) + """
SELECT site, CAST(prio AS BIGINT) AS prio, category, strength, vendor, CAST(section AS BIGINT) AS section, seq, hit
FROM site_hits""")
def site_hits(spark, sf_dir):
    return _site_hits(spark, sf_dir).select(
        "site", F.col("prio").cast("long").alias("prio"), "category", "strength", "vendor",
        F.col("section").cast("long").alias("section"), "seq", "hit")


FLAGS = """flags AS (
  SELECT s.site,
    coalesce(bool_or(h.category IN ('booking', 'intent_booking')), false) AS has_booking,
    coalesce(bool_or(h.category IN ('forms', 'intent_forms')), false) AS has_forms,
    coalesce(bool_or(h.category IN ('payments', 'intent_payments')), false) AS has_payments
  FROM sites s LEFT JOIN site_hits h ON h.site = s.site GROUP BY s.site)"""


@query("site_flags", with_ctes(A.HITS, FLAGS) + "SELECT * FROM flags")
def site_flags(spark, sf_dir):
    return sites.site_flags(_sites(spark, sf_dir), _hits(spark, sf_dir))


@query("capability_adoption", with_ctes(A.HITS, FLAGS) + """
SELECT count(*)::BIGINT AS n_sites,
  round(100.0 * count_if(has_booking) / greatest(count(*), 1), 2)::DOUBLE AS pct_booking,
  round(100.0 * count_if(has_forms) / greatest(count(*), 1), 2)::DOUBLE AS pct_forms,
  round(100.0 * count_if(has_payments) / greatest(count(*), 1), 2)::DOUBLE AS pct_payments FROM flags""")
def capability_adoption(spark, sf_dir):
    """What percent of sites show each capability."""
    n = F.count(F.lit(1))
    return site_flags(spark, sf_dir).agg(n.alias("n_sites"), *[
        summary.pct(F.count_if(f"has_{c}"), n).alias(f"pct_{c}") for c in sites.CAPABILITIES])


@query("likely_vendor", with_ctes(A.HITS) + """
SELECT site, arg_min(hit, prio) FILTER (category = 'booking') AS likely_booking_vendor,
  arg_min(hit, prio) FILTER (category = 'phone') AS likely_phone_provider
FROM site_hits WHERE category IN ('booking', 'phone') GROUP BY site""")
def likely_vendor(spark, sf_dir):
    return sites.likely(_site_hits(spark, sf_dir))


SOFTWARE = """tags AS (
  SELECT site, vendor, strength, hit, min(prio) AS prio FROM site_hits WHERE category = 'pms'
  GROUP BY site, vendor, strength, hit),
scores AS (
  SELECT site, vendor, CAST(sum(CASE WHEN strength = 'strong' THEN 5 ELSE 1 END) AS BIGINT) AS score
  FROM tags GROUP BY site, vendor),
guesses AS (
  SELECT s.site, coalesce(g.vendor, 'unknown') AS likely_pms,
    coalesce(round(g.score * 1.0::DOUBLE / g.total, 3), 0.0)::DOUBLE AS pms_confidence
  FROM sites s LEFT JOIN (
    SELECT *, sum(score) OVER (PARTITION BY site) AS total,
      row_number() OVER (PARTITION BY site ORDER BY score DESC, CASE vendor WHEN 'kappa' THEN 1 ELSE 2 END) AS rn
    FROM scores) g ON g.site = s.site AND g.rn = 1)"""


@query("evidence_tags", with_ctes(A.HITS, SOFTWARE) + """
SELECT site, vendor, strength, hit, vendor || ':' || upper(strength) || ':' || hit AS tag FROM tags""")
def evidence_tags(spark, sf_dir):
    return sites.software_tags(_site_hits(spark, sf_dir)).select("site", "vendor", "strength", "hit", "tag")


@query("pms_score", with_ctes(A.HITS, SOFTWARE) + "SELECT site, vendor, score FROM scores")
def pms_score(spark, sf_dir):
    return sites.software_scores(_site_hits(spark, sf_dir)).select("site", "vendor", "score")


@query("pms_guess", with_ctes(A.HITS, SOFTWARE) + "SELECT * FROM guesses")
def pms_guess(spark, sf_dir):
    return sites.software_guess(
        _sites(spark, sf_dir), sites.software_scores(_site_hits(spark, sf_dir)), A.fixture_patterns())


EVIDENCE = f"""cited AS (
  SELECT site, seq, final_url FROM captures
  WHERE regexp_matches(html, '(?i){A.EVIDENCE}') OR regexp_matches(array_to_string({A.LINKS_SQL}, chr(10)), '(?i){A.EVIDENCE}'))"""


def _evidence(spark, sf_dir):
    return patterns.evidence_pages(A.captures(spark, sf_dir), A.EVIDENCE)


@query("evidence_urls", with_ctes(A.CAPTURES, EVIDENCE) + """
SELECT site, final_url, min(seq) AS first_seq FROM cited GROUP BY site, final_url""")
def evidence_urls(spark, sf_dir):
    return patterns.first_seen(_evidence(spark, sf_dir))


@query("host_evidence_sample", with_ctes(A.CAPTURES, EVIDENCE) + """,
first3 AS (SELECT site, final_url AS url, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY seq) AS n FROM cited) WHERE n <= 3),
once AS (SELECT site, url, min(seq) AS seq FROM first3 GROUP BY site, url)
SELECT site AS host, CAST(pos AS BIGINT) AS pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY seq, url) AS pos FROM once) WHERE pos <= 5""")
def host_evidence_sample(spark, sf_dir):
    return sites.evidence_sample(_evidence(spark, sf_dir))


@query("site_first_page", with_ctes(A.CAPTURES) + """
SELECT site, arg_min(final_url, seq) AS final_url, CAST(200 AS INTEGER) AS http_status FROM captures
WHERE status < 400 GROUP BY site""")
def site_first_page(spark, sf_dir):
    return sites.first_pages(A.captures(spark, sf_dir))


DETECTED = """first_page AS (SELECT site, arg_min(final_url, seq) AS final_url FROM captures GROUP BY site),
clues AS (
  SELECT site,
    coalesce(string_agg(hit, ';' ORDER BY prio) FILTER (category = 'booking'), '') AS booking,
    coalesce(string_agg(hit, ';' ORDER BY prio) FILTER (category = 'forms'), '') AS forms,
    coalesce(string_agg(hit, ';' ORDER BY prio) FILTER (category = 'payments'), '') AS payments,
    coalesce(string_agg(hit, ';' ORDER BY prio) FILTER (category = 'other'), '') AS other,
    coalesce(string_agg(hit, ';' ORDER BY prio) FILTER (category = 'phone'), '') AS phone
  FROM (SELECT site, category, hit, min(prio) AS prio FROM site_hits GROUP BY site, category, hit) GROUP BY site),
software AS (
  SELECT site, string_agg(vendor || ':' || upper(strength) || ':' || hit, ';' ORDER BY prio) AS tags
  FROM tags GROUP BY site)"""


def _features(spark, sf_dir):
    return sites.site_features(A.captures(spark, sf_dir), A.fixture_patterns(), evidence=A.EVIDENCE,
                               rules={"booking": A.LINK_RULES["booking"], "payment": A.LINK_RULES["payment"],
                                      "forms": A.LINK_RULES["forms"]})


@query("site_features", with_ctes(A.HITS, SOFTWARE, DETECTED, EVIDENCE, FLAGS) + """
SELECT s.site, p.final_url, CAST(200 AS INTEGER) AS http_status,
  f.has_booking AS has_online_booking, f.has_forms AS has_online_forms, f.has_payments AS has_online_payments,
  coalesce(c.booking, '') AS third_party_booking_clues, coalesce(c.forms, '') AS third_party_forms_clues,
  coalesce(c.payments, '') AS third_party_payments_clues, coalesce(c.other, '') AS third_party_other_clues,
  nullif(string_split(coalesce(c.booking, ''), ';')[1], '') AS likely_booking_vendor,
  coalesce(c.phone, '') AS phone_clues_site,
  nullif(string_split(coalesce(c.phone, ''), ';')[1], '') AS likely_phone_provider,
  coalesce(w.tags, '') AS pms_clues_site, g.likely_pms, g.pms_confidence,
  coalesce(e.urls, '') AS evidence_urls, '' AS booking_urls, '' AS payment_urls, '' AS forms_urls
FROM sites s JOIN first_page p USING (site) JOIN flags f USING (site) JOIN guesses g USING (site)
LEFT JOIN clues c USING (site) LEFT JOIN software w USING (site)
LEFT JOIN (SELECT site, string_agg(final_url, ';' ORDER BY seq, final_url) AS urls FROM (
  SELECT site, final_url, min(seq) AS seq FROM cited GROUP BY site, final_url) GROUP BY site) e USING (site)
""")
def site_features(spark, sf_dir):
    """The whole detection row per site. The pages' own links are all internal, so the URL cells stay empty."""
    return sites.flat(_features(spark, sf_dir))


def _practices(spark, sf_dir):
    """A practice for every supplier; those with money in the bank own one of the captured sites."""
    own = A.listings(spark, sf_dir, "supplier")
    known = A.captures(spark, sf_dir).groupBy("site").agg(F.min("seq").alias("seq"))
    return own.join(known, "seq", "left").select(
        F.col("seq").alias("id"), "name",
        F.when(F.col("site").isNotNull(), F.concat(F.lit("https://"), F.col("site"), F.lit("/"))).otherwise(
            F.col("website")).alias("website"))


PRACTICES = A.SUPPLIERS + """,
first_seq AS (SELECT site, min(seq) AS seq FROM captures GROUP BY site),
owners AS (
  SELECT seq AS id, name, CASE WHEN site IS NOT NULL THEN 'https://' || site || '/' ELSE website END AS website
  FROM suppliers LEFT JOIN first_seq USING (seq)),
practices AS (
  SELECT id, name, """ + A.NORM_SQL + """ AS website, lower(regexp_extract(
    """ + A.NORM_SQL + """, '://([^/?#]*)', 1)) AS site
  FROM owners WHERE trim(website) <> '')"""


@query("practice_captures", with_ctes(A.CAPTURES, PRACTICES) + """
SELECT p.id, p.site, count(*)::BIGINT AS n_pages, count_if(c.status < 400)::BIGINT AS n_ok, min(c.seq) AS first_seq,
  max(c.seq) AS last_seq
FROM practices p JOIN captures c ON c.site = p.site GROUP BY p.id, p.site""")
def practice_captures(spark, sf_dir):
    from ..functions.urls import authority, norm_url
    from ..operators.listings import practice_captures as join
    own = _practices(spark, sf_dir).select("id", authority(norm_url(F.col("website"))).alias("site"))
    return join(own.where(F.col("site").isNotNull()), A.captures(spark, sf_dir)).select(
        "id", "site", "n_pages", "n_ok", "first_seq", "last_seq")


SUCCESS = with_ctes(A.HITS, SOFTWARE, DETECTED, PRACTICES) + """,
found AS (
  SELECT p.id, p.name, p.website, f.final_url,
    f.final_url IS NOT NULL OR coalesce(w.tags, '') <> '' OR coalesce(c.booking, '') <> '' OR coalesce(c.phone, '') <> ''
      AS success
  FROM practices p LEFT JOIN first_page f USING (site) LEFT JOIN clues c USING (site) LEFT JOIN software w USING (site))
"""


def _found(spark, sf_dir):
    return sites.with_success(sites.detections(_practices(spark, sf_dir), _features(spark, sf_dir)))


@query("detection_success", SUCCESS + "SELECT id, name, website, final_url, success FROM found")
def detection_success(spark, sf_dir):
    return _found(spark, sf_dir).select("id", "name", "website", "final_url", "success")


@query("status_200_count", SUCCESS + "SELECT count(*)::BIGINT AS sites, count(final_url)::BIGINT AS answered FROM found")
def status_200_count(spark, sf_dir):
    return vendors.answered(_found(spark, sf_dir))


TOTALS = """SELECT count(*)::BIGINT AS attempted, count_if(success)::BIGINT AS success,
  count_if(NOT success)::BIGINT AS failed, 100.0::DOUBLE * count_if(NOT success) / greatest(count(*), 1) AS fail_rate
FROM found"""


@query("crawl_totals", SUCCESS + TOTALS)
def crawl_totals(spark, sf_dir):
    return hostlog.run_totals(_found(spark, sf_dir))


@query("crawl_alert", SUCCESS + "SELECT attempted, success, failed, fail_rate, 15.0::DOUBLE AS threshold FROM ("
       + TOTALS + ") WHERE fail_rate >= 15.0")
def crawl_alert(spark, sf_dir):
    return hostlog.alert(crawl_totals(spark, sf_dir)).drop("message")


@query("progress_marks", with_ctes(A.LOG) + """,
numbered AS (
  SELECT row_number() OVER (ORDER BY ts, seq) AS attempted,
    sum(CASE WHEN coalesce(status < 400, false) THEN 1 ELSE 0 END) OVER (ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS succeeded,
    count(*) OVER () AS n FROM req)
SELECT attempted::BIGINT AS attempted, succeeded::BIGINT AS succeeded, (attempted - succeeded)::BIGINT AS failed,
  round(100.0::DOUBLE * attempted / n, 2) AS pct_done
FROM numbered WHERE attempted % 50 = 0""")
def progress_marks(spark, sf_dir):
    rows = hostlog.requests(A.fetch_log(spark, sf_dir))
    return hostlog.progress_marks(
        rows.withColumn("success", F.coalesce(F.col("status") < 400, F.lit(False))), ("ts", "seq"))
