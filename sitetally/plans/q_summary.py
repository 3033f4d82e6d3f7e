"""Cells, clues, adoption and distributions over detections; enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cells import join_list, parse_list
from ..operators import enrich, summary, vendors
from ..params import TOP_CLUES, TOP_SITES, URLS_PER_CELL
from . import adapters as A
from .adapters import with_ctes
from .registry import query

CLUE_CELLS = {"booking": "third_party_booking_clues", "payments": "third_party_payments_clues",
              "forms": "third_party_forms_clues"}
URL_CELLS = {"booking": "booking_urls", "payment": "payment_urls", "forms": "forms_urls"}
FLAG_OF = {"booking": "has_online_booking", "payment": "has_online_payments", "forms": "has_online_forms"}


def _pct(n: str, d: str = "count(*)") -> str:
    return f"round(100.0::DOUBLE * {n} / greatest({d}, 1), 2)"


@query("parse_list_cell", with_ctes(A.DETECTIONS) + f"""
SELECT id, array_to_string({A.PARSE_SQL.format('third_party_booking_clues')}, '|') AS items FROM detections""")
def parse_list_cell(spark, sf_dir):
    return A.detections(spark, sf_dir).select(
        "id", F.array_join(parse_list(F.col("third_party_booking_clues")), "|").alias("items"))


@query("join_list_cell", with_ctes(A.DETECTIONS) + f"""
SELECT id, array_to_string(list_slice(string_split(
  booking_urls || ';' || payment_urls || ';' || forms_urls || ';' || website || ';' || name, ';'), 1, {URLS_PER_CELL}), ';')
  AS cell FROM detections""")
def join_list_cell(spark, sf_dir):
    items = F.split(F.concat_ws(";", "booking_urls", "payment_urls", "forms_urls", "website", "name"), ";")
    return A.detections(spark, sf_dir).select("id", join_list(items, URLS_PER_CELL).alias("cell"))


CLUES = "clue_rows AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS category, lower(unnest({A.PARSE_SQL.format(col)})) AS clue FROM detections"
    for c, col in CLUE_CELLS.items()) + """),
clue_counts AS (SELECT category, clue, count(*)::BIGINT AS n FROM clue_rows GROUP BY category, clue)"""


@query("clue_counts", with_ctes(A.DETECTIONS, CLUES) + "SELECT * FROM clue_counts")
def clue_counts(spark, sf_dir):
    return vendors.clue_counts(A.detections(spark, sf_dir), CLUE_CELLS)


@query("clue_top10", with_ctes(A.DETECTIONS, CLUES) + """
SELECT category, clue, n, rank::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, clue) AS rank FROM clue_counts) WHERE rank <= 10""")
def clue_top10(spark, sf_dir):
    return vendors.top_counts(clue_counts(spark, sf_dir), "clue", "n", TOP_CLUES).withColumn(
        "rank", F.col("rank").cast("long"))


COUNTED = """counted AS (
  SELECT *, (coalesce(has_online_booking, false)::INT + coalesce(has_online_payments, false)::INT
    + coalesce(has_online_forms, false)::INT)::BIGINT AS integration_count FROM detections)"""


@query("integration_count", with_ctes(A.DETECTIONS, COUNTED) + "SELECT id, integration_count FROM counted")
def integration_count(spark, sf_dir):
    return A.detections(spark, sf_dir).select("id", vendors.integration_count().alias("integration_count"))


@query("top_integrated_sites", with_ctes(A.DETECTIONS, COUNTED) + f"""
SELECT id, name, website, integration_count,
  CASE WHEN has_online_booking THEN coalesce(likely_booking_vendor, 'detected') END AS booking,
  CASE WHEN has_online_payments THEN 'detected' END AS payments, CASE WHEN has_online_forms THEN 'detected' END AS forms
FROM counted WHERE integration_count >= 2 ORDER BY integration_count DESC, id LIMIT {TOP_SITES}""")
def top_integrated_sites(spark, sf_dir):
    return vendors.top_integrated(A.detections(spark, sf_dir))


@query("capture_rate", with_ctes(A.DETECTIONS) + ",\nflat AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS category, coalesce({FLAG_OF[c]}, false) AS flag, len({A.PARSE_SQL.format(col)}) AS n FROM detections"
    for c, col in URL_CELLS.items()) + """)
SELECT category, count_if(flag)::BIGINT AS flagged, sum(n)::BIGINT AS urls,
  count_if(flag AND n = 0)::BIGINT AS flagged_without_url,
  round(100.0::DOUBLE * sum(n) / greatest(count_if(flag), 1), 2) AS rate_pct FROM flat GROUP BY category""")
def capture_rate(spark, sf_dir):
    return vendors.capture_rate(A.detections(spark, sf_dir), URL_CELLS, FLAG_OF)


PRODUCTION_VENDORS = """CASE WHEN contains(h, 'nexhealth') THEN 'NexHealth' WHEN contains(h, 'localmed') THEN 'LocalMed'
    WHEN contains(h, 'square') THEN 'Square' WHEN contains(h, 'jotform') THEN 'JotForm' WHEN contains(h, 'facebook') THEN NULL
    ELSE h END"""
CELL_VENDORS = "cell_urls AS (\n" + "\n  UNION ALL ".join(
    f"SELECT id, '{c}' AS category, unnest({A.PARSE_SQL.format(col)}) AS url FROM detections"
    for c, col in URL_CELLS.items()) + f"""),
cell_vendors AS (
  SELECT id, category, url, {PRODUCTION_VENDORS} AS vendor
  FROM (SELECT *, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h FROM cell_urls))"""


@query("vendor_counts_cells", with_ctes(A.DETECTIONS, CELL_VENDORS) + """
SELECT category, vendor, count(*)::BIGINT AS n_urls FROM cell_vendors WHERE vendor IS NOT NULL GROUP BY category, vendor""")
def vendor_counts_cells(spark, sf_dir):
    """Vendors by the full vendor map, from the URL cells of flat detections."""
    return vendors.vendor_counts(vendors.cell_urls(A.detections(spark, sf_dir), URL_CELLS))


@query("full_stack_by_vendor", with_ctes(A.DETECTIONS, COUNTED, CELL_VENDORS) + """,
pairs AS (
  SELECT DISTINCT v.vendor, c.id, c.integration_count FROM cell_vendors v JOIN counted c USING (id) WHERE v.vendor IS NOT NULL)
SELECT vendor, count(*)::BIGINT AS n_sites, count_if(integration_count = 3)::BIGINT AS n_full,
  round(100.0::DOUBLE * count_if(integration_count = 3) / count(*), 2) AS full_pct,
  (SELECT round(100.0::DOUBLE * count_if(integration_count = 3) / count(*), 2) FROM counted) AS overall_pct
FROM pairs GROUP BY vendor""")
def full_stack_by_vendor(spark, sf_dir):
    rows = A.detections(spark, sf_dir).withColumn("integration_count", vendors.integration_count())
    urls = F.concat(*[parse_list(F.col(c)) for c in URL_CELLS.values()])
    named = rows.select("id", "integration_count", F.explode_outer(urls).alias("url")).withColumn(
        "vendor", vendors.vendor_from_url(F.col("url"))).where(F.col("vendor").isNotNull())
    return vendors.full_stack_by_vendor(named, rows)


ADOPTION = f"""count(*)::BIGINT AS num_practices, {_pct('count_if(has_online_booking)')} AS pct_online_booking,
  {_pct('count_if(has_online_payments)')} AS pct_online_payments, {_pct('count_if(has_online_forms)')} AS pct_online_forms"""
THIRD = ", ".join(f"{_pct(f'count_if(len({A.PARSE_SQL.format(c)}) > 0)')} AS {m}" for m, c in summary.CLUES.items())


@query("summary_adoption", with_ctes(A.DETECTIONS) + f"SELECT {ADOPTION} FROM detections")
def summary_adoption(spark, sf_dir):
    return summary.adoption(A.detections(spark, sf_dir))


@query("summary_third_party", with_ctes(A.DETECTIONS) + f"SELECT {THIRD} FROM detections")
def summary_third_party(spark, sf_dir):
    return summary.third_party(A.detections(spark, sf_dir))


DISTRIBUTIONS = f"""pms AS (
  SELECT coalesce(likely_pms, 'unknown') AS software, count(*)::BIGINT AS n,
    {_pct('count(*)', '(SELECT count(*) FROM detections)')} AS pct FROM detections GROUP BY 1),
phone AS (
  SELECT lower(p) AS provider, count(*)::BIGINT AS n, {_pct('count(*)', '(SELECT count(*) FROM detections)')} AS pct
  FROM (SELECT unnest({A.PARSE_SQL.format('phone_clues_site')}) AS p FROM detections) GROUP BY 1)"""


@query("pms_distribution", with_ctes(A.DETECTIONS, DISTRIBUTIONS) + "SELECT * FROM pms")
def pms_distribution(spark, sf_dir):
    return summary.pms_distribution(A.detections(spark, sf_dir))


@query("phone_distribution", with_ctes(A.DETECTIONS, DISTRIBUTIONS) + "SELECT * FROM phone ORDER BY n DESC, provider")
def phone_distribution(spark, sf_dir):
    return summary.phone_distribution(A.detections(spark, sf_dir))


MAPS = """maps AS (
  SELECT 'pms_distribution_pct' AS metric, software AS key, pct AS value, n FROM pms
  UNION ALL SELECT 'phone_providers_pct', provider, pct, n FROM phone)"""


@query("summary_maps", with_ctes(A.DETECTIONS, DISTRIBUTIONS, MAPS) + "SELECT metric, key, value FROM maps")
def summary_maps(spark, sf_dir):
    one = summary.summary_row(A.detections(spark, sf_dir))
    return one.select(F.lit("pms_distribution_pct").alias("metric"), F.explode("pms_distribution_pct")).unionByName(
        one.select(F.lit("phone_providers_pct").alias("metric"), F.explode("phone_providers_pct")))


def _json_map(name: str, label: str) -> str:
    return (f"(SELECT '{{' || string_agg('\"' || {label} || '\":' || CAST(pct AS VARCHAR), ',' ORDER BY n DESC, {label}) "
            f"|| '}}' FROM {name})")


SUMMARY_TEXT = f"""scalars AS (SELECT {ADOPTION}, {THIRD} FROM detections),
texts AS (
  SELECT 'num_practices' AS metric, CAST(num_practices AS VARCHAR) AS value FROM scalars
  {' '.join(f"UNION ALL SELECT '{m}', CAST({m} AS VARCHAR) FROM scalars" for m in (*summary.FLAGS, *summary.CLUES))}
  UNION ALL SELECT 'pms_distribution_pct', {_json_map('pms', 'software')}
  UNION ALL SELECT 'phone_providers_pct', {_json_map('phone', 'provider')})"""


@query("sink_summary_rows", with_ctes(A.DETECTIONS, DISTRIBUTIONS, SUMMARY_TEXT) + "SELECT metric, value FROM texts")
def sink_summary_rows(spark, sf_dir):
    from ..session import new_path
    from ..sources import readers, sinks
    from ..schemas import _s, _struct
    path = new_path(spark, "summary-rows")
    sinks.write_csv(summary.summary_rows(A.detections(spark, sf_dir)), path)
    return readers.read_csv(spark, path, _struct(metric=_s, value=_s))


@query("sink_summary_json", with_ctes(A.DETECTIONS, DISTRIBUTIONS, SUMMARY_TEXT) + """
SELECT metric, value FROM texts""")
def sink_summary_json(spark, sf_dir):
    """The document written as text, read back and taken apart again."""
    from ..session import new_path
    from ..sources import sinks
    path = new_path(spark, "summary-json")
    one = summary.summary_row(A.detections(spark, sf_dir))
    sinks.write_json_document(one.select(F.to_json(F.struct(*one.columns)).alias("value")), path)
    doc = spark.read.schema(one.schema).json(path)
    cells = [F.struct(F.lit(f.name).alias("metric"),
                      (F.to_json(f.name) if f.dataType.typeName() == "map" else F.col(f.name).cast("string")).alias("value"))
             for f in one.schema.fields]
    return doc.select(F.inline(F.array(*cells)))


# --- enrichment -----------------------------------------------------------------------------------------------------

@query("snippet_vendors", with_ctes(A.SEARCH_HITS) + "SELECT id, rank, vendor, url, tag FROM mentions")
def snippet_vendors(spark, sf_dir):
    return enrich.snippet_vendors(A.search_hits(spark, sf_dir), A.SNIPPET_WORDS).select(
        "id", "rank", "vendor", "url", "tag")


@query("job_text_mentions", """
SELECT conv_id AS id, turn, v.vendor, v.vendor || ':JOBS:mention' AS tag
FROM conversations, (VALUES ('alpha', 'the'), ('beta', 'dans')) v(vendor, word)
WHERE list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), word)""")
def job_text_mentions(spark, sf_dir):
    texts = A.table(spark, sf_dir, "conversations").select(
        F.struct("conv_id", "turn").alias("id"), "text")
    found = enrich.job_mentions(texts, (("alpha", "the"), ("beta", "dans")))
    return found.select(F.col("id.conv_id").alias("id"), "id.turn", "vendor", "tag")


@query("enrich_jobs", with_ctes(A.DETECTIONS, A.SEARCH_HITS) + """
SELECT d.id, d.name, CASE WHEN d.name <> '' THEN coalesce(c.clues, '') ELSE '' END AS pms_clues_jobs,
  coalesce(CASE WHEN d.name <> '' AND c.n_vendors = 1 THEN c.vendor END, d.likely_pms, 'unknown') AS likely_pms,
  CASE WHEN d.name <> '' AND c.n_vendors = 1 THEN greatest(d.pms_confidence, 0.8::DOUBLE) ELSE d.pms_confidence END
    AS pms_confidence
FROM detections d LEFT JOIN clues c ON c.id = d.id""")
def enrich_jobs(spark, sf_dir):
    clues = enrich.job_clues(enrich.snippet_vendors(A.search_hits(spark, sf_dir), A.SNIPPET_WORDS))
    return enrich.enrich(A.detections(spark, sf_dir), clues).select(
        "id", "name", join_list(F.col("pms_clues_jobs")).alias("pms_clues_jobs"), "likely_pms", "pms_confidence")
