"""Sources and sinks: tables written to the shared folder in the outside formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..dictionaries.fixed import SOURCE_1, SOURCE_2
from ..functions.urls import norm_url
from ..operators import enrich
from ..session import new_path
from ..sources import readers, sinks
from . import adapters as A
from .adapters import with_ctes
from .registry import query

FEED_PAGE = 50  # a feed returns pages of at most fifty rows
BOM = "﻿"


def _practice_rows(spark, sf_dir):
    rows = A.listings(spark, sf_dir, "customer")
    return rows.select(
        F.col("seq").alias("id"), "name", norm_url(F.col("website")).alias("website"), "phone",
        F.concat("street", F.lit(', "'), "city", F.lit('"\nfloor; 2')).alias("address"), F.lit("list").alias("source"))


@query("src_csv_listings", with_ctes(A.CUSTOMERS) + f"""
SELECT seq AS id, name, {A.NORM_SQL} AS website, CAST(NULL AS VARCHAR) AS phone,
  street || ', "' || city || '"' || chr(10) || 'floor; 2' AS address, 'list' AS source FROM customers""")
def src_csv_listings(spark, sf_dir):
    """Columns in another order, one too many and one missing; a byte-order mark, quotes and line breaks in a cell."""
    path = new_path(spark, "listings-csv")
    rows = _practice_rows(spark, sf_dir).withColumn("note", F.lit("extra"))
    sinks.write_csv(rows.select(F.col("source").alias(BOM + "source"), "address", "note", "name", "id", "website"), path)
    return readers.read_listings(spark, path)


@query("src_csv_seeds", "SELECT n_name AS city FROM nation")
def src_csv_seeds(spark, sf_dir):
    """Seed cities with blanks around them, twice each, and empty lines between."""
    path = new_path(spark, "seeds-csv")
    names = A.table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("state"), F.col("n_name").alias("city"))
    blank = names.select("state", F.lit(" ").alias("city"))
    sinks.write_csv(names.withColumn("city", F.concat(F.lit(" "), "city")).unionByName(names).unionByName(blank), path)
    return readers.read_seeds(spark, path, line_breaks=False)


FLAT = """SELECT id, nullif(name, '') AS name, website, NULL::VARCHAR AS final_url, 200::INTEGER AS http_status,
  has_online_booking, has_online_forms, has_online_payments,
  {0}(third_party_booking_clues) AS third_party_booking_clues, {0}(third_party_forms_clues) AS third_party_forms_clues,
  {0}(third_party_payments_clues) AS third_party_payments_clues, NULL::VARCHAR AS third_party_other_clues,
  likely_booking_vendor, {0}(phone_clues_site) AS phone_clues_site, NULL::VARCHAR AS likely_phone_provider,
  NULL::VARCHAR AS pms_clues_site, likely_pms, pms_confidence, NULL::VARCHAR AS evidence_urls,
  {0}(booking_urls) AS booking_urls, {0}(payment_urls) AS payment_urls, {0}(forms_urls) AS forms_urls
FROM detections"""
# Lists are parsed before writing, so a cell holds trimmed items; an empty cell is NULL when read back.
CELL_MACRO = "nullif(array_to_string(" + A.PARSE_SQL + ", ';'), '')"


def _flat_sql() -> str:
    sql = FLAT
    while "{0}(" in sql:
        start = sql.index("{0}(")
        end = sql.index(")", start)
        sql = sql[:start] + CELL_MACRO.format(sql[start + 4:end]) + sql[end + 1:]
    return sql


def _full(spark, sf_dir):
    """Detections with arrays inside and all 22 columns."""
    from ..functions.cells import parse_list
    rows = A.detections(spark, sf_dir).withColumn("http_status", F.lit(200))
    for f in schemas.DETECTION_CSV.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return rows.withColumns({c: parse_list(F.col(c)) for c in schemas.LIST_COLUMNS}).select(
        *schemas.DETECTION_CSV.fieldNames())


@query("src_csv_detections", with_ctes(A.DETECTIONS) + _flat_sql())
def src_csv_detections(spark, sf_dir):
    path = new_path(spark, "detections-csv")
    sinks.write_detections_csv(_full(spark, sf_dir), path)
    return readers.read_detections(spark, path)


@query("sink_csv_roundtrip", with_ctes(A.DETECTIONS) + f"""
SELECT d.id, coalesce({CELL_MACRO.format('third_party_booking_clues')}, '') AS third_party_booking_clues,
  coalesce({CELL_MACRO.format('booking_urls')}, '') AS booking_urls, has_online_forms, pms_confidence FROM detections d""")
def sink_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "detections-csv")
    sinks.write_detections_csv(_full(spark, sf_dir), path)
    back = readers.read_detections(spark, path)
    return back.select(
        "id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("third_party_booking_clues", "booking_urls")],
        "has_online_forms", "pms_confidence")


@query("sink_jsonl_roundtrip", with_ctes(A.DETECTIONS) + f"""
SELECT id, name, has_online_forms, coalesce({CELL_MACRO.format('phone_clues_site')}, '') AS phone_clues_site,
  coalesce({CELL_MACRO.format('booking_urls')}, '') AS booking_urls, likely_pms, pms_confidence FROM detections""")
def sink_jsonl_roundtrip(spark, sf_dir):
    path = new_path(spark, "detections-jsonl")
    rows = _full(spark, sf_dir)
    sinks.write_detections_jsonl(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.select(
        "id", "name", "has_online_forms", *[F.array_join(c, ";").alias(c) for c in ("phone_clues_site", "booking_urls")],
        "likely_pms", "pms_confidence")


@query("sink_resume_append", with_ctes(A.DETECTIONS) + """
SELECT id, name, likely_pms, has_online_booking FROM (SELECT id, nullif(name, '') AS name, likely_pms, has_online_booking FROM detections)""")
def sink_resume_append(spark, sf_dir):
    """First only the rows with booking, then all rows, then all rows again: each id ends up there once."""
    path = new_path(spark, "resume-csv")
    rows = A.detections(spark, sf_dir).select("id", "name", "likely_pms", "has_online_booking")
    for part in (rows.where("has_online_booking"), rows, rows):
        sinks.append_new(part, path, "id")
    return readers.read_csv(spark, path, rows.schema)


@query("src_captures", with_ctes(A.CAPTURES) + """
SELECT site, seq, CAST(status AS INTEGER) AS status, final_url, 'text/html' AS content_type, md5(html) AS digest FROM captures""")
def src_captures(spark, sf_dir):
    path = new_path(spark, "captures")
    A.captures(spark, sf_dir).write.parquet(path)
    return readers.read_captures(spark, path).select(
        "site", "seq", "status", "final_url", "content_type", F.md5("html").alias("digest"))


def _pages_of(rows, item, name):
    """Rows grouped into feed pages of at most fifty, by ranges of the key."""
    page = F.floor(F.col("seq") / FEED_PAGE).alias("page")
    return rows.groupBy("city", page).agg(F.collect_list(item).alias(name)).drop("page")


@query("src_feed_a_json", with_ctes(A.SUPPLIERS) + f"""
SELECT city, name, concat_ws(', ', nullif(street, ''), city) AS address,
  CASE WHEN balance < 3000 AND balance > 0 THEN 'http://own.example.com/' || seq WHEN balance <= 0 THEN ''
    ELSE 'https://feed.example.com/' || seq END AS website,
  CASE WHEN balance < 3000 AND balance > 0 THEN 'own' WHEN balance <= 0 THEN 'none' ELSE 'listing' END AS website_kind,
  '' AS phone, '{SOURCE_1}' AS source FROM suppliers""")
def src_feed_a_json(spark, sf_dir):
    rows = A.listings(spark, sf_dir, "supplier")
    key = F.concat(F.lit("s"), F.col("seq").cast("string")).alias("id")
    place = F.struct(F.col("street").alias("address1"), F.col("city"), F.lit("").alias("state")).alias("location")
    item = F.struct(key, F.col("name"), F.lit("").alias("display_phone"), place)
    number = F.col("seq").cast("string")
    details = rows.where(F.col("balance") > 0).select(
        key, F.concat(F.lit("https://feed.example.com/"), number).alias("url"),
        F.when(F.col("balance") < 3000, F.concat(F.lit("http://own.example.com/"), number)).otherwise("").alias("website"))
    pages, extra = new_path(spark, "feed-a"), new_path(spark, "feed-a-details")
    _pages_of(rows, item, "businesses").write.json(pages)
    details.write.json(extra)
    return readers.normalize_feed_a(
        spark.read.schema(schemas.FEED_A_PAGE).json(pages), spark.read.schema(schemas.FEED_A_DETAIL).json(extra))


@query("src_feed_b_json", with_ctes(A.CUSTOMERS) + f"""
SELECT city, name, street || ' ' || city AS address,
  CASE WHEN balance > 0 THEN 'http://own.example.com/' || seq ELSE '' END AS website,
  CASE WHEN balance > 0 THEN '555-' || seq ELSE '' END AS phone, '{SOURCE_2}' AS source FROM customers""")
def src_feed_b_json(spark, sf_dir):
    rows = A.listings(spark, sf_dir, "customer")
    number = F.col("seq").cast("string")
    key = F.concat(F.lit("c"), number).alias("place_id")
    item = F.struct(key, F.col("name"), F.concat("street", F.lit(" "), "city").alias("formatted_address"))
    details = rows.where(F.col("balance") > 0).select(key, F.struct(
        F.concat(F.lit("http://own.example.com/"), number).alias("website"),
        F.concat(F.lit("555-"), number).alias("formatted_phone_number")).alias("result"))
    pages, extra = new_path(spark, "feed-b"), new_path(spark, "feed-b-details")
    _pages_of(rows, item, "results").write.json(pages)
    details.write.json(extra)
    return readers.normalize_feed_b(
        spark.read.schema(schemas.FEED_B_PAGE).json(pages), spark.read.schema(schemas.FEED_B_DETAIL).json(extra))


@query("src_search_json", with_ctes(A.SEARCH_HITS) + f"""
, paged AS (SELECT *, rank - rank % {FEED_PAGE} AS page FROM hits),
a AS (
  SELECT *, page + row_number() OVER (PARTITION BY id, page ORDER BY rank) - 1 AS pos FROM paged WHERE length(snippet) > 600),
b AS (SELECT *, page + row_number() OVER (PARTITION BY id, page ORDER BY rank) - 1 AS pos FROM paged)
SELECT id, pos::BIGINT AS rank, name, url, snippet FROM a
UNION ALL SELECT id, pos::BIGINT, name, url, snippet FROM b WHERE id NOT IN (SELECT id FROM a)""")
def src_search_json(spark, sf_dir):
    """The first provider knows only the long snippets, the second knows all."""
    hits = A.search_hits(spark, sf_dir).withColumn("offset", F.col("rank") - F.col("rank") % FEED_PAGE)

    def pages(*item, keep=None):
        entry = F.struct("rank", F.struct(*item).alias("item"))
        listed = F.array_sort(F.collect_list(entry if keep is None else F.when(keep, entry)))
        return hits.groupBy("id", "offset").agg(F.transform(listed, lambda x: x["item"]).alias("items"))

    a = pages("name", "url", "snippet", keep=F.length("snippet") > 600).select(
        "id", "offset", F.struct(F.col("items").alias("value")).alias("webPages"))
    b = pages(F.col("name").alias("title"), F.col("url").alias("link"), "snippet").select(
        "id", "offset", F.col("items").alias("organic_results"))
    first, second = new_path(spark, "search-a"), new_path(spark, "search-b")
    a.write.json(first)
    b.write.json(second)
    return enrich.normalize_search(
        spark.read.schema(schemas.SEARCH_A).json(first), spark.read.schema(schemas.SEARCH_B).json(second))
