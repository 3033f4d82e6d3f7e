"""Listings: sources, limits, top-up, duplicates, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dictionaries.fixed import SEARCH_ALTERNATIVES, SOURCE_1, SOURCE_2, SOURCE_EXISTING, TARGET_PATHS
from ..functions.cells import address, drop_blank, ensure_column, search_query, with_defaults
from ..functions.urls import norm_url
from ..operators import listings as L
from ..params import PAGES_PER_HOST, SEARCH_NAME_CHARS
from ..session import new_path
from ..sources.readers import read_listings
from ..sources.sinks import write_practices
from . import adapters as A
from .adapters import with_ctes
from .registry import query

CITY_LIMIT, CITY_TARGET = 50, 60


@query("expand_targets", with_ctes(A.SUPPLIERS) + f"""
SELECT seq, (i - 1)::BIGINT AS path_no, website || paths[i] AS target FROM (
  SELECT seq, regexp_extract(w, '^[a-z]+://[^/]*') AS website, w FROM (SELECT seq, {A.NORM_SQL} AS w FROM suppliers)
  WHERE w IS NOT NULL) base,
  (SELECT {list(TARGET_PATHS)} AS paths), generate_series(2, {len(TARGET_PATHS)}) g(i)
UNION ALL SELECT seq, 0, w FROM (SELECT seq, {A.NORM_SQL} AS w FROM suppliers) WHERE w IS NOT NULL""")
def expand_targets(spark, sf_dir):
    sites = A.listings(spark, sf_dir, "supplier").select("seq", norm_url(F.col("website")).alias("website"))
    return L.expand_targets(sites.where(F.col("website").isNotNull())).select(
        "seq", F.col("path_no").cast("long").alias("path_no"), "target")


@query("address_concat", with_ctes(A.CUSTOMERS) + """
SELECT seq, concat_ws(', ', nullif(street, ''), nullif(city, ''), CASE WHEN balance < 5000 THEN name END) AS address
FROM customers""")
def address_concat(spark, sf_dir):
    state = F.when(F.col("balance") < 5000, F.col("name"))
    return A.listings(spark, sf_dir, "customer").select(
        "seq", address(F.col("street"), F.col("city"), state).alias("address"))


@query("defaults_coalesce", with_ctes(A.CUSTOMERS) + f"""
SELECT seq, coalesce(phone, '') AS phone, '{SOURCE_EXISTING}' AS source,
  coalesce(CASE WHEN balance >= 0 THEN balance END, 0.0::DOUBLE) AS balance FROM customers""")
def defaults_coalesce(spark, sf_dir):
    rows = A.listings(spark, sf_dir, "customer").select(
        "seq", "phone", F.lit(None).cast("string").alias("source"),
        F.when(F.col("balance") >= 0, F.col("balance")).alias("balance"))
    return with_defaults(rows, {"phone": "", "source": SOURCE_EXISTING, "balance": 0.0})


@query("drop_blank_keys", with_ctes(A.CUSTOMERS) + """
SELECT seq, website, street FROM customers WHERE trim(website) <> '' AND trim(street) <> ''""")
def drop_blank_keys(spark, sf_dir):
    return drop_blank(A.listings(spark, sf_dir, "customer"), "website", "street").select("seq", "website", "street")


@query("ensure_column", with_ctes(A.CUSTOMERS) + """
SELECT seq, name, CAST(NULL AS VARCHAR) AS pms_clues_jobs FROM customers""")
def ensure_column_query(spark, sf_dir):
    rows = A.listings(spark, sf_dir, "customer").select("seq", "name")
    return ensure_column(ensure_column(rows, "pms_clues_jobs"), "name")


@query("search_query_text", with_ctes(A.DETECTIONS) + f"""
SELECT id, '"' || substr(name || ' ' || website || ' ' || website || ' ' || website || ' ' || website, 1, 80)
  || '" ("Open Dental" OR Dentrix OR Eaglesoft OR "Curve Dental" OR Denticon OR "Practice-Web" OR Dolphin)' AS query
FROM detections""")
def search_query_text(spark, sf_dir):
    long_name = F.concat_ws(" ", "name", *["website"] * 4)
    return A.detections(spark, sf_dir).select(
        "id", search_query(long_name, SEARCH_ALTERNATIVES, SEARCH_NAME_CHARS).alias("query"))


@query("listings_union", with_ctes(A.SUPPLIERS, A.CUSTOMERS) + f"""
SELECT seq, name, city, website, '{SOURCE_1}' AS source FROM suppliers
UNION ALL SELECT seq, name, city, website, '{SOURCE_2}' FROM customers""")
def listings_union(spark, sf_dir):
    return L.union_sources(
        L.label_source(A.listings(spark, sf_dir, "supplier"), SOURCE_1),
        L.label_source(A.listings(spark, sf_dir, "customer"), SOURCE_2)).select("seq", "name", "city", "website", "source")


@query("limit_per_city", with_ctes(A.CUSTOMERS) + f"""
SELECT city, seq, name, rank::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY seq) AS rank FROM customers) WHERE rank <= {CITY_LIMIT}""")
def limit_per_city(spark, sf_dir):
    return L.limit_per_city(A.listings(spark, sf_dir, "customer"), ["seq"], CITY_LIMIT).select(
        "city", "seq", "name", F.col("rank").cast("long").alias("rank"))


@query("city_topup", with_ctes(A.SUPPLIERS, A.CUSTOMERS) + f""",
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY seq) AS rank FROM suppliers)
        WHERE rank <= {CITY_LIMIT}),
need AS (
  SELECT n_name AS city, greatest(0, {CITY_TARGET} - count(own.seq)) AS need
  FROM nation LEFT JOIN own ON own.city = n_name GROUP BY n_name),
extra AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY seq) AS rank FROM customers)
          WHERE rank <= {CITY_LIMIT})
SELECT city, seq, name, '{SOURCE_1}' AS source FROM own
UNION ALL SELECT city, seq, name, '{SOURCE_2}' FROM extra JOIN need USING (city)
WHERE rank <= need AND rank <= least({CITY_LIMIT}, greatest(20, need))""")
def city_topup(spark, sf_dir):
    seeds = A.table(spark, sf_dir, "nation").select(F.col("n_name").alias("city"))
    return L.city_topup(
        seeds, L.label_source(A.listings(spark, sf_dir, "supplier"), SOURCE_1),
        L.label_source(A.listings(spark, sf_dir, "customer"), SOURCE_2), ["seq"], CITY_LIMIT, CITY_TARGET).select(
        "city", "seq", "name", "source")


@query("listings_anti_existing", with_ctes(A.PARTS) + "SELECT seq, name, address FROM added")
def listings_anti_existing(spark, sf_dir):
    existing, new = A.parts(spark, sf_dir)
    return L.new_listings(existing, new, ["seq"]).select("seq", "name", "address")


@query("dedup_listings", with_ctes(A.PARTS) + """
SELECT 0::BIGINT AS prio, seq, name, address FROM existing UNION ALL SELECT 1, seq, name, address FROM added""")
def dedup_listings(spark, sf_dir):
    existing, new = A.parts(spark, sf_dir)
    return L.dedup_listings(existing, new, ["seq"]).select(F.col("prio").cast("long").alias("prio"), "seq", "name", "address")


@query("dedup_stats", with_ctes(A.PARTS) + """
SELECT (SELECT count(*) FROM fresh)::BIGINT AS n_input, (SELECT count(*) FROM added)::BIGINT AS n_added,
  ((SELECT count(*) FROM fresh) - (SELECT count(*) FROM added))::BIGINT AS n_skipped""")
def dedup_stats(spark, sf_dir):
    existing, new = A.parts(spark, sf_dir)
    return L.dedup_stats(existing, new, ["seq"])


MERGED = """merged AS (
  SELECT row_number() OVER (ORDER BY prio, seq)::BIGINT AS id, name, address, source FROM (
    SELECT 0 AS prio, seq, name, address, 'existing' AS source FROM existing
    UNION ALL SELECT 1, seq, name, address, 'new' FROM added))"""


@query("listings_merge", with_ctes(A.PARTS, MERGED) + "SELECT id, name, address, source FROM merged")
def listings_merge(spark, sf_dir):
    """Existing listings first, then the new ones, ids given anew."""
    existing, new = A.parts(spark, sf_dir)
    rows = L.dedup_listings(L.label_source(existing, SOURCE_EXISTING), L.label_source(new, "new"), ["seq"])
    return L.with_ids(rows, "prio", ["seq"]).select("id", "name", "address", "source")


@query("practices_with_ids", with_ctes(A.SUPPLIERS, A.CUSTOMERS) + f"""
SELECT row_number() OVER (ORDER BY prio, seq)::BIGINT AS id, name, website, source FROM (
  SELECT 0 AS prio, seq, name, website, '{SOURCE_1}' AS source FROM suppliers
  UNION ALL SELECT 1, seq, name, website, '{SOURCE_2}' FROM customers)""")
def practices_with_ids(spark, sf_dir):
    rows = L.union_sources(
        L.label_source(A.listings(spark, sf_dir, "supplier"), SOURCE_1).withColumn("prio", F.lit(0)),
        L.label_source(A.listings(spark, sf_dir, "customer"), SOURCE_2).withColumn("prio", F.lit(1)))
    path = new_path(spark, "practices-csv")
    write_practices(L.with_ids(rows, "prio", ["seq"]).withColumn("address", F.lit(None).cast("string")), path)
    return read_listings(spark, path, line_breaks=False).select("id", "name", "website", "source")


@query("page_cap", with_ctes(A.CAPTURES) + f"""
SELECT site, seq, final_url FROM (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY seq) AS n FROM captures) WHERE n <= {PAGES_PER_HOST}""")
def page_cap(spark, sf_dir):
    return L.cap_pages(A.captures(spark, sf_dir).select("site", "seq", "final_url")).drop("rank")


