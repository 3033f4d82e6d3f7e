"""URLs, links, vendors behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..functions.html import page_links
from ..operators import patterns, vendors
from . import adapters as A
from .adapters import with_ctes
from .registry import query


@query("norm_url", with_ctes(A.CUSTOMERS) + f"SELECT seq, {A.NORM_SQL} AS website FROM customers")
def norm_url(spark, sf_dir):
    return A.listings(spark, sf_dir, "customer").select("seq", urls.norm_url(F.col("website")).alias("website"))


@query("url_parts", """
SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
  lower(regexp_extract(url, '://([^/?#]*)', 1)) AS authority, regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path
FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return A.table(spark, sf_dir, "pages").select(
        "page_id", urls.scheme(u).alias("scheme"), urls.authority(u).alias("authority"), urls.url_path(u).alias("path"))


@query("resolve_url", with_ctes(A.SECTIONS) + """,
hrefs AS (
  SELECT b.seq, c.final_url AS base, unnest(b.links || ['', '#a', '?q=1', 'x/y', '//h.example/z', 'mailto.html',
    'https://o.example/p?q#r']) AS href
  FROM bodies b JOIN captures c USING (seq)),
split AS (
  SELECT *, regexp_extract(base, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_replace(base, '#.*$', '') AS no_fragment,
    regexp_replace(base, '[?#].*$', '') AS no_query FROM hrefs)
SELECT seq, href, CASE WHEN href = '' THEN no_fragment WHEN starts_with(href, 'https:') THEN href
  WHEN starts_with(href, '//') THEN split_part(base, ':', 1) || ':' || href
  WHEN starts_with(href, '/') THEN origin || href
  WHEN starts_with(href, '?') THEN no_query || href WHEN starts_with(href, '#') THEN no_fragment || href
  ELSE regexp_replace(no_query, '[^/]*$', '') || href END AS target, count(*)::BIGINT AS n
FROM split GROUP BY ALL""")
def resolve_url(spark, sf_dir):
    more = ["", "#a", "?q=1", "x/y", "//h.example/z", "mailto.html", "https://o.example/p?q#r"]
    links = F.concat(page_links(F.col("html")), F.array(*[F.lit(h) for h in more]))
    rows = A.captures(spark, sf_dir).select("seq", "final_url", F.explode(links).alias("href"))
    target = urls.resolve_url(F.col("final_url"), F.col("href"))
    return rows.select("seq", "href", target.alias("target")).groupBy("seq", "href", "target").agg(
        F.count(F.lit(1)).alias("n"))


@query("external_links", with_ctes(A.PAGE_GRAPH) + "SELECT site, seq, url FROM outside")
def external_links(spark, sf_dir):
    links = A.page_graph(spark, sf_dir)
    return links.where(urls.is_external(F.col("url"), F.col("site"))).select("site", "seq", "url")


@query("external_links_substring", with_ctes(A.PAGE_GRAPH) + """
SELECT site, seq, url FROM links WHERE NOT contains(host, site)""")
def external_links_substring(spark, sf_dir):
    links = A.page_graph(spark, sf_dir)
    return links.where(urls.is_external(F.col("url"), F.col("site"), "substring")).select("site", "seq", "url")


@query("link_categories", with_ctes(A.PAGE_GRAPH) + """
SELECT site, category, url, min(seq) AS first_seq FROM classed GROUP BY site, category, url""")
def link_categories(spark, sf_dir):
    found = patterns.service_links(A.page_graph(spark, sf_dir), A.LINK_RULES)
    return patterns.distinct_service_links(found).select(
        "site", "category", "url", F.col("first.seq").alias("first_seq"))


@query("vendor_from_url", with_ctes(A.SERVICE_URLS) + "SELECT url, category, vendor FROM named WHERE vendor IS NOT NULL")
def vendor_from_url(spark, sf_dir):
    rows = A.service_urls(spark, sf_dir)
    vendor = vendors.vendor_from_url(F.col("url"), A.SERVICE_VENDORS)
    return rows.select("url", "category", vendor.alias("vendor")).where(F.col("vendor").isNotNull())


def _counts(spark, sf_dir):
    return vendors.vendor_counts(A.service_urls(spark, sf_dir), A.SERVICE_VENDORS)


@query("vendor_counts", with_ctes(A.SERVICE_URLS) + "SELECT category, vendor, n_urls FROM counts")
def vendor_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query("vendor_top15", with_ctes(A.SERVICE_URLS) + """
SELECT category, vendor, n_urls, rank::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY n_urls DESC, vendor) AS rank FROM counts) WHERE rank <= 15""")
def vendor_top15(spark, sf_dir):
    return vendors.top_counts(_counts(spark, sf_dir), "vendor", "n_urls", 15).withColumn("rank", F.col("rank").cast("long"))


@query("market_share", with_ctes(A.SERVICE_URLS) + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n_urls DESC, vendor) AS rank FROM counts),
merged AS (
  SELECT category, CASE WHEN rank <= 3 THEN vendor ELSE 'Others' END AS vendor, least(rank, 4)::BIGINT AS rank,
    sum(n_urls)::BIGINT AS n_urls FROM ranked GROUP BY ALL)
SELECT *, round(100.0::DOUBLE * n_urls / sum(n_urls) OVER (PARTITION BY category), 1) AS share_pct FROM merged""")
def market_share(spark, sf_dir):
    return vendors.market_share(_counts(spark, sf_dir), 3)


@query("vendor_matrix", with_ctes(A.SERVICE_URLS) + """
SELECT vendor, coalesce(sum(n_urls) FILTER (category = 'booking'), 0)::BIGINT AS booking,
  coalesce(sum(n_urls) FILTER (category = 'payment'), 0)::BIGINT AS payment,
  coalesce(sum(n_urls) FILTER (category = 'forms'), 0)::BIGINT AS forms, count(*)::BIGINT AS n_categories
FROM counts GROUP BY vendor HAVING count(*) >= 2""")
def vendor_matrix(spark, sf_dir):
    return vendors.vendor_matrix(_counts(spark, sf_dir), ["booking", "payment", "forms"])


def _site_services(spark, sf_dir):
    """Vendors of the service pages that a site links to."""
    found = patterns.service_links(A.page_graph(spark, sf_dir), A.LINK_RULES)
    vendor = vendors.vendor_from_url(F.col("url"), A.SERVICE_VENDORS)
    return found.withColumn("vendor", vendor).where(F.col("vendor").isNotNull())


SITE_SERVICES = A.PAGE_GRAPH + """,
site_services AS (
  SELECT * FROM (
    SELECT site, category, url, CASE WHEN contains(h, 'spam-farm') THEN 'Spam Farm' WHEN contains(h, 'cheap-pills') THEN NULL
      WHEN contains(h, 'blog.') THEN 'Blog Host' WHEN contains(h, 'www.') THEN 'Web Host' ELSE h END AS vendor
    FROM (SELECT *, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h FROM classed)) WHERE vendor IS NOT NULL)"""


@query("vendor_consolidation", with_ctes(SITE_SERVICES) + """
SELECT site, n_vendors, n_categories, CASE WHEN n_vendors > 1 THEN 'several vendors' WHEN n_categories > 1 THEN 'all-in-one'
  ELSE 'single service' END AS kind
FROM (SELECT site, count(DISTINCT vendor)::BIGINT AS n_vendors, count(DISTINCT category)::BIGINT AS n_categories
      FROM site_services GROUP BY site)""")
def vendor_consolidation(spark, sf_dir):
    return vendors.vendor_consolidation(_site_services(spark, sf_dir))


@query("share_shift", with_ctes(A.SERVICE_URLS) + """,
t AS (SELECT run, count(*) AS n FROM named WHERE vendor IS NOT NULL GROUP BY run),
v AS (
  SELECT vendor, 100.0::DOUBLE * count_if(run = 0) / (SELECT n FROM t WHERE run = 0) AS b,
    100.0::DOUBLE * count_if(run = 1) / (SELECT n FROM t WHERE run = 1) AS a
  FROM named WHERE vendor IS NOT NULL GROUP BY vendor)
SELECT vendor, round(b, 2) AS share_before, round(a, 2) AS share_after, round(a - b, 2) AS shift FROM v""")
def share_shift(spark, sf_dir):
    return vendors.share_shift(vendor_runs(spark, sf_dir))


def vendor_runs(spark, sf_dir):
    rows = A.service_urls(spark, sf_dir)
    return rows.withColumn("vendor", vendors.vendor_from_url(F.col("url"), A.SERVICE_VENDORS)).where(
        F.col("vendor").isNotNull()).select("vendor", "run")


@query("pms_from_service_url", with_ctes(A.PAGE_GRAPH) + """
SELECT vendor, count(DISTINCT site)::BIGINT AS n_sites FROM (
  SELECT site, CASE WHEN contains(h, 'blog.') THEN 'kappa' WHEN contains(h, 'spam-farm') THEN 'lambda'
    WHEN contains(h, '.example.org') THEN 'mu' END AS vendor
  FROM (SELECT *, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h FROM classed))
WHERE vendor IS NOT NULL GROUP BY vendor""")
def pms_from_service_url(spark, sf_dir):
    found = patterns.service_links(A.page_graph(spark, sf_dir), A.LINK_RULES)
    return vendors.software_from_urls(found, A.PORTALS)
