"""The test tables in the shapes the operators read, once as DataFrames and once as SQL for checking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import authority
from ..operators.skew import top_k
from ..sources.dictionary import DICTIONARIES, Pattern, load_patterns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# --- captures -------------------------------------------------------------------------------------------------------

def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select(
        authority(F.col("url")).alias("site"), F.col("page_id").alias("seq"), F.lit(200).alias("status"),
        F.col("url").alias("final_url"), F.lit("text/html").alias("content_type"), "html")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures_of(table(spark, sf_dir, "pages"))


SITE = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
CAPTURES = f"""captures AS (
  SELECT {SITE} AS site, page_id AS seq, 200 AS status, url AS final_url, html FROM pages)"""

# Words of the test pages that stand in for challenge markers and evidence paths.
MARKERS = ("onlyth", "spam-farm")
EVIDENCE = r"(thonwh|thereth|/the\b|blog[.])"

# Visible text and links in SQL, by cutting at fixed strings: the test pages have one script, style and comment each, no ``>``
# in an attribute, and these references only.
_REFERENCES = (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&"))


def _unescape_sql(text: str) -> str:
    for name, char in _REFERENCES:
        text = f"replace({text}, '&{name};', '{char}')"
    return text


def _without_sql(text: str, start: str, end: str) -> str:
    return (f"CASE WHEN contains({text}, '{start}') THEN left({text}, strpos({text}, '{start}') - 1) || '<x>' || "
            f"substr({text}, strpos({text}, '{end}') + {len(end)}) ELSE {text} END")


_SEEN_SQL = f"""(SELECT {_without_sql('b', '<!--', '-->')} FROM (SELECT {_without_sql('a', '<script>', '</script>')} AS b FROM (
    SELECT {_without_sql('html', '<style>', '</style>')} AS a)))"""
TEXT_SQL = "lower(" + _unescape_sql(
    f"""(SELECT ' ' || array_to_string(list_filter(list_transform(string_split(s, '<')[2:], lambda p: substr(p, strpos(p, '>') + 1)),
    lambda p: p <> ''), ' ') || CASE WHEN ends_with(s, '>') THEN ' ' ELSE '' END FROM (SELECT {_SEEN_SQL} AS s))""") + ")"
LINKS_SQL = """list_filter(list_transform(list_filter(string_split(html, '<a ')[2:], lambda p: contains(split_part(p, '>', 1), 'href="')),
    lambda p: trim(""" + _unescape_sql("split_part(split_part(p, 'href=\"', 2), '\"', 1)") + """)), lambda h: NOT starts_with(h, 'mailto:'))"""

SECTIONS = CAPTURES + f""",
bodies AS (
  SELECT site, seq, html, {LINKS_SQL} AS links, {TEXT_SQL} AS text FROM captures),
sections AS (
  SELECT site, seq, 0 AS section, html AS body FROM bodies
  UNION ALL SELECT site, seq, 1, array_to_string(links, chr(10)) FROM bodies
  UNION ALL SELECT site, seq, 2, text FROM bodies)"""


def fixture_patterns() -> list[Pattern]:
    return load_patterns(DICTIONARIES / "fixture.yaml")


def _sql_str(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def patterns_values() -> str:
    rows = ", ".join(f"({p.prio}, {_sql_str(p.category)}, {_sql_str(p.strength)}, {_sql_str(p.vendor)}, {_sql_str(p.regex)})"
                     for p in fixture_patterns())
    return f"patterns(prio, category, strength, vendor, regex) AS (VALUES {rows})"


def _hits_sql() -> str:
    """One SELECT per pattern: SQL regular expressions must be constants."""
    selects = []
    for p in fixture_patterns():
        rx = f"'(?i){p.regex}'"
        selects.append(
            f"SELECT site, seq, section, {p.prio} AS prio, regexp_extract(body, {rx}) AS hit FROM sections "
            f"WHERE regexp_matches(body, {rx})")
    return "all_hits AS (\n  " + "\n  UNION ALL ".join(selects) + ")"


HITS = SECTIONS + ",\n" + patterns_values() + ",\n" + _hits_sql() + """,
page_hits AS (
  SELECT h.site, h.seq, h.prio, p.category, p.strength, p.vendor,
         min(h.section) AS section, arg_min(h.hit, h.section) AS hit
  FROM all_hits h JOIN patterns p USING (prio)
  GROUP BY h.site, h.seq, h.prio, p.category, p.strength, p.vendor),
site_hits AS (
  SELECT site, prio, category, strength, vendor, section, seq, hit FROM (
    SELECT *, row_number() OVER (PARTITION BY site, prio ORDER BY section, seq) AS rn FROM page_hits) WHERE rn = 1),
sites AS (SELECT DISTINCT site FROM captures)"""


# --- fetch log ------------------------------------------------------------------------------------------------------

def fetch_log_of(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when((kind == "signup") & (value < 5), None)
        .when(kind.isin("view", "click"), 200)
        .when(kind == "signup", 404)
        .when((kind == "purchase") & (value < 34), 429)
        .when(kind == "purchase", 200)
        .when(value < 20, 503)
        .when(value < 40, 502)
        .when(value >= 200, 403))
    return events.select(
        F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("host"), "ts", F.col("event_id").alias("seq"),
        status.cast("int").alias("status"),
        ((kind == "view") & (value >= 100)).alias("challenge"),
        ((kind == "signup") & (value < 5)).alias("disallowed"),
        F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("double").alias("crawl_delay"))


def evidence_of(log: DataFrame) -> DataFrame:
    """Up to five evidence pages of each host: its first challenged requests."""
    ranked = top_k(log.where("challenge"), ["host"], [F.col("seq")], 5, "pos")
    return ranked.select("host", "pos", F.concat(F.lit("http://"), "host", F.lit("/"), "seq").alias("url"))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log_of(table(spark, sf_dir, "events"))


LOG = """log AS (
  SELECT 'h' || user_id AS host, ts, event_id AS seq,
    CASE WHEN event_type = 'signup' AND value < 5 THEN NULL
         WHEN event_type IN ('view', 'click') THEN 200
         WHEN event_type = 'signup' THEN 404
         WHEN event_type = 'purchase' AND value < 34 THEN 429
         WHEN event_type = 'purchase' THEN 200
         WHEN value < 20 THEN 503 WHEN value < 40 THEN 502 WHEN value >= 200 THEN 403 END AS status,
    event_type = 'view' AND value >= 100 AS challenge,
    event_type = 'signup' AND value < 5 AS disallowed,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS crawl_delay
  FROM events),
req AS (SELECT * FROM log WHERE NOT disallowed),
islands AS (
  SELECT *, sum(CASE WHEN status < 400 THEN 1 ELSE 0 END) OVER w AS ok_no,
            sum(CASE WHEN status BETWEEN 200 AND 299 THEN 1 ELSE 0 END) OVER w AS fine_no
  FROM req WINDOW w AS (PARTITION BY host ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
runs AS (
  SELECT *, CAST(sum(CASE WHEN status IS NULL OR status >= 400 OR challenge THEN 1 ELSE 0 END)
              OVER (PARTITION BY host, ok_no ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS error_run,
         sum(CASE WHEN status IN (429, 503) THEN 1 ELSE 0 END)
              OVER (PARTITION BY host, fine_no ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS slow_run
  FROM islands),
steps AS (
  SELECT *, CASE WHEN slow_run = 0 THEN 0.0::DOUBLE WHEN slow_run >= 6 THEN 60.0::DOUBLE
                 ELSE least(60.0::DOUBLE, pow(2.0, slow_run)) END AS backoff,
    coalesce(sum(CASE WHEN error_run >= 3 OR status = 403 THEN 1 ELSE 0 END)
      OVER (PARTITION BY host ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS stopped
  FROM runs)"""


# --- listings -------------------------------------------------------------------------------------------------------

def _website(name: Column, balance: Column) -> Column:
    host = F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("-"))), F.lit(".example.com"))
    return (
        F.when(balance < 0, F.lit("  "))
        .when(balance < 2000, F.concat(host, F.lit("/")))
        .when(balance < 5000, F.concat(F.lit("http://"), host, F.lit("//")))
        .otherwise(F.concat(F.lit(" https://"), host, F.lit("/home/ "))))


def listings(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """``supplier`` or ``customer`` rows as listings of one source."""
    p = source[0]
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, source).join(nation, F.col(f"{p}_nationkey") == F.col("n_nationkey"))
    key = "s_suppkey" if p == "s" else "c_custkey"
    balance = F.col(f"{p}_acctbal")
    return rows.select(
        F.col(key).alias("seq"), F.col(f"{p}_name").alias("name"), F.col("n_name").alias("city"),
        F.when(balance >= 1000, F.col("n_name")).otherwise("").alias("street"),
        F.lit(None).cast("string").alias("phone"), _website(F.col(f"{p}_name"), balance).alias("website"),
        balance.alias("balance"))


def _listing_sql(name: str, tab: str, p: str, key: str) -> str:
    host = f"lower(replace({p}_name, '#', '-')) || '.example.com'"
    return f"""{name} AS (
  SELECT {key} AS seq, {p}_name AS name, n_name AS city,
    CASE WHEN {p}_acctbal >= 1000 THEN n_name ELSE '' END AS street, CAST(NULL AS VARCHAR) AS phone,
    CASE WHEN {p}_acctbal < 0 THEN '  ' WHEN {p}_acctbal < 2000 THEN {host} || '/'
         WHEN {p}_acctbal < 5000 THEN 'http://' || {host} || '//' ELSE ' https://' || {host} || '/home/ ' END AS website,
    {p}_acctbal AS balance
  FROM {tab} JOIN nation ON {p}_nationkey = n_nationkey)"""


SUPPLIERS = _listing_sql("suppliers", "supplier", "s", "s_suppkey")
CUSTOMERS = _listing_sql("customers", "customer", "c", "c_custkey")
NORM_SQL = ("regexp_replace(CASE WHEN starts_with(trim(website), 'http') THEN trim(website) "
            "WHEN trim(website) = '' THEN NULL ELSE 'http://' || trim(website) END, '/+$', '')")


def parts_of(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parts as listings with many copies: (existing, new)."""
    rows = part.select(
        F.col("p_partkey").alias("seq"),
        F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") == 50, None).otherwise(F.col("p_brand")).alias("address"), "p_type")
    known = F.col("p_type") == "ECONOMY"
    return rows.where(known).drop("p_type"), rows.where(~known).drop("p_type")


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return parts_of(table(spark, sf_dir, "part"))


PARTS = """rows AS (
  SELECT p_partkey AS seq, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS name,
    CASE WHEN p_size = 50 THEN NULL ELSE p_brand END AS address, p_type FROM part),
keyed AS (SELECT *, lower(coalesce(name, '')) AS k1, lower(coalesce(address, '')) AS k2 FROM rows),
existing AS (SELECT * FROM keyed WHERE p_type = 'ECONOMY' AND k1 <> '' AND k2 <> ''),
fresh AS (SELECT * FROM keyed WHERE p_type <> 'ECONOMY'),
added AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k1, k2 ORDER BY seq) AS rn FROM fresh) f
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.k1 = f.k1 AND e.k2 = f.k2))"""


# --- detections -----------------------------------------------------------------------------------------------------

def detections_of(orders: DataFrame) -> DataFrame:
    price, day, month = F.col("o_totalprice"), F.dayofmonth("o_orderdate"), F.month("o_orderdate")
    cust = F.col("o_custkey").cast("string")

    def cell(*pairs: tuple[Column, Column]) -> Column:
        return F.concat_ws(";", *[F.when(c, v) for c, v in pairs])

    def url(host: str) -> Column:
        return F.concat(F.lit(f"https://{host}/p/"), cust)

    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(day == 31, "").otherwise(F.concat(F.lit("Practice "), cust)).alias("name"),
        F.concat(F.lit("http://p"), cust, F.lit(".example.com")).alias("website"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("has_online_booking"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("has_online_forms"),
        (price > 250000).alias("has_online_payments"),
        F.when(price < 480000, cell((price < 100000, F.lit(" Alpha ")), (month <= 6, F.lit("beta")),
                                    (day < 4, F.lit("ALPHA")), (day == 5, F.lit(" ")))).alias("third_party_booking_clues"),
        cell((month > 9, F.lit("gamma")), (day > 27, F.lit("delta"))).alias("third_party_forms_clues"),
        F.when(day != 13, cell((price > 400000, F.lit("epsilon")))).alias("third_party_payments_clues"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "alpha").alias("likely_booking_vendor"),
        F.when(F.col("o_orderstatus") != "O", cell(
            (month == 1, F.lit("theta")), (day < 10, F.lit(" Iota")), (day > 20, F.lit("theta ")))).alias("phone_clues_site"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("likely_pms"),
        F.when(price < 100000, 0.25).when(price < 300000, 0.5).otherwise(0.9).alias("pms_confidence"),
        cell((price < 50000, url("book.nexhealth.com")), (day == 7, url("www.localmed.com")),
             (day == 9, url("www.facebook.com")), (month == 2, url("own.example.com"))).alias("booking_urls"),
        cell((price > 450000, url("squareup.com")), (day == 7, url("book.nexhealth.com"))).alias("payment_urls"),
        cell((month == 12, url("form.jotform.com")), (day == 8, url("x.dentrixascend.com"))).alias("forms_urls"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections_of(table(spark, sf_dir, "orders"))


DETECTIONS = """detections AS (
  SELECT o_orderkey AS id,
    CASE WHEN day(o_orderdate) = 31 THEN '' ELSE 'Practice ' || o_custkey END AS name,
    'http://p' || o_custkey || '.example.com' AS website,
    o_orderpriority IN ('1-URGENT', '2-HIGH') AS has_online_booking,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS has_online_forms,
    o_totalprice > 250000 AS has_online_payments,
    CASE WHEN o_totalprice < 480000 THEN concat_ws(';', CASE WHEN o_totalprice < 100000 THEN ' Alpha ' END,
      CASE WHEN month(o_orderdate) <= 6 THEN 'beta' END, CASE WHEN day(o_orderdate) < 4 THEN 'ALPHA' END,
      CASE WHEN day(o_orderdate) = 5 THEN ' ' END) END AS third_party_booking_clues,
    concat_ws(';', CASE WHEN month(o_orderdate) > 9 THEN 'gamma' END,
      CASE WHEN day(o_orderdate) > 27 THEN 'delta' END) AS third_party_forms_clues,
    CASE WHEN day(o_orderdate) <> 13 THEN concat_ws(';', CASE WHEN o_totalprice > 400000 THEN 'epsilon' END) END
      AS third_party_payments_clues,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'alpha' END AS likely_booking_vendor,
    CASE WHEN o_orderstatus <> 'O' THEN concat_ws(';', CASE WHEN month(o_orderdate) = 1 THEN 'theta' END,
      CASE WHEN day(o_orderdate) < 10 THEN ' Iota' END, CASE WHEN day(o_orderdate) > 20 THEN 'theta ' END) END
      AS phone_clues_site,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS likely_pms,
    CASE WHEN o_totalprice < 100000 THEN 0.25::DOUBLE WHEN o_totalprice < 300000 THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END
      AS pms_confidence,
    concat_ws(';', CASE WHEN o_totalprice < 50000 THEN 'https://book.nexhealth.com/p/' || o_custkey END,
      CASE WHEN day(o_orderdate) = 7 THEN 'https://www.localmed.com/p/' || o_custkey END,
      CASE WHEN day(o_orderdate) = 9 THEN 'https://www.facebook.com/p/' || o_custkey END,
      CASE WHEN month(o_orderdate) = 2 THEN 'https://own.example.com/p/' || o_custkey END) AS booking_urls,
    concat_ws(';', CASE WHEN o_totalprice > 450000 THEN 'https://squareup.com/p/' || o_custkey END,
      CASE WHEN day(o_orderdate) = 7 THEN 'https://book.nexhealth.com/p/' || o_custkey END) AS payment_urls,
    concat_ws(';', CASE WHEN month(o_orderdate) = 12 THEN 'https://form.jotform.com/p/' || o_custkey END,
      CASE WHEN day(o_orderdate) = 8 THEN 'https://x.dentrixascend.com/p/' || o_custkey END) AS forms_urls
  FROM orders)"""
PARSE_SQL = "list_filter(list_transform(string_split(coalesce({0}, ''), ';'), lambda x: trim(x)), lambda x: x <> '')"


# --- service URLs ---------------------------------------------------------------------------------------------------

SERVICE_VENDORS = (("spam-farm", "Spam Farm"), ("cheap-pills", None), ("blog.", "Blog Host"), ("www.", "Web Host"))
PORTALS = (("blog.", "kappa"), ("spam-farm", "lambda"), (".example.org", "mu"))


def service_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as service URLs; the language path gives the category and the scheme the run."""
    lang = F.regexp_extract("url", "://[^/]+/([a-z]+)/", 1)
    category = F.when(lang == "en", "booking").when(lang == "fr", "payment").otherwise("forms")
    return table(spark, sf_dir, "pages").select(
        authority(F.col("url")).alias("site"), "url", category.alias("category"),
        F.when(F.col("url").startswith("https"), 1).otherwise(0).alias("run"))


SERVICE_URLS = f"""services AS (
  SELECT {SITE} AS site, url,
    CASE regexp_extract(url, '://[^/]+/([a-z]+)/', 1) WHEN 'en' THEN 'booking' WHEN 'fr' THEN 'payment' ELSE 'forms' END
      AS category,
    CASE WHEN starts_with(url, 'https') THEN 1 ELSE 0 END AS run FROM pages),
named AS (
  SELECT *, CASE WHEN contains(site, 'spam-farm') THEN 'Spam Farm' WHEN contains(site, 'cheap-pills') THEN NULL
    WHEN contains(site, 'blog.') THEN 'Blog Host' WHEN contains(site, 'www.') THEN 'Web Host' ELSE site END AS vendor
  FROM services),
counts AS (
  SELECT category, vendor, count(*)::BIGINT AS n_urls FROM named WHERE vendor IS NOT NULL GROUP BY category, vendor)"""

LINK_RULES = {"booking": ("blog", "/en/"), "payment": ("spam", "pills", "page="), "forms": ("utm", "/fr/")}


def page_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page linking to the page with the next id: ``site, seq, pos, url``."""
    pages = table(spark, sf_dir, "pages")
    target = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("target"))
    return pages.select("page_id", "url").join(target, "page_id").select(
        authority(F.col("url")).alias("site"), F.col("page_id").alias("seq"), F.lit(0).alias("pos"),
        F.col("target").alias("url"))


BARE = "regexp_replace({0}, '^www[.]', '')"
PAGE_GRAPH = f"""links AS (
  SELECT a.site, a.seq, b.url, lower(regexp_extract(b.url, '://([^/?#]*)', 1)) AS host
  FROM (SELECT {SITE} AS site, page_id AS seq FROM pages) a JOIN pages b ON b.page_id = a.seq + 1),
outside AS (
  SELECT site, seq, url FROM links
  WHERE {BARE.format('host')} <> {BARE.format('site')} AND NOT ends_with({BARE.format('host')}, '.' || {BARE.format('site')})),
classed AS (
  SELECT *, 'booking' AS category FROM outside WHERE regexp_matches(lower(url), 'blog|/en/')
  UNION ALL SELECT *, 'payment' FROM outside WHERE regexp_matches(lower(url), 'spam|pills|page=')
  UNION ALL SELECT *, 'forms' FROM outside WHERE regexp_matches(lower(url), 'utm|/fr/'))"""


# --- search hits ----------------------------------------------------------------------------------------------------

SNIPPET_WORDS = (("kappa", ("onbl", "thonwh")), ("lambda", ("tionble",)), ("mu", ("eauxle",)), ("nu", ("schau", "auch")))


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("rank"), F.col("role").alias("name"),
        F.concat(F.lit("https://j.example.org/"), F.col("conv_id").cast("string"), F.lit("/"),
                 F.col("turn").cast("string")).alias("url"),
        F.col("text").alias("snippet"))


SEARCH_HITS = """hits AS (
  SELECT conv_id AS id, turn AS rank, role AS name, 'https://j.example.org/' || conv_id || '/' || turn AS url,
    text AS snippet FROM conversations),
mentions AS (
  SELECT id, rank, url, v.vendor_no, v.vendor, v.vendor || ':JOBS:' || url AS tag
  FROM hits, (VALUES (1, 'kappa', 'onbl', 'thonwh'), (2, 'lambda', 'tionble', 'tionble'), (3, 'mu', 'eauxle', 'eauxle'),
              (4, 'nu', 'schau', 'auch')) v(vendor_no, vendor, w1, w2)
  WHERE contains(lower(snippet), w1) OR contains(lower(snippet), w2)),
clues AS (
  SELECT id, string_agg(tag, ';' ORDER BY n) AS clues, count(DISTINCT vendor) AS n_vendors, min(vendor) AS vendor
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, vendor_no) AS n FROM mentions) WHERE n <= 5
  GROUP BY id)"""


# --- robots ---------------------------------------------------------------------------------------------------------

AGENT = "tallybot/1.0"


def robots_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots text per captured site, by the kind of its name; ``www.`` sites have none."""
    sites = table(spark, sf_dir, "pages").select(authority(F.col("url")).alias("host")).distinct()
    delay = (F.length("host") / 2).cast("string")
    body = (
        F.when(F.col("host").contains("spam-farm"), "User-agent: *\nDisallow: /\ncrawl-delay: 1.2.3\n")
        .when(F.col("host").startswith("blog."), F.concat(
            F.lit("Disallow: /lost/\nUSER-AGENT: TallyBot # ours\nUser-agent: otherbot\nDisallow: /de/ # later\n"
                  "Allow: /\n\nUser-agent: *\nCrawl-delay: "), delay, F.lit("\nDisallow:\n")))
        .otherwise(F.concat(
            F.lit("# rules\nUser-agent: *\nCrawl-Delay: 7\nDisallow: /fr/\nDisallow: /en/2\nAllow: /en/\nAllow: /es/\n"
                  "Crawl-delay :"), delay, F.lit("\n\nDisallow: /lost/\n"))))
    return sites.where(~F.col("host").startswith("www.")).select("host", body.alias("body"))


def robots_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer of every captured site: ``www.`` sites fail (503), ``shop.`` sites refuse (403), the others send their text."""
    sites = table(spark, sf_dir, "pages").select(authority(F.col("url")).alias("host")).distinct()
    status = F.when(F.col("host").startswith("www."), 503).when(F.col("host").startswith("shop."), 403).otherwise(200)
    return sites.join(robots_texts(spark, sf_dir), "host", "left").withColumn("status", status)


ROBOTS = f"""hosts AS (SELECT DISTINCT {SITE} AS host FROM pages),
kinds AS (
  SELECT host, CASE WHEN contains(host, 'spam-farm') THEN 'spam' WHEN starts_with(host, 'blog.') THEN 'blog'
    ELSE 'plain' END AS kind FROM hosts WHERE NOT starts_with(host, 'www.')),
known(kind, group_no, agent, rule_no, allow, prefix) AS (VALUES
  ('spam', 0, '*', 1, false, '/'),
  ('blog', 1, 'tallybot', 3, false, '/de/'), ('blog', 1, 'otherbot', 3, false, '/de/'),
  ('blog', 1, 'tallybot', 4, true, '/'), ('blog', 1, 'otherbot', 4, true, '/'), ('blog', 2, '*', 8, true, ''),
  ('plain', 0, '*', 3, false, '/fr/'), ('plain', 0, '*', 4, false, '/en/2'), ('plain', 0, '*', 5, true, '/en/'),
  ('plain', 0, '*', 6, true, '/es/')),
rules AS (SELECT host, group_no, agent, rule_no, allow, prefix FROM kinds JOIN known USING (kind))"""
