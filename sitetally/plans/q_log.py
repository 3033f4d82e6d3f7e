"""Fetch logs, robots rules, call budgets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cells import status_class
from ..functions.urls import crawl_delay
from ..operators import hostlog, robots
from ..params import SOURCE_1_CALL_CAP, CallBudget
from ..schemas import HOST_REPORT
from ..session import new_path
from ..sources.readers import read_csv
from ..sources.sinks import write_host_report
from . import adapters as A
from .adapters import with_ctes
from .registry import query


@query("status_class", with_ctes(A.LOG) + """
SELECT host, CASE WHEN status IS NULL THEN 'none' WHEN status BETWEEN 200 AND 299 THEN '2xx' WHEN status = 403 THEN '403'
  WHEN status = 429 THEN '429' WHEN status = 503 THEN '503' WHEN status BETWEEN 400 AND 499 THEN 'other_4xx'
  WHEN status >= 400 THEN 'other_error' ELSE 'other' END AS class, count(*)::BIGINT AS n
FROM log GROUP BY ALL""")
def status_classes(spark, sf_dir):
    return A.fetch_log(spark, sf_dir).groupBy("host", status_class(F.col("status")).alias("class")).agg(
        F.count(F.lit(1)).alias("n"))


@query("error_runs", with_ctes(A.LOG) + "SELECT host, seq, error_run, stopped FROM steps")
def error_runs(spark, sf_dir):
    return hostlog.error_runs(A.fetch_log(spark, sf_dir)).select("host", "seq", "error_run", "stopped")


@query("backoff_series", with_ctes(A.LOG) + "SELECT host, seq, backoff FROM steps")
def backoff_series(spark, sf_dir):
    return hostlog.backoff_series(A.fetch_log(spark, sf_dir)).select("host", "seq", "backoff")


@query("politeness_gap", with_ctes(A.LOG) + """,
gaps AS (
  SELECT host, seq, greatest(1.0::DOUBLE, coalesce(crawl_delay, 0), coalesce(lag(backoff) OVER w, 0)) AS required,
    (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6::DOUBLE AS gap
  FROM steps WINDOW w AS (PARTITION BY host ORDER BY ts, seq))
SELECT host, seq, required, gap, coalesce(gap < required, false) AS early FROM gaps""")
def politeness_gap(spark, sf_dir):
    return hostlog.politeness(A.fetch_log(spark, sf_dir)).select("host", "seq", "required", "gap", "early")


REPORT = with_ctes(A.LOG) + """,
made AS (SELECT * FROM steps WHERE NOT stopped),
metrics AS (
  SELECT host, count(*)::BIGINT AS pages_attempted, count_if(status BETWEEN 200 AND 299)::BIGINT AS pages_fetched,
    count_if(status = 403)::BIGINT AS http_403, count_if(status = 429)::BIGINT AS http_429,
    count_if(status = 503)::BIGINT AS http_5xx,
    count_if(status BETWEEN 400 AND 499 AND status NOT IN (403, 429))::BIGINT AS other_4xx,
    count_if(status >= 500 AND status <> 503)::BIGINT AS other_5xx, count_if(status IS NULL)::BIGINT AS no_response,
    count_if(challenge)::BIGINT AS captcha_hits, count_if(status IN (429, 503))::BIGINT AS backoff_events,
    max(backoff) AS backoff_max, arg_max(error_run, (ts, seq)) AS last_run, arg_max(backoff, (ts, seq)) AS last_backoff
  FROM made GROUP BY host),
asides AS (
  SELECT host, count_if(disallowed)::BIGINT AS disallowed_paths, arg_max(crawl_delay, (ts, seq)) AS robots_crawl_delay
  FROM log GROUP BY host)
SELECT a.host, coalesce(pages_attempted, 0) AS pages_attempted, coalesce(pages_fetched, 0) AS pages_fetched,
  coalesce(pages_fetched, 0) AS http_2xx, coalesce(http_403, 0) AS http_403, coalesce(http_429, 0) AS http_429,
  coalesce(http_5xx, 0) AS http_5xx, coalesce(other_4xx, 0) AS other_4xx, coalesce(other_5xx, 0) AS other_5xx,
  coalesce(no_response, 0) AS no_response, coalesce(captcha_hits, 0) AS captcha_hits,
  coalesce(backoff_events, 0) AS backoff_events, disallowed_paths, coalesce(last_run, 0)::BIGINT AS consec_errors_final,
  coalesce(last_backoff, 0)::DOUBLE AS backoff_seconds_final, coalesce(backoff_max, 0)::DOUBLE AS backoff_seconds_max,
  coalesce(pages_attempted, 0) AS pages_count, robots_crawl_delay,
  CASE WHEN robots_crawl_delay IS NOT NULL THEN 'yes' ELSE 'no' END AS robots_cached,
  coalesce(e.urls, '') AS sample_evidence_urls
FROM asides a LEFT JOIN metrics m USING (host) LEFT JOIN (
  SELECT host, string_agg('http://' || host || '/' || seq, ';' ORDER BY n) AS urls FROM (
    SELECT host, seq, row_number() OVER (PARTITION BY host ORDER BY seq) AS n FROM log WHERE challenge) WHERE n <= 5
  GROUP BY host) e USING (host)"""


@query("host_report", REPORT)
def host_report(spark, sf_dir):
    log = A.fetch_log(spark, sf_dir)
    return hostlog.host_report(log, A.evidence_of(log))


@query("sink_host_report", f"""SELECT host, pages_attempted, pages_fetched, http_2xx, http_403, http_429, http_5xx, captcha_hits,
  backoff_events, disallowed_paths, consec_errors_final, backoff_seconds_final, pages_count, robots_crawl_delay, robots_cached,
  nullif(sample_evidence_urls, '') AS sample_evidence_urls FROM ({REPORT})""")
def sink_host_report(spark, sf_dir):
    """Written as the 16-column file and read back by its header."""
    path = new_path(spark, "host-report")
    report = host_report(spark, sf_dir)
    write_host_report(report, path)
    return read_csv(spark, path, StructType([report.schema[c] for c in HOST_REPORT]), required=["host"])


@query("crawl_delay", f"""WITH {A.ROBOTS}
SELECT host, CASE kind WHEN 'spam' THEN NULL ELSE length(host) / 2.0::DOUBLE END AS crawl_delay FROM kinds""")
def crawl_delays(spark, sf_dir):
    return A.robots_texts(spark, sf_dir).select("host", crawl_delay(F.col("body")).alias("crawl_delay"))


@query("robots_rules", f"""WITH {A.ROBOTS}
SELECT host, CAST(group_no AS BIGINT) AS group_no, agent, CAST(rule_no AS BIGINT) AS rule_no, allow, prefix FROM rules""")
def robots_rules(spark, sf_dir):
    return robots.robots_rules(A.robots_texts(spark, sf_dir)).select(
        "host", F.col("group_no").cast("long").alias("group_no"), "agent",
        F.col("rule_no").cast("long").alias("rule_no"), "allow", "prefix")


@query("robots_allowed", f"""WITH {A.ROBOTS},
mine AS (
  SELECT host, rule_no, allow, prefix FROM rules WHERE (agent = 'tallybot' OR (agent = '*' AND host NOT IN (
    SELECT host FROM rules WHERE agent = 'tallybot'))) AND host NOT LIKE 'shop.%'
  UNION ALL SELECT host, 1, false, '/' FROM hosts WHERE host LIKE 'www.%' OR host LIKE 'shop.%'),
urls AS (SELECT page_id, {A.SITE} AS host, regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path FROM pages),
matched AS (
  SELECT u.page_id, arg_min(m.allow, m.rule_no) AS allow, min(m.rule_no) AS rule_no
  FROM urls u JOIN mine m ON m.host = u.host AND starts_with(u.path, m.prefix) GROUP BY u.page_id)
SELECT u.page_id, u.host, CAST(m.rule_no AS BIGINT) AS rule_no, coalesce(m.allow, true) AS allowed
FROM urls u LEFT JOIN matched m USING (page_id)""")
def robots_allowed(spark, sf_dir):
    texts = robots.rules_for_status(A.robots_answers(spark, sf_dir))
    rules = robots.rules_for_agent(robots.robots_rules(texts), A.AGENT)
    urls = A.captures(spark, sf_dir).select(
        F.col("seq").alias("page_id"), F.col("site").alias("host"), F.col("final_url").alias("url"))
    return robots.robots_allowed(urls, rules, "url").select(
        "page_id", "host", F.col("rule_no").cast("long").alias("rule_no"), "allowed")


@query("robots_asof", """
WITH r AS (SELECT 'h' || user_id AS host, ts, event_id AS id FROM events WHERE event_type = 'view'),
s AS (SELECT 'h' || user_id AS host, ts, event_id AS id FROM events WHERE event_type = 'signup')
SELECT r.host, r.id AS request_id, s.id AS snapshot_id, (epoch_us(r.ts) - epoch_us(s.ts)) / 1e6::DOUBLE AS age_seconds,
  coalesce((epoch_us(r.ts) - epoch_us(s.ts)) / 1e6 >= 43200, true) AS needs_refresh
FROM r ASOF LEFT JOIN s ON r.host = s.host AND r.ts >= s.ts""")
def robots_asof(spark, sf_dir):
    log = A.table(spark, sf_dir, "events").select(
        F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("host"), "ts", F.col("event_id").alias("id"),
        "event_type")
    def of(kind):
        return log.where(F.col("event_type") == kind).drop("event_type")
    return robots.robots_asof(of("view"), of("signup"), ttl_seconds=12 * 3600)


def _calls(spark, sf_dir):
    cost = F.when(F.col("o_orderstatus") == "O", "0.02").when(F.col("o_orderstatus") == "P", "0.01").otherwise("0.00")
    return A.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source"), "o_orderdate", "o_orderkey",
        cost.cast("decimal(10,4)").alias("unit_cost"))


CALLS = """calls AS (
  SELECT o_orderstatus AS source, o_orderdate, o_orderkey,
    CAST(CASE o_orderstatus WHEN 'O' THEN 0.02 WHEN 'P' THEN 0.01 ELSE 0.00 END AS DECIMAL(10,4)) AS unit_cost
  FROM orders)"""


@query("budget_cap", f"""WITH {CALLS},
numbered AS (
  SELECT *, row_number() OVER w AS call_no, sum(unit_cost) OVER (w ROWS UNBOUNDED PRECEDING) AS spend,
    CASE source WHEN 'F' THEN 4500 WHEN 'O' THEN 1000 END AS cap
  FROM calls WINDOW w AS (PARTITION BY source ORDER BY o_orderdate, o_orderkey))
SELECT source, o_orderkey, call_no::BIGINT AS call_no, spend::DOUBLE AS spend,
  coalesce(call_no <= cap, true) AS within_cap, coalesce(call_no >= 4000 AND cap IS NOT NULL, false) AS near_cap,
  coalesce(call_no >= cap, false) AS cap_reached
FROM numbered""")
def budget_cap(spark, sf_dir):
    caps = {"F": SOURCE_1_CALL_CAP, "O": CallBudget().cap}
    return hostlog.budget_calls(_calls(spark, sf_dir), caps, ("o_orderdate", "o_orderkey")).select(
        "source", "o_orderkey", "call_no", F.col("spend").cast("double").alias("spend"), "within_cap", "near_cap",
        "cap_reached")


@query("spend_by_source", f"""WITH {CALLS}
SELECT source, count(*)::BIGINT AS calls, sum(unit_cost)::DOUBLE AS cost FROM calls GROUP BY source
UNION ALL SELECT 'total', count(*)::BIGINT, sum(unit_cost)::DOUBLE FROM calls""")
def spend_by_source(spark, sf_dir):
    return hostlog.spend(_calls(spark, sf_dir)).select("source", "calls", F.col("cost").cast("double").alias("cost"))
