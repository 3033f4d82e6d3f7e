"""Streams over the test tables, drained to the end; the results equal the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hostlog, patterns
from ..session import new_path
from ..streaming import hosts
from ..streaming.runs import drain_batches, drain_to_files, first_listings_writer, read_stream, totals_writer
from . import adapters as A
from .adapters import with_ctes
from .registry import ORACLE, query


def _stream(spark, sf_dir, name):
    # the pattern fits a single file as well as a folder of files
    return read_stream(spark, f"{sf_dir}/{name}.parquet*", A.table(spark, sf_dir, name).schema)


def _hits(pages):
    return patterns.page_hits(A.captures_of(pages), A.fixture_patterns()).select(
        "site", "seq", F.col("prio").cast("long").alias("prio"), "category", "strength", "vendor",
        F.col("section").cast("long").alias("section"), "hit")


@query("stream_page_hits", ORACLE["pattern_hits"])
def stream_page_hits(spark, sf_dir):
    out = new_path(spark, "hits")
    hits = _hits(_stream(spark, sf_dir, "pages"))
    drain_to_files(hits, out, new_path(spark, "hits-checkpoint"))
    return spark.read.schema(hits.schema).parquet(out)


@query("stream_resume", ORACLE["pattern_hits"])
def stream_resume(spark, sf_dir):
    """Pages arrive in two lots; the stream is stopped in between and started again from its checkpoint."""
    pages = A.table(spark, sf_dir, "pages")
    arrivals, out, checkpoint = (new_path(spark, n) for n in ("arrivals", "hits", "hits-checkpoint"))
    secure = F.coalesce(F.col("url").startswith("https"), F.lit(False))
    for lot in (pages.where(secure), pages.where(~secure)):
        lot.write.mode("append").parquet(arrivals)
        drain_to_files(_hits(read_stream(spark, arrivals, pages.schema)), out, checkpoint)
    return spark.read.schema(_hits(pages).schema).parquet(out)


@query("stream_host_state", with_ctes(A.LOG) + """,
made AS (SELECT * FROM steps WHERE NOT stopped),
seen AS (SELECT host, ts, seq, coalesce(status = 200, false) AS early,
  row_number() OVER (PARTITION BY host, coalesce(status = 200, false) ORDER BY ts DESC, seq DESC) AS n FROM req),
late AS (
  SELECT r.host, count(*)::BIGINT AS n FROM seen r JOIN seen l ON l.host = r.host AND l.early AND l.n = 1
  WHERE NOT r.early AND (r.ts, r.seq) <= (l.ts, l.seq) GROUP BY r.host)
SELECT m.host, count(*)::BIGINT AS pages_attempted, count(*) FILTER (status BETWEEN 200 AND 299)::BIGINT AS pages_fetched,
  count_if(challenge)::BIGINT AS captcha_hits, arg_max(error_run, (ts, seq)) AS consec_errors_final,
  arg_max(backoff, (ts, seq)) AS backoff_seconds_final, bool_or(error_run >= 3 OR coalesce(status = 403, false)) AS stopped,
  coalesce(any_value(late.n), 0) AS late_rows
FROM made m LEFT JOIN late ON late.host = m.host GROUP BY m.host""")
def stream_host_state(spark, sf_dir):
    """The good answers arrive first, in several files; all others, of any time, arrive afterwards."""
    log = A.fetch_log(spark, sf_dir)
    arrivals, folder, checkpoint = (new_path(spark, n) for n in ("log", "hosts", "hosts-checkpoint"))
    good = F.coalesce(F.col("status") == 200, F.lit(False))
    for lot in (log.where(good), log.where(~good)):
        lot.repartition(3, "seq").write.mode("append").parquet(arrivals)
        drain_batches(read_stream(spark, arrivals, log.schema), hosts.cell_writer(folder), checkpoint, "append")
    return hosts.host_states(spark, folder)


@query("stream_totals", with_ctes(A.LOG) + """
SELECT count(*)::BIGINT AS attempted, count_if(coalesce(status < 400, false))::BIGINT AS success,
  count_if(NOT coalesce(status < 400, false))::BIGINT AS failed,
  100.0::DOUBLE * count_if(NOT coalesce(status < 400, false)) / count(*) AS fail_rate, true AS alert FROM req""")
def stream_totals(spark, sf_dir):
    out, alerts = new_path(spark, "totals"), new_path(spark, "alerts")
    log = hostlog.requests(A.fetch_log_of(_stream(spark, sf_dir, "events")))
    totals = hostlog.run_totals(log.withColumn("success", F.coalesce(F.col("status") < 400, F.lit(False))))
    drain_batches(totals, totals_writer(out, alerts), new_path(spark, "totals-checkpoint"), "complete")
    rows = spark.read.parquet(out)
    last = rows.agg(F.max("epoch")).scalar()
    alerted = spark.read.parquet(alerts).select("epoch", F.lit(True).alias("alert"))
    return rows.where(F.col("epoch") == last).join(alerted, "epoch", "left").drop("epoch").withColumn("alert", F.coalesce("alert", F.lit(False)))


@query("stream_dedup", with_ctes(A.PARTS) + "SELECT seq, name, address FROM added")
def stream_dedup(spark, sf_dir):
    """The first listing of every key that is neither among the existing ones nor came before."""
    out = new_path(spark, "added")
    existing, _ = A.parts(spark, sf_dir)
    _, new = A.parts_of(_stream(spark, sf_dir, "part"))
    drain_batches(new, first_listings_writer(existing, out, ["seq"]), new_path(spark, "added-checkpoint"), "append")
    return spark.read.parquet(out).select("seq", "name", "address")
