"""Fetch logs: error runs, backoff, politeness, metrics per host, call budgets.

A log has one row per request: ``host, ts, seq, status, challenge, disallowed, crawl_delay``, ordered by ``(ts, seq)``
inside a host. ``disallowed`` rows are targets that robots rules kept from being requested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.cells import pct
from .skew import OrderedRows, Stop, latest, micros_of, runs_since

ORDER = ("ts", "seq")


def requests(log: DataFrame) -> DataFrame:
    return log.where(~F.col("disallowed"))


def _made() -> Column:
    return ~F.col("disallowed")


def is_error() -> Column:
    return F.col("status").isNull() | (F.col("status") >= 400)


def error_run_parts() -> tuple[Column, Column]:
    """Failures since the last success. A challenge page resets the run and then counts one."""
    return _made() & ~is_error(), (_made() & (is_error() | F.col("challenge"))).cast("int")


def slow_run_parts() -> tuple[Column, Column]:
    """Answers 429 or 503 since the last 2xx."""
    slow = F.coalesce(_made() & F.col("status").isin(429, 503), F.lit(False))
    return _made() & F.col("status").between(200, 299), slow.cast("int")


def backoff_seconds(slow_run: str = "slow_run") -> Column:
    """Seconds after the row: doubled with each step of the slow run, up to the cap."""
    steps = F.least(F.col(slow_run), F.lit(30).cast("long"))
    doubled = F.pow(F.lit(2.0), steps) * (params.BACKOFF_INITIAL_SECONDS / 2)
    return F.when(F.col(slow_run) > 0, F.least(F.lit(float(params.BACKOFF_CAP_SECONDS)), doubled)).otherwise(0.0)


def _stop() -> Stop:
    """``stopped``: the host was given up before this row, after three failures in a row or a 403."""
    return Stop("stopped", "error_run", params.MAX_ERROR_RUN, _made() & (F.col("status") == 403))


def _with_runs(log: DataFrame, segments: int | None, **runs: tuple[Column, Column]) -> DataFrame:
    """Running runs of each row, and the stop flag, in one pass."""
    return OrderedRows.of(log, ["host"], ORDER, segments).add(runs_since(runs, ["host"], _stop())).rows()


def error_runs(log: DataFrame, segments: int | None = None) -> DataFrame:
    """Every request with its error run and whether the host had been stopped before."""
    return _with_runs(requests(log), segments, error_run=error_run_parts())


def backoff_series(log: DataFrame, segments: int | None = None) -> DataFrame:
    """Every request with the backoff in force after it."""
    rows = OrderedRows.of(requests(log), ["host"], ORDER, segments).add(runs_since({"slow_run": slow_run_parts()}, ["host"]))
    return rows.rows().withColumn("backoff", backoff_seconds()).drop("slow_run")


def politeness(log: DataFrame, base: float = params.DELAY_BASE_SECONDS, segments: int | None = None) -> DataFrame:
    """Delay required before each request against the gap to the request before it.

    Required is the largest of the base delay, the crawl delay and the backoff in force. The first request of a host has
    no gap and is never early.
    """
    timed = requests(log).withColumn("us", micros_of(log, "ts"))
    rows = OrderedRows.of(timed, ["host"], ORDER, segments).add(
        runs_since({"slow_run": slow_run_parts()}, ["host"], before={"slow_before": "slow_run"}), latest({"us_before": F.col("us")}, before=True))
    required = F.greatest(F.lit(base), F.coalesce("crawl_delay", F.lit(0.0)), backoff_seconds("slow_before"))
    gap = (F.col("us") - F.col("us_before")) / F.lit(1e6)
    return rows.rows().withColumns({"required": required, "gap": gap}).withColumn(
        "early", F.coalesce(F.col("gap") < F.col("required"), F.lit(False))).drop(
        "us", "us_before", "slow_before", "slow_run")


def host_report(log: DataFrame, evidence: DataFrame | None = None, apply_stop: bool = True, segments: int | None = None) -> DataFrame:
    """Metrics per host over the requests made until the host was stopped, in one pass over the log.

    ``evidence``: ``host, pos, url``, at most five per host. Beside the older final values there are a true maximum of
    the backoff and counters for what used to be uncounted: other 5xx and no response.
    """
    rows = _with_runs(log, segments, error_run=error_run_parts(), slow_run=slow_run_parts()).withColumn("backoff", backoff_seconds())
    made = _made() & ~F.col("stopped") if apply_stop else _made()
    s = F.when(made, F.col("status"))
    last = F.max(F.when(made, F.struct(*ORDER, "error_run", "backoff")))
    # targets that were not requested count and tell the delay, and leave runs, backoff and stop as they are
    out = rows.groupBy("host").agg(
        F.count_if(made).alias("pages_attempted"),
        F.count_if(s.between(200, 299)).alias("pages_fetched"),
        F.count_if(s == 403).alias("http_403"),
        F.count_if(s == 429).alias("http_429"),
        F.count_if(s == 503).alias("http_5xx"),
        F.count_if(s.between(400, 499) & ~s.isin(403, 429)).alias("other_4xx"),
        F.count_if((s >= 500) & (s != 503)).alias("other_5xx"),
        F.count_if(made & F.col("status").isNull()).alias("no_response"),
        F.count_if(made & F.col("challenge")).alias("captcha_hits"),
        F.count_if(s.isin(429, 503)).alias("backoff_events"),
        F.count_if("disallowed").alias("disallowed_paths"),
        F.max_by("crawl_delay", F.when(F.col("crawl_delay").isNotNull(), F.struct(*ORDER))).alias("robots_crawl_delay"),
        F.max(F.when(made, F.col("backoff"))).alias("backoff_max"),
        last.alias("last"))
    if evidence is not None:
        cells = evidence.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("e"))
        out = out.join(cells.select("host", F.concat_ws(";", F.transform("e", lambda x: x["url"])).alias("urls")), "host", "left")
    else:
        out = out.withColumn("urls", F.lit(""))
    none = F.lit(0).cast("long")
    return out.select(
        "host", "pages_attempted", "pages_fetched", F.col("pages_fetched").alias("http_2xx"), "http_403", "http_429",
        "http_5xx", "other_4xx", "other_5xx", "no_response", "captcha_hits", "backoff_events", "disallowed_paths",
        F.coalesce("last.error_run", none).alias("consec_errors_final"),
        F.coalesce("last.backoff", F.lit(0.0)).alias("backoff_seconds_final"),
        F.coalesce("backoff_max", F.lit(0.0)).alias("backoff_seconds_max"),
        F.col("pages_attempted").alias("pages_count"),
        "robots_crawl_delay",
        F.when(F.col("robots_crawl_delay").isNotNull(), "yes").otherwise("no").alias("robots_cached"),
        F.coalesce("urls", F.lit("")).alias("sample_evidence_urls"))


def host_states(log: DataFrame, segments: int | None = None) -> DataFrame:
    """Counters, final run and backoff, and whether the host was stopped: what the stream keeps per host, from a whole log."""
    runs = _with_runs(requests(log), segments, error_run=error_run_parts(), slow_run=slow_run_parts())
    made = runs.where(~F.col("stopped")).withColumn("backoff", backoff_seconds())
    at, s = F.struct(*ORDER), F.col("status")
    stop = (F.col("error_run") >= params.MAX_ERROR_RUN) | F.coalesce(s == 403, F.lit(False))
    return made.groupBy("host").agg(
        F.count("*").alias("pages_attempted"), F.count_if(s.between(200, 299)).alias("pages_fetched"),
        F.count_if("challenge").alias("captcha_hits"), F.max_by("error_run", at).alias("consec_errors_final"),
        F.max_by("backoff", at).alias("backoff_seconds_final"), F.bool_or(stop).alias("stopped"))


def run_totals(detections: DataFrame) -> DataFrame:
    """Rows attempted, kept and failed, and the failure rate. Needs a boolean ``success``."""
    n, ok = F.count(F.lit(1)), F.count_if("success")
    return detections.agg(n.alias("attempted"), ok.alias("success"), (n - ok).alias("failed")).withColumn(
        "fail_rate", F.lit(100.0) * F.col("failed") / F.greatest(F.col("attempted"), F.lit(1)))


def alert(totals: DataFrame, threshold_pct: float = params.FAIL_ALERT_PCT) -> DataFrame:
    """The totals row if the failure rate has reached the threshold, else nothing."""
    return totals.where(F.col("fail_rate") >= F.lit(threshold_pct)).withColumns({
        "threshold": F.lit(threshold_pct),
        "message": F.format_string(
            "%.2f%% of the sites failed; the limit is %.1f%%", F.col("fail_rate"), F.lit(threshold_pct))})


def progress_marks(rows: DataFrame, order: tuple[str, ...], every: int = params.PROGRESS_EVERY, segments: int | None = None) -> DataFrame:
    """Running totals at every ``every``-th row. Needs a boolean ``success``."""
    one = F.lit(1).cast("long")
    ordered = OrderedRows.of(rows.select(F.lit(0).alias("all"), "success", *order), ["all"], order, segments)
    ordered = ordered.running_sum({"attempted": one, "succeeded": F.col("success").cast("long")})
    marks = ordered.rows().where(F.col("attempted") % every == 0)
    total = rows.agg(F.count(F.lit(1))).scalar()
    return marks.select("attempted", "succeeded", (F.col("attempted") - F.col("succeeded")).alias("failed"),
                        pct(F.col("attempted"), total).alias("pct_done"))


def budget_calls(calls: DataFrame, caps: dict[str, int], order: tuple[str, ...],
                 warn_at: int = params.SOURCE_1_WARN_AT, segments: int | None = None) -> DataFrame:
    """Every call with its running number and spend in its source, and whether the cap still allows it.

    ``caps`` by source; a source without a cap is unlimited.
    """
    cap = F.lit(None).cast("long")
    for source, n in caps.items():
        cap = F.when(F.col("source") == source, F.lit(n).cast("long")).otherwise(cap)
    rows = OrderedRows.of(calls, ["source"], order, segments)
    rows = rows.running_sum({"call_no": F.lit(1).cast("long"), "spend": F.col("unit_cost")}).rows()
    return rows.withColumns({
        "within_cap": F.coalesce(F.col("call_no") <= cap, F.lit(True)),
        "near_cap": F.coalesce(cap.isNotNull() & (F.col("call_no") >= warn_at), F.lit(False)),
        "cap_reached": F.coalesce(F.col("call_no") >= cap, F.lit(False))})


def spend(calls: DataFrame) -> DataFrame:
    """Calls and cost per source, and in total."""
    costs = calls.groupBy("source", "unit_cost").agg(F.count(F.lit(1)).alias("calls")).withColumn(
        "cost", (F.col("calls") * F.col("unit_cost")))
    per = costs.groupBy("source").agg(F.sum("calls").alias("calls"), F.sum("cost").alias("cost"))
    both = costs.agg(F.sum("calls").alias("calls"), F.sum("cost").alias("cost")).withColumn("source", F.lit("total"))
    return per.unionByName(both)


