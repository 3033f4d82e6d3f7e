"""Robots, enrichment, listings, budgets, sinks, streams, published figures."""

from __future__ import annotations

import datetime
import random
from collections import Counter
from decimal import Decimal
from urllib.robotparser import RobotFileParser

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from sitetally.functions.cells import pct
from sitetally.operators import enrich, hostlog, listings, robots, summary, vendors
from sitetally.params import CallBudget
from sitetally.plans import adapters as A
from sitetally.session import new_path
from sitetally.sources import readers, sinks
from sitetally.streaming import hosts
from sitetally.streaming.runs import drain_batches, drain_to_files, epoch_writer, first_listings_writer, logged_keys, read_stream, totals_writer

TEXTS = {
    "one": "User-agent: *\nDisallow: /a\nAllow: /a/b\n",
    "two": "# c\nUser-agent: TallyBot\nUser-agent: x\nDisallow: /t/ # why\n\nUser-agent: *\nDisallow: /",
    "gap": "User-agent: *\n\nDisallow: /a\n",
    "late": "Disallow: /a\nUser-agent: *\nDisallow: /c\nUser-agent: tallybot\nAllow: /c/d\nDisallow: /c\nSitemap: /s",
    "open": "User-agent: *\nDisallow:\nDisallow: /a",
    "delay": "User-agent: tallybot\nCrawl-delay: 3\n\nUser-agent: *\nDisallow: /",
    "star": "User-agent: *\nDisallow: *\n",
    "crlf": "User-Agent:*\r\nDISALLOW:/t\r\n\r\n",
    "quoted": "User-agent: *\nDisallow: /a%20b\nDisallow: /c+d\nDisallow: /%7Ex\nDisallow: /100%",
    "empty": "",
}
PATHS = ["/", "/a", "/a/b", "/a/b?q", "/t/x", "/t", "/c/d", "/c/e", "", "/a b", "/a%20b/c", "/c+d", "/c%2Bd", "/~x", "/100%", "*"]


def test_robots_like_the_standard_parser(spark):
    texts = spark.createDataFrame(list(TEXTS.items()), "host string, body string")
    urls = spark.createDataFrame(
        [(f"{h}{i}", h, f"http://{h}{p}") for h in (*TEXTS, "unknown") for i, p in enumerate(PATHS)],
        "id string, host string, url string")
    mine = robots.rules_for_agent(robots.robots_rules(texts), "tallybot/1.0")
    got = {(r.host, r.url): r.allowed for r in robots.robots_allowed(urls, mine, "url").collect()}
    for host, text in TEXTS.items():
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        for p in PATHS:
            assert got[host, f"http://{host}{p}"] == parser.can_fetch("tallybot/1.0", f"http://{host}{p}"), (host, p)
        assert got["unknown", "http://unknown/a"] is True


def test_robots_status(spark):
    rows = spark.createDataFrame(
        [("ok", 200, "User-agent: *\nDisallow: /x"), ("no", 403, ""), ("gone", 404, "?"), ("down", 500, ""), ("dead", None, "")],
        "host string, status int, body string")
    for strict, denied in ((True, {"no", "down", "dead"}), (False, {"no"})):
        mine = robots.rules_for_agent(robots.robots_rules(robots.rules_for_status(rows, strict)), "any")
        urls = rows.select("host", F.lit("http://h/y").alias("url"))
        got = {r.host for r in robots.robots_allowed(urls, mine, "url").where("not allowed").collect()}
        assert got == denied


def _log(spark, statuses, challenge=()):
    rows = [("h", i, i, s, i in challenge, False, None) for i, s in enumerate(statuses)]
    return spark.createDataFrame(
        rows, "host string, ts long, seq long, status int, challenge boolean, disallowed boolean, crawl_delay double")


def test_error_runs_and_backoff(spark):
    log = _log(spark, [200, 404, None, 200, 200, 503, 429, 404, 429, 200], challenge={4})
    runs = {r.seq: (r.error_run, r.stopped) for r in hostlog.error_runs(log).collect()}
    assert [runs[i][0] for i in range(10)] == [0, 1, 2, 0, 1, 2, 3, 4, 5, 0]
    assert [runs[i][1] for i in range(10)] == [False] * 7 + [True] * 3
    wait = {r.seq: r.backoff for r in hostlog.backoff_series(log).collect()}
    assert [wait[i] for i in range(10)] == [0, 0, 0, 0, 0, 2, 4, 4, 8, 0]
    long = {r.seq: r.backoff for r in hostlog.backoff_series(_log(spark, [429] * 8)).collect()}
    assert [long[i] for i in range(8)] == [2, 4, 8, 16, 32, 60, 60, 60]
    challenges = hostlog.error_runs(_log(spark, [200] * 5, challenge=set(range(5))))
    assert {(r.error_run, r.stopped) for r in challenges.collect()} == {(1, False)}
    blocked = hostlog.host_report(_log(spark, [200, 403, 200, 200])).collect()[0]
    assert (blocked.pages_attempted, blocked.http_403, blocked.consec_errors_final) == (2, 1, 1)


def test_host_report_details(spark):
    rows = [("h", 1, 1, 200, True, False, None), ("h", 2, 2, None, False, True, 2.5), ("h", 3, 3, 503, False, False, None),
            ("h", 4, 4, 500, False, False, None), ("g", 1, 9, None, False, True, None)]
    log = spark.createDataFrame(rows, _log(spark, []).schema)
    evidence = spark.createDataFrame([("h", 2, "u2"), ("h", 1, "u1")], "host string, pos long, url string")
    got = {r.host: r for r in hostlog.host_report(log, evidence).collect()}
    h, g = got["h"], got["g"]
    assert (h.pages_attempted, h.http_2xx, h.http_5xx, h.other_5xx, h.captcha_hits, h.disallowed_paths) == (3, 1, 1, 1, 1, 1)
    assert (h.consec_errors_final, h.backoff_seconds_final, h.backoff_seconds_max) == (3, 2.0, 2.0)
    assert (h.robots_crawl_delay, h.robots_cached, h.sample_evidence_urls) == (2.5, "yes", "u1;u2")
    assert (g.pages_attempted, g.disallowed_paths, g.consec_errors_final, g.sample_evidence_urls) == (0, 1, 0, "")


def test_alert(spark):
    rows = spark.createDataFrame([(i >= 15,) for i in range(100)], "success boolean")
    totals = hostlog.run_totals(rows)
    assert totals.collect()[0].fail_rate == 15.0
    assert hostlog.alert(totals).count() == 1 and hostlog.alert(totals, 15.01).count() == 0


def test_budget():
    assert CallBudget(hard_cap=10**6).cap == 4500  # exact decimals
    assert CallBudget().cap == 1000 and CallBudget(budget=Decimal(0)).cap == 0
    assert CallBudget(unit_cost=Decimal(0)).cap == 1000 and CallBudget(reserve_pct=Decimal(120)).cap == 0


def test_job_clues(spark):
    hits = spark.createDataFrame(
        [(1, 0, "u;1", "We use OPEN DENTAL and more"), (1, 1, "u2", "open dental again"), (2, 0, "a", "Dentrix, curvehero"),
         (3, 0, "b", "nothing"), (4, 0, None, "practice-web"), (5, 0, "n", "dolphin")],
        "id long, rank long, url string, snippet string")
    clues = enrich.job_clues(enrich.snippet_vendors(hits))
    found = spark.createDataFrame(
        [(1, "A", "unknown", 0.0), (2, "B", "dentrix", 0.5), (3, "C", None, None), (4, "D", "x", 0.9), (5, " ", "x", 0.1)],
        "id long, name string, likely_pms string, pms_confidence double")
    got = {r.id: (r.pms_clues_jobs, r.likely_pms, r.pms_confidence) for r in enrich.enrich(found, clues).collect()}
    assert got[1] == (["open_dental:JOBS:u;1", "open_dental:JOBS:u2"], "open_dental", 0.8)
    assert got[2] == (["dentrix:JOBS:a", "curve_dental:JOBS:a"], "dentrix", 0.5)
    assert got[3] == ([], "unknown", 0.0)
    assert got[4] == (["practice_web:JOBS:"], "practice_web", 0.9)
    assert got[5] == ([], "x", 0.1)
    many = spark.createDataFrame([(1, i, f"u{i}", "dentrix" if i < 5 else "dolphin") for i in range(9)], hits.schema)
    assert [(len(r.pms_clues_jobs), r.agreed) for r in enrich.job_clues(enrich.snippet_vendors(many)).collect()] == [(5, "dentrix")]


def test_job_mentions(spark):
    texts = spark.createDataFrame([(1, "Open Dental, dentrixes"), (2, "EAGLESOFT. Dentrix")], "id long, text string")
    assert sorted(r.tag for r in enrich.job_mentions(texts).collect()) == [
        "dentrix:JOBS:mention", "eaglesoft:JOBS:mention", "open_dental:JOBS:mention"]


def test_dedup_is_idempotent(spark):
    existing, new = A.parts(spark, SF_DIR)
    once = listings.dedup_listings(existing, new, ["seq"]).cache()
    again = listings.dedup_listings(once.where("prio = 0").drop("prio"), once.where("prio = 1").drop("prio"), ["seq"])
    assert once.exceptAll(again).count() == 0 == again.exceptAll(once).count()
    single = listings.dedup_listings(existing, new, ["seq"], dedup_existing=True)
    keys = single.select(*listings.dedup_key())
    assert keys.count() == keys.distinct().count()


def test_new_rows_without_key_are_kept_once(spark):
    new = spark.createDataFrame([(1, "", ""), (2, None, ""), (3, "A", "b"), (4, "a", "B")], "seq long, name string, address string")
    old = spark.createDataFrame([(9, "x", None), (8, "x", "y"), (7, "X", "Y")], new.schema)
    assert sorted(r.seq for r in listings.dedup_listings(old, new, ["seq"]).collect()) == [1, 3, 7, 8]


def test_seeds(spark):
    path = new_path(spark, "seeds")
    spark.createDataFrame([("﻿city",), (" Bonn ",), ("",), ("Bonn",), ("Köln",)], "v string").coalesce(1).write.text(path)
    assert sorted(r.city for r in readers.read_seeds(spark, path).collect()) == ["Bonn", "Köln"]


def test_sinks_refuse_to_overwrite_and_resume(spark):
    path = new_path(spark, "resume")
    df = spark.range(10).select("id", F.lit("a;b").alias("cell"))
    sinks.append_new(df.where("id < 4"), path, "id")
    sinks.append_new(df, path, "id")
    sinks.append_new(df, path, "id")
    assert sorted(r.id for r in readers.read_csv(spark, path, df.schema).collect()) == list(range(10))
    with pytest.raises(Exception):
        sinks.write_csv(df, path)


def test_missing_keys_are_appended_once(spark):
    path = new_path(spark, "resume")
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "id long, cell string")
    for _ in range(3):
        sinks.append_new(df, path, "id")
    assert sorted(r.cell for r in readers.read_csv(spark, path, df.schema).collect()) == ["a", "b", "c"]


def test_columns_by_name(spark):
    path = new_path(spark, "listings")
    lines = ["address,name,id,more", '"1 Main St, X",Ann,7,?', ",Bob,no number,?"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    got = [tuple(r) for r in readers.read_listings(spark, path, line_breaks=False).select("id", "name", "website", "address").collect()]
    assert got == [(7, "Ann", None, "1 Main St, X"), (None, "Bob", None, None)]
    with pytest.raises(ValueError, match="no column city"):
        readers.read_seeds(spark, path)


def test_practice_list_round_trip(spark):
    path = new_path(spark, "practices")
    rows = [(1, 'A "B", C', " http://x ", None, "1\nMain", "s"), (2, "D", None, "5", None, "t")]
    df = spark.createDataFrame(rows, "id long, name string, website string, phone string, address string, source string")
    sinks.write_practices(df, path)
    assert sorted(tuple(r) for r in readers.read_listings(spark, path).collect()) == rows


def test_two_robots_texts_of_a_host(spark):
    texts = spark.createDataFrame([("h", 1, "User-agent: a\nDisallow: /x\n"), ("h", 2, "User-agent: b\nDisallow: /y%0Az\n")],
                                  "host string, snapshot int, body string")
    got = sorted((r.snapshot, r.agent, r.rule_no, r.allow, r.prefix) for r in robots.robots_rules(texts).collect())
    assert got == [(1, "a", 1, False, "/x"), (2, "b", 1, False, "/y\nz")]
    plan = robots.robots_rules(texts)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_percentages_sum_to_100(spark):
    d = A.detections(spark, SF_DIR)
    n = summary.pms_distribution(d).count()
    total = summary.pms_distribution(d).agg(F.sum("pct")).collect()[0][0]
    assert abs(total - 100) <= 0.01 * n


def test_published_figures(spark):
    """Percentages of the published counts, and a market share from its counts."""
    cases = [(701, 2617, 26.79), (848, 2617, 32.4), (297, 2617, 11.35), (527, 701, 75.18), (293, 848, 34.55),
             (768, 839, 91.54), (83, 270, 30.74), (73, 270, 27.04), (57, 270, 21.11)]
    rows = spark.createDataFrame([(n, d) for n, d, _ in cases], "n long, d long")
    assert [r[0] for r in rows.select(pct(F.col("n"), F.col("d"))).collect()] == [c[2] for c in cases]
    counts = {"n1": 77, "n2": 64, "n3": 55, "n4": 49, "n5": 20, "n6": 11, "rest1": 10, "rest2": 8}
    counts["rest3"] = 527 - sum(counts.values())
    many = {**counts, **{f"tail{i}": 1 for i in range(counts.pop("rest3"))}}
    many.pop("rest3", None)
    df = spark.createDataFrame([("booking", v, n) for v, n in many.items()], "category string, vendor string, n_urls long")
    share = {r.vendor: r.share_pct for r in vendors.market_share(df, 6).collect()}
    assert [share[f"n{i}"] for i in range(1, 7)] == [14.6, 12.1, 10.4, 9.3, 3.8, 2.1] and share["Others"] == 47.6


def _arrive(df, path, order, parts):
    """The rows in ``parts`` files, in order of time."""
    n = df.count()
    rows = df.orderBy(*order).coalesce(1).withColumn("_n", F.monotonically_increasing_id()).cache()
    for i in range(parts):
        rows.where(F.col("_n").between(i * n // parts, (i + 1) * n // parts - 1)).drop("_n").coalesce(1).write.mode("append").parquet(path)


def test_host_state_over_many_batches(spark):
    path, folder = new_path(spark, "events"), new_path(spark, "state")
    events = A.table(spark, SF_DIR, "events")
    _arrive(events, path, ["ts", "event_id"], 5)
    log = A.fetch_log_of(read_stream(spark, path, events.schema, 1))
    drain_batches(log, hosts.cell_writer(folder), new_path(spark, "state-checkpoint"), "append")
    assert spark.read.parquet(f"{folder}/cells").select("epoch").distinct().count() == 5
    want = {r.host: r for r in hostlog.host_report(A.fetch_log_of(events)).collect() if r.pages_attempted}
    got = {r.host: r for r in hosts.host_states(spark, folder).collect()}
    assert set(got) == set(want) and all(r.late_rows == 0 for r in got.values())
    for h, r in got.items():
        w = want[h]
        assert (r.pages_attempted, r.pages_fetched, r.captcha_hits, r.consec_errors_final, r.backoff_seconds_final) == (
            w.pages_attempted, w.pages_fetched, w.captcha_hits, w.consec_errors_final, w.backoff_seconds_final)


def test_late_rows_of_a_host_are_not_lost(spark):
    """Interleaved times in two files give the batch result."""
    path, folder = new_path(spark, "log"), new_path(spark, "state")
    log = spark.range(100).select(
        F.lit("h").alias("host"), F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.col("id").alias("seq"),
        F.when(F.col("id") % 4 == 3, 503).otherwise(200).cast("int").alias("status"), F.lit(False).alias("challenge"),
        F.lit(False).alias("disallowed"), F.lit(None).cast("double").alias("crawl_delay"))
    for part in (log.where("seq % 2 = 0"), log.where("seq % 2 = 1")):
        part.coalesce(1).write.mode("append").parquet(path)
        drain_batches(read_stream(spark, path, log.schema, 1), hosts.cell_writer(folder), folder + "-checkpoint", "append")
    got = hosts.host_states(spark, folder).collect()
    want = hostlog.host_report(log).collect()[0]
    assert len(got) == 1 and got[0].late_rows == 49
    assert (got[0].pages_attempted, got[0].consec_errors_final, got[0].backoff_seconds_final) == (
        want.pages_attempted, want.consec_errors_final, want.backoff_seconds_final) and want.pages_attempted == 100


def test_states_do_not_depend_on_the_order_of_arrival(spark):
    """Runs, stops and backoff over cells that are filled in any order, some batches twice; a batch reads its own cells only."""
    dice = random.Random(8)
    rows = []
    for i in range(400):
        host = dice.choice(["a", "b", "c", None, "d"])
        status = dice.choices([200, 204, 404, 503, 429, 403, None, 302], [60, 5, 12, 8, 6, 1 if host in ("a", "c") else 0, 6, 4])[0]
        rows.append((host, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=dice.randrange(2000)), i, status, dice.random() < 0.1,
                     dice.random() < 0.05))
    log = spark.createDataFrame(rows, "host string, ts timestamp, seq long, status int, challenge boolean, disallowed boolean").cache()
    want = {tuple(sorted(r.asDict().items(), key=str)) for r in hostlog.host_states(log).collect()}
    for seed in (1, 2):
        folder, write = new_path(spark, "state"), None
        write = hosts.cell_writer(folder, cell_seconds=300)
        lots = log.withColumn("lot", F.pmod(F.xxhash64("seq", F.lit(seed)), F.lit(4)))
        for epoch in range(4):
            for _ in range(2 if epoch == seed else 1):
                write(lots.where(F.col("lot") == epoch).drop("lot"), epoch)
        states = hosts.host_states(spark, folder)
        got = {tuple(sorted(r.asDict().items(), key=str)) for r in states.drop("late_rows").collect()}
        assert got == want
        seen, late = {}, Counter()
        for epoch in range(4):
            batch = [(h, (ts, seq)) for h, ts, seq, _, _, gone in rows if not gone and (h, seq) in {
                (r.host, r.seq) for r in lots.where(F.col("lot") == epoch).select("host", "seq").collect()}]
            for h, at in batch:
                late[h] += h in seen and at <= seen[h]
            for h, at in batch:
                seen[h] = max(seen.get(h, at), at)
        assert {r.host: r.late_rows for r in states.collect()} == {h: late[h] for h in seen}
        first = spark.read.parquet(f"{folder}/rows").agg(F.min("cell")).head()[0]
        files = hosts.stored_rows(spark, folder, [first]).inputFiles()
        assert files and all(f"cell={first}/" in f for f in files)
    assert hosts.host_states(spark, new_path(spark, "nothing")) is None


def test_first_listings_over_many_batches(spark):
    path, out = new_path(spark, "parts"), new_path(spark, "added")
    part = A.table(spark, SF_DIR, "part")
    _arrive(part, path, ["p_partkey"], 4)
    existing, new = A.parts(spark, SF_DIR)
    _, arriving = A.parts_of(read_stream(spark, path, part.schema, 1))
    drain_batches(arriving, first_listings_writer(existing, out, ["seq"]), new_path(spark, "added-checkpoint"), "append")
    got = sorted(r.seq for r in spark.read.parquet(out).collect())
    assert got == sorted(r.seq for r in listings.new_listings(existing, new, ["seq"]).collect())


def test_a_failed_batch_is_done_again_once(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("parts", "out", "checkpoint"))
    part = A.table(spark, SF_DIR, "part")
    _arrive(part, path, ["p_partkey"], 3)
    write, calls = epoch_writer(out), []

    def failing(batch, epoch):
        calls.append(epoch)
        write(batch, epoch)
        if calls.count(1) == 1 and epoch == 1:
            raise RuntimeError("lost in the middle")

    for attempt in range(2):
        try:
            drain_batches(read_stream(spark, path, part.schema, 1), failing, checkpoint, "append")
        except Exception:
            assert attempt == 0
    assert calls.count(0) == 1 and calls.count(1) == 2 and calls.count(2) == 1
    assert sorted(r.p_partkey for r in spark.read.parquet(out).collect()) == sorted(r.p_partkey for r in part.collect())


def test_files_are_read_once_across_restarts(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("parts", "out", "checkpoint"))
    part = A.table(spark, SF_DIR, "part")
    for _ in range(2):
        _arrive(part, path, ["p_partkey"], 2)
        drain_to_files(read_stream(spark, path, part.schema, 1), out, checkpoint)
        drain_to_files(read_stream(spark, path, part.schema, 1), out, checkpoint)
    assert spark.read.parquet(out).count() == 2 * part.count()


def test_a_batch_reads_the_buckets_of_its_keys_only(spark):
    """Keys seen before are found again in their buckets; other buckets and the rows written before are not read."""
    out = new_path(spark, "added")
    kind = "seq long, name string, address string"
    existing = spark.createDataFrame([(1, "Old", "Street 1")], kind)
    write = first_listings_writer(existing, out, ["seq"], buckets=16)
    lots = [[(i, f"N{i % 30}", "x") for i in range(50)] + [(99, "old", "street 1"), (98, None, None)], [(200, "n7", "X"), (201, "New", "y"), (202, None, "")],
            [], [(300, "new", "Y"), (301, "N31", "x")]]
    for epoch, lot in enumerate(lots):
        for _ in range(2 if epoch in (0, 3) else 1):  # a repeated batch leaves the same
            write(spark.createDataFrame(lot, kind), epoch)
    got = {(r.epoch, r.seq) for r in spark.read.parquet(out).collect()}
    assert got == {(0, i) for i in range(30)} | {(0, 98), (1, 201), (3, 301)}
    some = logged_keys(spark, f"{out}-keys", [3]).inputFiles()
    assert all("_bucket=3/" in f for f in some) and len(some) <= 2
    assert logged_keys(spark, f"{out}-keys", list(range(16))).count() == len(got)


def test_rows_without_a_key_are_appended_once_each(spark):
    out = new_path(spark, "resumed")
    rows = [("a", 1, "x"), (None, 2, "y"), ("b", None, None)]
    for more in ([], [(None, 3, "y"), (None, 2, "y"), ("a", 9, "z")], [(None, None, None)], [(None, None, None)]):
        rows = rows if not more else more
        sinks.append_new(spark.createDataFrame(rows, "k string, n int, t string"), out, "k")
    got = sorted(tuple(r) for r in readers.read_csv(spark, out, spark.createDataFrame([], "k string, n int, t string").schema).fillna(
        {"k": "-", "n": 0, "t": "-"}).collect())
    assert got == [("-", 0, "-"), ("-", 2, "y"), ("-", 3, "y"), ("a", 1, "x"), ("b", 0, "-")]


def test_rules_of_large_hosts_are_joined_by_prefix(spark):
    """Thousands of rules on one host, equal prefixes among them: the first one that starts the path decides, as in a list."""
    dice = random.Random(4)
    rules = [("big", [(i, dice.random() < 0.5, "/" + "".join(dice.choice("abé") for _ in range(dice.randrange(9)))) for i in range(3000)]),
             ("small", [(0, False, "/a"), (1, True, "/")]), ("none", []), (None, [(0, False, "/")])]
    rules[0] = ("big", [r for r in rules[0][1] if r[2] != "/"])
    kind = "host string, rules array<struct<rule_no: int, allow: boolean, prefix: string>>"
    urls = [(h, f"http://{h}/" + "".join(dice.choice("abéz") for _ in range(dice.randrange(12)))) for h in ("big", "small", "none", "other") for _ in range(150)]
    urls += urls[:40] + [("big", None), (None, "http://x/a"), ("big", "http://big")]
    data, table = spark.createDataFrame(urls, "host string, url string"), spark.createDataFrame(rules, kind)

    def got(many):
        return sorted(map(repr, robots.robots_allowed(data, table, "url", many).select("host", "url", "rule_no", "allowed").collect()))
    assert got(10) == got(10_000) and len(got(10)) == len(urls)
    by = {(r.host, r.url): r for r in robots.robots_allowed(data, table, "url", 10).collect()}
    for host, url in urls:
        if host == "big" and url:
            path = url.removeprefix("http://big")
            first = next((r for r in rules[0][1] if path.startswith(r[2])), None)
            assert (by[host, url].rule_no, by[host, url].allowed) == ((first[0], first[1]) if first else (None, True))


def test_the_alert_is_there_before_the_next_batch(spark):
    """Failures begin in the second of three files; the totals pass the limit there and fall below it again."""
    path, out, alerts = (new_path(spark, n) for n in ("log", "totals", "alerts"))
    lots = [[True] * 10, [False] * 5, [True] * 40]
    write, seen = totals_writer(out, alerts, 15.0), []

    def watched(batch, epoch):
        if epoch:
            seen.append(spark.read.parquet(f"{alerts}/epoch={epoch - 1}").count())
        write(batch, epoch)

    for lot in lots:
        spark.createDataFrame([(x,) for x in lot], "success boolean").coalesce(1).write.mode("append").parquet(path)
        log = read_stream(spark, path, spark.createDataFrame([], "success boolean").schema, 1)
        drain_batches(hostlog.run_totals(log), watched, out + "-checkpoint", "complete")
    assert seen == [0, 1]
    rows = spark.read.parquet(alerts).collect()
    assert [(r.epoch, r.attempted, r.failed) for r in rows] == [(1, 15, 5)] and "33.33%" in rows[0].message
