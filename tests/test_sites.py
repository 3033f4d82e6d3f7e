"""Detection with the production dictionary against a direct reading of the rules, page by page."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sitetally.dictionaries.fixed import CHALLENGE_MARKERS, EVIDENCE_PATTERN
from sitetally.operators import patterns, sites
from sitetally.sources.dictionary import Pattern, load_patterns, patterns_table, production_patterns

PAGES = [
    ("a.com", 1, 200, '<p>Welcome. <b>Book</b> <i>online</i> with <a href="https://book.nexhealth.com/x">NexHealth</a></p>'),
    ("a.com", 2, 200, '<a href="https://www.facebook.com/x">f</a><a href="/pay">Pay your bill</a> Square and square'),
    ("a.com", 3, 503, "Dentrix"),
    ("a.com", 4, 200, "<p>Open&nbsp;Dental, Web Sched, curvehero, Dentrix &amp; Eaglesoft</p> <a href='https://x.patientviewer.com/f'>f</a>"),
    ("b.com", 5, 200, "<p>cloudflare: verify. We use Weave.</p>"),
    ("b.com", 6, 200, "<p>Call us via RingCentral or 8x8.</p><a href='http://www.b.com/form'>own</a>"),
    ("c.com", 7, None, "Dolphin"),
    ("d.com", 8, 200, "Dentri&#120; and gravity<b>forms</b>, paper<i>less</i> forms, DOLPHIN IMAGING dolphin imaging"),
    ("d.com", 9, 200, "STRIPE strİpe; dolphin ımaging"),
]


@pytest.fixture(scope="module")
def captures(spark):
    rows = [(s, q, st, f"http://{s}/{q}", "text/html", h) for s, q, st, h in PAGES]
    return spark.createDataFrame(rows, "site string, seq long, status int, final_url string, content_type string, html string")


@pytest.fixture(scope="module")
def dictionary():
    return production_patterns()


def brute_hits(spark, captures, dictionary):
    """First match per site and pattern over html, links and text, by Java's regular expressions on each page alone."""
    out = {}
    sections = {(r.site, r.seq, r.section): r.body for r in patterns.page_sections(captures).collect()}
    for p in dictionary:
        for site, seq, section in sorted(sections, key=lambda k: (k[2], k[1])):
            body = sections[site, seq, section]
            found = re.search(p.regex, body, re.I)
            if found:
                out.setdefault((site, p.prio), (section, seq, found.group()))
    return out


def test_site_hits(spark, captures, dictionary):
    hits = sites.site_hits(patterns.page_hits(captures, dictionary)).collect()
    got = {(h.site, h.prio): (h.section, h.seq, h.hit) for h in hits}
    want = brute_hits(spark, captures, dictionary)
    assert got == want and len(want) > 15


def large_dictionary(copies: int):
    """The production patterns, and as many times with other words: pieces that begin or hold one another, and some without any."""
    own = list(production_patterns())
    more = [Pattern(1000 * c + p.prio, p.category, p.strength, f"{p.vendor}{c}", p.regex.replace("e", "e" + "xq"[c % 2], 1) + (r"\d?" if c % 3 else ""))
            for c in range(1, copies) for p in own]
    odd = ["zq", "zqx", "zqxlong", "qx[0-9]+", "x{2}", r"\bab\b", r"(?:dolphin|zqx)\.com", "long zqx", "ﬁnd", r"patients?\.x"]
    return own + more + [Pattern(900_000 + i, "other", None, None, rx) for i, rx in enumerate(odd)]


def test_index_gives_what_all_patterns_give(spark):
    """Also where a reference stands for a character of a pattern, with or without regard to case."""
    dice = random.Random(3)
    words = ["zqxlong", "zqx", "zq ", "qx7", "xx", " ab ", "dolphin.com", "dolphin&period;com", "dolphin&#46;com", "long <b>zqx</b>", "LONG ZQX", "ﬁnd",
             "Dentri&#120;", "dolph&imath;n imaging", "strİpe", "<a href='https://x.patientviewer.com/f&sol;g'>", "patient&#x2e;x", "weave", "&amp;", "\n"]
    pages = [("s", i, "".join(dice.choice(words) for _ in range(dice.randrange(8)))) for i in range(120)]
    data = spark.createDataFrame(pages, "site string, seq long, html string")
    dictionary = large_dictionary(3)
    index = patterns.dictionary_index(dictionary)
    assert len(index.patterns) > 3 * 46 and {p.regex for p in index.rest} >= {"x{2}", r"\bab\b", "ﬁnd"}
    got = {(h.seq, h.prio): (h.section, h.hit) for h in patterns.page_hits(data, dictionary).collect()}
    want = {}
    sections = {(r.seq, r.section): r.body for r in patterns.page_sections(data).collect()}
    for (seq, section), body in sorted(sections.items(), key=lambda k: k[0][1]):
        for p in dictionary:
            if found := re.search(p.regex, body, re.I):
                want.setdefault((seq, p.prio), (section, found.group()))
    assert got == want and len(want) > 200


def test_features(captures, dictionary):
    rows = {r.site: r for r in sites.site_features(captures, dictionary).collect()}
    assert set(rows) == {"a.com", "b.com", "c.com", "d.com"}
    a, b, c, d = (rows[f"{x}.com"] for x in "abcd")
    assert (a.final_url, a.http_status) == ("http://a.com/1", 200)
    assert (a.has_online_booking, a.has_online_forms, a.has_online_payments) == (True, False, True)
    assert a.third_party_booking_clues == ["nexhealth"] and a.likely_booking_vendor == "nexhealth"
    assert a.third_party_payments_clues == ["Square"]
    assert a.booking_urls == ["https://book.nexhealth.com/x", "https://www.facebook.com/x"]
    assert a.evidence_urls == ["http://a.com/2", "http://a.com/4"]
    assert a.pms_clues_site[:2] == ["open_dental:STRONG:patientviewer.com", "open_dental:STRONG:Web Sched"]
    # open_dental 5+5, curve_dental 5, dentrix 1, eaglesoft 1; the no-break space keeps "Open Dental" apart
    assert (a.likely_pms, a.pms_confidence) == ("open_dental", round(10 / 17, 3))
    assert (b.http_status, b.final_url) == (200, "http://b.com/5")  # a challenge page counts as the first answer
    assert b.phone_clues_site == ["RingCentral", "8x8"] and b.booking_urls == [] == b.forms_urls
    assert (c.final_url, c.http_status, c.likely_pms, c.pms_confidence) == (None, None, "unknown", 0.0)
    assert d.has_online_forms is False and d.third_party_payments_clues == ["STRIPE"]
    assert d.pms_clues_site[0].startswith("dolphin:STRONG:") and "dentrix:WEAK:dentrix" in d.pms_clues_site


def test_features_agree_with_single_steps(captures, dictionary):
    pages = sites.usable(captures, CHALLENGE_MARKERS)
    hits = sites.site_hits(patterns.page_hits(pages, dictionary))
    rows = {r.site: r for r in sites.site_features(captures, dictionary).collect()}
    known = captures.select("site").distinct()
    for r in sites.software_guess(known, sites.software_scores(hits), dictionary).collect():
        assert (rows[r.site].likely_pms, rows[r.site].pms_confidence) == (r.likely_pms, r.pms_confidence)
    for r in sites.site_flags(known, hits).collect():
        assert (rows[r.site].has_online_booking, rows[r.site].has_online_forms, rows[r.site].has_online_payments) == (
            r.has_booking, r.has_forms, r.has_payments)
    for r in patterns.evidence_pages(pages, EVIDENCE_PATTERN).groupBy("site").agg(F.count("*").alias("n")).collect():
        assert len(rows[r.site].evidence_urls) == r.n


def test_service_links_agree_with_features(captures, dictionary):
    links = patterns.exploded_links(sites.usable(captures))
    got = {(r.site, r.category, r.url) for r in patterns.distinct_service_links(patterns.service_links(links)).collect()}
    want = {(r.site, c, u) for r in sites.site_features(captures, dictionary).collect()
            for c in ("booking", "payment", "forms") for u in r[f"{c}_urls"]}
    assert got == want and len(want) == 2


def test_evidence_is_complete(spark, dictionary):
    """Twenty evidence pages give twenty URLs in the site's row and in the written file."""
    from sitetally.session import new_path
    from sitetally.sources import readers, sinks
    pages = [("h.com", i, 200, f"http://h.com/{i % 20}", "text/html", '<a href="/privacy">x</a> online booking dentrix') for i in range(25)]
    captures = spark.createDataFrame(pages, "site string, seq long, status int, final_url string, content_type string, html string")
    features = sites.site_features(captures, dictionary, evidence="booking")
    want = [f"http://h.com/{i}" for i in range(20)]
    assert features.collect()[0].evidence_urls == want
    practices = spark.createDataFrame([(1, "A", "h.com")], "id long, name string, website string")
    path = new_path(spark, "found")
    sinks.write_detections_csv(sites.detections(practices, features), path)
    assert readers.read_detections(spark, path).collect()[0].evidence_urls == ";".join(want)


def test_a_new_pattern_removes_no_hit(captures, dictionary):
    fewer = [p for p in dictionary if p.category != "forms"]
    some = {(r.site, r.prio) for r in patterns.page_hits(captures, fewer).collect()}
    assert some <= {(r.site, r.prio) for r in patterns.page_hits(captures, dictionary).collect()}


def test_detections(spark, captures, dictionary):
    practices = spark.createDataFrame(
        [(1, "A", " a.com/ "), (2, "A2", "https://A.com"), (3, "None", "  "), (4, "C", "c.com"), (5, "Z", "z.com")],
        "id long, name string, website string")
    found = sites.with_success(sites.detections(practices, sites.site_features(captures, dictionary)))
    got = {r.id: (r.website, r.success, r.likely_pms) for r in found.collect()}
    assert got == {1: ("http://a.com", True, "open_dental"), 2: ("https://A.com", True, "open_dental"),
                   4: ("http://c.com", False, "unknown"), 5: ("http://z.com", False, "unknown")}


def test_guess_ties_go_to_the_earlier_vendor(spark, dictionary):
    page = [("t", 1, 200, "u", "text/html", "Dolphin and Denticon and Dentrix")]
    captures = spark.createDataFrame(page, "site string, seq long, status int, final_url string, content_type string, html string")
    row = sites.site_features(captures, dictionary).collect()[0]
    assert (row.likely_pms, row.pms_confidence) == ("dentrix", 0.333)


def test_dictionary(spark, tmp_path, dictionary):
    assert len([p for p in dictionary if not p.category.startswith("intent")]) == 43
    assert [p.prio for p in dictionary] == list(range(1, len(dictionary) + 1))
    assert patterns_table(spark, dictionary).where("category = 'pms'").select("vendor").distinct().count() == 7
    from sitetally.sources.dictionary import DICTIONARIES
    three = load_patterns(DICTIONARIES / "production.yaml", vendors=["open_dental", "dentrix", "eaglesoft"])
    assert {p.vendor for p in three if p.category == "pms"} == {"open_dental", "dentrix", "eaglesoft"}
    (tmp_path / "d.json").write_text('{"booking": ["x|y"], "strong": {"v": ["z"]}}')
    assert [tuple(p) for p in load_patterns(tmp_path / "d.json")] == [
        (1, "booking", None, None, "x|y"), (2, "pms", "strong", "v", "z")]


def test_evidence_sample(spark):
    rows = [("h", i, f"u{i // 2}") for i in range(10)] + [("g", 1, "x")]
    df = spark.createDataFrame(rows, "site string, seq long, final_url string")
    got = sorted((r.host, r.pos, r.url) for r in sites.evidence_sample(df).collect())
    assert got == [("g", 1, "x"), ("h", 1, "u0"), ("h", 2, "u1")]
