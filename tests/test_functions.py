"""Scalar functions on literal tables, against the standard library where it has the same function."""

from __future__ import annotations

import html
import random
import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitetally.dictionaries.fixed import CHALLENGE_MARKERS, LINK_PATTERNS
from sitetally.functions import cells, urls
from sitetally.functions.html import is_challenge, page_links, page_text, unescape
from sitetally.functions.literals import fold_text, required_literals
from sitetally.operators.patterns import link_categories
from sitetally.operators.vendors import vendor_from_url
from sitetally.sources.dictionary import production_patterns


def column(spark, values, fn, dtype="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def test_norm_url(spark):
    cases = {" a.com/ ": "http://a.com", "https://x//": "https://x", "": None, "   ": None, None: None,
             "httpbin.org": "httpbin.org", "http://": "http:", "ftp://x/": "http://ftp://x"}
    assert column(spark, list(cases), urls.norm_url) == list(cases.values())


BASES = ["http://h.com", "https://H.com/a/b", "http://h.com/a/b/?q=1#f", "http://h.com?x=/y", "http://u:p@h.com:80/a#b/c"]
HREFS = ["", "/x", "/x?y", "z", "z/w", "?q=2", "#top", "//o.com/p", "https://o.com/p/../q", "mailto:a@b.c", "a:b",
         "../c", "./d", "../../x", "/a/../b", "..", ".", "a/./b?x=../y", "a/b/../../../e#../f", "x..y/.z"]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url(spark, base):
    got = column(spark, HREFS, lambda h: urls.resolve_url(F.lit(base), h))
    want = [urljoin(base, h) for h in HREFS]
    # the library drops the fragment of the base for an empty link only when it has to join; both name the same page
    for g, w, h in zip(got, want, HREFS):
        if h == "":
            g, w = g.split("#")[0], w.split("#")[0]
        if not h.startswith(("https:", "mailto:")):
            assert g == w, (base, h)


def test_authority(spark):
    cases = ["http://A.com:8080/x", "https://u@h_x.com?q|r", "//h/x", "/x", "mailto:a@b", "x", "http://", None]
    assert column(spark, cases, urls.authority) == [
        (urlparse(c).netloc.lower() or None) if c is not None else None for c in cases]


def test_targets(spark):
    from sitetally.dictionaries.fixed import TARGET_PATHS
    for base in ("http://h.com", "https://h.com/a/b"):
        got = column(spark, [base], urls.target_urls)[0]
        assert got == [urljoin(base, p) for p in TARGET_PATHS] and len(got) == 12


def test_external(spark):
    links = ["http://www.a.com/x", "https://b.a.com", "http://nota.com", "HTTP://x.com", "/x", "http://x.com/?a.com"]
    assert column(spark, links, lambda c: urls.is_external(c, F.lit("a.com"))) == [False, False, True, False, False, True]
    assert column(spark, links, lambda c: urls.is_external(c, F.lit("a.com"), "substring")) == [
        False, False, False, False, False, True]
    assert column(spark, links, lambda c: urls.is_external(c, F.lit("www.a.com"), "substring"))[1] is True
    assert column(spark, links, lambda c: urls.is_external(c, F.lit("www.a.com")))[1] is False


def test_crawl_delay(spark):
    cases = {"Crawl-delay: 5\nCRAWL-DELAY :2.5": 2.5, "x": None, "crawl-delay: 3\ncrawl-delay: 1.2.3": None,
             "crawl-delay:\n7": None, "crawl-delay: x\ncrawl-delay: 4": 4.0, None: None}
    assert column(spark, list(cases), urls.crawl_delay) == list(cases.values())


def test_vendor_from_url(spark):
    cases = {"https://app.NexHealth.com/x": "NexHealth", "https://www.facebook.com/square": None,
             "http://squareup.com": "Square", "http://own.org:81/zocdoc": "own.org:81", "/x": None, None: None,
             "http://getweave.zocdoc.com": "Zocdoc"}
    assert column(spark, list(cases), vendor_from_url) == list(cases.values())


def test_link_categories(spark):
    cases = ["https://x.com/Book", "https://facebook.com/payments", "https://x.com/platform", "https://x.com/"]
    want = [[c for c, ps in LINK_PATTERNS.items() if any(re.search(p, u.lower()) for p in ps)] for u in cases]
    assert column(spark, cases, link_categories) == want == [["booking"], ["booking", "payment"], ["forms"], []]


def test_cells(spark):
    assert column(spark, [" a; b;;c ", "", None, ";"], cells.parse_list) == [["a", "b", "c"], [], [], []]
    row = spark.range(1).select(
        cells.join_list(F.array(*[F.lit(x) for x in "abcdef"]), 5), cells.address(F.lit("1 St"), F.lit(""), F.lit(None), F.lit("TX")),
        cells.pct(F.lit(1), F.lit(0)), cells.pct(F.lit(1), F.lit(3)),
        cells.search_query(F.lit("n" * 90), ("Open Dental", "Dentrix", "Practice-Web"), 80)).collect()[0]
    assert tuple(row) == ("a;b;c;d;e", "1 St, TX", 100.0, 33.33,
                          f'"{"n" * 80}" ("Open Dental" OR Dentrix OR "Practice-Web")')


def test_status_class(spark):
    cases = {None: "none", 200: "2xx", 204: "2xx", 301: "other", 403: "403", 404: "other_4xx", 429: "429", 500: "other_error", 503: "503"}
    assert column(spark, list(cases), cells.status_class, "int") == list(cases.values())


def test_links(spark):
    page = """<A class=x HREF=" /a?b=1&amp;c=2 ">1</A><a href='mailto:x@y'>m</a><a data-href="no" href=/c>3</a>
      <a name="x">none</a><a
      href="d e">4</a><area href="/no"><a href="/a?b=1&amp;c=2">again</a>"""
    assert column(spark, [page], page_links)[0] == ["/a?b=1&c=2", "/c", "d e", "/a?b=1&c=2"]


def test_links_as_a_parser_sees_them(spark):
    """Expected values by hand."""
    cases = {
        '<!-- <a href="https://old.example/book">x</a> --><a href="/a">y</a>': ["/a"],
        """<script>document.write('<a href="https://js.example/pay">')</script><a href=/b>y</a>""": ["/b"],
        '<a title="a>b" href="/ok">y</a>': ["/ok"],
        """<a data-x='href="/no"' href='/yes?a=1&amp;b=2'>y</a>""": ["/yes?a=1&b=2"],
        '<a title="see href=/no" href="/c">y</a><abbr href="/no">z</abbr><a-b href="/no">': ["/c"],
        '<a href="/first" href="/second">y</a><a href>empty</a>': ["/first", ""],
        '<a href="/d&rarr;&iacute;">y</a><!-- open <a href="/no">': ["/d→í"],
    }
    got = column(spark, list(cases), page_links)
    assert [[x for x in g if x] for g in got] == [[x for x in w if x] for w in cases.values()]


def test_text_as_a_parser_sees_it(spark):
    cases = {
        '<p>x</p><a title="a>b" href="/ok">y</a>': "x y",
        "A &rarr; B &iacute; &ZeroWidthSpace;&NotEqualTilde;&hearts;": "a → b í ​≂̸♥",
        "<style>p{content:'>'}</style>a<!-- x > y -->b<script src='a>b'>if(1>0)x</script>c": "a b c",
        "<p title='it > that'>in</p> &amp;lt; &AMP;": "in &lt; &",
    }
    assert [" ".join(t.split()) for t in column(spark, list(cases), page_text)] == list(cases.values())


PIECES = [
    "<p>", "</p>", "<p class=it's>", "<a href=/it's>", "<a href='/q?a=1&amp;b=2'>", '<a HREF="/b>c">', "</a>", "<b>", "</b >", "<br/>", "<br />",
    "text ", "it's ", "5 < 6 ", "a<3 ", "&amp;", "&eacute;", "&copy", "&copy2", "&#233;", "&#x2014;", "&#150;", "&nope;", "& ", "&", "&#65 ",
    "<a title=x href=/y/>", "<a href=>", "<a href>", "<a\nhref = /sp ace>", "<a =x href=/eq>", "<a/href=/sl>", "<a x='y'href='/glued'>",
    "<a href=\"/u\"title='t>t'>", "<a href==/dbl>", "<A data-href=/no href=/yes>", "<abbr href=/no>", "<!-- c <a href=/no> -->", "<!DOCTYPE html>",
    "<?php x ?>", "</ x>", "</>", "<a-b href=/no>", "<script>if(a<b) '<a href=/no>'</script>", "<style>p>a{}</style>", "<SCRIPT type='x'>y</SCRIPT >",
    "<div id=\"a'b\" class='c\"d'>", "<i/>", "< b>", "<a href='mailto:x@y'>", "<a href=' /pad\n'>", '<img alt="<b>">', '"', "'", "=", ">", "\n",
    "<p a=b'c\"d>", "&lt;b&gt;", "&ampx", "<a href=/r&amp=1&lt>", "é😀 "]


class Reader(HTMLParser):
    """Links and visible text of a page, with one space for all the markup between two texts."""

    def __init__(self):
        super().__init__()
        self.links, self.parts, self.hidden = [], [], False

    def handle_starttag(self, tag, attrs):
        self.parts.append(None)
        self.hidden = self.hidden or tag in ("script", "style")
        href = [(v or "").strip(" \t\n\r\f\x0b") for k, v in attrs if k == "href"][:1] if tag == "a" else []
        self.links += [h for h in href if not h.startswith("mailto:")]

    def handle_endtag(self, tag):
        self.parts.append(None)
        self.hidden = False

    def handle_other(self, _):
        self.parts.append(None)

    handle_comment = handle_decl = handle_pi = handle_other

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)

    def text(self):
        kept = [" " if p is None else p for i, p in enumerate(self.parts) if p is not None or i == 0 or self.parts[i - 1] is not None]
        return " ".join("".join(kept).lower().split())


def test_broken_pages_read_like_the_standard_library(spark):
    """Quotes in unquoted values, glued and empty attributes, stray signs, references without an end, in any order."""
    dice = random.Random(11)
    pages = ["".join(dice.choice(PIECES) for _ in range(dice.randrange(1, 30))) + " end<p>" for _ in range(1500)]
    links, texts = column(spark, pages, page_links), column(spark, pages, page_text)
    for page, own, text in zip(pages, links, texts, strict=True):
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert (own, " ".join(text.split())) == (reader.links, reader.text()), page


def test_a_quote_that_never_closes_makes_no_tag(spark):
    pages = ['<p>a <a href="/x>b</a> <i>c</i>', "<a href=/ok>x</a><p title='y>z"]
    assert column(spark, pages, page_links) == [[], ["/ok"]]
    assert [" ".join(t.split()) for t in column(spark, pages, page_text)] == ['a <a href="/x>b c', "x <p title='y>z"]


def test_long_tags_do_not_exhaust_the_stack(spark):
    page = "<a " + " ".join(f"d{i}='{i}>'" for i in range(20_000)) + ' href="/x">t</a><p class="' + "y" * 200_000 + '">u</p>'
    assert column(spark, [page], page_links) == [["/x"]]
    assert " ".join(column(spark, [page], page_text)[0].split()) == "t u"


def test_text(spark):
    page = """<!DOCTYPE html><head><title>T &amp; U</title><script>if (a < b) x("</p>")</script><style>p{}</style></head>
<p>Book <b>Online</b><!-- not > this --> 5 < 6</p><i>now</i><i>!</i> &eacute;&#233;&#xE9;&nope; caf&eacute;"""
    text = column(spark, [page], page_text)[0]
    assert " ".join(text.split()) == "t & u book online 5 < 6 now ! ééé&nope; café"
    assert "<i>now</i><i>!</i>" in page and "now !" in text  # one space for the markup between two text nodes


def test_unescape(spark):
    cases = ["a&lt;b&gt;&quot;&apos;", "&amp;lt;", "&#65;&#x42;&#0;&#x110000;", "&copy;&hellip;", "x & y", "&nbsp;", None]
    want = [None if c is None else html.unescape(c) for c in cases]
    want[2] = "AB&#0;&#x110000;"  # invalid code points stay
    assert column(spark, cases, unescape) == want


def test_challenge(spark):
    cases = {"<p>Please solve this CAPTCHA": True, "Are You Human?": True, "fine": False, "": False, None: False}
    assert column(spark, list(cases), lambda c: is_challenge(c, CHALLENGE_MARKERS)) == list(cases.values())


WORDS = sorted({w for p in production_patterns() for w in re.findall(r"[A-Za-z0-9.]+", p.regex)})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(WORDS), st.sampled_from([" ", "  ", "-", ".", "/", "ſ", "İ", "ı", "\n"]),
                          st.text(max_size=3)), max_size=12))
def test_literals_lose_no_match(words):
    text = "".join(words)
    for variant in (text, text.upper(), text.swapcase()):
        folded = fold_text(variant)
        for p in production_patterns():
            need = required_literals(p.regex)
            if need is not None and re.search(p.regex, variant, re.I):
                assert any(x in folded for x in need), (p.regex, variant)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ΟΔΣσςßſKéÉabcİı", min_size=3, max_size=6), st.text(alphabet="ΟΔΣσςßſKéÉabcİı ", max_size=12))
def test_literals_of_any_alphabet_lose_no_match(pattern, text):
    need = required_literals(pattern)
    for variant in (text + pattern, pattern + text, (text + pattern + "α").upper()):
        if need is not None and re.search(pattern, variant, re.I):
            assert any(x in fold_text(variant) for x in need)
    assert need is None or pattern.isascii()


def test_literals():
    assert required_literals("ΟΔΟΣ") is None
    assert required_literals(r"a\.com/b|cd\s*efg") == ["a.com/b", "efg"]
    assert required_literals(r"\b(book online|request (an )?appointment)\b") == ["appointment", "book online"]
    assert required_literals(r"(abc)?d") is None
    assert required_literals(r"abcd?") == ["abc"]
    assert required_literals(r"[abc]+") is None
    assert required_literals(r"(?=abc)x") is None
    assert required_literals(r"abc{2}de") is None
    assert required_literals(r"abcd{2}e") == ["abc"]
    assert all(required_literals(p.regex) for p in production_patterns())
