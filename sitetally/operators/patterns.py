"""Matching page sections against the pattern dictionary.

The dictionary is compiled into one narrow projection: an index of rare pieces of the patterns' literals, looked for in one
scan of the page, tells which patterns can match at all, and only their regular expressions run. So the work on a page does
not grow with the dictionary. The page body is dropped right after; nothing is joined and no body is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries.fixed import EVIDENCE_PATTERN, LINK_PATTERNS
from ..functions.cells import once
from ..functions.html import page_links, strip_markup, unescape
from ..functions.literals import anchors, coded, fold, index_pattern, may_match, required_literals
from ..functions.urls import authority, is_external
from ..sources.dictionary import Pattern

FLAGS = "(?iU)"  # Unicode-aware \b, \s and case folding
SECTIONS = ("html", "joined", "text")
FEW = 24  # pieces that are looked for one by one; more are looked for together, in one scan


def with_sections(captures: DataFrame) -> DataFrame:
    """Adds ``links`` (array), ``joined`` (one per line) and ``text`` to the page bodies, in steps that are kept apart."""
    stripped = captures.withColumns({"links": page_links(F.col("html")), "text": strip_markup(F.col("html"))})
    return stripped.withColumns({"joined": F.array_join("links", "\n"), "text": F.lower(unescape(F.col("text")))})


def page_sections(captures: DataFrame) -> DataFrame:
    """One row per page and section, in the order in which sections are searched."""
    bodies = F.array(*[
        F.struct(F.lit(i).alias("section"), F.col(s).alias("body")) for i, s in enumerate(SECTIONS)])
    return with_sections(captures).select("site", "seq", F.inline(bodies))


class Index(NamedTuple):
    """The dictionary by rare pieces of its patterns' literals; ``rest`` are the patterns that have none."""

    patterns: list[Pattern]
    rest: list[Pattern]
    #: piece -> numbers of the patterns (from 0) that may match where it is
    of: dict[str, list[int]]


def dictionary_index(patterns: Sequence[Pattern]) -> Index:
    index = Index([], [], {})
    for p in patterns:
        pieces = anchors(p.regex)
        if pieces is None:
            index.rest.append(p)
            continue
        for piece in pieces:
            index.of.setdefault(piece, []).append(len(index.patterns))
        index.patterns.append(p)
    # The index finds the longest piece at a place, so a piece stands for those that it begins with, too.
    shorter = {w: [n for k in range(1, len(w) + 1) for n in index.of.get(w[:k], ())] for w in index.of}
    return index._replace(of={w: sorted(set(ns)) for w, ns in shorter.items()})


def with_candidates(pages: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """Adds what :func:`matches` needs: folded sections, and the patterns (by place in the index) that may match the page.

    The page source is scanned once for all pieces; the other sections only where a reference may hide a piece in them.
    """
    pages = pages.withColumns({f"folded_{s}": fold(F.col(s)) for s in SECTIONS})
    index = dictionary_index(patterns)
    if not index.patterns:
        return pages.withColumn("candidates", F.array().cast("array<int>"))
    folded = [F.col(f"folded_{s}") for s in SECTIONS]
    scanned = F.when(coded(F.col("html")), F.concat_ws("\n", *folded)).otherwise(folded[0])
    if len(index.of) <= FEW:
        found = once(scanned, lambda page: F.filter(F.lit(list(index.of)), lambda piece: F.contains(page, piece)))
    else:
        found = F.array_distinct(F.regexp_extract_all(scanned, F.lit(index_pattern(list(index.of))), F.lit(1)))
    known = F.map_from_arrays(F.lit(list(index.of)), F.array(*[F.lit(ns) for ns in index.of.values()]))
    return pages.withColumn("candidates", F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda w: known[w])))))


def found_in(section: str, regex: str) -> Column:
    """Does a section match? The regular expression runs only where the literal text any match needs is present."""
    match = F.col(section).rlike(FLAGS + regex)
    possible = may_match(F.col(f"folded_{section}"), regex)
    return match if possible is None else possible & match


def _first_match(p: Pattern) -> Column:
    """Section number and matched text of the first section that matches, as one string; NULL without a match."""
    return F.coalesce(*[
        F.when(found_in(s, p.regex), F.concat(F.lit(str(i)), F.regexp_extract(s, FLAGS + p.regex, 0)))
        for i, s in enumerate(SECTIONS)])


def _candidate_matches(patterns: list[Pattern]) -> Column:
    """``(prio, found)`` of the candidates that match; each is tried on a section only if none before it matched."""
    prios, regexes = F.lit([p.prio for p in patterns]), F.lit([FLAGS + p.regex for p in patterns])
    literals = F.array(*[F.lit(required_literals(p.regex)) for p in patterns])

    def tried_in(i: int, number: Column) -> Column:
        """The match in a section; the expression runs only where one of the literals that any match needs is present."""
        folded, regex = F.col(f"folded_{SECTIONS[i]}"), F.get(regexes, number)
        possible = F.exists(F.get(literals, number), lambda x: F.contains(folded, x))
        found = F.when(possible, F.call_function("regexp_extract", F.col(SECTIONS[i]), regex, F.lit(0))).otherwise("")
        return F.struct(number.alias("number"), F.lit(str(i)).alias("section"), found.alias("hit"))

    def later(i: int):
        return lambda x: F.when(x["hit"] != "", x).otherwise(tried_in(i, x["number"]))

    tried = F.transform("candidates", lambda number: tried_in(0, number))
    for i in range(1, len(SECTIONS)):
        tried = F.transform(tried, later(i))
    return F.transform(F.filter(tried, lambda x: x["hit"] != ""),
                       lambda x: F.struct(F.get(prios, x["number"]).alias("prio"), F.concat(x["section"], x["hit"]).alias("found")))


def matches(patterns: Sequence[Pattern]) -> Column:
    """Array of ``(prio, found)`` of the patterns that match: of the page's candidates, and of those that have no index entry."""
    index = dictionary_index(patterns)
    parts = [_candidate_matches(index.patterns)] if index.patterns else []
    if index.rest:
        each = F.array(*[F.struct(F.lit(p.prio).alias("prio"), _first_match(p).alias("found")) for p in index.rest])
        parts.append(F.filter(each, lambda m: m["found"].isNotNull()))
    if not parts:
        return F.array().cast("array<struct<prio: int, found: string>>")
    return F.array_sort(F.concat(*parts)) if len(parts) > 1 else parts[0]


def describe(prio: Column, patterns: Sequence[Pattern]) -> dict[str, Column]:
    """Category, strength and vendor of a pattern number, looked up in a literal map."""
    out = {}
    for field in ("category", "strength", "vendor"):
        known = [(p.prio, getattr(p, field)) for p in patterns if getattr(p, field) is not None]
        out[field] = F.create_map(*[F.lit(x) for kv in known for x in kv])[prio] if known else F.lit(None).cast("string")
    return out


def page_hits(captures: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """One row per page and matching pattern: the first matching section and the matched text, case kept."""
    found = with_candidates(with_sections(captures), patterns).select("site", "seq", matches(patterns).alias("found"))
    # An outer generator: for an inner one Spark tests the array first, and would match everything twice.
    hits = found.select("site", "seq", F.inline_outer("found")).where(F.col("prio").isNotNull())
    return hits.select(
        "site", "seq", "prio", F.substring("found", 1, 1).cast("int").alias("section"),
        F.expr("substring(found, 2)").alias("hit")).withColumns(describe(F.col("prio"), patterns))


def page_intents(captures: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """Per page: does any section hold an intent phrase for booking, forms, payments."""
    phrases = [p for p in patterns if p.category.startswith("intent_")]
    of = {k: [p.prio for p in phrases if p.category == f"intent_{k}"] for k in ("booking", "forms", "payments")}
    pages = captures.select("site", "seq", *(F.lit(False).alias(f"intent_{k}") for k in of))
    if phrases:
        pages = with_candidates(with_sections(captures), phrases).select("site", "seq", matches(phrases).alias("found"))
        prios = F.transform("found", lambda m: m["prio"])
        pages = pages.select("site", "seq", *[
            F.arrays_overlap(prios, F.lit(own).cast("array<int>")).alias(f"intent_{k}") if own else F.lit(False).alias(f"intent_{k}")
            for k, own in of.items()])
    return pages


def evidence_pages(captures: DataFrame, regex: str = EVIDENCE_PATTERN) -> DataFrame:
    """Pages whose body or link list matches the evidence pattern."""
    links = F.array_join(page_links(F.col("html")), "\n")
    test = F.col("html").rlike(FLAGS + regex) | links.rlike(FLAGS + regex)
    return captures.where(test).select("site", "seq", "final_url")


def first_seen(pages: DataFrame, url: str = "final_url") -> DataFrame:
    """Distinct URLs per site with the position of their first appearance; order by it to list them."""
    return pages.groupBy("site", url).agg(F.min("seq").alias("first_seq"))


def link_categories(link: Column, rules: dict[str, tuple[str, ...]] = LINK_PATTERNS) -> Column:
    """Categories of a link, by the patterns found in the lower-cased URL; a link may have several."""
    low = F.lower(link)
    return F.array_compact(F.array(*[
        F.when(low.rlike("|".join(f"(?:{r})" for r in regexes)), F.lit(category))
        for category, regexes in rules.items()]))


def service_links(links: DataFrame, rules: dict[str, tuple[str, ...]] = LINK_PATTERNS,
                  mode: str = "domain") -> DataFrame:
    """External links by category. ``links``: ``site, seq, pos, url``."""
    outside = links.where(is_external(F.col("url"), F.col("site"), mode) & authority(F.col("url")).isNotNull())
    return outside.select("*", F.explode_outer(link_categories(F.col("url"), rules)).alias("category")).where(
        F.col("category").isNotNull())


def distinct_service_links(services: DataFrame) -> DataFrame:
    """Each URL once per site and category, with its first position."""
    return services.groupBy("site", "category", "url").agg(F.min(F.struct("seq", "pos")).alias("first"))


def exploded_links(captures: DataFrame) -> DataFrame:
    return captures.select("site", "seq", F.posexplode_outer(page_links(F.col("html"))).alias("pos", "url")).where(
        F.col("url").isNotNull())
