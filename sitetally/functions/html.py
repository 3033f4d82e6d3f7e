"""Page bodies: links and visible text, as built-in string functions.

One grammar of tags for all uses, after the states of the HTML standard: an attribute's name runs to white space, ``/``, ``=``
or ``>``; a value is quoted only if a quote follows the ``=`` at once, and then ends at that quote alone; an unquoted value runs
to white space or ``>`` and may hold quotes. A tag whose quote never closes is not a tag. The patterns are possessive, so the
work is linear in the page and no stack grows with it; they mean the same to Java and to Python's ``re``.
"""

from __future__ import annotations

import json
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import once

VALUE = r"\"[^\"]*+\"|'[^']*+'|(?![\"'])[^>\s]*+"
ATTRIBUTE = rf"(?<=[\s/\"'])[^\s/>][^\s/=>]*+(?:\s*+=++\s*+(?:{VALUE}))?+"
ATTRIBUTES = rf"(?:[\s/]*+{ATTRIBUTE})*+[\s/]*+"
COMMENT = r"!--(?s:.*?)(?:--\s*>|\z)"


def _element(name: str) -> str:
    """An element whose content is not markup, without its first ``<``."""
    return rf"(?i:{name})(?=[\s/>]){ATTRIBUTES}>(?s:.*?)(?:</(?i:{name})\s*>|\z)"


HIDDEN = f"{COMMENT}|{_element('script')}|{_element('style')}"
UNSEEN = f"<(?:{HIDDEN})"
MARKUP = rf"(?:<(?:{HIDDEN}|[!?/][^>]++>|[a-zA-Z][^\s/>]*+{ATTRIBUTES}>))++"
#: An anchor with an ``href``; group 1 is the value of the first one, with its quotes.
ANCHOR = (rf"<[aA](?=[\s/])(?:[\s/]*+(?!(?i:href)[\s/=>]){ATTRIBUTE})*+[\s/]*+(?<=[\s/\"'])(?i:href)(?=[\s/=>])"
          rf"(?:\s*+=++\s*+({VALUE}))?+{ATTRIBUTES}>")
SPACES = " \t\n\r\f\x0b"
#: All named references of the standard, as the standard library has them; some are known without ``;`` too.
NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
BARE = {name: char for name, char in html5.items() if not name.endswith(";")}
#: Tried first, as nearly all references are among them.
COMMON = ("amp", "nbsp", "lt", "gt", "quot", "#39")
#: What the numbers 128 to 159 stand for.
WINDOWS = "".join(bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(128, 160))
BUCKETS = 256


def _buckets(of: dict[str, str]) -> str:
    """The table as JSON, by a hash of the names: Spark goes through a map entry by entry."""
    parts: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for name, text in of.items():
        parts[crc32(name.encode()) % BUCKETS][name] = text
    return json.dumps(parts)


_NAMED, _BARE = _buckets(NAMED), _buckets(BARE)
_BARE_START = "^(" + "|".join(sorted(BARE, key=lambda n: (-len(n), n))) + ")"


def _known(name: Column, table: str) -> Column:
    parts = F.from_json(F.lit(table), "array<map<string, string>>")
    return F.get(parts, (F.crc32(name.cast("binary")) % BUCKETS).cast("int"))[name]


def _numbered(code: Column) -> Column:
    """The character of ``#...``; NULL for a number that is none."""
    number = F.when(code.rlike("^#[xX]"), F.conv(F.substring(code, 3, 8), 16, 10)).otherwise(F.substring(code, 2, 8)).try_cast("long")

    def char(n: Column) -> Column:
        valid = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        return F.when(n.between(128, 159), F.substr(F.lit(WINDOWS), (n - 127).cast("int"), F.lit(1))).when(
            valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    return once(number, char)


def _reference(part: Column) -> Column:
    """The text after an ``&``, with the reference it begins with decoded; with the ``&`` if there is none."""
    whole = F.concat(F.lit("&"), part)

    def decoded(code: Column) -> Column:
        after = F.substr(part, F.length(code) + 1)
        closed = after.startswith(";")
        rest = F.when(closed, F.substr(after, F.lit(2))).otherwise(after)
        bare = once(F.regexp_extract(part, _BARE_START, 1), lambda b: F.concat(_known(b, _BARE), F.substr(part, F.length(b) + 1)))
        by_name = F.coalesce(F.when(closed, F.concat(_known(code, _NAMED), rest)), bare)
        return F.coalesce(F.when(code.startswith("#"), F.concat(_numbered(code), rest)).otherwise(by_name), whole)

    test = F.when(part.startswith("amp;"), F.concat(F.lit("&"), F.substr(part, F.lit(5))))
    for name in COMMON[1:]:
        test = test.when(part.startswith(name + ";"), F.concat(F.lit(NAMED.get(name, "'")), F.substr(part, F.lit(len(name) + 2))))
    start = F.regexp_extract(part, r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*+)", 0)
    return test.when(part.rlike("^[#a-zA-Z]"), once(start, decoded)).otherwise(whole)


def unescape(text: Column) -> Column:
    """Named and numeric references as characters, each once: the text is cut at every ``&`` and put together again.

    Invalid numbers and unknown names stay as they are; a text without ``&`` is not touched.
    """
    parts = F.split(text, "&")
    decoded = F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(_reference(part)))
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def page_links(html: Column) -> Column:
    """Every ``<a href>`` in page order, unescaped and trimmed, ``mailto:`` left out, duplicates kept.

    Comments, scripts and styles hold no links. Of several ``href`` in a tag the first counts.
    """
    seen = F.when(html.rlike(r"(?i)<(?:!--|script\b|style\b)"), F.regexp_replace(html, UNSEEN, " ")).otherwise(html)

    def plain(value: Column) -> Column:
        quoted = value.startswith('"') | value.startswith("'")
        return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    links = F.transform(F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(1)), lambda v: F.trim(unescape(plain(v)), F.lit(SPACES)))
    return F.filter(links, lambda h: ~h.startswith("mailto:"))


def strip_markup(html: Column) -> Column:
    """Text nodes with one space for the markup between two of them, however much there is; ``</>`` is nothing at all."""
    return F.regexp_replace(F.replace(html, F.lit("</>"), F.lit("")), MARKUP, " ")


def page_text(html: Column) -> Column:
    """Visible text in lower case."""
    return F.lower(unescape(strip_markup(html)))


def is_challenge(html: Column, markers: tuple[str, ...]) -> Column:
    """True if the lower-cased body contains any of the markers."""
    low = F.lower(html)
    hit = F.lit(False)
    for marker in markers:
        hit = hit | low.contains(marker)
    return F.coalesce(hit, F.lit(False))
