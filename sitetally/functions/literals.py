"""Literal text that any match of a pattern must contain: a cheap test before an expensive regular expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import NAMED

_TOKEN = re.compile(r"\\[bBAZz]|\\[sSdDwWhHvV]|\\\W|\\.|\[(?:\\.|[^\]])*\]|[.^$]|[^\\\[\]().^$*+?{}|]")
_QUANTIFIER = re.compile(r"[*+?][+?]?|\{\d+(?:,\d*)?\}[+?]?")
MIN_LENGTH = 3


def _branches(regex: str) -> list[str]:
    """Alternatives outside groups and classes."""
    out, depth, start, i, in_class = [], 0, 0, 0, False
    while i < len(regex):
        c = regex[i]
        if c == "\\":
            i += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            out.append(regex[start:i])
            start = i + 1
        i += 1
    return [*out, regex[start:]]


def _group_end(regex: str, start: int) -> int:
    depth, i = 0, start
    while i < len(regex):
        if regex[i] == "\\":
            i += 1
        elif regex[i] == "(":
            depth += 1
        elif regex[i] == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError(f"unbalanced group in {regex!r}")


def _of_branch(branch: str) -> list[str] | None:
    runs, run, groups, i = [], "", [], 0
    while i < len(branch):
        if branch[i] == "(":
            end = _group_end(branch, i)
            inner, i = branch[i + 1:end], end + 1
            quantifier = _QUANTIFIER.match(branch, i)
            i = quantifier.end() if quantifier else i
            if inner.startswith("?") and not inner.startswith("?:"):
                return None  # look-around and inline flags are not analysed
            if quantifier is None:
                groups.append(inner.removeprefix("?:"))
            runs.append(run)
            run = ""
            continue
        token = _TOKEN.match(branch, i)
        if token is None:
            return None
        text, i = token.group(), token.end()
        quantifier = _QUANTIFIER.match(branch, i)
        char = text if len(text) == 1 and text not in ".^$" else text[1] if re.fullmatch(r"\\\W", text) else None
        if char is None or quantifier is not None:
            if char is None and text.startswith("\\") and text[1] not in "bBAZzsSdDwWhHvV":
                return None
            runs.append(run)
            run = ""
            i = quantifier.end() if quantifier else i
        else:
            run += char
    runs.append(run)
    best = max(runs, key=len)
    if len(best) >= MIN_LENGTH:
        return [best]
    for inner in groups:
        found = required_literals(inner)
        if found:
            return found
    return None


def required_literals(regex: str) -> list[str] | None:
    """Texts of which every match contains at least one; None if there is no such list."""
    out: list[str] = []
    for branch in _branches(regex):
        found = _of_branch(branch)
        if found is None:
            return None
        out += found
    if not all(x.isascii() for x in out):
        return None  # folding a whole text can depend on the place of a letter, such as the Greek sigma at a word's end
    return sorted({fold_text(x) for x in out})


#: Letters that equal an ASCII letter without regard to case, beside its own other case.
ALIKE = {"İ": "i", "ı": "i", "ſ": "s", "\u212a": "k"}


def fold_text(text: str) -> str:
    for letter, plain in ALIKE.items():
        text = text.replace(letter, plain)
    return text.lower()


def fold(text: Column) -> Column:
    """Text with case removed, for ASCII letters as far as Unicode case-insensitive matching does."""
    for letter, plain in ALIKE.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return F.lower(text)


#: What markup and most references cannot bring about: markup turns into a space, and nearly all names stand for other characters.
WHOLE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789./%_-[]")
#: Characters from the most to the least common one in page sources.
COMMONNESS = " etaoinsrlcdhpm\"=u/<>.-fgbvwy0123456789:k_;x'jqz%[]"
ANCHOR_LENGTH = 3


def _stands_for_whole(char: str) -> bool:
    return fold_text(char) in WHOLE


#: References that do stand for such a character, or for one that is equal to it without regard to case.
TELLING = sorted(name for name, text in NAMED.items() if any(map(_stands_for_whole, text)))


def coded(html: Column) -> Column:
    """May a reference in the page source stand for a character of ``WHOLE``?"""
    return html.contains("&#") | (html.contains("&") & html.rlike(f"&(?:{'|'.join(TELLING)});"))


def anchor(literal: str) -> str | None:
    """The end of a run of ``WHOLE`` characters in a literal, from its rarest character on; None if all runs are short.

    A text that holds the literal holds its anchor, and, unless the page is ``coded``, so does the page source.
    """
    best = None
    for run in re.findall(f"[{re.escape(''.join(sorted(WHOLE)))}]{{{ANCHOR_LENGTH},}}", literal):
        for start in range(len(run) - ANCHOR_LENGTH + 1):
            rank = (COMMONNESS.find(run[start]), COMMONNESS.find(run[start + 1]), len(run) - start)
            best = max(best or (rank, ""), (rank, run[start:]))
    return best[1] if best else None


def anchors(regex: str) -> list[str] | None:
    """Texts of which every page with a match has at least one; None if there is no such list."""
    found = [anchor(x) for x in required_literals(regex) or ()]
    return sorted(set(found)) if found and None not in found else None


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_])", r"\\\1", text)


def _tree(words: list[str]) -> str:
    """A pattern for the longest of the words at a place, grouped by their first characters."""
    if words == [""]:
        return ""
    by: dict[str, list[str]] = {}
    for w in words:
        if w:
            by.setdefault(w[0], []).append(w[1:])
    branches = [_quoted(c) + _tree(sorted(rest)) for c, rest in sorted(by.items())]
    if "" in words:
        branches.append("")
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def index_pattern(words: list[str]) -> str:
    """A pattern that matches before every place where one of the words begins; group 1 is the longest one there."""
    first = "".join(sorted({_quoted(w[0]) for w in words}))
    return f"(?=[{first}])(?=({_tree(sorted(set(words)))}))"


def has_any(folded: Column, literals: list[str]) -> Column:
    test = folded.contains(literals[0])
    for x in literals[1:]:
        test = test | folded.contains(x)
    return test


def may_match(folded: Column, regex: str) -> Column | None:
    """False where the pattern cannot match a text with this folded form; None if nothing can be said."""
    literals = required_literals(regex)
    if literals is None:
        return None
    return has_any(folded, literals)
