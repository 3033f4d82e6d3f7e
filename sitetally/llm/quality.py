"""Quality rules: figures of each text, and lines that many documents of a host share.

A line is *shared* if it stands in more than ``max(LINE_DOCS, LINE_SHARE * documents of the host)`` distinct documents of
its host; equal texts of a host count as one document, so a copied document does not condemn itself. Shared lines are
removed; a document is *depleted* if fewer than ``MIN_WORDS`` words, or less than ``MIN_LEFT`` of its words, are left.

NULL text: no words (so the basic rule fails). NULL host: a host of its own. Blank lines are never shared. Repeated rows
get equal results. Lines are compared in lower case (A-Z), with runs of white space as one space and digits as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BYTES, map_rows, saved, windows

MIN_WORDS = 10
REPEATED_PERCENT = 20
WINDOW = 5
LINE_DOCS = 10
LINE_SHARE = 0.05
MIN_LEFT = 0.1
SYMBOLS = b"#*$%&|<>"
DIGITS = bytes.maketrans(b"123456789", b"0" * 9)
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words in ``WINDOW``-word windows that occur at least twice in the text, the first occurrence included."""
    if len(words) <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    at = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.uint64)
    if len(ids) == len(words):
        return 0
    marks = windows((at + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), WINDOW)
    order = np.argsort(marks, kind="stable")
    same = marks[order][1:] == marks[order][:-1]
    twice = np.zeros(len(marks), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    steps[:len(marks)] += twice
    steps[WINDOW:WINDOW + len(marks)] -= twice
    return int((np.cumsum(steps[:-1]) > 0).sum())


def figures(text: bytes) -> tuple[int, int, int, int, int]:
    """``FIGURES`` of one text."""
    words = text.split()
    seen: set[bytes] = set()
    doubled = 0
    for line in text.split(b"\n"):
        if not line.strip():
            continue
        if line in seen:
            doubled += 1
        seen.add(line)
    spaces = len(text) - len(text.translate(None, SPACE_BYTES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), len(text.decode()) - spaces, symbols, doubled, repeated_words(words)


def lines_of(text: bytes, hashed: Callable[[bytes], int]) -> list[tuple[int, int]]:
    """Hash of each distinct normalised line, and the words all its occurrences in the text have."""
    found: dict[int, int] = {}
    for line in text.split(b"\n"):
        if words := line.split():
            key = hashed(b" ".join(words).lower().translate(DIGITS))
            found[key] = found.get(key, 0) + len(words)
    return list(found.items())


def measured(docs: DataFrame, text: str = "text", host: str = "source", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the host, figures, two hashes of the text, and its lines as (hash, words)."""
    keep = list(keep)
    data = docs.select(F.col(text).alias("_text"), F.col(host).cast("string").alias("_host"), *keep)
    kinds = ", ".join(f"`{c}` {data.schema[c].dataType.simpleString()}" for c in keep)

    def make():
        from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

        def signed(x: int) -> int:
            return x - (1 << 64) if x >= 1 << 63 else x

        def each(body, own_host, *rest):
            body = body or b""
            whole = xxh3_128_intdigest(body)
            lines = [{"line": signed(h), "words": n} for h, n in lines_of(body, xxh3_64_intdigest)]
            decoded = [r.decode() if isinstance(r, bytes) else r for r in rest]
            yield (*decoded, None if own_host is None else own_host.decode(), *figures(body), signed(whole >> 64),
                   signed(whole & ((1 << 64) - 1)), lines)
        return each

    return map_rows(data, make, f"{kinds}, _host string, {', '.join(f'{f} long' for f in FIGURES)}, _t1 long, _t2 long, "
                                "_lines array<struct<line: long, words: long>>")


def shared_lines(rows: DataFrame) -> DataFrame:
    """``_host``, ``line`` of the lines above their host's limit, from ``measured`` rows."""
    texts = rows.select("_host", "_t1", "_t2").distinct()
    limits = texts.groupBy("_host").agg(F.greatest(F.lit(float(LINE_DOCS)), F.count("*") * LINE_SHARE).alias("limit"))
    lines = (rows.select("_host", "_t1", "_t2", F.explode("_lines.line").alias("line")).distinct()
             .groupBy("_host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > LINE_DOCS))
    return lines.join(limits, lines["_host"].eqNullSafe(limits["_host"])).where("docs > limit").select(
        lines["_host"], "line")


def judged(docs: DataFrame, text: str = "text", host: str = "source", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, figures, ``base_failed``, ``shared_words``, ``kept``."""
    keep = list(keep)
    rows = saved(measured(docs, text, host, keep), "quality")
    shared = shared_lines(rows)
    lines = rows.select("_host", "_t1", "_t2", F.explode("_lines").alias("l")).select(
        "_host", "_t1", "_t2", F.col("l.line").alias("line"), F.col("l.words").alias("words")).distinct()
    removed = (lines.join(shared.withColumnRenamed("_host", "_at").withColumnRenamed("line", "_line"),
                          F.col("_host").eqNullSafe(F.col("_at")) & (F.col("line") == F.col("_line")))
               .groupBy("_host", "_t1", "_t2").agg(F.sum("words").alias("shared_words"))
               .select(F.col("_host").alias("_h"), F.col("_t1").alias("_a"), F.col("_t2").alias("_b"), "shared_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    found = rows.drop("_lines").join(
        removed, (F.col("_t1") == F.col("_a")) & (F.col("_t2") == F.col("_b")) & F.col("_host").eqNullSafe(F.col("_h")), "left")
    gone = F.coalesce("shared_words", F.lit(0).cast("long"))
    left = F.col("n_words") - gone
    return found.select(
        *keep, *FIGURES, failed.alias("base_failed"), gone.alias("shared_words"),
        (~failed & (left >= MIN_WORDS) & (left >= MIN_LEFT * F.col("n_words"))).alias("kept"))


def kept_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` whose verdict is to stay, with all their columns and whole texts."""
    mark = F.xxhash64(F.col(text), F.col(host).cast("string"))
    data = docs.select(F.col(text).alias("text"), F.col(host).alias("host"), F.col("doc_id").alias("_id"), mark.alias("_mark"))
    out = judged(data, "text", "host", keep=("_id", "_mark")).where("not kept").select(
        F.col("_id").alias("__st_id"), F.col("_mark").alias("__st_mark")).distinct()
    marked = docs.withColumn("__st_own", mark)
    same = F.col("doc_id").eqNullSafe(F.col("__st_id")) & (F.col("__st_own") == F.col("__st_mark"))
    return marked.join(out, same, "left_anti").drop("__st_own")
