"""Findings of round 3: work of line shingles, written tables of components, bytes of a set, bitmaps sent for pairs."""

from __future__ import annotations

from zlib import decompress

import numpy as np
from pyspark.sql import functions as F

from sitetally.llm import components, line_dedup, signature_join


def brute(line: str, size: int = line_dedup.SHINGLE) -> list[str]:
    out, at = [], 0
    for word in line.split(" "):
        places = range(at, at + len(word)) if len(word) > size else [at] if word else []
        out.extend(line[k:k + size] for k in places)
        at += len(word) + 1
    return sorted(out)


def test_shingles_by_one_expression(spark):
    lines = ["a", "ab  cd", "twelve_chars next", "thirteen_char next word", "x " + "long" * 9 + " y z", "\U0001f600" * 15 + " end", "é" * 13]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", line_dedup.shingle_hashes(F.col("line")).alias("s"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    want = spark.createDataFrame([(x, s) for x in lines for s in brute(x)], "line string, s string")
    want = {r.line: r.s for r in want.groupBy("line").agg(F.sort_array(F.collect_list(F.xxhash64("s"))).alias("s")).collect()}
    assert {r.line: sorted(r.s) for r in got.collect()} == want


def test_components_of_stars_in_one_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components, "saved", lambda df, name, own=components.saved: made.append(name) or own(df, name))
    stars = spark.createDataFrame([(10, k) for k in range(11, 40)] + [(50, 51), (51, 50), (50, 50), (None, 7)], "a long, b long")
    got = sorted((r.id, r.component) for r in components.components(stars).collect())
    assert got == [(k, 10) for k in range(10, 40)] + [(50, 50), (51, 50)]
    assert len(made) == 2
    chain = spark.createDataFrame([(k, k + 1) for k in range(100)], "a long, b long")
    assert sorted((r.id, r.component) for r in components.components(chain).collect()) == [(k, 0) for k in range(101)]
    assert components.components(stars.limit(0)).count() == 0


def test_wide_bitmap_is_compressed(spark):
    text = " ".join(f"w{k * 7919 % 1009}" for k in range(600))
    r = signature_join.sets_of(spark.createDataFrame([(1, text)], "doc_id long, text string"), set()).first()
    assert len(r.wide) < 800  # 1,024 bytes before
    assert signature_join.folded(decompress(bytes(r.wide))).tobytes() == bytes(r.bits)
    assert r.n == 596 and np.bitwise_count(np.frombuffer(decompress(bytes(r.wide)), dtype=np.uint64)).sum() <= r.n


def test_wide_bitmaps_do_not_travel_with_pairs(spark, monkeypatch):
    words = [f"w{k * 7919 % 10007}" for k in range(400)]
    texts = [" ".join(words[:300 + k % 7] + [f"x{k}y{m}" for m in range(k)]) for k in range(40)] + ["others " * 3 + str(k) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = signature_join.sets_of(docs, set()).cache()
    known = {r.f: (r.n, decompress(bytes(r.wide))) for r in sets.collect()}
    names = sorted(f for f, (n, _) in known.items() if n > 100)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    sent = []

    def counted(df, *more, own=signature_join.map_rows):
        sent.append(sum(r[c] is not None for r in df.collect() for c, kind in df.dtypes if kind == "binary"))
        return own(df, *more)

    monkeypatch.setattr(signature_join, "map_rows", counted)
    got = {(r.a, r.b) for r in signature_join.wide_bounded(sets, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert sent[0] <= signature_join.SPREAD * len(names)  # two for each of 780 pairs before
    assert got == {(a, b) for a, b in pairs if signature_join._may_link(known[a][0], known[b][0], known[a][1], known[b][1])}
    assert 0 < len(got) < len(pairs)
    some = signature_join._needed(sets, spark.createDataFrame([(names[0],)], "f long"), "wide").collect()
    assert [(r.f, r.n) for r in some] == [(names[0], known[names[0]][0])]
    monkeypatch.setattr(signature_join, "PLACE", 4)
    assert {(r.a, r.b) for r in signature_join.wide_bounded(sets, spark.createDataFrame(pairs, "a long, b long")).collect()} == got


def test_cells_that_share_a_name_only_add_tries(spark, monkeypatch):
    texts = [f"a{k // 2} b{k // 2} c d e f g h i j k l m n o p q r s t u v w x y z {'end' * (k % 2)}" for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((r.doc_id, r.component_id) for r in signature_join.linked(docs).collect())
    monkeypatch.setattr(signature_join, "CELL_BITS", 3)
    assert sorted((r.doc_id, r.component_id) for r in signature_join.linked(docs).collect()) == want
