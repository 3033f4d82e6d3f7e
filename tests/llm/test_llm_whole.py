"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitetally.llm import line_dedup, signature_join


def _components(n, links):
    up = list(range(n))
    while True:
        before = up[:]
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
        if up == before:
            return up


def _shingles(line):
    """Twelve characters from each word start, and from every character of a longer word."""
    out, at = set(), 0
    for word in line.split(" "):
        out |= {line[at + i:at + i + 12] for i in range(len(word)) if not i or len(word) > 12}
        at += len(word) + 1
    return out


def test_lines_without_spaces_and_with_equal_beginnings(spark):
    rng = np.random.default_rng(6)
    signs, same = [chr(0x4E00 + k) for k in range(2000)], "第一章之前的话都是一样的啊"
    lines = [same + "".join(rng.choice(signs, 40)) for _ in range(15)]
    lines += [x[:-1] + "完" for x in lines[:4]] + [x[:20] + x[40:] for x in lines[4:8]]
    lines += [f"https://www.example.org/{''.join(rng.choice(list('abcdef0123456789'), 30))}" for _ in range(15)]
    lines += [f"see https://en.wikipedia.org/wiki/{x}" for x in ("a", "b", "some_longer_title", "another_one")]
    lines += [f"{a} line with an extraordinarilylongwordinit{b} and a few short words at its end" for a in "xy" for b in ("", "q r")]
    sets = [_shingles(x) for x in lines]
    links = [(i, j) for i, j in combinations(range(len(lines)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    up = _components(len(lines), links)
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.kept for r in line_dedup.judged_lines(df).collect()}
    assert links and [got[i] for i in range(len(lines))] == [up[i] == i for i in range(len(lines))]
    hashes = df.select("doc_id", F.size(F.array_distinct(line_dedup.shingle_hashes(F.col("text")))).alias("n")).collect()
    assert {r.doc_id: r.n for r in hashes} == {i: len(s) for i, s in enumerate(sets)}


def test_large_bucket_of_several_families(spark):
    """All lines in one bucket; families whose lines drift, of which one line at most is next to the smallest id."""
    rng = np.random.default_rng(7)
    lines = []
    for f in range(5):
        words = [f"f{f}w{k}" for k in range(40)]
        for k in range(60):
            words[int(rng.integers(40))] = f"n{f}x{k}"
            lines.append(" ".join(words))
    sets = [_shingles(x) for x in lines]
    links = [(i, j) for i, j in combinations(range(len(lines)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df = spark.createDataFrame([(x,) for x in lines], "body string")
    hashed = df.select(F.xxhash64("body").alias("id"), F.array(*(F.lit(k).cast("long") for k in range(6))).alias("bands"))
    at = {r.id: i for i, r in enumerate(hashed.collect())}
    found = [(at[r.a], at[r.b]) for r in line_dedup.similar_lines(df, hashed).collect()]
    assert {tuple(sorted(x)) for x in found} <= set(links) and _components(len(lines), found) == _components(len(lines), links)


def _one_bucket(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "body string")
    hashed = df.select(F.xxhash64("body").alias("id"), F.array(*(F.lit(k).cast("long") for k in range(6))).alias("bands"))
    return df, hashed, {r.id: i for i, r in enumerate(hashed.collect())}


@pytest.mark.parametrize("n", [50, 150])
def test_lines_that_share_much_but_are_not_similar_make_no_pairs(spark, monkeypatch, n):
    """A bucket of one family: each line has half of its words from the family, a few have a near copy."""
    rng = np.random.default_rng(8)
    word = [f"w{k}" for k in range(30)]
    lines = [" ".join([*rng.permutation(word)[:15].tolist(), *word[:15], *(f"x{i}y{k}" for k in range(15))]) for i in range(n)]
    lines += [x + " end" for x in lines[:10]]
    tried = []
    monkeypatch.setattr(line_dedup, "_verified", lambda sets, pairs, own=line_dedup._verified: tried.append(pairs.count()) or own(sets, pairs))
    df, hashed, at = _one_bucket(spark, lines)
    found = {tuple(sorted((at[r.a], at[r.b]))) for r in line_dedup.similar_lines(df, hashed).collect()}
    assert found == {(i, n + i) for i in range(10)}
    assert sum(tried) <= 30  # pairs whose sets moved; tried against the smallest id alone, the bucket has more


def test_bound_of_bitmaps_and_blocks_lose_no_link(spark, monkeypatch):
    """Lines with more shingles than a bitmap has bits, short ones, and buckets cut into blocks."""
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rng = np.random.default_rng(9)
    lines = []
    for f, n in enumerate([5, 6, 30, 30, 200, 1200]):
        words = [f"f{f}w{k}" for k in range(n)]
        for c in range(14):
            for _ in range(max(1, n // 40)):
                words[int(rng.integers(n))] = f"n{f}x{c}y{rng.integers(1 << 30)}"
            lines.append(" ".join(words))
    sets = [_shingles(x) for x in lines]
    links = [(i, j) for i, j in combinations(range(len(lines)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df, hashed, at = _one_bucket(spark, lines)
    found = [tuple(sorted((at[r.a], at[r.b]))) for r in line_dedup.similar_lines(df, hashed).collect()]
    assert links and set(found) <= set(links) and _components(len(lines), found) == _components(len(lines), links)


def test_lines_that_meet_in_many_buckets_are_a_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(10)
    base = [f"w{k}" for k in range(100)]
    lines = [" ".join([*base, *(f"x{i}y{k}" for k in range(5))]) for i in range(12)]
    df, hashed, at = _one_bucket(spark, lines)
    sets = line_dedup.shingle_sets(df, hashed.select("id"))
    rows = [(key, i, i, 12) for key in rng.integers(1 << 40, size=30).tolist() for i in at]
    members = spark.createDataFrame(rows, "key long, id long, c long, size long")
    for block, least in ((2048, 64), (4, 64), (2048, 30)):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        monkeypatch.setattr(line_dedup, "LEAST", least)
        pairs = [(r.a, r.b) for r in line_dedup._all_pairs(members, line_dedup.marks_of(sets)).collect()]
        assert sorted(pairs) == sorted(combinations(sorted(at), 2))
    # lines carry too few keys to tell: pairs may be there twice, but all are
    few = spark.createDataFrame([(k, i, i, 12) for k, i in [(1, 1), (2, 1), (3, 1), (0, 2), (2, 2), (3, 2)]], "key long, id long, c long, size long")
    marks = line_dedup.marks_of(sets).limit(1).select("n", "w", "spare")
    marks = marks.withColumn("id", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))))
    monkeypatch.setattr(line_dedup, "LEAST", 1)
    assert {(r.a, r.b) for r in line_dedup._all_pairs(few, marks).collect()} == {(1, 2)}


def test_sets_that_share_many_cells_are_a_pair_once(spark):
    """Ten sets in thirty cells, and one set that is in the last cell alone."""
    bits, rng = b"\x0f" * 256, np.random.default_rng(11)
    made = []
    for least in (8, 1):
        cells = sorted(rng.integers(-(1 << 40), 1 << 40, size=30).tolist())
        rows = [(h, 0, 0, 0, f, 1000, f, bits, cells[:least]) for h in cells for f in range(10)]
        rows.append((cells[-1], 0, 0, 0, 10, 1000, 10, bits, cells[-1:]))
        halves = [[r[8] for r in rows if r[0] == cells[-1]], []]
        seen = signature_join.lesser(cells[-1], halves)[0]
        assert seen[:10].any(axis=1).all() and not seen[10].any()
        df = spark.createDataFrame(rows, "h long, p long, q long, side int, f long, n int, c long, bits binary, keys array<long>")
        found = signature_join._tree_pairs(df.repartition(1).sortWithinPartitions("h", "p", "q")).collect()
        assert sorted((r.a, r.b) for r in found) == list(combinations(range(11), 2))
        # what the trees give cell by cell, before anything is made distinct
        for h in cells:
            part = [r for r in rows if r[0] == h]
            tree = signature_join.Tree(np.array([r[6] for r in part]), np.array([r[5] for r in part]),
                                       np.frombuffer(b"".join(r[7] for r in part), dtype=np.uint64).reshape(len(part), -1),
                                       signature_join.lesser(h, [[r[8] for r in part]])[0])
            made += [(h, len(i)) for i, _ in signature_join.dual(tree, tree, True)]
    assert sum(n for _, n in made) == 2 * 55


def test_join_of_rows_without_an_id_or_with_a_shared_one(spark):
    base = [f"word{k}" for k in range(60)]
    near, other = " ".join([*base[:-1], "edited"]), " ".join(f"other{k}" for k in range(40))
    own = " ".join(f"own{k}" for k in range(40))
    rows = [(1, " ".join(base)), (None, near), (None, near), (5, " ".join([*base[:-1], "changed"])), (5, own), (None, other), (7, other + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in signature_join.linked(df).collect())
    assert got == [(0, 0), (0, 0), (0, 0), (1, 1), (5, 1), (5, 5), (7, 7)]
    left = sorted((r.doc_id or 0, r.text) for r in signature_join.one_of_each(df).collect())
    assert left == sorted([(0, near), (0, near), (0, other), (1, " ".join(base)), (5, own), (7, other + " more")])
