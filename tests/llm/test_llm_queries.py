"""Every query of the subpackage against its SQL; the others against brute force on the test tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR

import oracle
from sitetally.llm import brown, html_model, queries, sentencepiece_scan
from sitetally.llm.html_tree import parsed


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def words(text: str) -> list[str]:
    return [w.decode() for w in (text or "").encode().lower().split()]


def remainder(doc_id: int, by: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % by


def test_registered():
    import __spark_entry__ as entry
    keys = [k for k in entry.queries() if k.startswith("op")]
    assert sorted({int(k[2:].split("_")[0]) for k in keys}) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_sql(spark, con, key):
    assert oracle.differences(queries.QUERIES[key](spark, SF_DIR), con, queries.ORACLE[key]) == ""


def test_brown_counts_and_gain(spark, texts):
    rows = {r.doc_id: r for r in queries.QUERIES["op1_brown_lm"](spark, SF_DIR).collect()}
    count = Counter()
    for d, t in texts.items():
        if remainder(d, 7) != 2:
            count.update([*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    for d, t in texts.items():
        tokens = [*words(t), "\n"]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        r = rows[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(tokens), sum(count[w] > 0 for w in tokens), n, remainder(d, 7) == 2)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_brown_is_a_distribution(spark):
    docs = spark.createDataFrame([(f"{a} {b} {a} c{i % 5} rare{i}",) for i, (a, b) in enumerate([("x", "y"), ("u", "v")] * 30)], "text string")
    model, _ = brown.trained(docs)
    assert np.allclose((10 ** model.log_next).sum(axis=1), 1)
    # in each class, all known words and the unseen ones add up to one
    counts = Counter(w for r in docs.collect() for w in [*r.text.split(), ""])
    total = defaultdict(float)
    for w, n in counts.items():
        c = int(model.of[model.items.of(w.encode())])
        total[c] += 10 ** brown.emission(np.array([n]), model.size[c], model.discount)[0]
    for c, known in total.items():
        assert abs(known + 10 ** model.unseen[c] - 1) < 1e-9
    # words in the same places are in one class
    assert model.of[model.items.of(b"x")] == model.of[model.items.of(b"u")] or len(set(model.of)) > 2


def test_main_text_of_pages(spark):
    rows = queries.QUERIES["op2_html_model"](spark, SF_DIR).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        nodes, runs = parsed(pages[r.page_id])
        inside = [t for i, t in runs if _below(nodes, i, "article")]
        assert r.text == " ".join(inside) and r.n_chars == len(r.text)


def _below(nodes, i, tag):
    while i >= 0:
        if nodes[i].tag == tag:
            return True
        i = nodes[i].parent
    return False


def test_held_out_rule_pages():
    trees = [parsed(p, html_model.MARK)[0] for p in html_model.labelled_pages(120, seed=3)]
    for nodes in trees:
        for x in nodes:
            x.attrs = x.attrs.replace(f' {html_model.MARK}="1"', "").replace(f' {html_model.MARK}="0"', "")
    model = html_model.fitted([*trees, *(html_model.neutral(t) for t in trees)])
    right = total = 0
    for page in html_model.labelled_pages(60, seed=4):
        nodes, runs = parsed(page, html_model.MARK)
        plain = page.replace(f' {html_model.MARK}="1"', "").replace(f' {html_model.MARK}="0"', "")
        p = model.marginals(parsed(plain)[0])
        right += sum((p[i] >= 0.5) == bool(nodes[i].label) for i, _ in runs)
        total += len(runs)
    assert right / total > 0.95


def test_messages_equal_enumeration():
    """Sum-product marginals against the sum over all labelings of a small tree."""
    from itertools import product
    nodes, _ = parsed("<div class=content><p>some text, here</p><ul><li><a>x</a></li></ul></div><div class=ad><p>buy</p></div>")
    model = html_model.Model({"w:content": 1.5, "w:ad": -2.0, "t:p": 0.3, "m0:3": 0.4}, {"": (0.8, 0.2), "p": (0.9, 0.3)}, 0.4)
    totals = html_model._sums(nodes)
    own = [model.evidence(x, nodes[x.parent].tag if x.parent >= 0 else "", t) for x, t in zip(nodes, totals, strict=True)]
    weight, each = 0.0, [0.0] * len(nodes)
    for ys in product((0, 1), repeat=len(nodes)):
        w = (model.prior if ys[0] else 1 - model.prior) * (own[0] if ys[0] else 1)
        for i in range(1, len(nodes)):
            p = model.edges.get(html_model.kind_of(nodes[i]), model.edges[""])[0 if ys[nodes[i].parent] else 1]
            w *= (p if ys[i] else 1 - p) * (own[i] if ys[i] else 1)
        weight += w
        each = [e + w * y for e, y in zip(each, ys, strict=True)]
    assert np.allclose(model.marginals(nodes), [e / weight for e in each])


def brute_pieces(p, text):
    """The best cut of the whole text in one sequential pass."""
    whole = p.normal(text)
    n, places, start = len(whole), [], 0
    for i in range(n):
        if i and whole[i] == sentencepiece_scan.SPACE and whole[i - 1] != sentencepiece_scan.SPACE:
            start = i
        places.append(i - start)
    best = [(0, 0)] + [None] * n
    for j in range(1, n + 1):
        for i in range(max(0, j - p.longest), j):
            s = p.scores.get(whole[i:j], p.unknown if j == i + 1 else None)
            if s is not None:
                value = best[i][0] + s + sentencepiece_scan.PLACES[places[i] & 4095]
                if best[j] is None or value > best[j][0]:
                    best[j] = value, i
    out, j = [], n
    while j:
        i = best[j][1]
        out.append([p.ids[whole[i:j]]] if whole[i:j] in p.ids else [p.bytes[b] for b in whole[i:j].encode()])
        j = i
    return [x for ids in reversed(out) for x in ids]


def test_pieces_in_chunks_equal_one_pass(spark):
    import random
    from sentencepiece import SentencePieceProcessor
    path, rnd = queries.vocabulary("piece_bpe_32k.model"), random.Random(5)
    parts = ["the ", "a", "  ", "ing", "😛", "\n", "implementation", "x" * 20, " ", "日本", "﻿"]
    docs = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 90)))) for i in range(60)] + [(99, None), (100, "y" * 900)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    p, sp = sentencepiece_scan.Pieces(path), SentencePieceProcessor(model_file=path)
    for chunk in (7, 64):
        rows = sentencepiece_scan.encoded(df, path, chunk=chunk)
        spans = {(r.doc, r.k): r.span for r in sentencepiece_scan.decoded(rows, path).collect()}
        by = defaultdict(list)
        for r in rows.collect():
            assert r.round_trip
            by[r.doc].append((r.k, r.ids))
        for d, text in docs:
            ids = [x for _, got in sorted(by[d]) for x in got]
            assert ids == brute_pieces(p, text or ""), (d, chunk)
            assert "".join(spans[d, k] for k, _ in sorted(by[d])) == p.normal(text or "")
            # the library leaves the sign of a lone space as it is
            assert sp.decode(ids).replace(sentencepiece_scan.SPACE, " ").strip(" ") == (text or "").strip(" ")


def test_new_words_of_many_texts_are_cut_together(spark):
    import random
    p, rnd = sentencepiece_scan.Pieces(queries.vocabulary("piece_bpe_32k.model")), random.Random(6)
    parts = ["the", "a", "ing", "😛", "\n", "implement", "ation", "日本", "é", "0", "ß"]
    words = list({"▁" * rnd.randint(0, 3) + "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6))) for _ in range(3000)})
    p.learn([words])
    assert len(p.known) > 2000
    for w in words:
        _, back = p.best(w, {0: 0}, len(w))
        assert p.words([w]).tolist() == p.traced(w, back, 0, len(w)), w


def test_chunks_are_scanned_without_a_frame_for_each_text(spark):
    df = spark.createDataFrame([(k, "some words " * 40) for k in range(3)], "doc_id long, text string")
    rows = sentencepiece_scan.encoded(df, queries.vocabulary("piece_bpe_32k.model"), chunk=64)
    assert "FlatMapGroupsInPandas" not in rows._jdf.queryExecution().executedPlan().toString()


def test_round_trip_of_documents(spark):
    rows = queries.QUERIES["op3_sentencepiece_scan"](spark, SF_DIR)
    assert rows.where("not round_trip").isEmpty() and rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_language_of_held_out_documents(spark):
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op4_language_id"](spark, SF_DIR).join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9
    assert all(0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer
    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op9_packing"](spark, SF_DIR).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for d, own in pieces.items():
        ids = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = tokens = 0
    for own in sequences.values():
        total = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == total
            total += r.length
        assert total <= 2048
        tokens += total
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding == 0
    steps = defaultdict(set)
    for own in sequences.values():
        steps[own[0].step_group].add(own[0].tier)
    assert all(len(t) == 1 for t in steps.values())
