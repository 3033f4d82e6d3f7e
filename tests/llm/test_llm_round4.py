"""Findings of round 4: links between shards of vectors, words without a class of their own."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitetally.llm import brown, vector_graph


def _vectors(kind: str) -> np.ndarray:
    rng = np.random.default_rng(11)
    if kind == "family":  # more near copies than a shard holds, among vectors without any structure
        m = np.concatenate([np.ones((1, 24)) + rng.normal(size=(170, 24)) * 0.12, rng.normal(size=(200, 24))])
    elif kind == "arc":  # each vector's partners are on both sides of any cut
        a = np.linspace(0, 5, 400)
        m = np.stack([np.cos(a), np.sin(a), rng.normal(size=400) * 0.01], axis=1)
    else:  # groups far apart, each with vectors that are linked in pairs
        base = np.repeat(np.eye(16)[:4] * 3, 50, axis=0) + rng.normal(size=(200, 16)) * 0.2
        m = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1])
    return m.astype(np.float32).astype(float)


@pytest.mark.parametrize("kind", ["family", "arc", "groups"])
def test_no_link_is_lost_between_shards(spark, monkeypatch, kind):
    m = _vectors(kind)
    m = np.concatenate([m, m[:3]])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = (unit @ unit.T >= vector_graph.LIMIT) & ~np.eye(len(m), dtype=bool)
    monkeypatch.setattr(vector_graph, "SHARD", 100)
    # labels that only differ by what names of shards end with are labels of their own
    rows = [(i, v.tolist(), "a") for i, v in enumerate(m)] + [(5000 + k, m[0].tolist(), f"a{x}") for k, x in enumerate(("/0", "#0-0", "#0-1"))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = {r.vec_id: r for r in vector_graph.near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(len(m))] == near.sum(axis=1).tolist()
    low = list(range(len(m)))
    for _ in m:
        new = [min([low[i], *(low[j] for j in np.flatnonzero(near[i]))]) for i in range(len(m))]
        if new == low:
            break
        low = new
    assert [got[i].component_id for i in range(len(m))] == low
    assert all(got[k].n_links == 0 for k in range(5000, 5003))


@pytest.mark.parametrize("kind", ["family", "arc", "groups"])
def test_a_main_shard_holds_all_partners(spark, monkeypatch, kind):
    m = _vectors(kind)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    monkeypatch.setattr(vector_graph, "SHARD", 100)
    vectors = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(m)], "k long, label string, v array<double>")
    rows = vector_graph.shards(vectors, 0.98).collect()
    cells = {}
    for r in rows:
        cells.setdefault(r.cell, []).append(r)
    met, blocks = [[] for _ in m], {r.cell for r in rows if "#" in r.cell}
    assert len(cells) > 3 and (not blocks if kind == "arc" else kind == "groups" or blocks)
    for members in cells.values():
        assert len(members) < 130
        for x in members:
            met[x.k] += [y.k for y in members if x.main and y.k != x.k and (x.side is None or x.side != y.side)]
    for i, others in enumerate(met):
        assert len(set(others)) == len(others)
        assert set(np.flatnonzero(unit @ unit[i] >= 0.98).tolist()) - {i} <= set(others)


def test_gains_against_counting_anew():
    rng = np.random.default_rng(1)
    classes, words = 7, 30
    of = np.append(0, 1 + rng.integers(0, classes - 1, words - 1))
    text = np.concatenate([[0], rng.choice(words, 400, p=np.append(0.1, rng.dirichlet(np.ones(words - 1) * 0.3) * 0.9)), [0]])
    a, b = text[:-1], text[1:]

    def joint(of):
        out = np.zeros((classes, classes))
        np.add.at(out, (of[a], of[b]), 1)
        return out
    after, before = np.zeros((words, classes)), np.zeros((words, classes))
    np.add.at(after, (a, of[b]), 1)
    np.add.at(before, (b, of[a]), 1)
    own = np.bincount(a[a == b], minlength=words).astype(float)
    gain, move = brown.gains(joint(of), of, after, before, own), brown.Mover(joint(of))
    assert own.sum() > 20
    new = move._block(of, after, before, own)
    for w in set(text.tolist()) - {0}:
        want = np.array([brown.likelihood(joint(np.where(np.arange(words) == w, c, of))) for c in range(1, classes)])
        assert np.allclose(gain[w, 1:] - gain[w, of[w]], want - want[of[w] - 1], atol=1e-8)
        assert np.isclose(want[new[w] - 1], want.max())
        if new[w] != of[w]:  # the next block's class bigrams have the move
            one = brown.Mover(joint(of))
            one(*(x[w:w + 1] for x in (of, after, before, own)))
            assert np.array_equal(one.joint, joint(np.where(np.arange(words) == w, new[w], of)))


def _sentences(n: int) -> list[str]:
    """Two kinds of words with the same endings, in places of their own; only the first word of each kind is among the items."""
    rng = np.random.default_rng(4)
    number = [max(0, k) for k in rng.integers(-20, 45, 6 * n).tolist()]
    return [" ".join(f"da n{k}ing" if rng.random() < 0.5 else f"ko v{k}ing" for k in number[6 * i:6 * i + 6]) for i in range(n)]


@pytest.mark.parametrize("head", [30, 1000])
def test_every_word_has_a_class_of_its_own(spark, monkeypatch, head):
    for name, value in (("ITEMS", 4), ("SUFFIXES", 3), ("HEAD", head)):
        monkeypatch.setattr(brown, name, value)
    texts = [*_sentences(300), "", None, "Da n1ing\tda da n1ing n1ing", "new0 da n2ing new1ing new2ing ko"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, "da v1ing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = (F.col("doc_id") % 7 != 2) & (F.col("doc_id") != len(texts) - 1)
    model, scored = brown.trained_and_scored(docs, learn)
    _, others, *_ = brown.learned(docs, learn)
    words, n, of = model.head
    own = {b"": 0} | {w: (int(n[k]), int(of[k])) for k, w in enumerate(words, 1)} | {r.word.encode(): (r.n, r.c) for r in others.collect()}
    own[b""] = (int(n[0]), 0)
    # the words are those of the training texts, and each kind is told apart by where its words are
    lists = [[*(t or "").lower().encode().split(), b""] for _, t in rows]
    train = [d is not None and d % 7 != 2 and d != len(texts) - 1 for d, _ in rows]
    count = Counter(w for ws, t in zip(lists, train, strict=True) for w in ws if t)
    assert {w: k for w, (k, _) in own.items()} == dict(count) and len(model.items.words) <= 4
    kinds = {k: Counter(c for w, (_, c) in own.items() if w.startswith(k) and w not in model.items.words) for k in (b"n", b"v")}
    assert sum((kinds[b"n"] | kinds[b"v"]).values()) > 0.75 * sum((kinds[b"n"] + kinds[b"v"]).values())  # half, if the ending tells
    # scores by the definition, with class bigrams counted here
    joint, types = np.zeros((brown.CLASSES, brown.CLASSES)), Counter(c for _, c in own.values())
    for ws, t in zip(lists, train, strict=True):
        c = [0, *(own[w][1] for w in ws)] if t else [0]
        np.add.at(joint, (c[:-1], c[1:]), 1)
    size, total = joint.sum(axis=0), defaultdict(float)
    assert np.array_equal(size, model.size)
    prior = (size + 1) / (size + 1).sum()
    following = np.log10((joint + brown.MU * prior) / (joint.sum(axis=1, keepdims=True) + brown.MU))
    unseen = np.log10([min(1.0, (model.discount * types[c] + 1) / (size[c] + 1)) for c in range(brown.CLASSES)])
    want = Counter()
    for (d, _), ws in zip(rows, lists, strict=True):
        before = score = 0
        for w in ws:
            k, c = own.get(w, (0, int(model.of[model.items.of(w)])))
            score += following[before, c] + (np.log10((k - model.discount) / (size[c] + 1)) if k else unseen[c])
            before = c
        want[d, len(ws), sum(w in own for w in ws), round(score, 6)] += 1
    for got in (scored, brown.scored(docs, model, others)):
        assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6)) for r in got.collect()) == want
    for k, c in own.values():
        total[c] += (k - model.discount) / (size[c] + 1)
    assert all(np.isclose(x + 10 ** model.unseen[c], 1) for c, x in total.items())
