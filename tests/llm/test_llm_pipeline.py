"""The pipeline on the test tables: what every stage keeps, and the packed result."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from conftest import SF_DIR
from pyspark.sql import functions as F

from sitetally.llm.common import saved


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_DIR), "stage")
        now = docs.count()
        assert docs.columns == columns and 0 < now <= before, name
        before = now
    texts = [set(zip(*(w[i:] for i in range(5)))) for w in (r.text.lower().split() for r in docs.select("text").collect()) if len(w) > 4]
    of = Counter(x for s in texts for x in s)
    for a, s in enumerate(texts):  # no near copies are left
        if sum(of[x] > 1 for x in s) >= 0.8 * len(s):
            assert all(len(s & t) < 0.8 * len(s | t) for t in texts[:a])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == before


def test_extra_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    extra = ("score", "lang_pred", "_text", "_mark", "mark", "line_no", "id", "kept", "component_id", "f", "n", "words")
    docs = docs.withColumns({c: F.lit(c) for c in extra} | {"raw": F.encode(F.lit("\u00e9"), "ISO-8859-1"), "t": F.array("doc_id")})
    docs = docs.withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_DIR), "stage")
        row = docs.first()
        assert all(row[c] == c for c in extra) and row["t"] == [row["doc_id"]] and bytes(row["raw"]) == b"\xe9", name
    assert docs.where("lang is null").isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0


def test_run_twice_gives_the_same(spark):
    def rows():
        return Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    first = rows()
    assert first and {d for d, *_ in first} == {d for d, *_ in rows()}


def test_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_DIR), "stage")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0
