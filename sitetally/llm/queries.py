"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    brown, fill_middle, html_model, imatch, language, licences, line_dedup, packing, quality, sentencepiece_scan, signature_join, turn_repair,
    vector_graph,
)
from .common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return register


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``SITETALLY_VOCABULARIES`` names another folder."""
    if folder := os.environ.get("SITETALLY_VOCABULARIES"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_brown_lm")
def op1_brown_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, rows = brown.trained_and_scored(docs, remainder("doc_id", 7) != 2)
    return rows.select(
        "doc_id", F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


@query("op2_html_model")
def op2_html_model(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_model.extracted(pages, html_model.trained(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op3_sentencepiece_scan")
def op3_sentencepiece_scan(spark, sf_dir):
    """Per document: pieces, chunks, sum of scores, a digest of the ids, and whether decoding gives the text as the file
    normalises it (so a text with U+2581, or with runs of spaces, comes back normalised)."""
    rows = sentencepiece_scan.encoded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    sums = rows.groupBy("doc", "mark").agg(
        F.sum(F.size("ids").cast("long")).alias("n_pieces"), F.max("n_chunks").cast("long").alias("n_chunks"),
        F.sum("score").alias("score"), F.bit_xor(F.xxhash64("k", "ids")).alias("ids_digest"), F.every("round_trip").alias("round_trip"))
    return sums.select(F.col("doc").alias("doc_id"), "n_pieces", "n_chunks", "score", "ids_digest", "round_trip")


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 0
    model = language.fitted(docs.where(~held_out))
    return language.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: a folder for each source, language and order of length; a short text that speaks of a licence
    stands for the licence file of its source and language."""
    name, base = F.col("doc_id").cast("string"), F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("und")))
    is_licence = (F.length("text") < 400) & F.lower("text").contains("licen")
    order = F.floor(F.log2(F.coalesce(F.length("text"), F.lit(0)) + 1)).cast("string")
    path = F.when(is_licence, F.concat(base, F.lit("/LICENSE-"), name)).otherwise(F.concat(base, F.lit("/"), order, F.lit("/"), name))
    return docs.select("doc_id", path.alias("path"), "text")


_TEMPLATE_ROWS = ", ".join(f"('{n}', {k}, '{t}', {licences._terms(x).count(t)})" for n, texts in licences.TEMPLATES.items()
                           for k, x in enumerate(texts) for t in sorted(set(licences._terms(x))))
_SPLIT = r"list_filter(list_transform(string_split_regex(lower({0}), '[^a-z0-9.\-]+'), lambda w: trim(w, '.-')), lambda w: w != '')"
OP5_SQL = rf"""
WITH t(licence, k, term, n) AS (VALUES {_TEMPLATE_ROWS}),
d AS (SELECT doc_id, text, coalesce(source, 'none') || '/' || coalesce(lang, 'und') AS base, length(text) < 400 AND
      lower(text) LIKE '%licen%' AS is_licence, floor(log2(coalesce(length(text), 0) + 1))::INT::VARCHAR AS ord FROM documents),
f AS (SELECT *, CASE WHEN is_licence THEN base || '/LICENSE-' || doc_id ELSE base || '/' || ord || '/' || doc_id END AS path,
      CASE WHEN is_licence THEN base ELSE base || '/' || ord END AS dir FROM d),
df AS (SELECT term, count(DISTINCT doc_id) AS c FROM (SELECT doc_id, unnest(list_distinct({_SPLIT.format('text')})) AS term FROM f)
       WHERE term IN (SELECT term FROM t) GROUP BY term),
total AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT v.term, ln((1 + total.n) / (1 + coalesce(c, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM t) v LEFT JOIN df USING (term), total),
q AS (SELECT licence, k, term, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY licence, k)) AS q FROM t JOIN idf USING (term)),
s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS statement FROM f UNION ALL SELECT doc_id, text FROM f WHERE is_licence),
b AS (SELECT DISTINCT statement FROM s),
c AS (SELECT statement, term, count(*) AS n FROM (SELECT statement, unnest({_SPLIT.format('statement')}) AS term FROM b) GROUP BY ALL),
w AS (SELECT statement, c.term, c.n * coalesce(idf, (SELECT ln(1 + n) + 1 FROM total)) AS w FROM c LEFT JOIN idf ON idf.term = c.term),
norm AS (SELECT statement, sqrt(sum(w * w)) AS norm FROM w GROUP BY statement),
score AS (SELECT statement, licence, round(sum(w * q) / any_value(norm), 6) AS score FROM w JOIN q USING (term) JOIN norm USING (statement)
          GROUP BY statement, licence, k),
own AS (SELECT doc_id, licence, score FROM s JOIN score USING (statement) WHERE score >= {licences.ACCEPT}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
per_dir AS (SELECT dir, licence, score FROM f JOIN own USING (doc_id) WHERE is_licence
        QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, licence) = 1),
near AS (SELECT f.doc_id, p.dir, p.licence, p.score FROM f JOIN per_dir p ON f.dir = p.dir OR starts_with(f.dir, p.dir || '/')
        QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(p.dir) DESC) = 1)
SELECT f.doc_id, path, coalesce(own.licence, near.licence) AS licence, coalesce(own.score, near.score) AS score,
  CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN near.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN own.licence IS NULL THEN near.dir END AS origin_dir FROM f LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)"""


@query("op5_licence_scan", OP5_SQL)
def op5_licence_scan(spark, sf_dir):
    files = document_files(table(spark, sf_dir, "documents"))
    return licences.scanned(files, key="doc_id").withColumnRenamed("key", "doc_id")


_WORD = r"'[^\x20\x09-\x0D]+'"
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, {_WORD}) AS words FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM w, unnest(range(1, len(words) - 3)) u(i)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM rep, unnest(range(0, 5)) v(k) GROUP BY doc_id),
raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (SELECT doc_id, line, count(*) AS n FROM raw
        WHERE regexp_matches(line, {_WORD}) GROUP BY doc_id, line) GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, len(regexp_extract_all(line, {_WORD})) AS n, translate(translate(
          array_to_string(regexp_extract_all(line, {_WORD}), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '123456789', '000000000') AS line FROM raw WHERE regexp_matches(line, {_WORD})),
hosts AS (SELECT source, greatest({quality.LINE_DOCS}, count(DISTINCT text) * {quality.LINE_SHARE}) AS most FROM d GROUP BY source),
shared AS (SELECT l.source, line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
           GROUP BY l.source, line, most HAVING count(DISTINCT text) > most),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n FROM lines l WHERE EXISTS (SELECT 1 FROM shared s
         WHERE s.source IS NOT DISTINCT FROM l.source AND s.line = l.line) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
  (length(w.text) - len(regexp_extract_all(w.text, '[\x20\x09-\x0D]')))::BIGINT AS word_chars,
  len(regexp_extract_all(w.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
  coalesce(repeated.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS shared_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEATED_PERCENT} * n_words)
  AND n_words - shared_words >= {quality.MIN_WORDS} AND n_words - shared_words >= {quality.MIN_LEFT} * n_words AS kept FROM f"""


@query("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def reach_sql(vertices: str, edges: str) -> str:
    """``id``, ``low``: smallest vertex reachable; CTEs ``reach`` from relations of (id) and of (a, b), both ways."""
    return f"""reach(id, low) AS (SELECT id, id FROM {vertices} UNION
      SELECT e.b, r.low FROM reach r JOIN {edges} e ON e.a = r.id WHERE r.low < e.b),
    lowest AS (SELECT id, min(low) AS low FROM reach GROUP BY id)"""


OP7_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(2, len(words) - 3))) u(i)
      WHERE len(words) > 0),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id != y.doc_id
      GROUP BY ALL) p JOIN n i ON i.doc_id = p.a JOIN n j ON j.doc_id = p.b WHERE 100 * c >= 80 * (i.n + j.n - c)),
v AS (SELECT doc_id AS id FROM documents), {reach_sql('v', 'e')}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low AS component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN lowest ON lowest.id = d.doc_id"""


@query("op7_signature_join", OP7_SQL)
def op7_signature_join(spark, sf_dir):
    return signature_join.linked(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    lines = line_dedup.judged_lines(table(spark, sf_dir, "documents"))
    kept = F.when(F.col("kept"), 1).otherwise(0)
    return lines.groupBy("doc_id", "mark").agg(
        F.count("*").alias("n_lines"), F.sum(kept.cast("long")).alias("n_kept"),
        F.sum((kept * F.col("chars")).cast("long")).alias("kept_chars"),
        F.sum(F.when(F.col("kept"), F.crc32(F.concat_ws(" ", "line_no", "id").cast("binary"))).otherwise(0)).alias("kept_sum")
    ).drop("mark")


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


OP10_SQL = f"""
WITH RECURSIVE x AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda q: q IS NULL OR NOT isfinite(q))) = 0 AND list_aggregate(embedding, 'max') IS NOT NULL
  AND (list_aggregate(embedding, 'max') != 0 OR list_aggregate(embedding, 'min') != 0)),
e AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM x p JOIN x q ON p.label = q.label AND p.vec_id != q.vec_id
  WHERE list_cosine_similarity(p.v, q.v) >= {vector_graph.LIMIT}),
v AS (SELECT vec_id AS id FROM embeddings), {reach_sql('v', 'e')}
SELECT d.vec_id, (SELECT count(*) FROM e WHERE e.a = d.vec_id) AS n_links, low AS component_id, d.vec_id = low AS kept
FROM embeddings d JOIN lowest ON lowest.id = d.vec_id"""


@query("op10_vector_graph", OP10_SQL)
def op10_vector_graph(spark, sf_dir):
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{M}}\p{{N}}]+')"
_HEX = "('0x' || sha256(term)[{0}:{1}])::BIGINT"
_DEPTH = "1 + " + " + ".join(f"({_HEX.format(9, 16)} % {4 ** k} = 0)::INT" for k in range(1, imatch.STEPS))
_ENTRY = "printf('%03d:%d:%s', ({0})::INT, ({1})::INT, md5({2})[1:8])"
_NEAR = ("round(2 * coalesce(list_sum([1.0::DOUBLE / split_part(e, ':', 2)::INT FOR e IN list_sort(list_intersect({0}, {1}))]), 0) / "
         "(list_sum([1.0::DOUBLE / split_part(e, ':', 2)::INT FOR e IN {0}]) + list_sum([1.0::DOUBLE / split_part(e, ':', 2)::INT FOR e IN {1}])), 6)")
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER w AS pos, coalesce(lead(coalesce(text, '')) OVER w,
  first_value(coalesce(text, '')) OVER w) AS next FROM documents WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
s AS (SELECT pos, 0 AS side, text AS body FROM d UNION ALL
  SELECT pos, 1, left(text, length(text) - length(text) // 2) || left(next, length(text) // 2) FROM d),
b AS (SELECT body, {_WORDS.format('body')} AS words FROM (SELECT DISTINCT body FROM s)),
df AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({_WORDS.format('text')})) AS term FROM d) GROUP BY term),
lex AS (SELECT term, {_HEX.format(1, 8)} % {imatch.PARTS} AS part, {_DEPTH} AS depth FROM df, (SELECT count(*) AS total FROM d)
  WHERE n >= {imatch.LEAST_DOCS} AND n * {imatch.RAREST} >= total AND n * {imatch.COMMONEST} <= total),
k AS (SELECT body, term, part, depth FROM (SELECT body, unnest(list_distinct(words)) AS term FROM b) JOIN lex USING (term)),
parts AS (SELECT body, part, step, count(*) AS n, string_agg(term, ' ' ORDER BY term) AS kept FROM k, generate_series(1, {imatch.STEPS}) g(step)
  WHERE depth >= step GROUP BY ALL),
whole AS (SELECT body, sum(n) AS n, string_agg(md5(kept), ' ' ORDER BY part) AS kept FROM parts WHERE step = 1 GROUP BY body),
e AS (SELECT body, {_ENTRY.format(f'1 + part * {imatch.STEPS} + step - 1', 'n', 'kept')} AS entry FROM parts UNION ALL
  SELECT body, {_ENTRY.format('0', 'n', 'kept')} FROM whole UNION ALL
  SELECT body, {_ENTRY.format('0', 'greatest(len(list_distinct(words)), 1)', "CASE WHEN len(words) > 0 THEN array_to_string(words, ' ') ELSE body END")}
  FROM b WHERE body NOT IN (SELECT body FROM whole)),
f AS (SELECT body, list(entry ORDER BY entry) AS fp FROM e GROUP BY body),
r AS (SELECT d.doc_id, length(d.text)::BIGINT AS n_chars, e.body AS edited, x.fp AS a, y.fp AS b, z.fp AS c
  FROM d JOIN s e ON e.pos = d.pos AND e.side = 1 JOIN f x ON x.body = d.text JOIN f y ON y.body = e.body JOIN f z ON z.body = d.next)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(a, ' ') AS fingerprint, array_to_string(b, ' ') AS edited_fingerprint,
  {_NEAR.format('a', 'b')} AS near_edited, {_NEAR.format('a', 'c')} AS near_next FROM r"""


@query("op11_imatch", OP11_SQL)
def op11_imatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.fingerprints(docs, imatch.lexicon(docs))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations with faults, by a hash of conversation and turn: rows dropped, emptied, cut, repeated, given to the user."""
    rows = turns.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = rows.withColumn("dice", F.crc32(place.cast("binary")) % 20).where("dice != 0")
    text = F.when(F.col("dice") == 1, "").when(F.col("dice") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("dice") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.when(F.col("dice") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


@query("op12_turn_repair")
def op12_turn_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = turn_repair.repaired(damaged_turns(turns))
    every = turns.select(F.col("conv_id").alias("own")).distinct()
    figures = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("own").alias("conv_id"), *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in figures),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_FIM = [f"('0x' || sha256('{fill_middle.SEED}:' || coalesce(doc_id::VARCHAR, ''))[{1 + 8 * i}:{8 + 8 * i}])::BIGINT" for i in range(4)]
OP13_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  {', '.join(f'{h} AS h{i + 1}' for i, h in enumerate(_FIM))} FROM documents),
c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {fill_middle.CHANGED_PERCENT}
  THEN 'plain' WHEN h4 % 100 < {fill_middle.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


@query("op13_fill_middle", OP13_SQL)
def op13_fill_middle(spark, sf_dir):
    rows = fill_middle.transformed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
