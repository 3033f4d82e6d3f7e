"""I-Match fingerprints: the terms of a text within a band of inverse document frequency, sorted and hashed, for the whole
lexicon and for many random parts of it.

Terms are runs of letters, marks and digits in lower case. A term is in the lexicon if at least ``LEAST_DOCS`` texts hold it
and its frequency is between one text in ``RAREST`` and one in ``COMMONEST`` (so the inverse frequency lies between the
logarithms of the two). The lexicon is dealt at random into ``PARTS`` parts, and each part thinned to a quarter ``STEPS - 1``
times, by the digits of a term's SHA-256. A fingerprint has one entry for the whole lexicon and one for each part and step that
keeps a term of the text: its number, how many terms it keeps, and a hash of them in order. Dense parts agree for texts that
are almost equal only, thin ones for texts that share much of their terms; ``likeness`` is the share of entries that agree,
each weighing one over the terms it keeps.

The lexicon has at most ``RAREST`` times the average number of distinct terms of a text, whatever the corpus; it is
broadcast only after a count of its rows, and joined by a shuffle beyond ``MOST_BROADCAST``. Texts are shuffled once, into
buckets of consecutive ids; the first text of a bucket also goes to the one before it, and everything after that stays there.

No term in the lexicon: the first entry is a hash of all words in order, or of the text if there is none; so equal texts always have
equal fingerprints. NULL text: read as empty. NULL id: comes last. Rows with the same id are ordered by text, and an id (or
NULL) that fills more than a bucket is split by a hash of the text. Repeated rows get equal results. An empty table gives no
rows. Extra columns are not read, so their names do not matter.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

GAP = r"[^\p{L}\p{M}\p{N}]+"
LEAST_DOCS, RAREST, COMMONEST = 2, 5000, 20
PARTS, STEPS = 32, 5
MOST_BROADCAST = 2_000_000
BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 100_000
TIE_DIGITS = 7


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAP), "")


def place(term: Column) -> tuple[Column, Column]:
    """Part of the lexicon that a term is in, and the number of steps (at least one) after which it is still there."""
    digest = F.sha2(term, 256)
    digits = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    depth = F.lit(1)
    for step in range(1, STEPS):
        depth = F.when(digits % 4 ** step == 0, step + 1).otherwise(depth)
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % PARTS).cast("int"), depth


def lexicon(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term``, ``part``, ``depth`` of the terms within the band, written."""
    total = docs.count()
    found = docs.select(F.explode(F.array_distinct(words_of(F.col(text)))).alias("term")).groupBy("term").agg(F.count("*").alias("docs"))
    band = (F.col("docs") >= LEAST_DOCS) & (F.col("docs") * RAREST >= total) & (F.col("docs") * COMMONEST <= total)
    part, depth = place(F.col("term"))
    return saved(found.where(band).select("term", part.alias("part"), depth.alias("depth")), "lexicon")


def _bounds(docs: DataFrame) -> tuple[list[int], int]:
    """Ids, falling, at which a new bucket begins, and the number of buckets for rows without an id."""
    spark = docs.sparkSession
    size = docs.agg(F.count("*"), F.count("id"), F.sum(F.octet_length("text"))).head()
    rows, with_id, stored = size[0], size[1], size[2] or 0
    wanted = max(stored // BUCKET_BYTES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    buckets = max(1, min(wanted, MOST_BUCKETS, rows // 16))
    own = ceil(buckets * with_id / rows) if rows else 1
    if own < 2:
        return [], buckets - own
    shares = [i / own for i in range(1, own)]
    return sorted(docs.agg(F.percentile_approx("id", shares, 10 * own)).head()[0], reverse=True), buckets - own


def _literal(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _above(id_: Column, bounds: list[int]) -> Column:
    """How many bounds (falling) are greater than an id: first among every so many of them, then in one stretch."""
    def greater(part: Column) -> Column:
        return F.size(F.filter(part, lambda b: b > id_))
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    coarse = greater(_literal(bounds[::step]))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    return start + greater(F.slice(_literal(bounds), start + 1, F.lit(step)))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows of (id, text) as ``bucket``, ``pos``, ``guest``, ``id``, ``text``, ``next`` by falling id; the last row's next
    is the first. In each bucket the first row of the following one comes last, as a guest."""
    docs = docs.withColumn("tie", F.md5("text"))
    bounds, without_id = _bounds(docs)
    equal = F.size(F.filter(_literal(bounds), lambda b: b == F.col("id"))) if len(set(bounds)) < len(bounds) else F.lit(0)
    parts = F.when(F.col("id").isNull(), F.lit(max(without_id, 1))).otherwise(equal + 1)
    split = F.floor(F.conv(F.substring("tie", 1, TIE_DIGITS), 16, 10).cast("long") * parts / 16 ** TIE_DIGITS)
    first = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(_above(F.col("id"), bounds))
    order = ["no_id", "falling", "tie"]
    rows = docs.select("*", (first + split).cast("int").alias("bucket"), F.col("id").isNull().alias("no_id"),
                       F.bitwise_not(F.col("id")).alias("falling"))
    heads = sorted((r.bucket, r.head) for r in rows.groupBy("bucket").agg(F.min(F.struct(*order)).alias("head")).collect())
    guests = docs.sparkSession.createDataFrame(
        [(heads[i - 1][0], b, *h) for i, (b, h) in enumerate(heads)], "host int, bucket int, no_id boolean, falling long, tie string")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("bucket", *order)]
    rows = rows.alias("r").join(F.broadcast(guests).alias("h"), same[0] & same[1] & same[2] & same[3], "left")
    own, guest = (F.struct(b.alias("bucket"), F.lit(g).alias("guest")) for b, g in ((F.col("r.bucket"), False), (F.col("host"), True)))
    places = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    rows = rows.select(*(F.col(f"r.{c}") for c in ("id", "text", *order)), F.inline(places))
    by = Window.partitionBy("bucket").orderBy("guest", *order)
    return rows.select("bucket", "guest", "id", "text", F.row_number().over(by).alias("pos"), F.lead("text").over(by).alias("next"))


def entry(number: Column, n: Column, digest: Column) -> Column:
    """An entry as text, and what it weighs."""
    return F.struct(F.format_string("%03d:%d:%s", number, n, F.substring(digest, 1, 8)).alias("text"), (1.0 / n).alias("weight"))


def part_entries(rows: DataFrame, by: list[str], carried: list[str]) -> DataFrame:
    """One row per text and part: its terms ``n``, their ``digest``, and the entries of all steps that keep one."""
    term = F.when(F.col("part").isNotNull(), F.struct("term", "depth"))
    parts = rows.groupBy(*by, "part").agg(F.sort_array(F.collect_list(term)).alias("left_1"), *(F.max(c).alias(c) for c in carried))
    entries = []
    for step in range(1, STEPS + 1):
        left = F.col(f"left_{step}")
        entries.append(F.when(F.size(left) > 0, entry(1 + F.col("part") * STEPS + (step - 1), F.size(left), F.md5(F.array_join(left["term"], " ")))))
        if step < STEPS:
            parts = parts.withColumn(f"left_{step + 1}", _deeper(left, step + 1))
    return parts.select(*by, "part", *carried, F.size("left_1").alias("n"), F.md5(F.array_join(F.col("left_1")["term"], " ")).alias("digest"),
                        F.array_compact(F.array(*entries)).alias("entries"))


def _deeper(terms_left: Column, least: int) -> Column:
    return F.filter(terms_left, lambda t: t["depth"] >= least)


def with_entries(rows: DataFrame, by: list[str], carried: list[str]) -> DataFrame:
    """One row per text with its ``fp``: texts of its entries in order, and their total ``weight``.

    ``rows``: terms of a text with their ``part`` and ``depth``, NULL outside the lexicon; ``whole`` and ``n_terms`` on some.
    """
    parts = part_entries(rows, by, carried)
    found = parts.groupBy(*by).agg(
        F.flatten(F.collect_list("entries")).alias("entries"), F.sum("n").alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("part", "digest")))).alias("digests"), *(F.max(c).alias(c) for c in carried))
    first = F.when(F.col("n") > 0, entry(F.lit(0), F.col("n"), F.md5(F.array_join(F.col("digests")["digest"], " ")))).otherwise(
        entry(F.lit(0), F.greatest("n_terms", F.lit(1)), F.col("whole")))
    found = found.withColumn("entries", F.sort_array(F.concat(F.array(first), "entries")))
    weight = F.aggregate("entries", F.lit(0.0), lambda s, e: s + e["weight"])
    return found.select(*by, *carried, F.struct(F.col("entries")["text"].alias("entries"), weight.alias("weight")).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: the weight of the entries that both have, of the weight of all."""
    same = F.aggregate(F.array_intersect(a["entries"], b["entries"]), F.lit(0.0),
                       lambda s, e: s + 1.0 / F.substring_index(F.substr(e, F.lit(5)), ":", 1).cast("int"))
    return F.round(2 * same / (a["weight"] + b["weight"]), 6)


def fingerprints(docs: DataFrame, words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars``, ``edited`` digest, fingerprints of the text and of its edited form, and their likenesses.

    The edited form has its last half replaced by the beginning of the next text, by falling id. ``words``: a lexicon.
    """
    rows = in_order(docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    rows = rows.select("bucket", "pos", "guest", "id", n.alias("n_chars"), "text", edited.alias("edited"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))
    rows = rows.select("bucket", "pos", "guest", "id", "n_chars", F.inline(F.when(F.col("guest"), F.slice(sides, 1, 1)).otherwise(sides)))
    rows = rows.withColumn("words", words_of(F.col("body"))).withColumn("terms", F.array_distinct("words"))
    whole = F.when(F.size("words") > 0, F.md5(F.array_join("words", " "))).otherwise(F.md5("body"))
    rows = rows.select("bucket", "pos", "side", "guest", "id", "n_chars", F.when(F.col("side") == 1, F.sha2("body", 256)).alias("sha"),
                       whole.alias("whole"), F.size("terms").alias("n_terms"), F.posexplode_outer("terms").alias("at", "term"))
    once = F.coalesce(F.col("at") == 0, F.lit(True))
    carried = ["guest", "id", "n_chars", "sha", "whole", "n_terms"]
    rows = rows.select("bucket", "pos", "side", "term", once.alias("once"), *(F.when(once, F.col(c)).alias(c) for c in carried))
    if words.count() <= MOST_BROADCAST:
        words = F.broadcast(words)
    found = rows.join(words, "term", "left").where(F.col("once") | F.col("part").isNotNull())
    found = with_entries(found, ["bucket", "pos", "side"], carried)
    by = Window.partitionBy("bucket").orderBy("pos", "side")
    found = found.select("*", F.lead("fp", 1).over(by).alias("fp_edited"), F.lead("fp", 2).over(by).alias("fp_next"),
                         F.lead("sha", 1).over(by).alias("edited_sha256")).where("side = 0 and not guest")
    return found.select(
        F.col("id").alias(key), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        F.array_join("fp.entries", " ").alias("fingerprint"), F.array_join("fp_edited.entries", " ").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("fp_edited")).alias("near_edited"), likeness(F.col("fp"), F.col("fp_next")).alias("near_next"))
