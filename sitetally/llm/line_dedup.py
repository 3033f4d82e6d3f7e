"""Near-duplicate lines of a corpus, one of each kept. DataFrame functions only.

A line is its text in lower case without outer white space. Its shingles: the ``SHINGLE`` characters from each word start, and
from every other character of a word longer than that, so that all of the line is in some shingle.
Equal lines collapse by a 64-bit hash. The others get ``BANDS`` x ``ROWS`` MinHash values (smallest and greatest of several
hashes of their shingles); lines that agree on a whole band share a bucket, which a pair of similarity 0.8 misses in all bands with
a chance of about (1 - 0.8 ** ROWS) ** BANDS = 0.2 %. Pairs are verified by the exact Jaccard similarity of their shingles.

Every pair of a bucket is tried unless it is one component already or cannot be similar: first every line against the
smallest of its bucket, then all others in buckets of at most ``SMALL`` lines. Larger buckets are cut into cells: with the
shingles in the bucket's order of frequency, rarest first, similar lines share one of their first ``n - ceil(0.8 n) + 1``. Cells
are tried in the same way, those above ``BLOCK`` lines in pairs of blocks, so no task holds a large one.
Sizes and bitmaps of the sets bound what a pair can share; the join that meets two lines tests the bound, so that only pairs which
may be similar become rows, and only those move their sets. The bound excludes no similar pair. Two lines that share several
buckets or cells become a row in the least of them: each line carries its ``LEAST`` least keys, and a pair is left to a lesser
key only if both lines carry it.

NULL text: no lines. Blank lines stay. Rows with equal id and text are one document. Of a component the line with the
smallest (id, line number) stays; NULL ids come first.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import components

SHINGLE = 12
SIMILAR = 0.8
BANDS, ROWS = 6, 2
SMALL = 64
BLOCK = 2048  # lines of a bucket that meet in one place
LEAST = 64  # keys a line carries of the buckets or cells it is in; of longer lists, a pair may be a row more than once
WIDE = 8  # 64-bit words of a line's bitmap
SPACES = " \t\x0b\f\r"
# a match for each shingle: a word of at most SHINGLE characters is passed at once, a longer one by single characters
_SHINGLES = rf"(?s)\s*+(?=(\S.{{0,{SHINGLE - 1}}}+))(?:(?<!\S)\S{{1,{SHINGLE}}}+(?!\S)|\S)"
MARK_BITS = 17  # log2 of the 64-bit words of the bitmap of needed lines: at most 131,072 rows are broadcast


def shingle_hashes(line: Column) -> Column:
    return F.transform(F.regexp_extract_all(line, F.lit(_SHINGLES), F.lit(1)), lambda s: F.xxhash64(s))


def rehashed(hashes: Column) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h))


def bands(bases: list[Column]) -> Column:
    """Band keys from ``BANDS`` arrays of independent hashes of the same shingles. The smallest and the greatest hash of an
    array are two MinHash values; a band joins the smallest of one array with the greatest of the next."""
    return F.array(*(F.xxhash64(F.lit(b), F.array_min(bases[b]), F.array_max(bases[(b + 1) % BANDS])) for b in range(BANDS)))


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``line_no``, ``line``, ``body`` (as compared) of every line."""
    lines = docs.select("doc_id", F.xxhash64(text).alias("mark"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.withColumn("body", F.lower(F.btrim("line", F.lit(SPACES))))


def shingle_sets(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """``id``, ``s`` of the lines in ``ids``. A bitmap of fixed size leaves out most others before anything is shuffled."""
    place = F.pmod("id", F.lit(64 << MARK_BITS))
    bits = ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    marked = lines.select(F.xxhash64("body").alias("id"), "body").withColumn("p", place)
    some = marked.join(F.broadcast(bits), F.shiftright("p", 6) == F.col("w")).where("bit_get(b, cast(p & 63 AS int)) = 1")
    once = some.groupBy("id").agg(F.first("body").alias("body")).join(ids, "id", "left_semi")
    return saved(once.select("id", F.array_distinct(shingle_hashes(F.col("body"))).alias("s")), "sets")


def marks_of(sets: DataFrame) -> DataFrame:
    """``id``, ``n`` (shingles), ``w``: the set as a bitmap of ``WIDE`` 64-bit words, ``spare``: shingles without a bit of their own."""
    bit = F.expr("shiftleft(1L, cast(h & 63 AS int))")
    words = [F.coalesce(F.bit_or(F.when(F.pmod(F.shiftright("h", 6), F.lit(WIDE)) == k, bit)), F.lit(0).cast("long")) for k in range(WIDE)]
    one = sets.select("id", F.explode("s").alias("h")).groupBy("id").agg(F.count("*").cast("int").alias("n"), F.array(*words).alias("w"))
    return saved(one.withColumn("spare", F.col("n") - reduce(add, (F.bit_count(F.col("w")[k]) for k in range(WIDE)))), "marks")


def _possible(x: str, y: str) -> Column:
    """Whether two sets with marks may be similar; never false for a pair that is. The shared ones have a bit in both, but for
    those without a bit of their own. Each word is counted once: the code of a join's condition must stay small to run fast."""
    m, n = F.col(f"{x}.n"), F.col(f"{y}.n")
    both = reduce(add, (F.bit_count(F.col(f"{x}.w")[k].bitwiseAND(F.col(f"{y}.w")[k])) for k in range(WIDE)))
    fewest = SIMILAR / (1 + SIMILAR) * (m + n) - 1e-6
    return (m >= SIMILAR * n) & (n >= SIMILAR * m) & (both + F.least(f"{x}.spare", f"{y}.spare") >= fewest)


def _bounded(marks: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""
    left = pairs.join(marks.withColumnRenamed("id", "a"), "a").alias("x")
    right = marks.withColumnRenamed("id", "b").alias("y")
    return left.join(right, (F.col("x.b") == F.col("y.b")) & _possible("x", "y")).select("x.a", "x.b")


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= SIMILAR * (F.size("x") + F.size("y") - common)).select("a", "b")


def _grouped(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (``key``, ``id``) of buckets that hold several components ``c``, and the bucket's ``size``. Of buckets with
    the same lines one stays."""
    of = components(links)
    rows = saved(members.join(of, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c")), "buckets")
    open_ = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size"),
                                    F.bit_xor(F.xxhash64("id")).alias("same")).where("lo != hi")
    open_ = open_.groupBy("same", "size").agg(F.min("key").alias("key"))
    return saved(rows.join(open_.select("key", "size"), "key"), "buckets")


def _leaders(members: DataFrame) -> DataFrame:
    lead = members.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a != z").select("key", "a")
    return members.join(lead, "key").where("id != a").select("a", F.col("id").alias("b")).distinct()


def _all_pairs(members: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of different components of each bucket that bitmaps do not rule out. The join itself tests them, so what it makes are
    the pairs left, each in the least bucket that both lines carry; a bucket of more than ``BLOCK`` lines is visited by pairs of
    blocks."""
    keys = members.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("key")), 1, LEAST).alias("keys"))
    blocks = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK)).join(keys, "id").join(marks, "id")
    one = blocks.where("blocks = 1").withColumns({"own": F.lit(0).cast("long"), "k": F.lit(0).cast("long")})
    more = blocks.where("blocks > 1").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn(
        "k", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = saved(one.unionByName(more).select(
        "key", F.least("own", "k").alias("p"), F.greatest("own", "k").alias("q"), (F.col("own") > F.col("k")).alias("right"),
        "id", "c", "keys", "n", "w", "spare"), "dealt")
    # as many tasks as the session shuffles to: the rows are few, what they meet is not
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = dealt.where("not right").repartition(tasks, "key", "p", "q").alias("x")
    y = dealt.where("right or p = q").repartition(tasks, "key", "p", "q").alias("y")
    same = reduce(and_, (F.col(f"x.{k}") == F.col(f"y.{k}") for k in ("key", "p", "q")))
    once = ((F.col("x.p") < F.col("x.q")) | (F.col("x.id") < F.col("y.id"))) & (F.col("x.c") != F.col("y.c"))
    here = F.coalesce(F.array_min(F.array_intersect("x.keys", "y.keys")) >= F.col("x.key"), F.lit(True))
    pairs = x.join(y, same & once & _possible("x", "y") & here)
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _cells(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``key``, ``id`` of the cells of buckets: one for each of the rarest shingles of a line."""
    of = saved(members.select("key", "id").join(sets, "id").select("key", "id", F.size("s").alias("n"), F.explode("s").alias("s")), "cells")
    often = of.groupBy("key", "s").agg(F.count("*").alias("lines"))
    place = F.row_number().over(Window.partitionBy("key", "id").orderBy("lines", "s"))
    first = of.join(often, ["key", "s"]).withColumn("place", place).where(
        (F.col("place") <= F.col("n") - F.ceil(SIMILAR * F.col("n") - 1e-6) + 1) & (F.col("lines") > 1))
    return first.select(F.xxhash64("key", "s").alias("key"), "id").distinct()


def similar_lines(lines: DataFrame, hashed: DataFrame) -> DataFrame:
    """Verified links (``a``, ``b``) between ids of different lines. ``hashed``: ``id``, ``bands``, any number of times."""
    one = hashed.groupBy("id").agg(F.first("bands").alias("bands"))
    every = one.select(F.explode("bands").alias("key"), "id")
    held = every.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("key")
    members = saved(every.join(held, "key"), "buckets")
    sets = shingle_sets(lines, members.select("id").distinct())
    marks = marks_of(sets)
    links = saved(_verified(sets, saved(_bounded(marks, _leaders(members)), "pairs")), "links")
    members = _grouped(members, links)
    cells = saved(_cells(members.where(F.col("size") > SMALL), sets), "cells")
    pairs = _all_pairs(members.where(F.col("size") <= SMALL), marks).unionByName(_bounded(marks, _leaders(cells))).distinct()
    links = saved(links.unionByName(_verified(sets, saved(pairs, "pairs"))), "links")
    if not cells.isEmpty():
        pairs = _all_pairs(_grouped(cells, links), marks).distinct().join(links, ["a", "b"], "left_anti")
        links = links.unionByName(saved(_verified(sets, saved(pairs, "pairs")), "links"))
    return links


def judged_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``mark``, ``line_no``, ``id``, ``chars``, ``kept`` of every line; blank lines have no id."""
    lines = lines_of(docs.select("doc_id", F.col(text).alias("text")))
    filled = F.col("body") != ""
    hashed = lines.withColumn("h0", F.when(filled, shingle_hashes(F.col("body"))))
    for k in range(1, BANDS):  # steps of their own: bands use each array often
        hashed = hashed.withColumn(f"h{k}", rehashed(F.col(f"h{k - 1}")))
    rows = saved(hashed.select(
        "doc_id", "mark", "line_no", F.length("line").alias("chars"), F.when(filled, F.xxhash64("body")).alias("id"),
        F.when(filled, bands([F.col(f"h{k}") for k in range(BANDS)])).alias("bands")), "lines")
    links = similar_lines(lines.where(filled), rows.where("id is not null"))
    of = components(links)
    place = F.struct("doc_id", "mark", "line_no")
    named = rows.drop("bands").join(of.select("id", "component"), "id", "left").withColumn("c", F.coalesce("component", "id"))
    first = named.where("c is not null").groupBy("c").agg(F.min(place).alias("first"))
    return named.join(first, "c", "left").select(
        "doc_id", "mark", "line_no", "id", "chars",
        F.coalesce(place.eqNullSafe(F.col("first")) | F.col("c").isNull(), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the lines that stay; every row and every other column is kept as it is."""
    gone = judged_lines(docs, text).where("not kept").groupBy("doc_id", "mark").agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("__st_id"), F.col("mark").alias("__st_of"), F.col("_gone").alias("__st_gone"))
    marked = docs.withColumn("__st_mark", F.xxhash64(text))
    joined = marked.join(gone, F.col("doc_id").eqNullSafe(F.col("__st_id")) & (F.col("__st_mark") == F.col("__st_of")), "left")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, k: ~F.array_contains("__st_gone", k)), "\n")
    return joined.withColumn(text, F.when(F.col("__st_gone").isNull(), F.col(text)).otherwise(left)).select(*docs.columns)
