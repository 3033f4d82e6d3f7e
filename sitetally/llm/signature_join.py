"""Similarity join of documents on word shingles, by signature trees.

A document's set: its distinct shingles of ``WORDS`` words as 64-bit hashes. Two sets link when their Jaccard similarity is
at least ``PERCENT`` / 100. Equal sets collapse first, so copies cost one row each.

* *Cells.* In a global order of shingles (frequent ones last), linked sets share one of their first
  ``n - ceil(0.8 n) + 1`` shingles. Every set goes to the cells of those; cells with one set are dropped. A cell is named by
  ``CELL_BITS`` bits of its shingle's hash.
* *Leaders.* Each set of a cell is tried against the cell's first set if their sizes allow a link. That joins groups of near copies in one round,
  in rows proportional to the memberships and not to their squares.
* *Trees.* In cells that still hold two components, sets form a tree by size: each node has the OR (and AND) of its
  members' bitmaps, the range of their sizes and of their components. Two nodes are visited together; a pair of nodes is
  left out if all its members are one component already, or if the greatest overlap that sizes and bitmaps allow is too
  small. Cells beyond ``BLOCK`` members are cut into blocks; a task visits two blocks at a time. Two sets that share many cells
  are a pair in the least of them: each set carries its ``LEAST`` least cells, and nodes whose members all carry a lesser one
  are left to that.
* Pairs that remain are tried by wider bitmaps, of which a set sends one to a place and not one a pair. Those left are verified
  exactly on the whole sets, and components are taken over all verified links.

Nothing is lost: a linked pair shares a cell; there it is either in one component already or visited by the trees, whose
bounds never exclude it. The order of shingles comes from a sample of 1 in ``ORDER_SAMPLE`` documents; any order is right.

NULL or blank text: the empty set, linked with nothing. NULL id: a row of its own, component NULL. Rows that share an id
are judged one by one. Sets are known by a 64-bit hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import compress, decompress

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, map_rows, saved, windows, word_hashes
from .components import components

WORDS = 5
PERCENT = 80
BITS = 2048
LEAF, FAN = 8, 8
BLOCK = 2048
PLACE, SPREAD = 4096, 4  # sets of a block whose wide bitmaps meet those of another, and the fewest blocks
CELL_BITS = 48  # of a shingle's hash that name a cell; shingles that agree in them share one, which only adds tries
LEAST, SEEN = 8, 512  # lesser cells that a set carries, and that a task tells apart; beyond, a pair may be there more than once
MARK_BITS = 18  # log2 of the 64-bit words of the bitmap of needed texts: 2 MB
ORDER_SAMPLE, MANY, MOST_FREQUENT = 64, 6, 1 << 16


def shingles(text: bytes, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; fewer words than ``size``: the whole sequence as one."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = hashes(words)
    return np.unique(windows(known, size) if len(words) >= size else windows(known, len(words)) ^ np.uint64(len(words)))


def needed(n: int, percent: int = PERCENT) -> int:
    """Fewest common shingles of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def bitmap(found: np.ndarray) -> bytes:
    """At least eight bits a shingle, a multiple of ``BITS``: with fewer, the shingles of long texts hide each other."""
    size = BITS
    while size < 8 * len(found):
        size *= 2
    flags = np.zeros(size, dtype=bool)
    flags[(found >> np.uint64(20)) % np.uint64(size)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def folded(bits: bytes, size: int = BITS) -> np.ndarray:
    """A bitmap of ``size`` bits from one of as many or more."""
    return np.bitwise_or.reduce(np.frombuffer(bits, dtype=np.uint64).reshape(-1, size // 64), axis=0)


def frequent(docs: DataFrame) -> set[int]:
    """Shingles that stand in many documents of the sample; at most ``MOST_FREQUENT``."""
    def make():
        class Each:
            def __init__(self):
                self.hashes, self.seen = word_hashes(), Counter()

            def __call__(self, body):
                self.seen.update(shingles(body, self.hashes).astype(np.int64).tolist())
                if len(self.seen) > 1_000_000:
                    yield from self.close()

            def close(self):
                yield from self.seen.items()
                self.seen = Counter()
        return Each()

    sample = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(ORDER_SAMPLE)) == 0)).select("text")
    counted = map_rows(sample, make, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= MANY)
    return {r.h for r in counted.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").collect()}


def sets_of(docs: DataFrame, late: set[int]) -> DataFrame:
    """``doc_id``, ``row`` (as ``_row`` has it), ``f`` (hash of the set, NULL if empty), ``n``, the shingles that name its
    cells, its bitmap, and the wide one compressed, as few of its bits are set."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(sorted(late), dtype=np.int64).view(np.uint64))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        from xxhash import xxh3_64_intdigest

        hashes, last, done = word_hashes(), np.sort(sent.value), set()

        def each(doc, row, body):
            doc = doc.decode() if isinstance(doc, bytes) else doc
            found = shingles(body or b"", hashes)
            n = len(found)
            if not n:
                yield doc, row, None, 0, [], None, None
                return
            f = xxh3_64_intdigest(found.tobytes())
            f -= (f >= 1 << 63) << 64
            if f in done:  # the cells of a copy in this task are known
                yield doc, row, f, n, [], None, None
                return
            if len(done) > 200_000:
                done.clear()
            done.add(f)
            is_late = last[np.searchsorted(last[:-1], found)] == found if len(last) else np.zeros(n, dtype=bool)
            cells = np.concatenate([found[~is_late], found[is_late]])[:n - needed(n) + 1]
            wide = bitmap(found)
            yield doc, row, f, n, cells.astype(np.int64).tolist(), folded(wide).tobytes(), compress(wide, 1)
        return each

    return map_rows(docs.select("doc_id", _row(), "text"), make, f"doc_id {kind}, row long, f long, n int, cells array<long>, bits binary, wide binary")


def _row(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by id and text: ids may be missing or repeated."""
    return F.xxhash64(doc_id, text).alias("row")


def _place(row: str | Column) -> Column:
    return F.pmod(row, F.lit(64 << MARK_BITS))


def _marked(rows: DataFrame) -> np.ndarray:
    """Bitmap of ``row``: its size is fixed, so with many rows it only lets more through."""
    place = rows.select(_place("row").alias("p"))
    words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b")).toPandas()
    out = np.zeros(1 << MARK_BITS, dtype=np.int64)
    out[words["w"].to_numpy(dtype=np.int64)] = words["b"]
    return out.view(np.uint64)


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of ``pairs`` whose sets link, by intersecting the whole sets.

    A set is sent once to each task that has a pair of it: the pairs of a connected group of sets share one task, or, if the
    group has more than ``BLOCK`` sets, as many as its pairs of blocks.
    """
    groups = components(pairs)
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    own = groups.join(sizes, "component").select(
        F.col("id"), F.col("component").alias("c"), F.pmod(F.xxhash64("id"), F.col("blocks")).alias("own"))
    placed = pairs.join(own.select(F.col("id").alias("a"), "c", F.col("own").alias("p")), "a").join(
        own.select(F.col("id").alias("b"), F.col("own").alias("q")), "b").select("c", "p", "q", "a", "b")
    placed = saved(placed, "pairs")
    ends = placed.select("c", "p", "q", F.explode(F.array("a", "b")).alias("f")).distinct()
    one = sets.where("f is not null").groupBy("f").agg(F.min("row").alias("row")).join(groups.select(F.col("id").alias("f")), "f")
    sent = docs.sparkSession.sparkContext.broadcast(_marked(one))

    def hashed():
        hashes, bits, done = word_hashes(), sent.value, set()
        from xxhash import xxh3_64_intdigest

        def each(place, body):
            if int(bits[place >> 6]) >> (place & 63) & 1:
                f = xxh3_64_intdigest(shingles(body, hashes).tobytes())
                if f in done:  # a repeated row
                    return
                if len(done) > 200_000:
                    done.clear()
                done.add(f)
                yield f - ((f >= 1 << 63) << 64), body
        return each

    # most texts that are not needed are known by a bitmap of fixed size, the rest by the join. The others are sent as they are,
    # which takes less than half of what their shingles do
    texts = docs.where("text is not null").select(_place(_row()), "text")
    bodies = map_rows(texts, hashed, "f long, body binary")
    empty = F.lit(None).cast("long")
    rows = ends.join(bodies, "f").select("c", "p", "q", F.lit(0).alias("kind"), F.col("f").alias("a"), empty.alias("b"), "body")
    rows = rows.unionByName(placed.select("c", "p", "q", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("body")))

    def make():
        hashes, at = word_hashes(), None
        held: dict[int, np.ndarray] = {}

        def each(c, p, q, kind, a, b, body):
            nonlocal at
            if (c, p, q) != at:
                held.clear()
                at = c, p, q
            if not kind:
                held[a] = shingles(body, hashes)
                return
            x, y = held[a], held[b]
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.searchsorted(y[:-1], x)] == x).sum())
            if 100 * common >= PERCENT * (len(x) + len(y) - common):
                yield a, b
        return each

    return map_rows(rows.repartition("c", "p", "q").sortWithinPartitions("c", "p", "q", "kind"), make, "a long, b long")


def _needed(sets: DataFrame, ids: DataFrame, by: str) -> DataFrame:
    """``f``, ``n`` and ``bits`` (the column ``by``), once a set. A bitmap of fixed size leaves out most sets that are not in ``ids``
    (``f``) before anything is shuffled."""
    marks = ids.select(_place("f").alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    rows = sets.where("bits is not null").select("f", "n", F.col(by).alias("bits"), _place("f").alias("p"))
    some = rows.join(F.broadcast(marks), F.shiftright("p", 6) == F.col("w")).where("bit_get(b, cast(p & 63 AS int)) = 1")
    return some.groupBy("f").agg(F.first("n").alias("n"), F.min("bits").alias("bits"))


def _ends(pairs: DataFrame, *more: str) -> DataFrame:
    return pairs.select(*more, F.explode(F.array("a", "b")).alias("f")).distinct()


def _may_link(m: int, n: int, x: bytes, y: bytes) -> bool:
    """Whether sets of ``m`` and ``n`` shingles with these bitmaps may link."""
    size = 8 * min(len(x), len(y))
    x, y = folded(x, size), folded(y, size)
    common = min(m - int(np.bitwise_count(x & ~y).sum()), n - int(np.bitwise_count(y & ~x).sum()))
    return (100 + PERCENT) * common >= PERCENT * (m + n)


def bounded(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that sizes and ``bits`` do not rule out."""
    bits = _needed(sets, _ends(pairs), "bits")
    both = pairs.join(bits.select(F.col("f").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x")), "a").join(
        bits.select(F.col("f").alias("b"), "n", F.col("bits").alias("y")), "b").select("a", "b", "m", "n", "x", "y")

    def make():
        def each(a, b, m, n, x, y):
            if _may_link(m, n, x, y):
                yield a, b
        return each

    return map_rows(both, make, "a long, b long")


def wide_bounded(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that ``wide`` does not rule out. Those bitmaps are long, so they do not travel with pairs: sets are dealt into
    blocks by hash, a place has the pairs of two blocks, and a set is sent once to each place that has a pair of it."""
    blocks = max(SPREAD, -(-_ends(pairs).count() // PLACE))
    own = [F.pmod(F.xxhash64(k), F.lit(blocks)) for k in ("a", "b")]
    placed = pairs.select(F.least(*own).alias("p"), F.greatest(*own).alias("q"), "a", "b")
    ends = _ends(placed, "p", "q")
    rows = ends.join(_needed(sets, ends, "wide"), "f").select(
        "p", "q", F.lit(0).alias("kind"), F.col("f").alias("a"), F.lit(None).cast("long").alias("b"), "n", "bits")
    rows = rows.unionByName(placed.select(
        "p", "q", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("bits")))

    def make():
        held: dict[int, tuple[int, bytes]] = {}
        at = last = None

        def each(p, q, kind, a, b, n, bits):
            nonlocal at, last
            if (p, q) != at:
                held.clear()
                at, last = (p, q), None
            if not kind:
                held[a] = n, bits
                return
            if last is None or last[0] != a:
                m, x = held[a]
                last = a, m, decompress(x)
            n, y = held[b]
            if _may_link(last[1], n, last[2], decompress(y)):
                yield a, b
        return each

    return map_rows(rows.repartition("p", "q").sortWithinPartitions("p", "q", "kind", "a"), make, "a long, b long")


class Tree:
    """Sets sorted by component and size, and the nodes above them, level by level (leaves first)."""

    def __init__(self, group: np.ndarray, sizes: np.ndarray, bits: np.ndarray, seen: np.ndarray | None = None):
        self.order = np.lexsort((sizes, group))
        seen = np.zeros((len(group), 1), dtype=np.uint64) if seen is None else seen
        group, sizes, bits, seen = group[self.order], sizes[self.order], bits[self.order], seen[self.order]
        spare = sizes - np.bitwise_count(bits).sum(axis=1)
        level = (group, group, sizes, sizes, bits, bits, spare, seen)
        self.levels = [level]
        step = LEAF
        while len(level[0]) > 1:
            at = np.arange(0, len(level[0]), step)
            level = (np.minimum.reduceat(level[0], at), np.maximum.reduceat(level[1], at),
                     np.minimum.reduceat(level[2], at), np.maximum.reduceat(level[3], at),
                     np.bitwise_or.reduceat(level[4], at), np.bitwise_and.reduceat(level[5], at),
                     np.maximum.reduceat(level[6], at), np.bitwise_and.reduceat(level[7], at))
            self.levels.append(level)
            step = FAN

    def fan(self, depth: int) -> int:
        return LEAF if depth == 1 else FAN


def possible(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
    """Whether nodes ``i`` of level ``x`` and ``j`` of level ``y`` may hold a linked pair of different components that is not
    left to a lesser cell."""
    one = (x[0][i] == x[1][i]) & (y[0][j] == y[1][j]) & (x[0][i] == y[0][j])
    either, both = x[4][i] & y[4][j], np.minimum(x[3][i], y[3][j])
    most = np.minimum(both, np.bitwise_count(either).sum(axis=1) + np.minimum(x[6][i], y[6][j]))
    most = np.minimum(most, x[3][i] - np.bitwise_count(x[5][i] & ~y[4][j]).sum(axis=1))
    most = np.minimum(most, y[3][j] - np.bitwise_count(y[5][j] & ~x[4][i]).sum(axis=1))
    fewest = x[2][i].astype(np.int64) + y[2][j]
    near = (PERCENT * x[2][i] <= 100 * y[3][j]) & (PERCENT * y[2][j] <= 100 * x[3][i])
    one |= (x[7][i] & y[7][j]).any(axis=1)
    return ~one & near & ((100 + PERCENT) * most.astype(np.int64) >= PERCENT * fewest)


def dual(one: Tree, other: Tree, same: bool, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of both trees that may link, in pieces; the node pairs of a level are visited in bounded batches."""
    top_x, top_y = len(one.levels) - 1, len(other.levels) - 1
    stack = [(top_x, np.zeros(1, dtype=np.int64), top_y, np.zeros(1, dtype=np.int64))]
    while stack:
        dx, i, dy, j = stack.pop()
        keep = possible(one.levels[dx], i, other.levels[dy], j)
        if same and dx == dy:
            keep &= i <= j if dx else i < j
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if not dx and not dy:
            yield one.order[i], other.order[j]
            continue
        if dx >= dy and dx:
            i, j = _children(one, dx, i, j)
            if dy == dx and dy:
                j, i = _children(other, dy, j, i)
                dy -= 1
            dx -= 1
        else:
            j, i = _children(other, dy, j, i)
            dy -= 1
        stack.extend((dx, i[k:k + most], dy, j[k:k + most]) for k in range(0, len(i), most))


def _children(tree: Tree, depth: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fan, below = tree.fan(depth), len(tree.levels[depth - 1][0])
    down = (i[:, None] * fan + np.arange(fan)).ravel()
    return down[down < below], np.repeat(j, fan)[down < below]


def lesser(h: int, halves: list[list[list[int]]]) -> list[np.ndarray]:
    """For each half, which of the cells below ``h`` its sets carry, as bitmaps of the ``SEEN`` cells that most of them carry."""
    below = [np.array([k for keys in half for k in keys if k < h], dtype=np.int64) for half in halves]
    names, times = np.unique(np.concatenate(below), return_counts=True)
    names = np.sort(names[np.argsort(-times, kind="stable")[:SEEN]])
    out = []
    for half, keys in zip(halves, below, strict=True):
        flags = np.zeros((len(half), 64 * max(1, -(-len(names) // 64))), dtype=bool)
        own = np.repeat(np.arange(len(half)), [sum(k < h for k in keys) for keys in half])
        place = np.searchsorted(names, keys)
        known = np.flatnonzero(place < len(names))
        known = known[names[place[known]] == keys[known]]
        flags[own[known], place[known]] = True
        out.append(np.packbits(flags, axis=1, bitorder="little").view(np.uint64))
    return out


def _tree_pairs(groups: DataFrame) -> DataFrame:
    """``a``, ``b`` from rows (``h``, ``p``, ``q``, ``side``, ``f``, ``n``, ``c``, ``bits``, ``keys``): one tree for each side of
    a task. ``keys``: the least cells of a set, of those that are visited."""
    def make():
        class Each:
            def __init__(self):
                self.key, self.rows = None, []

            def __call__(self, h, p, q, side, f, n, c, bits, keys):
                if (h, p, q) != self.key:
                    yield from self.close()
                    self.key = h, p, q
                self.rows.append((side, f, n, c, bits, keys))

            def close(self):
                rows, self.rows = self.rows, []
                halves = [[r for r in rows if r[0] == s] for s in (0, 1)]
                if not halves[0]:
                    return
                names = [np.array([r[1] for r in half], dtype=np.int64) for half in halves]
                seen = lesser(self.key[0], [[r[5] for r in half] for half in halves])
                trees = [Tree(np.array([r[3] for r in half], dtype=np.int64), np.array([r[2] for r in half], dtype=np.int64),
                              np.frombuffer(b"".join(r[4] for r in half), dtype=np.uint64).reshape(len(half), -1), known)
                         for half, known in zip(halves, seen, strict=True) if half]
                same = self.key[1] == self.key[2]
                if not same and len(trees) < 2:
                    return
                for i, j in dual(trees[0], trees[0] if same else trees[1], same):
                    left, right = names[0][i], names[0 if same else 1][j]
                    yield from zip(np.minimum(left, right).tolist(), np.maximum(left, right).tolist(), strict=True)
        return Each()

    return map_rows(groups, make, "a long, b long").distinct()


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included)."""
    return linked_rows(docs, doc_id, text).drop("row")


def linked_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``linked``, with ``row`` (see ``_row``)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sets = saved(sets_of(docs, frequent(docs)), "sets")
    # dealt once: the cell's first set is found, and met with the others, where the cell is. Of neighbouring rows only ``h``
    # differs; as the last column it leaves the rest in one piece, which compresses better
    cells = sets.select("f", "n", F.explode("cells").alias("h")).withColumn("h", F.col("h").bitwiseAND(F.lit((1 << CELL_BITS) - 1)))
    cells = cells.repartition("h")
    lead = cells.groupBy("h").agg(F.min("f").alias("a"), F.max("f").alias("z"), F.min_by("n", "f").alias("m")).where("a != z").drop("z")
    members = saved(cells.join(lead, "h").distinct(), "members")
    near = (PERCENT * F.col("m") <= 100 * F.col("n")) & (PERCENT * F.col("n") <= 100 * F.col("m"))
    tried = saved(members.where((F.col("f") != F.col("a")) & near).select("a", F.col("f").alias("b")).distinct(), "pairs")
    left = saved(bounded(sets, tried), "pairs")
    first = saved(verified(docs, sets, saved(wide_bounded(sets, left), "pairs")), "links")
    groups = components(first).select(F.col("id").alias("f"), "component")

    grouped = members.join(groups, "f", "left").select("h", "f", F.coalesce("component", "f").alias("c"))
    grouped = saved(grouped, "members")
    open_cells = grouped.groupBy("h").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("f")).alias("same")).where("lo != hi")
    # cells with the same sets are visited once
    open_cells = open_cells.groupBy("same", "size").agg(F.min("h").alias("h")).select("h", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("f"), F.col("blocks"))
    visited = saved(grouped.join(open_cells, "h"), "members")
    bits = _needed(sets, visited.select("f"), "bits")
    least = visited.groupBy("f").agg(F.slice(F.sort_array(F.collect_set("h")), 1, LEAST).alias("keys"))
    placed = visited.join(bits.join(least, "f"), "f").withColumn("own", own)
    task = F.struct(F.least("own", "k").alias("p"), F.greatest("own", "k").alias("q"), (F.col("own") > F.col("k")).cast("int").alias("side"))
    placed = placed.withColumn("k", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn("t", task)
    placed = placed.select("h", "t.p", "t.q", "t.side", "f", "n", "c", "bits", "keys").repartition("h", "p", "q")
    found = _tree_pairs(placed.sortWithinPartitions("h", "p", "q"))
    rest = saved(found.join(tried, ["a", "b"], "left_anti"), "pairs")  # leaders are the smaller ids, as the first of a pair is
    second = saved(verified(docs, sets, saved(wide_bounded(sets, rest), "pairs")), "links")

    groups = components(first.unionByName(second)).select(F.col("id").alias("f"), "component")
    rows = sets.select("doc_id", "row", "f", "n").join(groups, "f", "left").withColumn("g", F.coalesce("component", "f"))
    lowest = rows.where("g is not null").groupBy("g").agg(F.min("doc_id").alias("low"))
    return rows.join(lowest, "g", "left").select(
        "doc_id", "row", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component; rows without an id stay."""
    out = linked_rows(docs).where("doc_id != component_id").select(
        F.col("doc_id").alias("__st_id"), F.col("row").alias("__st_row")).distinct()
    marked = docs.withColumn("__st_own", _row())
    same = (F.col("doc_id") == F.col("__st_id")) & (F.col("__st_own") == F.col("__st_row"))
    return marked.join(out, same, "left_anti").drop("__st_own")
