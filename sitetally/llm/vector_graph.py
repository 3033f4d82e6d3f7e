"""Near-duplicate vectors by a robust-pruned flat graph over overlapping shards.

* *Shards.* Vectors of a label are split around up to ``FAN`` sampled and refined centres, and parts of more than ``SHARD``
  vectors again, until all are small enough. A vector is searched for in the shard of its nearest centre, its main shard, and is
  a member of every shard that may be the main one of a vector within the limit: those it would be nearest to after a step of
  the limit's length. So a vector's main shard holds all its partners. The sample only decides how parts are split.
* *Pairs of blocks.* If a split would not make the pairs to compare fewer (more than ``PAYS`` of them left), the part is dealt
  into blocks of half a shard. Each block is a shard of its own, and each pair of blocks is compared in a task.
* *Graph.* In each shard a vector's nearest members are thinned by robust pruning (a neighbour is left out if one already
  taken is ``ALPHA`` times nearer to it) and linked both ways. The adjacency lists of a vector from all its shards are united.
* *Search.* Every vector is a query: a greedy search from its shard's medoid, and from its own node, visits ``BEAM`` nodes;
  then the range is expanded: the neighbours of every vector within the limit are looked at until none is new.
* *Audit.* Every query is compared with a scan of its shard's members in blocks, and partners that the search missed are added.
* *Verify.* A link needs a cosine of at least the limit in double precision.

What leaves a task is a count and a link to one member for each vector with partners, no pairs.

Equal vectors of a label collapse first and count with their multiplicity; no two copies are compared. Each end of a
link finds it by its own query. A vector that is NULL, zero, or has NULL or non-finite components, or whose label is
NULL, links with nothing. Rows with a NULL id count as partners but have no component of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, ship_package
from .components import components

LIMIT = 0.98
SHARD, FAN, PER_CENTRE = 4000, 16, 64
PAYS = 0.6  # of the pairs of blocks, at most so many are left by a split
DEEPEST = 20
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 40, 1.2, 24
BLOCK = 512


def usable(vector: str) -> Column:
    inner = F.col(vector)
    finite = F.forall(inner, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(inner.isNotNull() & finite & F.exists(inner, lambda x: x != 0), F.lit(False))


def unit(rows: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _reach(limit: float) -> float:
    """Distance of two unit vectors at the limit, and a little for rounding."""
    return float(np.sqrt(2 - 2 * limit)) + 1e-9


def _members(m: np.ndarray, centres: np.ndarray, reach: float) -> np.ndarray:
    """Rows x centres: whether a vector within ``reach`` of the row may have this nearest centre.

    If y has, ``y.(c' - c) <= 0`` for all centres c', so that ``x.(c' - c) <= reach |c' - c|``.
    """
    near = m @ centres.T
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    inside = np.ones(near.shape, dtype=bool)
    for k in range(len(centres)):
        inside &= near[:, [k]] - near <= reach * apart[k] + 1e-9
    return inside


def _centres(reach: float):
    """The centres that leave the fewest pairs of a part, by a sample; none if a split does not pay."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        m = unit(part["v"])
        order = np.random.default_rng(7).permutation(len(m))
        best, least = np.zeros(0), PAYS
        for want in sorted({min(FAN >> k, len(m)) for k in range(4)} - {0, 1}):
            centres = m[order[:want]]
            for _ in range(4):
                near = (m @ centres.T).argmax(axis=1)
                for k in range(want):
                    if (mine := m[near == k]).size and (norm := np.linalg.norm(s := mine.sum(axis=0))):
                        centres[k] = s / norm
            if (left := (_members(m, centres, reach).mean(axis=0) ** 2).sum()) < least:
                best, least = centres, left
        return pd.DataFrame({"cell": [part["cell"].iloc[0]], "centres": [best.ravel().tolist()]})
    return run


def _assigned(reach: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            out = []
            for _, rows in part.groupby("cell", sort=False):
                m = unit(rows["v"])
                c = np.asarray(rows["centres"].iloc[0]).reshape(-1, m.shape[1])
                inside, nearest, main = _members(m, c, reach), (m @ c.T).argmax(axis=1), rows["main"].to_numpy()
                for k in range(len(c)):
                    own = main & (nearest == k)
                    take = inside[:, k] | own
                    out.append(pd.DataFrame({"cell": rows["cell"][take] + f"/{k}", "main": own[take], "k": rows["k"][take], "v": rows["v"][take]}))
            if out:
                yield pd.concat(out)
    return run


def _block_pairs(part: DataFrame) -> DataFrame:
    """Members of a part with its ``size``, dealt into blocks; a copy for each pair of blocks that the member's block is in."""
    blocks = F.ceil(F.col("size") * 2 / SHARD).cast("int")
    dealt = part.select("*", F.pmod(F.xxhash64("k", F.lit("block")), blocks).cast("int").alias("own"),
                        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    name = F.concat_ws("-", F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string"))
    side = F.when(F.col("own") != F.col("other"), (F.col("own") > F.col("other")).cast("int"))
    return dealt.select(F.concat("cell", F.lit("#"), name).alias("cell"), "main", "k", "v", side.alias("side"))


def shards(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``cell``, ``main``, ``k``, ``v``, ``side``: members of each shard from distinct vectors (``k``, ``label``, ``v``).

    ``side`` is NULL in a shard; in a pair of blocks it is 0 or 1, and only members of different sides are to be compared. A
    vector within the limit of a main member is a member of the same shard, or on the other side of a pair of blocks with it.
    Parts that nobody is searched for in are left out.
    """
    reach, done, depth = _reach(limit), [], 0
    cell = F.concat(F.length("label").cast("string"), F.lit(":"), "label")  # what is appended to it makes no other label's name
    rest = vectors.select(cell.alias("cell"), F.lit(True).alias("main"), "k", "v")
    while True:
        rest = saved(rest, "shards")
        sizes = saved(rest.groupBy("cell").agg(F.count("*").alias("size"), F.max("main").alias("asked")).where("asked").drop("asked"), "cells")
        done.append(rest.join(sizes.where(F.col("size") <= SHARD), "cell", "left_semi").withColumn("side", F.lit(None).cast("int")))
        big = sizes.where(F.col("size") > SHARD)
        if big.isEmpty():
            break
        chance = F.lit(0.8 * FAN * PER_CENTRE if depth < DEEPEST else 0.0) / F.col("size")
        dealt = F.pmod(F.xxhash64("k", F.lit(depth)), F.lit(1 << 20)) / float(1 << 20)
        sample = rest.join(big, "cell").where(dealt < chance)
        centres = saved(sample.groupBy("cell").applyInPandas(_centres(reach), "cell string, centres array<double>").where(F.size("centres") > 0), "centres")
        done.append(_block_pairs(rest.join(big.join(centres, "cell", "left_anti"), "cell")))
        rest = rest.join(centres, "cell").mapInPandas(_assigned(reach), rest.schema)
        depth += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def near_lists(m: np.ndarray) -> np.ndarray:
    """The nearest ``CANDIDATES`` others of each row, nearest first."""
    n = len(m)
    most = min(CANDIDATES, n - 1)
    out = np.empty((n, most), dtype=np.int64)
    for start in range(0, n, BLOCK):
        s = m[start:start + BLOCK] @ m.T
        s[np.arange(len(s)), np.arange(start, start + len(s))] = -np.inf
        top = np.argpartition(-s, most - 1, axis=1)[:, :most]
        out[start:start + BLOCK] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    return out


def robust_pruned(m: np.ndarray, near: Iterable[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """Up to ``DEGREE`` of each row's candidates; one taken rules out those it is ``ALPHA`` times nearer to than the row is."""
    out = []
    for i, candidates in near:
        c = m[candidates]
        far = np.sqrt(np.maximum(0, 2 - 2 * (c @ m[i])))
        apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
        open_, taken = np.ones(len(candidates), dtype=bool), []
        while open_.any() and len(taken) < DEGREE:
            k = int(open_.argmax())
            taken.append(k)
            open_ &= ALPHA * apart[k] > far
            open_[k] = False
        out.append(candidates[taken])
    return out


def _graph(part: pd.DataFrame) -> pd.DataFrame:
    ids, m = part["k"].to_numpy(), unit(part["v"])
    if len(m) < 2:
        return pd.DataFrame({"k": [], "to": []})
    out = robust_pruned(m, enumerate(near_lists(m)))
    a = np.repeat(np.arange(len(m)), [len(x) for x in out])
    b = np.concatenate(out)
    return pd.DataFrame({"k": np.concatenate([ids[a], ids[b]]), "to": np.concatenate([ids[b], ids[a]])}).drop_duplicates()


def _table(m: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Adjacency as one array; shorter lists are filled with the node itself, longer ones thinned again."""
    out = np.repeat(np.arange(len(m))[:, None], 2 * DEGREE, axis=1)
    for i, to in enumerate(lists):
        if len(to) > 2 * DEGREE:
            to = to[np.argsort(-(m[to] @ m[i]), kind="stable")[:4 * DEGREE]]
            pruned = robust_pruned(m, {i: to}.items())[0]
            to = np.concatenate([pruned, np.setdiff1d(to, pruned)])[:2 * DEGREE]
        out[i, :len(to)] = to
    return out


def range_search(m: np.ndarray, table: np.ndarray, queries: np.ndarray, limit: float) -> Iterator[np.ndarray]:
    """For each query row the rows found within the limit."""
    medoid = int((m @ m.sum(axis=0)).argmax())
    for start in range(0, len(queries), BLOCK):
        mine = queries[start:start + BLOCK]
        q, row = m[mine], np.arange(len(mine))
        seen = np.full((len(mine), len(m)), -3.0)  # cosine of what was looked at
        seen[:, medoid] = q @ m[medoid]
        seen[row, mine] = 1
        waiting, hops = seen.copy(), 0  # of those, what was not expanded
        while len(row):
            best = waiting[row].argmax(axis=1)
            value = waiting[row, best]
            go = (value > -2) & ((hops < BEAM) | (value >= limit))
            row, best = row[go], best[go]
            waiting[row, best] = -3
            to = table[best]
            at = row[:, None]
            new = seen[at, to] < -2
            s = np.where(new, np.einsum("adk,ak->ad", m[to], q[row]), -3)
            seen[at, to] = np.maximum(seen[at, to], s)
            waiting[at, to] = np.where(new, s, waiting[at, to])
            hops += 1
        seen[np.arange(len(mine)), mine] = -3
        yield from (np.flatnonzero(r >= limit) for r in seen)


def _scan(m: np.ndarray, queries: np.ndarray, limit: float, among: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """For each query row the rows within the limit, of all or ``among`` some."""
    others = m if among is None else m[among]
    for start in range(0, len(queries), BLOCK):
        mine = queries[start:start + BLOCK]
        s = m[mine] @ others.T
        if among is None:
            s[np.arange(len(mine)), mine] = -3
        for row in s >= limit:
            to = np.flatnonzero(row)
            yield to if among is None else among[to]


class Links:
    """Counts of partners, and the lowest member that each one is linked to so far."""

    def __init__(self, ids: np.ndarray, times: np.ndarray):
        self.ids, self.times, self.root, self.count = ids, times, np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64)

    def add(self, i: int, to: np.ndarray) -> None:
        if not len(to):
            return
        self.count[i] += self.times[to].sum()
        near = self.root[to]
        if (near != self.root[i]).any():
            joined = np.unique(np.append(near, self.root[i]))
            self.root[np.isin(self.root, joined)] = joined[0]

    def rows(self, audited: int = 0, found: int = 0) -> pd.DataFrame:
        at = np.flatnonzero((self.count > 0) | (self.root != np.arange(len(self.root))))
        out = pd.DataFrame({"a": self.ids[at], "b": self.ids[self.root[at]], "n": self.count[at], "audited": 0, "found": 0})
        if audited:
            out.loc[0, ["audited", "found"]] = audited, found
        return out


def _search(limit: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        ids, m, main = part["k"].to_numpy(), unit(part["v"]), part["main"].to_numpy()
        place = {k: i for i, k in enumerate(ids.tolist())}
        lists = [np.array(sorted({place[x] for x in to if x in place} - {i}), dtype=np.int64) if to is not None
                 else np.zeros(0, dtype=np.int64) for i, to in enumerate(part["to"])]
        queries, links = np.flatnonzero(main), Links(ids, part["times"].to_numpy())
        whole = got = 0
        searches = range_search(m, _table(m, lists), queries, limit), _scan(m, queries, limit)
        for i, found, exact in zip(queries.tolist(), *searches, strict=True):
            both = np.union1d(found, exact) if len(found) != len(exact) or (found != exact).any() else exact
            whole, got = whole + len(both), got + len(found)
            links.add(i, both)
        return links.rows(whole, got)
    return run


def _compared(limit: float):
    """Two blocks: what the main members of each have as partners in the other."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        m, main, side = unit(part["v"]), part["main"].to_numpy(), part["side"].to_numpy()
        links = Links(part["k"].to_numpy(), part["times"].to_numpy())
        for k in (0, 1):
            queries = np.flatnonzero(main & (side == k))
            for i, to in zip(queries.tolist(), _scan(m, queries, limit, np.flatnonzero(side != k)), strict=True):
                links.add(i, to)
        return links.rows()
    return run


def searched(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """From distinct vectors (``k``, ``label``, ``v``, ``times``): a row says that ``a`` is in one component with ``b`` and has
    ``n`` partners in a shard or on the other side of a pair of blocks; the sum over the rows of ``a`` is the number of its
    partners. ``audited``, ``found``: links of the queries of a shard, and how many of them the graph search had found."""
    members = saved(shards(vectors, limit), "shards")
    own, across = members.where("side is null").drop("side"), members.where("side is not null")
    edges = own.groupBy("cell").applyInPandas(_graph, "k long, to long")
    lists = edges.groupBy("k").agg(F.collect_set("to").alias("to"))
    times, kind = vectors.select("k", "times"), "a long, b long, n long, audited long, found long"
    full = own.join(lists, "k", "left").join(times, "k")
    pairs = across.join(times, "k").groupBy("cell").applyInPandas(_compared(limit), kind)
    return full.groupBy("cell").applyInPandas(_search(limit), kind).unionByName(pairs)


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    limit: float = LIMIT) -> DataFrame:
    """``vec_id``, ``n_links`` (other rows linked directly), ``component_id``, ``kept`` for every row."""
    ship_package(table.sparkSession.sparkContext)
    v = F.col(vector).cast("array<float>") if table.schema[vector].dataType.simpleString() != "array<double>" else F.col(vector)
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    k = F.when(usable("v") & F.col("label").isNotNull(), F.xxhash64("label", "v"))
    rows = saved(rows.withColumn("k", k), "vectors")
    vectors = saved(rows.where("k is not null").groupBy("k").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("times")), "vectors")
    found = saved(searched(vectors, limit), "found")
    partners = found.groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("n"))
    of = components(found.select("a", "b")).select(F.col("id").alias("k"), "component")
    known = vectors.select("k", "times").join(partners, "k", "left").join(of, "k", "left").select(
        "k", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "k").alias("g"))
    full = rows.select("vec_id", "k").join(known, "k", "left")
    lowest = full.where("g is not null").groupBy("g").agg(F.min("vec_id").alias("low"))
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("low", "vec_id"))
    return full.join(lowest, "g", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
