"""Running state, lookups and top-k that hold when one key owns a third of all rows.

* *Running state*: rows are range-partitioned by the whole order (keys, then every order column), so the cut points are
  quantiles of what is there: outlying values, equal first values, NULL keys and any sortable type split alike. The piece of
  a key in one partition is a segment; each segment is one window group. A row's running values are a function of what is
  known before its segment, so the segments are gone through at the same time, written, and told afterwards what came before
  them by the last rows of the others. There is one plan, whatever the number of rows; no key is looked for, measured or
  treated apart.
* *Lookups*: a plain left or inner join against one row per key. Adaptive execution splits what a hot key, or NULL, has in a
  partition at run time; both kinds of join allow it.
* *Top-k* uses rank filters that Spark cuts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_path

SEGMENT = "_seg"


def lookup_join(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join ``left`` (any skew) to ``right``, which has one row per ``on``; NULL keys match nothing."""
    return left.join(right, on, how)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key. The filter on the rank lets Spark cut each group to ``k`` before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def seconds_of(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970 of a timestamp column; zone-less values do not depend on the session time zone."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_seconds(c)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def micros_of(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 of a timestamp column, like :func:`seconds_of`."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(F.col(ts))
    fraction = (F.date_part(F.lit("SECOND"), F.col(ts)) - F.second(ts)) * 1_000_000
    return seconds_of(df, ts) * 1_000_000 + fraction.cast("long")


@dataclass(frozen=True)
class Running:
    """Running columns, as what a segment can tell by itself and what it needs to know of the segments before it.

    ``local``: columns over the rows of one segment, in order; later ones may use earlier ones. ``ends``: those whose values
    at the last row of a segment are its summary. ``fold``: summaries and the window over the segments of a key -> the
    columns of ``carried``, looking back only. ``carried``: their values where nothing precedes. ``result``: final columns.
    """

    local: Mapping[str, Callable[[WindowSpec], Column]]
    ends: Sequence[str]
    fold: Callable[[DataFrame, WindowSpec], DataFrame]
    carried: Mapping[str, Column]
    result: Mapping[str, Column]
    #: Local columns that ``result`` names; the others are not written.
    needed: Sequence[str]


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def sums(values: Mapping[str, Column], before: bool = False) -> Running:
    """Running sums up to the row, or up to the row before it."""
    zero, local, result = F.lit(0).cast("long"), {}, {}
    for n, value in values.items():
        local[f"_v{n}"] = lambda w, c=value: c
        local[f"_sum{n}"] = lambda w, n=n: F.coalesce(F.sum(f"_v{n}").over(_upto(w)), zero)
        near = F.col(f"_sum{n}") - F.coalesce(F.col(f"_v{n}"), zero) if before else F.col(f"_sum{n}")
        result[n] = near + F.col(f"_far{n}")
    return Running(local, [f"_sum{n}" for n in values],
                   lambda s, w: s.withColumns({f"_far{n}": F.sum(f"_sum{n}").over(_earlier(w)) for n in values}),
                   {f"_far{n}": zero for n in values}, result, [f"_v{n}" for n in values] if before else [])


def latest(values: Mapping[str, Column], before: bool = False) -> Running:
    """Latest non-NULL values at the row, or at the rows before it."""
    local: dict = {}
    for n, value in values.items():
        local[f"_v{n}"] = lambda w, c=value: c
        local[f"_last{n}"] = lambda w, n=n: F.last(f"_v{n}", ignorenulls=True).over(_upto(w))
        if before:
            local[f"_near{n}"] = lambda w, n=n: F.lag(f"_last{n}").over(w)
    near = {n: F.col(f"_near{n}" if before else f"_last{n}") for n in values}
    return Running(local, [f"_last{n}" for n in values],
                   lambda s, w: s.withColumns({f"_far{n}": F.last(f"_last{n}", ignorenulls=True).over(_earlier(w)) for n in values}),
                   {f"_far{n}": F.lit(None) for n in values}, {n: F.coalesce(near[n], F.col(f"_far{n}")) for n in values},
                   [f"_near{n}" for n in values] if before else [])


@dataclass(frozen=True)
class Stop:
    """Name of a flag that holds after the first row where a run has reached a limit, or where ``also`` holds."""

    name: str
    run: str
    limit: int
    also: Column


def runs_since(runs: Mapping[str, tuple[Column, Column]], keys: Sequence[str], stop: Stop | None = None,
               before: Mapping[str, str] | None = None) -> Running:
    """Per name ``(reset, value)``: the sum of ``value`` since the latest row where ``reset`` holds, that row included.

    A run is the running sum less what it was before the latest reset, so that all runs share one window. Until its first
    reset a segment goes on with the run it was entered with: it is a function of that number, and so is the first row that
    stops it, which is told by the greatest run before the first reset. ``before``: name -> run, as it was at the row before.
    """
    names, zero, no = list(runs), F.lit(0).cast("long"), F.lit(False)
    local: dict = {}
    for n, (reset, value) in runs.items():
        local[f"_r{n}"] = lambda w, c=reset: F.coalesce(c, no)
        local[f"_v{n}"] = lambda w, c=value: F.coalesce(c.cast("long"), zero)
    local |= {f"_sum{n}": lambda w, n=n: F.sum(f"_v{n}").over(_upto(w)) for n in names}
    local |= {f"_base{n}": lambda w, n=n: F.last(F.when(F.col(f"_r{n}"), F.col(f"_sum{n}") - F.col(f"_v{n}")), ignorenulls=True).over(_upto(w))
              for n in names}
    local |= {f"_near{n}": lambda w, n=n: F.col(f"_sum{n}") - F.coalesce(F.col(f"_base{n}"), zero) for n in names}
    local |= {f"_open{n}": lambda w, n=n: F.col(f"_base{n}").isNull() for n in names}
    ends, needed = [f"_{kind}{n}" for n in names for kind in ("near", "open")], []
    carried = {f"_far{n}": zero for n in names}

    def entered(n: str, near: Column, is_open: Column) -> Column:
        return near + F.when(is_open, F.col(f"_far{n}")).otherwise(zero)

    result = {n: entered(n, F.col(f"_near{n}"), F.col(f"_open{n}")) for n in names}
    for name, n in (before or {}).items():
        local |= {f"_{kind}_{name}": lambda w, c=f"_{kind}{n}": F.lag(c).over(w) for kind in ("near", "open")}
        needed += [f"_near_{name}", f"_open_{name}"]
        result[name] = F.coalesce(entered(n, F.col(f"_near_{name}"), F.col(f"_open_{name}")), F.col(f"_far{n}"))
    if stop is not None:
        near, is_open = F.col(f"_near{stop.run}"), F.col(f"_open{stop.run}")
        sure = F.coalesce(stop.also, no) | (~is_open & (near >= stop.limit))
        local |= {
            "_sure": lambda w: F.max(sure).over(_upto(w)), "_most": lambda w: F.max(F.when(is_open, near)).over(_upto(w)),
            "_sure_before": lambda w: F.lag("_sure").over(w), "_most_before": lambda w: F.lag("_most").over(w)}
        ends += ["_sure", "_most"]
        needed += ["_sure_before", "_most_before"]
        carried["_far_stop"] = no
        met = F.col(f"_far{stop.run}") + F.col("_most_before") >= stop.limit
        result[stop.name] = F.col("_far_stop") | F.coalesce(F.col("_sure_before"), no) | F.coalesce(met, no)

    def fold(summary: DataFrame, w: WindowSpec) -> DataFrame:
        for n in names:
            # the segments since the latest one with a reset go on with the same run
            summary = summary.withColumn(f"_group{n}", F.sum((~F.col(f"_open{n}")).cast("int")).over(_upto(w)))
            within = Window.partitionBy(*keys, f"_group{n}").orderBy(SEGMENT)
            summary = summary.withColumn(f"_end{n}", F.sum(f"_near{n}").over(_upto(within)))
            summary = summary.withColumn(f"_far{n}", F.coalesce(F.lag(f"_end{n}").over(w), zero))
        if stop is not None:
            stops = F.col("_sure") | F.coalesce(F.col(f"_far{stop.run}") + F.col("_most") >= stop.limit, no)
            summary = summary.withColumn("_stops", stops).withColumn("_far_stop", F.max("_stops").over(_earlier(w)))
        return summary

    return Running(local, ends, fold, carried, result, needed)


@dataclass(frozen=True)
class OrderedRows:
    """Rows with an order inside each key, cut into segments (``_seg``, a number that grows with the order).

    Each :meth:`add` writes them once to the shared folder, with what their segments tell: where the range boundaries fall
    differs from run to run, and all that follows must see the same ones.
    """

    data: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str], segments: int | None = None) -> OrderedRows:
        """``order`` must be total inside a key; its columns can be of any sortable type, NULL first. ``segments``: how many
        partitions, else as many as adaptive execution finds right."""
        ranges = [*([segments] if segments else []), *keys, *order]
        return cls(df.repartitionByRange(*ranges).withColumn(SEGMENT, F.spark_partition_id()), tuple(keys), tuple(order))

    def add(self, *running: Running) -> OrderedRows:
        """Adds the ``result`` columns of all ``running`` in one pass.

        Only the first key of a partition can have a segment before it, so what is carried over is at most one row per
        partition, and is broadcast.
        """
        by_segment = [*self.keys, SEGMENT]
        window = Window.partitionBy(*by_segment).orderBy(*self.order)
        data = self.data
        for r in running:
            for name, column in r.local.items():
                data = data.withColumn(name, column(window))
        data = data.withColumn("_end", F.lead(F.lit(True)).over(window).isNull())
        carried = {c: v for r in running for c, v in r.carried.items()}
        data = data.select(*self.data.columns, "_end", *dict.fromkeys(c for r in running for c in (*r.ends, *r.needed)))
        path = new_path(data.sparkSession, "segments")
        data.write.parquet(path)
        data = data.sparkSession.read.schema(data.schema).parquet(path)
        segments = Window.partitionBy(*self.keys).orderBy(SEGMENT)
        summary = data.where("_end").select(*by_segment, *dict.fromkeys(c for r in running for c in r.ends))
        summary = summary.withColumn("_nth", F.row_number().over(segments))
        for r in running:
            summary = r.fold(summary, segments)
        names = {c: f"_at{i}" for i, c in enumerate(by_segment)}
        before = F.broadcast(summary.where("_nth > 1").select(*(F.col(c).alias(n) for c, n in names.items()), *carried))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
        data = data.join(before, same, "left").withColumns({c: F.coalesce(F.col(c), v) for c, v in carried.items()})
        results = {n: c for r in running for n, c in r.result.items()}
        kept = [c for c in self.data.columns if c not in results]
        return OrderedRows(data.select(*kept, *(c.alias(n) for n, c in results.items())), self.keys, self.order)

    def running_sum(self, values: Mapping[str, Column], before: bool = False) -> OrderedRows:
        return self.add(sums(values, before))

    def last_known(self, values: Mapping[str, Column], before: bool = False) -> OrderedRows:
        return self.add(latest(values, before))

    def rows(self) -> DataFrame:
        return self.data.drop(SEGMENT)
