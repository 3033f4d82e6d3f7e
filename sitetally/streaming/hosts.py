"""Per-host state over a stream of fetch logs: counters, error run, backoff, stop flag, whatever the order of arrival.

Time is cut into cells. What a host did in a cell is kept as a small summary: a function of the run it enters the cell with,
which is 0, 1 or 2 as long as it is not stopped. A micro-batch stores its rows by cell, reads back the rows of the hosts and
cells it touches, no others, and writes their summaries; so a late row costs one cell, not the log. The state of a host is its
summaries put together in the order of time. A repeated batch replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import hostlog
from ..operators.skew import SEGMENT, OrderedRows, micros_of, runs_since, sums
from ..params import MAX_ERROR_RUN

CELL_SECONDS = 7 * 86_400
NO_TIME = -(1 << 40)  # cell of rows without a time, which come first
ROWS = "host string, us long, seq long, status int, challenge boolean, epoch long, cell long"
#: What is known at a row of a cell, counted from the cell's beginning.
SO_FAR = ("us", "seq", "attempted", "fetched", "challenges", "error_run", "error_open", "slow_run", "slow_open")
RUNS = {"error_run": "error", "slow_run": "slow"}


def stored_rows(spark: SparkSession, folder: str, cells: list[int]) -> DataFrame:
    """Rows of some cells, from the folders of these cells alone."""
    paths = [f"{folder}/rows/cell={c}" for c in cells]
    if not paths:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).option("basePath", f"{folder}/rows").parquet(*paths)


def _runs() -> dict:
    return {"error_run": hostlog.error_run_parts(), "slow_run": hostlog.slow_run_parts()}


def cell_summaries(rows: DataFrame, epoch: int) -> DataFrame:
    """Per host and cell: ``last``, what is known at its last row; ``stop_0`` to ``stop_2``, the same at the row that stops a
    host which enters with that run (NULL if none does); rows ``new`` in this epoch, and those ``late`` within the cell."""
    one = F.lit(1).cast("long")
    data = rows.withColumns({"disallowed": F.lit(False), "older": -F.col("epoch")})
    runs = _runs()
    counts = {
        "attempted": one, "fetched": F.col("status").between(200, 299).cast("long"), "challenges": F.col("challenge").cast("long"),
        "new": (F.col("epoch") == epoch).cast("long"), **{f"{RUNS[n]}_resets": r.cast("long") for n, (r, _) in runs.items()}}
    keys = ["host", "cell"]
    done = OrderedRows.of(data, keys, ["us", "seq", "older"]).add(runs_since(runs, keys), sums(counts)).rows()
    done = done.withColumns({f"{short}_open": F.col(f"{short}_resets") == 0 for short in RUNS.values()})
    known = F.struct(*SO_FAR)
    stops = {}
    for entry in range(MAX_ERROR_RUN):
        run = F.col("error_run") + F.when(F.col("error_open"), entry).otherwise(0)
        stops[f"stop_{entry}"] = (run >= MAX_ERROR_RUN) | F.coalesce(F.col("status") == 403, F.lit(False))
    return done.groupBy(*keys).agg(
        F.max(known).alias("last"), *(F.min(F.when(stop, known)).alias(name) for name, stop in stops.items()),
        F.max("new").alias("new"), F.coalesce(F.max(F.when(F.col("epoch") < epoch, F.col("new"))), F.lit(0).cast("long")).alias("late"))


def cell_writer(folder: str, cell_seconds: int = CELL_SECONDS) -> Callable[[DataFrame, int], None]:
    """Stores each micro-batch of a log and the summaries of the cells that it touches."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        us = micros_of(batch, "ts")
        rows = batch.where(~F.col("disallowed")).select(
            "host", us.alias("us"), "seq", F.col("status").cast("int").alias("status"), "challenge", F.lit(epoch).cast("long").alias("epoch"),
            F.coalesce(F.floor(us / F.lit(cell_seconds * 1_000_000)), F.lit(NO_TIME)).alias("cell"))
        cells = sorted(r.cell for r in rows.select("cell").distinct().collect())
        rows.hint("rebalance", F.col("cell")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cell", "epoch").parquet(f"{folder}/rows")
        stored = stored_rows(spark, folder, cells).where(F.col("epoch") <= epoch)
        touched = stored.where(F.col("epoch") == epoch).select(F.col("host").alias("_host"), F.col("cell").alias("_cell")).distinct()
        mine = stored.join(touched, F.col("host").eqNullSafe(F.col("_host")) & (F.col("cell") == F.col("_cell")), "left_semi")
        cell_summaries(mine, epoch).write.mode("overwrite").parquet(f"{folder}/cells/epoch={epoch}")
    return write


def host_states(spark: SparkSession, folder: str) -> DataFrame | None:
    """One row per host from the summaries in a folder; None before the first batch.

    ``late_rows``: rows that came in a later batch than a newer row, or one of the same time, of their host.
    """
    try:
        cells = spark.read.parquet(f"{folder}/cells")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    of_host = Window.partitionBy("host").orderBy("epoch").rangeBetween(Window.unboundedPreceding, -1)
    newest = F.max("cell").over(of_host)
    late = cells.withColumn("newest", newest).groupBy("host").agg(
        F.sum(F.when(F.col("newest") > F.col("cell"), F.col("new")).otherwise(F.col("late"))).alias("late_rows"))

    names = ["last", *(f"stop_{e}" for e in range(MAX_ERROR_RUN))]
    now = cells.groupBy("host", "cell").agg(F.max_by(F.struct(*names), "epoch").alias("s")).select("host", F.col("cell").alias(SEGMENT), "s.*")
    by = Window.partitionBy("host").orderBy(SEGMENT)
    running = runs_since(_runs(), ["host"])
    now = running.fold(now.withColumns({f"_{kind}{n}": F.col(f"last.{column}") for n, short in RUNS.items()
                                        for kind, column in (("near", n), ("open", f"{short}_open"))}), by)
    stop = F.lit(None)
    for entry in range(MAX_ERROR_RUN):
        stop = F.when(F.least(F.col("_farerror_run"), F.lit(MAX_ERROR_RUN - 1)) == entry, F.col(f"stop_{entry}")).otherwise(stop)
    now = now.withColumn("stop", stop)
    before = F.max(F.col("stop").isNotNull()).over(by.rowsBetween(Window.unboundedPreceding, -1))
    now = now.withColumn("gone", F.coalesce(before, F.lit(False))).where(~F.col("gone")).withColumn("end", F.coalesce("stop", "last"))
    runs = {n: F.col(f"end.{n}") + F.when(F.col(f"end.{short}_open"), F.col(f"_far{n}")).otherwise(0) for n, short in RUNS.items()}
    out = now.withColumns(runs).groupBy("host").agg(
        *(F.sum(f"end.{c}").alias(c) for c in ("attempted", "fetched", "challenges")),
        F.max(F.struct(SEGMENT, "error_run", "slow_run")).alias("at_end"), F.max(F.col("stop").isNotNull()).alias("stopped"))
    out = out.select("host", F.col("attempted").alias("pages_attempted"), F.col("fetched").alias("pages_fetched"),
                     F.col("challenges").alias("captcha_hits"), F.col("at_end.error_run").alias("consec_errors_final"),
                     F.col("at_end.slow_run").alias("slow_run"), "stopped")
    late = late.withColumnRenamed("host", "_host")
    out = out.withColumn("backoff_seconds_final", hostlog.backoff_seconds()).drop("slow_run")
    return out.join(late, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
