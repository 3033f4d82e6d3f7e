"""Running streams to the end of their input: parquet in, parquet out, checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.hostlog import alert
from ..operators.listings import dedup_key, known_rows, new_listings
from ..params import FAIL_ALERT_PCT

KEY_BUCKETS = 64
MAX_BYTES = 1 << 30  # input of one micro-batch; it bounds what a busy key can bring into one task


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None,
                max_bytes: int = MAX_BYTES) -> DataFrame:
    """Files as they arrive, in micro-batches of bounded size (or of ``max_files`` files)."""
    limit = ("maxBytesPerTrigger", max_bytes) if max_files is None else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(schema).option(*limit).parquet(path)


def drain_to_files(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append everything that has arrived. Called again with the same checkpoint, it goes on where it stopped."""
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "update") -> None:
    """Hand each micro-batch to ``write``, which must leave the same result when a batch is repeated."""
    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def epoch_writer(out: str) -> Callable[[DataFrame, int], None]:
    """One folder per epoch, replaced when the epoch is repeated."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
    return write


def totals_writer(out: str, alerts: str, threshold_pct: float = FAIL_ALERT_PCT) -> Callable[[DataFrame, int], None]:
    """Writes the running totals of each batch and, before the next batch begins, the alert that they call for, if any.

    ``batch``: one row of :func:`..operators.hostlog.run_totals` in complete mode. Both are replaced when a batch is repeated.
    """
    totals = epoch_writer(out)

    def write(batch: DataFrame, epoch: int) -> None:
        totals(batch, epoch)
        written = batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/epoch={epoch}")
        alert(written, threshold_pct).write.mode("overwrite").parquet(f"{alerts}/epoch={epoch}")
    return write


def _key_hashes(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with two hashes of their key, 128 bits together, and the bucket of the key log."""
    h1, h2 = F.xxhash64(*dedup_key()), F.xxhash64(F.lit("second"), *dedup_key())
    return rows.withColumns({"_h1": h1, "_h2": h2, "_bucket": F.pmod(h1, F.lit(buckets))})


def logged_keys(spark: SparkSession, log: str, buckets: list[int]) -> DataFrame:
    """Hashes of the keys written so far that fall into some buckets, from the folders of these buckets alone."""
    files = spark._jvm.org.apache.hadoop.fs.Path(log).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [p for p in (f"{log}/_bucket={b}" for b in buckets) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    kind = "_h1 long, _h2 long, _bucket long, _epoch long"
    return spark.read.schema(kind).option("basePath", log).parquet(*paths) if paths else spark.createDataFrame([], kind)


def first_listings_writer(existing: DataFrame, out: str, order: list[str], buckets: int = KEY_BUCKETS) -> Callable[[DataFrame, int], None]:
    """Rows of each batch whose key is neither among ``existing`` nor was written by an earlier batch, the first per key.

    The memory is a log of key hashes beside the output, in folders by bucket; a batch reads the buckets of its own keys only,
    and none of the rows written before. A repeated epoch replaces what it wrote and does not see its own keys or later ones.
    """
    log = f"{out}-keys"

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        path = f"{out}/epoch={epoch}"
        fresh = _key_hashes(new_listings(known_rows(existing), batch, order, complete=False), buckets).persist()
        try:
            touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())
            known = logged_keys(spark, log, touched).where(F.col("_epoch") < epoch).select("_h1", "_h2")
            rows = fresh.join(known, ["_h1", "_h2"], "left_anti")
            rows.drop("_h1", "_h2", "_bucket").select(*batch.columns).write.mode("overwrite").parquet(path)
            keys = _key_hashes(spark.read.schema(batch.schema).parquet(path), buckets).select(
                "_h1", "_h2", "_bucket", F.lit(epoch).cast("long").alias("_epoch"))
            keys.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_epoch").parquet(log)
        finally:
            fresh.unpersist()
    return write
