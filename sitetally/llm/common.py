"""What several operators share: written tables, words of a text, and a row function over Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path

#: Words are runs of anything but these; ``bytes.split()`` without arguments splits at exactly them.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_GAP = r"[\x20\x09-\x0D]+"
M64 = (1 << 64) - 1


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and any executor can read it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL ids fall into no part."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@lru_cache(maxsize=8)
def ship_package(context: SparkContext) -> None:
    """Workers import the functions of this package: send it to them once, as they need not have it installed."""
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="sitetally-code-")) / "sitetally.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(str(archive))


def rows_to_arrow(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str, at_once: int = 500) -> DataFrame:
    """``make()`` runs once a task and gives a function from a row's values to result rows.

    Strings arrive as bytes. ``at_once`` rows are held at a time, and four times as many result rows, beside those of the last
    row, make a batch. If the function has a ``close``, its rows follow the last input row's.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship_package(df.sparkSession.sparkContext)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, out = make(), []
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                columns = [c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in part.columns]
                for values in zip(*(c.to_pylist() for c in columns), strict=True):
                    out.extend(each(*values))
                    if len(out) >= 4 * at_once:
                        yield rows_to_arrow(out, arrow)
                        out = []
        out.extend(each.close() if hasattr(each, "close") else ())
        for start in range(0, len(out), 4 * at_once):
            yield rows_to_arrow(out[start:start + 4 * at_once], arrow)
        del each, out
        give_back()

    return df.mapInArrow(run, schema)


#: What the tasks of a worker share; one thing only, as workers serve many operators one after the other.
_RESIDENT: dict[str, object] = {}


def resident(name: str, make: Callable[[], object]) -> object:
    """The worker's thing of this name, made when first asked for; what another operator left in the worker is dropped."""
    if name not in _RESIDENT:
        _RESIDENT.clear()
        give_back()
        _RESIDENT[name] = make()
    return _RESIDENT[name]


def give_back() -> None:
    """Free memory of the worker goes back to the machine, where the C library can do that."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


class WordHashes:
    """64-bit hashes of words, remembered; the memory is emptied at so many bytes, so its size is bounded."""

    def __init__(self, limit: int = 32 << 20):
        from xxhash import xxh3_64_intdigest

        self.hash, self.limit, self.known, self.held = xxh3_64_intdigest, limit, {}, 0

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, found = self.known, self.hash
        if self.held > self.limit:
            known.clear()
            self.held = 0
        get = known.get
        out = list(map(get, words))
        if None in out:
            for i, h in enumerate(out):
                if h is None:
                    w = words[i]
                    out[i] = known[w] = found(w)
                    self.held += len(w) + 150  # an entry's objects
        return np.array(out, dtype=np.uint64)


def word_hashes() -> WordHashes:
    """One for all tasks of a worker."""
    return resident("words", WordHashes)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` words, in order."""
    n = len(hashes) - size + 1
    with np.errstate(over="ignore"):
        mixed = np.zeros(max(n, 0), dtype=np.uint64)
        for k in range(size if n > 0 else 0):
            mixed = (mixed ^ hashes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return mixed
