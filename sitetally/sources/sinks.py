"""Writers. All write folders of part files; none gathers rows in one place."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.cells import join_list
from .readers import read_csv


ROWS_PER_FILE = 1_000_000  # a file with line breaks in cells is read by one task, so files stay small


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path, header=True, nullValue="", emptyValue="", escape='"',
                                                                             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def detections_flat(found: DataFrame) -> DataFrame:
    """The 22 columns of the flat file, lists joined by ``;``."""
    lists = {f.name for f in found.schema.fields if f.dataType.typeName() == "array"}
    return found.select(*[
        (join_list(F.col(f.name)) if f.name in lists else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schemas.DETECTION_CSV.fields])


def write_detections_csv(found: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_csv(detections_flat(found), path, mode)


def write_detections_jsonl(found: DataFrame, path: str, mode: str = "errorifexists") -> None:
    found.write.mode(mode).json(path, ignoreNullFields=False)


def write_practices(practices: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_csv(practices.select(*schemas.PRACTICE.fieldNames()), path, mode)


def write_host_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The 16 columns of the host file, the evidence sample among them."""
    write_csv(report.select(*schemas.HOST_REPORT), path, mode)


def write_json_document(doc: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``doc``: one row with the document in ``value``."""
    doc.select("value").write.mode(mode).text(path)


def identity(df: DataFrame, key: str) -> Column:
    """The key of a row; where it is missing, a hash of all cells as they are written, so that other rows differ from it."""
    cells = F.concat_ws("\u001f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    own = F.col(key).cast("string")
    return F.when(F.coalesce(own, F.lit("")) != "", F.concat(F.lit("key:"), own)).otherwise(F.concat(F.lit("row:"), F.sha2(cells, 256)))


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows that are not in the folder yet, by key or, without one, as a whole; running it again adds nothing.

    A run that breaks off leaves nothing behind that a reader sees, as Spark commits the files of a job together.
    """
    spark = df.sparkSession
    try:
        done = read_csv(spark, path, df.schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        fresh = df
    else:
        done = done.select(identity(done, key).alias("_done")).distinct()
        fresh = df.withColumn("_id", identity(df, key)).join(done, F.col("_id") == F.col("_done"), "left_anti").drop("_id")
    write_csv(fresh, path, "append")
