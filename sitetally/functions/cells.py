"""Multi-valued cells, defaults and small scalar helpers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used, also in lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def parse_list(cell: Column) -> Column:
    """``a; b;;c`` -> ``[a, b, c]``; NULL is the empty list."""
    parts = F.transform(F.split(F.coalesce(cell, F.lit("")), ";"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def join_list(items: Column, limit: int | None = None) -> Column:
    """The first ``limit`` items (or all) joined by ``;``."""
    return F.concat_ws(";", items if limit is None else F.slice(items, 1, limit))


def address(*parts: Column) -> Column:
    """Non-empty parts joined by a comma."""
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def pct(n: Column, d: Column) -> Column:
    return F.round(F.lit(100.0) * n / F.greatest(d, F.lit(1)), 2)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def ensure_column(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column has something other than white space."""
    for c in columns:
        df = df.where(F.trim(F.col(c)) != "")
    return df


def status_class(status: Column) -> Column:
    return (
        F.when(status.isNull(), "none")
        .when(status.between(200, 299), "2xx")
        .when(status == 403, "403")
        .when(status == 429, "429")
        .when(status == 503, "503")
        .when(status.between(400, 499), "other_4xx")
        .when(status >= 400, "other_error")
        .otherwise("other")
    )


def search_query(name: Column, alternatives: tuple[str, ...], name_chars: int) -> Column:
    """Quoted start of the name, then the alternatives; a term that is not one plain word is quoted."""
    terms = " OR ".join(t if t.isalnum() else f'"{t}"' for t in alternatives)
    return F.concat(F.lit('"'), F.substring(name, 1, name_chars), F.lit(f'" ({terms})'))
