"""Fill-in-middle transformation: a text is cut at line ends into prefix, middle and suffix, and the middle is moved last.

A unit is a line with its end, or the last line without one; ``regexp_count`` gives their number ``n``. Two cuts ``a <= b``
come from a hash of the row's id, so they are the same wherever and however often a row is computed. Each row has its own
pattern, in which possessive groups ``unit{a}`` and ``unit{b-a}`` take prefix and middle: one match captures all three
parts, and no step back is ever taken, so long texts need neither stack nor more than one pass.

NULL text: read as empty. Empty texts, and texts that hold a marker, stay as they are (form ``plain``). NULL id: hashed as
the empty text. Repeated rows get equal results. An empty table gives no rows. Only the key and the results are returned,
so extra columns of any name do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"(?:[^\n]*+\n|[^\n]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
CHANGED_PERCENT = 100
SPM_PERCENT = 50
#: Order of the parts, and where they go back to.
FORMS = {
    "psm": (f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z", "$1$3$2"),
    "spm": (f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2", rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z", "$2$3$1"),
}


def dice(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 for a row, from its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def has_marker(text: Column) -> Column:
    return text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)


def by_form(form: Column, of: dict[str, Column], otherwise: Column) -> Column:
    for name, value in of.items():
        otherwise = F.when(form == name, value).otherwise(otherwise)
    return otherwise


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone: the first marker of each kind is the one that was put in."""
    return by_form(form, {f: F.regexp_replace(output, pattern, back) for f, (_, pattern, back) in FORMS.items()}, output)


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
                changed_percent: int = CHANGED_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``key``, ``text``, units ``n``, ``form``, ``output``, and of changed texts ``prefix_chars`` and ``middle_chars``."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    h1, h2, h3, h4 = dice(F.col("key"), seed)
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    rows = rows.withColumns({
        "a": F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), "b": F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)),
        "form": F.when((F.col("text") == "") | has_marker(F.col("text")) | (h3 % 100 >= changed_percent), "plain")
                 .when(h4 % 100 < spm_percent, "spm").otherwise("psm")})
    own = F.format_string(rf"(?s)\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*)\z", F.col("a"), F.col("b") - F.col("a"))
    order = by_form(F.col("form"), {f: F.lit(put) for f, (put, _, _) in FORMS.items()}, F.lit(""))
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col("text"))
                           .otherwise(F.regexp_replace("text", own, order)))
    at = {m: F.instr("output", m).cast("long") for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix = {"psm": at[SUFFIX] - 1 - len(PREFIX), "spm": at[MIDDLE] - at[PREFIX] - len(PREFIX)}
    middle = F.length("output") - at[MIDDLE] + 1 - len(MIDDLE)
    none = F.lit(None).cast("long")
    return rows.select(
        F.col("key").alias(key), F.col("text"), "n", "form", "output", by_form(F.col("form"), prefix, none).alias("prefix_chars"),
        F.when(F.col("form") != "plain", middle.cast("long")).alias("middle_chars"))
