"""Language of a text: word frequencies first, character n-grams for words that were never seen.

Each language has the relative frequency of its words. A word that any language knows is scored by its smoothed log
frequency in each; an unseen word by the mean over its known character n-grams of the greatest length of which any is
known, from ``LONGEST`` down to 1. A text's score per language is the mean over its words; ``score`` is the softmax of the
sum over at most ``SHARPEST`` words' worth of evidence.

The model is fitted on about ``SAMPLE`` labelled documents per language, chosen by a hash of the id (all if there are
fewer); the bound keeps the tables small enough to send to every task. Whole texts are counted and scored. ``und``: NULL
text or no letter. Ties go to the first language in alphabetical order. Without any labelled text everything is ``und``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, saved

SAMPLE = 1_000
LONGEST = 4
SMOOTH = 0.5
MIN_COUNT = 3
SHARPEST = 30
UNKNOWN = "und"


def letters(token: str) -> str:
    return "".join(c for c in token.lower() if c.isalpha())


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i:i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def fitted(docs: DataFrame, text: str = "text", lang: str = "lang", by: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Counts over the sample, gathered by Spark; the result is bounded by the sample's size."""
    data = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(by)).alias("h"))
    # one number per language; the model has a column for each of them anyway
    sizes = {r.lang: r["count"] for r in data.groupBy("lang").count().collect()}
    share = F.create_map(*(F.lit(x) for own, n in sorted(sizes.items()) for x in (own, 1e6 * sample / n)))
    chosen = data.where(F.pmod("h", F.lit(1_000_000)) < share[F.col("lang")] if sizes else F.lit(False)).select("lang", "text")

    def make():
        class Each:
            def __init__(self):
                self.counts: dict[str, Counter] = {}

            def __call__(self, own, body):
                self.counts.setdefault(own.decode(), Counter()).update(body.split())
                if sum(map(len, self.counts.values())) > 300_000:
                    yield from self.close()

            def close(self):
                for own, tokens in self.counts.items():
                    words: Counter = Counter()
                    for token, n in tokens.items():
                        if word := letters(token.decode()):
                            words[word] += n
                    units: Counter = Counter()
                    for word, n in words.items():
                        units[0, word] += n
                        for size in range(1, LONGEST + 1):
                            for gram in grams(word, size):
                                units[size, gram] += n
                    yield from ((own, size, unit, n) for (size, unit), n in units.items())
                self.counts = {}
        return Each()

    counted = map_rows(chosen, make, "lang string, size int, unit string, n long")
    units = saved(counted.groupBy("lang", "size", "unit").agg(F.sum("n").alias("n")), "language")
    totals = {(r[0], r[1]): r[2] for r in units.groupBy("lang", "size").agg(F.sum("n")).collect()}
    return Model.of(units.groupBy("size", "unit").agg(
        F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("all")).where(F.col("all") >= MIN_COUNT).select(
        "size", "unit", F.explode("by").alias("b")).select("size", "unit", "b.lang", "b.n").toPandas(), totals)


class Model:
    """For each size (0: words), the row of log frequencies by language of each unit."""

    def __init__(self, languages: list[str], tables: dict[int, tuple[dict[str, int], np.ndarray]]):
        self.languages, self.tables = languages, tables

    @classmethod
    def of(cls, units, totals: dict[tuple[str, int], int]) -> Model:
        languages = sorted({own for own, _ in totals})
        at = {own: k for k, own in enumerate(languages)}
        tables = {}
        for size in range(LONGEST + 1):
            part = units[units["size"] == size]
            row = {u: k for k, u in enumerate(sorted(set(part["unit"])))}
            counts = np.zeros((len(row), len(languages)))
            counts[[row[u] for u in part["unit"]], [at[own] for own in part["lang"]]] = part["n"]
            all_n = np.array([totals.get((own, size), 0) for own in languages], dtype=float)
            tables[size] = row, np.log((counts + SMOOTH) / (all_n + SMOOTH * (len(row) + 1)))
        return cls(languages, tables)

    def word(self, word: str) -> np.ndarray:
        row, logs = self.tables[0]
        if (k := row.get(word)) is not None:
            return logs[k]
        for size in range(LONGEST, 0, -1):
            row, logs = self.tables[size]
            if found := [k for g in grams(word, size) if (k := row.get(g)) is not None]:
                return logs[found].mean(axis=0)
        return np.zeros(len(self.languages))


class Scorer:
    """Scores texts; remembers the tokens seen, within a bound."""

    def __init__(self, model: Model, limit: int = 200_000):
        self.model, self.limit = model, limit
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.rows = np.zeros((1 << 12, max(1, len(self.model.languages))))
        self.used = 1  # row 0: tokens without a letter

    def _row(self, token: bytes) -> int:
        word = letters(token.decode())
        if not word:
            return 0
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = self.model.word(word)
        self.used += 1
        return self.used - 1

    def __call__(self, text: bytes | None) -> tuple[str, float]:
        if not text or not self.model.languages:
            return UNKNOWN, 0.0
        if len(self.known) > self.limit:
            self._forget()
        known, tokens = self.known, text.split()
        get = known.get
        at = [get(t) for t in tokens]
        if None in at:
            for i, t in enumerate(tokens):
                if at[i] is None:
                    if (k := get(t)) is None:
                        k = known[t] = self._row(t)
                    at[i] = k
        at = np.array(at, dtype=np.int64)
        n = np.count_nonzero(at)
        if not n:
            return UNKNOWN, 0.0
        mean = self.rows[at].sum(axis=0) / n
        best = int(mean.argmax())
        return self.model.languages[best], float(1 / np.exp((mean - mean[best]) * min(n, SHARPEST)).sum())


def predicted(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``."""
    data = docs.select(F.col(text).alias("_text"), *keep)
    sent = data.sparkSession.sparkContext.broadcast(model)

    is_text = [data.schema[c].dataType.typeName() == "string" for c in keep]

    def make():
        scorer = Scorer(sent.value)

        def each(body, *rest):
            yield (*(r.decode() if t and r is not None else r for r, t in zip(rest, is_text, strict=True)), *scorer(body))
        return each

    kinds = ", ".join(f"`{c}` {data.schema[c].dataType.simpleString()}" for c in keep)
    return map_rows(data, make, f"{kinds}, lang_pred string, score double")
