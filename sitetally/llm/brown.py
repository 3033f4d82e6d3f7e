"""Brown class-based bigram model: exchange clustering, smoothed class transitions and word emissions.

``P(word | previous) = P(class | previous class) * P(word | class)``; a text is its words and one end.

* *Counts.* Every word of every training text is counted by Spark.
* *Items.* The first classes come from a bounded vocabulary: the most frequent words (about ``ITEMS``) and suffixes of the
  others (about ``SUFFIXES``, the longest known one counts, the empty one is the last resort). Every training token is one
  of them; the table of item bigrams is at most ``(ITEMS + SUFFIXES + 2) ** 2`` rows whatever the corpus.
* *Exchange of items.* Each round, Spark sums the bigrams to what each item has before and after it by class; then each item
  moves to the class that raises the likelihood of the class bigrams most. The end of a text is a class of its own.
* *Exchange of words.* Then every other word of the corpus gets a class of its own; it begins with that of its ending. Tasks
  gather what each word has before and after it by class, and move it, in blocks of words, to the class that raises the
  likelihood most against the class bigrams, which are counted anew after each turn. The ``HEAD`` words do so in up to ``TURNS``
  turns, then all others once. What would lower the likelihood is undone.
* *Unknown words* have the class of their ending.
* *Smoothing.* Transitions are interpolated with the class frequencies (``MU`` pseudo counts). Emissions are discounted
  by ``n1 / (n1 + 2 n2)``; the discounted mass of a class goes to the unseen words of that class.
* *Coded texts.* About ``HEAD`` words are numbers with counts and classes in every task. A text is written once as numbers and
  a list of its other words; what is known of these is brought to the text by joins, so that any word has its own class.

NULL text: empty, one token. NULL id: scored, not learned from. Repeated rows: equal results. Nothing to learn from: every
token is unseen, one class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, map_rows, saved, ship_package

CLASSES = 64
ITEMS, SUFFIXES, LONGEST_SUFFIX = 1500, 500, 3
HEAD = 1 << 18
ROUNDS = 8
TURNS = 2
AT_ONCE = 1 << 20  # words of texts, and those of one text
BLOCK = 2048  # words that are moved at a time
SPREAD = 32  # tasks that move the head words; their counts are few bytes, the moves are not
SLOTS = 256  # of a word: classes after it, classes before it, itself after itself
MU = 50.0
END = ""
STEPS = 16  # of a doubling of the count, where the frequent words are cut off


def counted(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over all texts; the end is the empty word."""
    def make():
        class Each:
            def __init__(self):
                self.seen: Counter = Counter()

            def __call__(self, body):
                self.seen.update((body or b"").lower().split())
                self.seen[b""] += 1
                if len(self.seen) > 400_000:
                    yield from self.close()

            def close(self):
                yield from ((w.decode(), n) for w, n in self.seen.items())
                self.seen = Counter()
        return Each()

    return map_rows(docs.select("text"), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The ``most`` words with the greatest counts, to a sixteenth of a doubling; of those of one step the least by hash.

    The sizes of the steps tell where the bound is, so only the words of one step are ranked, and no more than ``most`` taken.
    """
    step = F.floor(F.log2("n") * STEPS)
    sizes = words.groupBy(step.alias("step")).agg(F.count("*").alias("size")).orderBy(F.desc("step")).collect()
    total = 0
    for r in sizes:
        if total + r["size"] > most:
            tied = words.where(step == r["step"]).orderBy(F.xxhash64("word"), "word").limit(most - total)
            return words.where(step > r["step"]).unionByName(tied)
        total += r["size"]
    return words


@dataclass
class Items:
    """Numbers of the clustered words and suffixes; 0 is the end, 1 the empty suffix."""

    words: dict[bytes, int]
    suffixes: dict[str, int]

    def __len__(self) -> int:
        return 2 + len(self.words) + len(self.suffixes)

    def of(self, word: bytes) -> int:
        if not word:
            return 0
        if (k := self.words.get(word)) is not None:
            return k
        tail = word.decode()[-LONGEST_SUFFIX:]
        for i in range(len(tail)):
            if (k := self.suffixes.get(tail[i:])) is not None:
                return k
        return 1


def chosen_items(vocabulary: DataFrame) -> Items:
    top = _frequent(vocabulary.where(F.col("word") != END), ITEMS)
    words = sorted(r.word for r in top.select("word").collect())
    rest = vocabulary.where(F.col("word") != END).join(F.broadcast(top.select("word")), "word", "left_anti")
    tails = rest.select(F.explode(F.array_distinct(F.array(*(F.substring("word", -k, k) for k in range(1, LONGEST_SUFFIX + 1)))))
                        .alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    suffixes = sorted(r.word for r in _frequent(saved(tails, "suffixes"), SUFFIXES).select("word").collect())
    return Items({w.encode(): k + 2 for k, w in enumerate(words)}, {s: k + 2 + len(words) for k, s in enumerate(suffixes)})


def packed(x: np.ndarray, codec: pa.Codec) -> bytes:
    """Int32 numbers, compressed byte by byte: all first bytes, all second ones, ..."""
    return codec.compress(np.ascontiguousarray(x.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes(), asbytes=True)


def unpacked(x: bytes, many: int, codec: pa.Codec) -> np.ndarray:
    whole = np.frombuffer(codec.decompress(x, 4 * many, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(whole.reshape(4, -1).T).view(np.int32).ravel()


def coded(docs: DataFrame, head: list[bytes], items: Items) -> DataFrame:
    """``row``, other columns of ``docs``, ``many``, ``ids``, ``rare`` and ``endings`` of each text: numbers of its words and the end
    (packed), the words that have none, and their items. Number k > 0 is the k-th head word, 0 the end, -k the k-th of ``rare``."""
    sent = docs.sparkSession.sparkContext.broadcast((head, items))
    own = [c for c in docs.columns if c != "text"]

    def make():
        words, items = sent.value
        number = {b"": 0} | {w: k for k, w in enumerate(words, 1)}
        get, rows, codec = number.get, iter(range(TaskContext.get().partitionId() << 40, 1 << 62)), pa.Codec("zstd")

        def each(body, *doc):
            words = (body or b"").lower().split()
            words.append(b"")
            ids, rare = np.fromiter(map(get, words, repeat(-1)), dtype=np.int32, count=len(words)), {}
            for i in np.flatnonzero(ids < 0).tolist():
                ids[i] = ~rare.setdefault(words[i], len(rare))
            yield next(rows), *(d.decode() if isinstance(d, bytes) else d for d in doc), len(ids), packed(ids, codec), [w.decode() for w in rare], list(map(items.of, rare))
        return each

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in own)
    return saved(map_rows(docs.select("text", *own), make, f"row long, {kinds}many int, ids binary, rare array<string>, endings array<int>"), "coded")


class Tokens:
    """The words of a batch of coded texts, one after the other. Before the first is an end."""

    def __init__(self, batch: pa.RecordBatch):
        codec, self.lengths = pa.Codec("zstd"), batch.column("many").to_numpy().astype(np.int64)
        self.ids = np.concatenate([unpacked(x, n, codec) for x, n in zip(batch.column("ids").to_pylist(), self.lengths.tolist(), strict=True)])
        lists = batch.column("rare")
        self.many = np.diff(np.asarray(lists.offsets).astype(np.int64))
        self.rare, self.endings = lists.flatten(), np.asarray(batch.column("endings").flatten())
        self.at = np.flatnonzero(self.ids < 0)  # the words of the lists
        text = np.searchsorted(np.cumsum(self.lengths), self.at, side="right")
        self.of = (np.cumsum(self.many) - self.many)[text] + ~self.ids[self.at]  # which of ``rare``

    def spread(self, head: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """For each word its value of ``head`` by number or of ``rare`` by place."""
        out = head[np.maximum(self.ids, 0)]
        out[self.at] = rare[self.of]
        return out


def previous(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=x.dtype), x[:-1]])


def map_tokens(texts: DataFrame, make: Callable[[], Callable[[pa.RecordBatch, Tokens], Iterable[tuple]]], schema: str) -> DataFrame:
    """``make()`` runs once a task and gives a function from a batch and its words to tuples of columns; rows of its ``close``
    come last."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship_package(texts.sparkSession.sparkContext)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(columns: tuple) -> Iterator[pa.RecordBatch]:
            arrays = [c.cast(t.type) if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, arrow, strict=True)]
            whole = pa.RecordBatch.from_arrays(arrays, schema=arrow)
            yield from (whole.slice(k, 1 << 16) for k in range(0, whole.num_rows, 1 << 16))
        each = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = np.flatnonzero(np.diff(np.cumsum(batch.column("many").to_numpy().astype(np.int64)) // AT_ONCE)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                for columns in each(part, Tokens(part)):
                    yield from made(columns)
        if hasattr(each, "close"):
            for columns in each.close():
                yield from made(columns)
        del each
        give_back()

    return texts.mapInArrow(run, schema)


def packed_counts(codes: np.ndarray, n: np.ndarray, span: int) -> tuple:
    """Columns of ``COUNTS``: counts of rising codes, a row for each ``span`` of codes."""
    if not len(codes):
        return [], [], [], []
    codec, part = pa.Codec("zstd"), codes // span
    ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(part))
    begins = np.append(0, ends[:-1])
    spans = list(zip(begins.tolist(), ends.tolist(), strict=True))
    return (part[begins], ends - begins, [packed(np.diff(codes[a:b], prepend=int(part[a]) * span), codec) for a, b in spans],
            [packed(n[a:b], codec) for a, b in spans])


COUNTS = "part int, many int, codes binary, n binary"


def summed_counts(rows: pd.DataFrame, span: int) -> tuple[int, np.ndarray]:
    """The first code of a span, and the sums of all its codes."""
    out, codec = np.zeros(span, dtype=np.int64), pa.Codec("zstd")
    for many, codes, n in zip(rows["many"], rows["codes"], rows["n"], strict=True):
        out[np.cumsum(unpacked(codes, many, codec))] += unpacked(n, many, codec)
    return int(rows["part"].iloc[0]) * span, out


def _pairs(texts: DataFrame, size: int, make_values: Callable[[], Callable]) -> DataFrame:
    """``a``, ``b``, ``n``: counts of a number below ``size`` after another one."""
    def make():
        values = make_values()

        class Each:
            def __init__(self):
                self.sums = np.zeros(size * size, dtype=np.int64)

            def __call__(self, batch, tokens):
                x = values(batch, tokens).astype(np.int64)
                self.sums += np.bincount(previous(x) * size + x, minlength=size * size)
                return ()

            def close(self):
                at = np.flatnonzero(self.sums)
                yield packed_counts(at, self.sums[at], BLOCK * SLOTS)
        return Each()

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        first, n = summed_counts(rows, BLOCK * SLOTS)
        at = np.flatnonzero(n)
        return pd.DataFrame({"a": (first + at) // size, "b": (first + at) % size, "n": n[at]})

    return map_tokens(texts, make, COUNTS).groupBy("part").applyInPandas(summed, "a int, b int, n long")


def bigrams(texts: DataFrame, items: Items, head: list[bytes]) -> DataFrame:
    """``a``, ``b``, ``n``: how often item ``b`` follows ``a``; a text begins after an end and ends with one."""
    sent = texts.sparkSession.sparkContext.broadcast(np.array([0, *map(items.of, head)]))
    return _pairs(texts, len(items), lambda: lambda batch, tokens: tokens.spread(sent.value, tokens.endings))


def _gain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def contexts(pairs: DataFrame, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """What each item has after and before it, by class: two tables of items x classes, summed by Spark."""
    spark = pairs.sparkSession
    table = F.broadcast(spark.createDataFrame([(k, int(c)) for k, c in enumerate(of)], "item int, c int"))
    after = pairs.join(table, pairs["b"] == table["item"]).groupBy(F.col("a").alias("i"), "c").agg(F.sum("n").alias("n"))
    before = pairs.join(table, pairs["a"] == table["item"]).groupBy(F.col("b").alias("i"), "c").agg(F.sum("n").alias("n"))
    out = []
    for side in (after, before):
        m, got = np.zeros((len(of), classes)), side.toPandas()
        m[got["i"], got["c"]] = got["n"]
        out.append(m)
    return out[0], out[1]


def exchanged(pairs: DataFrame, size: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each item, and the class bigram counts. Class 0 is the end's."""
    selves = {r.a: r.n for r in pairs.where("a = b").collect()}
    own = np.array([selves.get(k, 0) for k in range(size)], dtype=float)
    after, _ = contexts(pairs, np.zeros(size, dtype=np.int64), classes)
    count = after.sum(axis=1)
    rank = np.empty(size, dtype=np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(size)
    of = 1 + rank % (classes - 1)
    of[0] = 0
    for turn in range(rounds + 1):
        after, before = contexts(pairs, of, classes)
        joint = np.zeros((classes, classes))
        np.add.at(joint, of, after)
        if turn == rounds:
            break
        total = joint.sum(axis=1)
        moved = 0
        for w in np.argsort(-count, kind="stable"):
            if w == 0 or not count[w]:
                continue
            old, r, left, s, n = of[w], after[w].copy(), before[w].copy(), own[w], count[w]
            r[old] -= s
            left[old] -= s
            joint[old] -= r
            joint[:, old] -= left
            joint[old, old] -= s
            total[old] -= n
            np.maximum(joint, 0, out=joint)
            gain = (_gain(joint + r) - _gain(joint)).sum(axis=1) + (_gain(joint + left[:, None]) - _gain(joint)).sum(axis=0)
            d = joint.diagonal()
            gain += _gain(d + r + left + s) + _gain(d) - _gain(d + r) - _gain(d + left)
            gain -= 2 * (_gain(total + n) - _gain(np.maximum(total, 0)))
            gain[0] = -np.inf
            new = int(gain.argmax())
            joint[new] += r
            joint[:, new] += left
            joint[new, new] += s
            total[new] += n
            moved += new != old
            of[w] = new
        if not moved:
            break
    return of, joint


def gains(joint: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Words x classes: how much the sum of ``x log x`` over class bigrams, less twice that over classes, grows when the word,
    taken out of its ``old`` class, is put into each class. ``after``, ``before``: what it has next to it, by class; ``own`` of
    both are the word itself, counted for its old class.

    Only cells of a word's neighbours change, so only those are looked at.
    """
    classes, w = len(joint), np.arange(len(old))
    n = after.sum(axis=1)
    after, before = after.copy(), before.copy()
    after[w, old] -= own
    before[w, old] -= own
    flat, total = _gain(joint), joint.sum(axis=1)
    out = -2 * (_gain(total + n[:, None]) - _gain(total))
    out[w, old] = -2 * (_gain(total[old]) - _gain(np.maximum(total[old] - n, 0)))
    for table, level, x in ((joint.T, flat.T, after), (joint, flat, before)):  # rows: the neighbour's class
        i, k = np.nonzero(x > 0)
        for start in range(0, len(i), 1 << 15):
            e, f = i[start:start + (1 << 15)], k[start:start + (1 << 15)]
            if not len(e):
                continue
            more = x[e, f]
            rise = _gain(table[f] + more[:, None]) - level[f]
            at = np.arange(len(e))
            # its old class has the word's own bigrams already
            rest = np.maximum(table[f, old[e]] - more - np.where(f == old[e], own[e], 0), 0)
            rise[at, old[e]] = _gain(rest + more) - _gain(rest)
            first = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
            out[e[first]] += np.add.reduceat(rise, first, axis=0)
    # bigrams with the old class lose the word's own on the other side of them
    for table, x, y in ((joint, after, before), (joint.T, before, after)):
        i, c = np.nonzero((y > 0) & (x[w, old] > 0)[:, None])
        i, c = i[c != old[i]], c[c != old[i]]
        level, more = table[c, old[i]], x[i, old[i]]
        rest = np.maximum(level - y[i, c], 0)
        out[i, c] += _gain(rest + more) - _gain(rest) - _gain(level + more) + _gain(level)
    # cells of a class with itself
    i, c = np.nonzero(((after > 0) & (before > 0)) | (own > 0)[:, None])
    d, r, l, s = joint[c, c], after[i, c], before[i, c], own[i]
    same = c == old[i]
    d = np.where(same, np.maximum(d - r - l - s, 0), d)
    out[i, c] += _gain(d + r + l + s) - _gain(d)
    out[i, c] -= np.where(same, 0, _gain(d + r) + _gain(d + l) - 2 * _gain(d))
    if same.any():  # as they were taken above
        i, r, l, s = i[same], r[same], l[same], s[same]
        cell = joint[old[i], old[i]]
        for x in (r, l):
            rest = np.maximum(cell - x - s, 0)
            out[i, old[i]] -= np.where(x > 0, _gain(rest + x) - _gain(rest), 0)
    return out


class Mover:
    """Moves words of a task to their best classes, in blocks: one word at first, then a sixteenth of those before, later half. What a
    block has moved is in the class bigrams of the next, so that words that are alike do not all go where only the first should."""

    def __init__(self, joint: np.ndarray):
        self.joint, self.done = joint.copy(), 0

    def __call__(self, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
        """New classes: the old one if none is better."""
        out, start = old.copy(), 0
        while start < len(old):
            size = min(BLOCK, 1 + self.done // (16 if self.done < 128 else 2), len(old) - start)
            part = slice(start, start + size)
            out[part] = self._block(old[part], after[part], before[part], own[part])
            start, self.done = start + size, self.done + size
        return out

    def _block(self, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
        gain, w = gains(self.joint, old, after, before, own), np.arange(len(old))
        gain[:, 0] = -np.inf  # the end's
        best = gain.argmax(axis=1)
        new = np.where(gain[w, best] > gain[w, old] + 1e-9, best, old)
        at = np.flatnonzero(new != old)
        a, b, r, l, s = old[at], new[at], after[at].copy(), before[at].copy(), own[at]
        r[np.arange(len(at)), a] -= s
        l[np.arange(len(at)), a] -= s
        for to, sign in ((a, -1), (b, 1)):
            np.add.at(self.joint, to, sign * r)
            np.add.at(self.joint.T, to, sign * l)
            np.add.at(self.joint, (to, to), sign * s)
        np.maximum(self.joint, 0, out=self.joint)
        return new


def likelihood(joint: np.ndarray) -> float:
    return float(_gain(joint).sum() - 2 * _gain(joint.sum(axis=1)).sum())


def _classes_of(of: np.ndarray, head_of: np.ndarray) -> Callable[[pa.RecordBatch, Tokens], np.ndarray]:
    """Classes of all words of a batch: ``c`` has those of its lists, and the ending tells where there is none."""
    def values(batch: pa.RecordBatch, tokens: Tokens) -> np.ndarray:
        if "c" not in batch.schema.names:
            return tokens.spread(head_of, of[tokens.endings])
        return tokens.spread(head_of, np.asarray(batch.column("c").flatten()))
    return values


def moved_head(texts: DataFrame, of: np.ndarray, head_of: np.ndarray, fixed: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Classes of the head words after a turn; those that are ``fixed`` stay."""
    context = texts.sparkSession.sparkContext
    sent = context.broadcast((of, head_of, fixed, joint))

    def make():
        of, head_of, fixed, _ = sent.value
        values = _classes_of(of, head_of)

        class Each:
            def __init__(self):
                self.held, self.many = [], 0

            def __call__(self, batch, tokens):
                c, ids = values(batch, tokens).astype(np.int64), tokens.ids.astype(np.int64)
                at = np.flatnonzero((ids > 0) & ~fixed[np.maximum(ids, 0)])
                before, word = previous(c)[at], ids[at] * SLOTS
                twice = at[ids[at] == previous(ids)[at]]
                self.held += [word + c[at + 1], word + CLASSES + before, ids[twice] * SLOTS + 2 * CLASSES]
                self.many += 2 * len(at)
                if self.many > 2_000_000:
                    yield from self.close()

            def close(self):
                if self.many:
                    yield packed_counts(*np.unique(np.concatenate(self.held), return_counts=True), BLOCK * SLOTS)
                self.held, self.many = [], 0
        return Each()

    def move(rows: pd.DataFrame) -> pd.DataFrame:
        _, head_of, _, joint = sent.value
        first, x = summed_counts(rows, BLOCK * SLOTS)
        first, x = first // SLOTS, x.reshape(BLOCK, SLOTS).astype(float)
        at = np.flatnonzero(x.any(axis=1))
        new = Mover(joint)(head_of[first + at].astype(np.int64), x[at, :CLASSES], x[at, CLASSES:2 * CLASSES], x[at, 2 * CLASSES])
        return pd.DataFrame({"id": first + at, "c": new})

    got = map_tokens(texts, make, COUNTS).repartition(SPREAD, "part").groupBy("part").applyInPandas(move, "id int, c int").toPandas()
    out = head_of.copy()
    out[got["id"].to_numpy()] = got["c"].to_numpy()
    return out


def moved_rare(texts: DataFrame, of: np.ndarray, head_of: np.ndarray, joint: np.ndarray) -> DataFrame:
    """``word``, ``row``, ``place``, ``n``, ``was``, ``c`` for each word in the list of a text: its count in all texts and its
    class before and after a turn. Written. Words stream in order, so no word is gathered."""
    sent = texts.sparkSession.sparkContext.broadcast((of, head_of, joint))

    def make():
        of, head_of, _ = sent.value
        values = _classes_of(of, head_of)

        def each(batch, tokens):
            if not len(tokens.at):
                return
            c = values(batch, tokens).astype(np.uint8)
            order = np.argsort(tokens.of, kind="stable")
            at = tokens.at[order]
            same = tokens.ids[at] == previous(tokens.ids)[at]
            around = np.stack([c[at + 1], previous(c)[at], same], axis=1).astype(np.uint8)
            ends = np.cumsum(np.bincount(tokens.of, minlength=len(tokens.rare))) * 3
            blob = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(around.tobytes())])
            begin = np.cumsum(tokens.many) - tokens.many
            was = np.zeros(len(ends), dtype=np.int32)
            was[tokens.of] = c[tokens.at]
            yield (tokens.rare, np.repeat(batch.column("row").to_numpy(), tokens.many),
                   (np.arange(len(ends)) - np.repeat(begin, tokens.many)).astype(np.int32), was, blob)
        return each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        move, held = Mover(sent.value[2]), None
        for batch in _and_none(batches):
            if batch is not None:
                held = pa.concat_batches([held, batch]) if held is not None else batch
                if not held.num_rows:
                    continue
            if held is None or not held.num_rows:
                break
            word = held.column("word").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            if batch is None:
                part, held = held, None
            else:  # the last word may go on
                if len(starts) == 1:
                    continue
                part, held, starts = held.slice(0, starts[-1]), held.slice(starts[-1]), starts[:-1]
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, part.num_rows)))
            blobs = part.column("around").to_pylist()
            around = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, 3).astype(np.int64)
            of_word = np.repeat(group, [len(b) // 3 for b in blobs])
            old = part.column("was").to_numpy()[starts].astype(np.int64)
            new, n = old.copy(), np.bincount(of_word, minlength=len(starts))
            for first in range(0, len(starts), BLOCK):
                size = min(BLOCK, len(starts) - first)
                a, b = np.searchsorted(of_word, [first, first + size])
                w, x = of_word[a:b] - first, around[a:b]
                after = np.bincount(w * CLASSES + x[:, 0], minlength=size * CLASSES).reshape(size, CLASSES).astype(float)
                before = np.bincount(w * CLASSES + x[:, 1], minlength=size * CLASSES).reshape(size, CLASSES).astype(float)
                own = np.bincount(w, weights=x[:, 2], minlength=size)
                new[first:first + size] = move(old[first:first + size], after, before, own)
            yield pa.RecordBatch.from_arrays(
                [part.column("word"), part.column("row"), part.column("place"), pa.array(n[group]), pa.array(old[group], pa.int32()),
                 pa.array(new[group], pa.int32())], names=["word", "row", "place", "n", "was", "c"])

    rows = map_tokens(texts, make, "word string, row long, place int, was int, around binary")
    dealt = rows.repartition("word").sortWithinPartitions("word")
    return saved(dealt.mapInArrow(run, "word string, row long, place int, n long, was int, c int"), "classes")


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def known(texts: DataFrame, classes: DataFrame, *figures: str) -> DataFrame:
    """``texts`` with a column for each of ``figures`` (of ``row``, ``place``): a list as long as ``rare``."""
    base = [c for c in texts.columns if c not in figures]
    lists = F.sort_array(F.collect_list(F.struct("place", *figures)))
    own = classes.groupBy("row").agg(lists.alias("found"))
    joined = texts.join(own, "row", "left")
    none = {f: F.array().cast(f"array<{classes.schema[f].dataType.simpleString()}>") for f in figures}
    return joined.select(*base, *(F.coalesce(F.col("found")[f], none[f]).alias(f) for f in figures))


@dataclass
class Model:
    items: Items
    of: np.ndarray  # class of each item
    log_next: np.ndarray  # log10 P(class | previous class)
    size: np.ndarray  # training tokens by class
    unseen: np.ndarray  # log10 of an unseen word's probability by class
    discount: float
    tokens: int  # N
    words: int  # V
    head: tuple[list[bytes], np.ndarray, np.ndarray]  # frequent words; counts and classes, with the end before them


def _whole(pairs: DataFrame) -> np.ndarray:
    out = np.zeros((CLASSES, CLASSES))
    for r in pairs.collect():
        out[r.a, r.b] = r.n
    return out


def exchanged_words(texts: DataFrame, items: Items, of: np.ndarray, joint: np.ndarray,
                    head: list[bytes]) -> tuple[np.ndarray, DataFrame, DataFrame, np.ndarray]:
    """Each word's own class: of the head words by number; of the others by word and text, as ``moved_rare`` has them, and with
    ``texts``, as lists ``n`` and ``c``. And the class bigrams."""
    context = texts.sparkSession.sparkContext

    def class_bigrams(of_texts: DataFrame, head_of: np.ndarray) -> np.ndarray:
        sent = context.broadcast((of, head_of))
        return _whole(_pairs(of_texts, CLASSES, lambda: _classes_of(*sent.value)))

    head_of = of[np.array([0, *map(items.of, head)])].astype(np.int64)
    fixed = np.array([True, *(w in items.words for w in head)])
    for _ in range(0 if fixed.all() else TURNS):
        new_head = moved_head(texts, of, head_of, fixed, joint)
        new = class_bigrams(texts, new_head)
        if likelihood(new) <= likelihood(joint):
            break
        head_of, joint = new_head, new
    classes = moved_rare(texts, of, head_of, joint)
    own = saved(known(texts, classes, "n", "c"), "known")
    new = class_bigrams(own, head_of)
    if likelihood(new) < likelihood(joint):
        classes = classes.withColumn("c", F.col("was"))
        return head_of, classes, saved(known(texts, classes, "n", "c"), "known"), joint
    return head_of, classes, own, new


def learned(docs: DataFrame, learn: Column) -> tuple[Model, DataFrame, DataFrame, DataFrame]:
    """The model of the texts where ``learn``; the words that are not in its head: ``word``, ``n``, ``c``; those texts as
    ``known``; all others of ``docs`` as ``coded``."""
    vocabulary = saved(counted(docs.where(learn)), "words")
    tokens, words, n1, n2 = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    items = chosen_items(vocabulary)
    most = _frequent(vocabulary.where(F.col("word") != END), HEAD).orderBy(F.desc("n"), "word").toPandas()
    head, n = [w.encode() for w in most["word"]], most["n"].to_numpy(dtype=np.int64)
    every = coded(docs.withColumn("learn", F.coalesce(learn, F.lit(False))), head, items)
    texts = every.where("learn")
    of, joint = exchanged(saved(bigrams(texts, items, head), "bigrams"), len(items))
    head_of, classes, texts, joint = exchanged_words(texts, items, of, joint, head)
    others = saved(classes.groupBy("word").agg(F.first("n").alias("n"), F.first("c").alias("c")), "others")
    discount = min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))

    types = np.bincount(head_of[(0 if tokens else 1):], minlength=CLASSES).astype(float)
    for r in others.groupBy("c").agg(F.count("*").alias("n")).collect():
        types[r.c] += r.n
    size = joint.sum(axis=0)
    prior = (size + 1) / (size + 1).sum()
    following = (joint + MU * prior) / (joint.sum(axis=1, keepdims=True) + MU)
    unseen = (discount * types + 1) / (size + 1)  # classes that are empty so far: all their mass
    model = Model(items, of, np.log10(following), size, np.log10(np.minimum(unseen, 1)), discount, tokens, words,
                  (head, np.append(int(size[0]), n), head_of))
    return model, others, texts, every.where("not learn")


def trained(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of all texts of ``docs`` (``text``), and the table of the words that are not in its head: ``word``, ``n``, ``c``."""
    return learned(docs.select("text"), F.lit(True))[:2]


def emission(n: np.ndarray, size: np.ndarray, discount: float) -> np.ndarray:
    return np.log10((n - discount) / (size + 1))


def looked_up(texts: DataFrame, others: DataFrame) -> DataFrame:
    """Coded texts with lists ``n`` and ``c`` for the words that are not in the head; 0 and -1 if the model has not seen them."""
    words = texts.select("row", F.posexplode("rare").alias("place", "word")).join(others, "word", "left")
    return known(texts, words.select("row", "place", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("c", F.lit(-1)).alias("c")), "n", "c")


def scores(texts: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` of each of ``texts``, which have lists ``n`` and ``c``."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    least = float(np.log10(model.tokens + model.words + 1))

    def make():
        m: Model = sent.value
        _, counts, head_of = m.head

        def sums(x, lengths):
            return np.add.reduceat(x, np.cumsum(lengths) - lengths)

        def each(batch, tokens):
            n, c = (np.asarray(batch.column(x).flatten()).astype(np.int64) for x in ("n", "c"))
            if (c < 0).any():  # not a word of the training texts
                c = np.where(c < 0, m.of[tokens.endings], c)
            n, c = tokens.spread(counts, n), tokens.spread(head_of, c)
            score = np.where(n > 0, emission(np.maximum(n, 1), m.size[c], m.discount), m.unseen[c]) + m.log_next[previous(c), c]
            yield (batch.column("doc_id"), tokens.lengths, sums((n > 0).astype(np.int64), tokens.lengths),
                   sums(np.log10(n + 1.0), tokens.lengths) - tokens.lengths * least, sums(score, tokens.lengths))
        return each

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_tokens(texts, make, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def scored(docs: DataFrame, model: Model, others: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score``; a row for each of ``docs``."""
    return scores(looked_up(coded(docs.select("doc_id", "text"), model.head[0], model.items), others), model)


def trained_and_scored(docs: DataFrame, learn: Column) -> tuple[Model, DataFrame]:
    """The model of the texts where ``learn``, and ``scored`` of all; each text is coded once."""
    model, others, own, rest = learned(docs.select("doc_id", "text"), learn)
    return model, scores(own, model).unionByName(scores(looked_up(rest, others), model))
