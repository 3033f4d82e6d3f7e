"""SentencePiece encoding as a max-plus parallel scan, and decoding.

A text is normalised as its vocabulary file says for plain text (a space in front, spaces as U+2581) and cut into the pieces
with the highest sum of scores. A character that no piece covers costs ``UNKNOWN`` below the lowest score and becomes its
bytes. The best cut of a long text is found in parallel:

* a text longer than ``CHUNK`` characters is cut at fixed places. A state of such a place is how many characters the piece
  over it reaches beyond it (0 to the longest piece less one). Each chunk yields the matrix of best scores from every state
  at its beginning to every state at its end;
* the matrices are combined by (max, +) products: within groups of ``GROUP`` chunks, then over the groups of a text; from
  the left for the best way to a state, from the right for the best way on;
* with the best state at both ends, every chunk finds its own pieces, independently of all others.

No piece goes on behind a space, so inside a chunk the words are cut one by one, and each distinct word once a worker: the
new words of many texts together, place by place for all words of a length. Only the words over a place where a text is cut
need their states. Scores are whole numbers; ``TIES`` adds a fixed small amount
to each piece, so that the best cut is unique and both ways find the same.

NULL or empty text: no pieces. Rows with equal id and text are one document. U+2581 in a text is read as a space.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, resident, saved

CHUNK, GROUP = 8192, 64
HELD = 1 << 21  # characters of the texts whose new words are cut together
FEW = 24  # words of one length are cut together if there are more
UNKNOWN = 10
BARRED = -1e8  # the files give this to pieces that are never to be chosen
TIES = 1 << 32
NEVER = -(1 << 62)
PLACES = np.random.default_rng(1).integers(0, TIES >> 4, 4096).tolist()
SPACE = "▁"


class Pieces:
    """A SentencePiece vocabulary as a table of scores; encodes words, spans with states, and decodes."""

    def __init__(self, path: str, limit: int = 600_000):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        plain = [i for i in plain if sp.get_score(i) > BARRED]
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        self.ids = {self.names[i]: i for i in plain}
        self.scores = {self.names[i]: round(sp.get_score(i)) * TIES for i in plain}
        self.unknown = min(round(sp.get_score(i)) for i in plain) * TIES - UNKNOWN * TIES
        self.points = np.full(size, self.unknown // TIES, dtype=np.int64)
        self.points[plain] = [round(sp.get_score(i)) for i in plain]
        self.longest = max(map(len, self.ids))
        # beginnings of pieces that are none themselves have no score; what is not here begins no piece
        self.table = {p[:k]: None for p in self.ids for k in range(1, len(p))} | self.scores
        self.plain_text = [chr(self.of_byte[i]) if i in self.of_byte else name for i, name in enumerate(self.names)]
        self.part_bytes = np.zeros(size, dtype=bool)
        self.part_bytes[[i for i, b in self.of_byte.items() if b > 127]] = True
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on behind a space")
        self.limit, self.known = limit, {}
        # the same table as a trie: a node and the next character, in one number, lead to a node
        node = {"": 0} | {p: k + 1 for k, p in enumerate(self.table)}
        steps = sorted((node[p[:-1]] << 21 | ord(p[-1]), node[p]) for p in self.table)
        self.steps, self.to = (np.array([*x, -1], dtype=np.int64) for x in zip(*steps, strict=True))
        self.steps[-1] = np.iinfo(np.int64).max
        self.first = np.full(1 << 21, -1, dtype=np.int32)
        self.first[[ord(p) for p in self.table if len(p) == 1]] = [node[p] for p in self.table if len(p) == 1]
        self.node_score, self.node_id = np.full(len(node), NEVER, dtype=np.int64), np.full(len(node), -1, dtype=np.int32)
        for p, i in self.ids.items():
            self.node_score[node[p]], self.node_id[node[p]] = self.scores[p], i

    def normal(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def best(self, span: str, entry: dict[int, int], stop: int, origin: int = 0) -> tuple[list[int], list[int]]:
        """Best score of a cut at each place of ``span``, from ``entry`` places; and the place before. Pieces begin before
        ``stop`` (and may end beyond it). ``origin``: characters of the word before the span."""
        n = len(span)
        score, back = [NEVER] * (n + 1), [-1] * (n + 1)
        for place, s in entry.items():
            score[place] = s
        table, longest = self.table, self.longest
        for i in range(min(stop, n)):
            here = score[i]
            if here == NEVER:
                continue
            here += PLACES[(origin + i) & 4095]
            for j in range(i + 1, min(i + longest, n) + 1):
                piece = span[i:j]
                if piece in table:
                    s = table[piece]
                    if s is None:
                        if j > i + 1:
                            continue
                        s = self.unknown
                elif j == i + 1:
                    s = self.unknown
                else:
                    break
                if here + s > score[j]:
                    score[j], back[j] = here + s, i
        return score, back

    def traced(self, span: str, back: list[int], start: int, end: int) -> list[int]:
        out: list[list[int]] = []
        while end > start:
            piece = span[back[end]:end]
            known = self.ids.get(piece)
            out.append([known] if known is not None else [self.bytes[b] for b in piece.encode()])
            end = back[end]
        return [i for ids in reversed(out) for i in ids]

    def word(self, word: str) -> bytes:
        """Ids, of four bytes each, of a span that begins and ends where pieces must."""
        if (found := self.known.get(word)) is None:
            if len(self.known) > self.limit:
                self.known.clear()
            _, back = self.best(word, {0: 0}, len(word))
            found = self.known[word] = np.array(self.traced(word, back, 0, len(word)), dtype=np.int32).tobytes()
        return found

    def learn(self, texts: Iterable[list[str]]) -> None:
        """Cuts the words of ``texts`` that are not known yet, all of a length at once; ``word`` gives the same for each."""
        if len(self.known) > self.limit:
            self.known.clear()
        by_length: dict[int, list[str]] = defaultdict(list)
        for w in set().union(*texts).difference(self.known):
            by_length[len(w)].append(w)
        for n, words in by_length.items():
            if len(words) > FEW:
                self._together(words, n)

    def _together(self, words: list[str], n: int) -> None:
        """As ``best`` and ``traced`` of every word; a character that no piece covers goes by its negative number."""
        chars = np.ascontiguousarray(np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(-1, n).T).astype(np.int64)
        score = np.full((n + 1, len(words)), NEVER, dtype=np.int64)
        back, ids = (np.zeros((n + 1, len(words)), dtype=np.int32) for _ in range(2))
        score[0] = 0
        for i in range(n):
            here = score[i] + PLACES[i & 4095]
            better = here + self.unknown > score[i + 1]
            score[i + 1][better] = here[better] + self.unknown
            back[i + 1][better], ids[i + 1][better] = i, ~chars[i][better]
            node = self.first[chars[i]].astype(np.int64)
            at = np.flatnonzero(node >= 0)
            node = node[at]
            for j in range(i + 1, min(i + self.longest, n) + 1):
                if j > i + 1:
                    step = node << 21 | chars[j - 1][at]
                    place = np.searchsorted(self.steps, step)
                    there = self.steps[place] == step
                    at, node = at[there], self.to[place[there]]
                if not len(at):
                    break
                own = self.node_score[node]
                new = here[at] + own
                better = np.flatnonzero((own > NEVER) & (new > score[j][at]))
                w = at[better]
                score[j][w], back[j][w], ids[j][w] = new[better], i, self.node_id[node[better]]
        ends = np.zeros((n + 1, len(words)), dtype=bool)
        ends[n] = True
        for j in range(n, 0, -1):
            w = np.flatnonzero(ends[j])
            ends[back[j][w], w] = True
        ends = ends[1:].T
        flat, stops = ids[1:].T[ends], np.cumsum(ends.sum(axis=1)).tolist()
        covered = (~(ends & (ids[1:].T < 0)).any(axis=1)).tolist()
        packed, start = flat.tobytes(), 0
        for w, stop, simple in zip(words, stops, covered, strict=True):
            if simple:
                self.known[w] = packed[4 * start:4 * stop]
            else:
                found = ([i] if i >= 0 else [self.bytes[b] for b in chr(~i).encode()] for i in flat[start:stop].tolist())
                self.known[w] = np.array([x for ids in found for x in ids], dtype=np.int32).tobytes()
            start = stop

    def words(self, words: list[str]) -> np.ndarray:
        get = self.known.get
        return np.frombuffer(b"".join([get(w) or self.word(w) for w in words]), dtype=np.int32)

    def score(self, ids: np.ndarray) -> int:
        """Sum of the pieces' scores; a byte costs its share of an unknown character, so their sum is only a bound."""
        return int(self.points[ids].sum())

    def decode(self, ids: np.ndarray) -> str:
        """The normal text of ids; ``plain`` of it is the text."""
        parted, ids = self.part_bytes[ids].any(), ids.tolist()
        if not parted:
            return "".join(map(self.plain_text.__getitem__, ids))
        out, raw = [], bytearray()
        for i in ids:
            if (b := self.of_byte.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            out.append(self.names[i])
        return "".join(out) + raw.decode(errors="replace")


def pieces(path: str) -> Pieces:
    """One for all tasks of a worker."""
    return resident(f"pieces {path}", lambda: Pieces(path))


def plain(normal: str) -> str:
    return normal.replace(SPACE, " ")[1:]


def split(span: str) -> list[str]:
    """Words with the spaces before them; a piece never reaches over their borders."""
    parts = span.split(SPACE)
    if all(parts[1:]):
        out = [SPACE + p for p in parts]
        out[0] = parts[0]
        return out if parts[0] else out[1:]
    out, spaces = [parts[0]] if parts[0] else [], 1
    for p in parts[1:]:
        if p:
            out.append(SPACE * spaces + p)
            spaces = 1
        else:
            spaces += 1
    return [*out, SPACE * (spaces - 1)] if spaces > 1 else out


def border(span: str, start: int, stop: int) -> int:
    """First place from ``start`` where a word begins, or ``stop`` if there is none before it."""
    while 0 <= (at := span.find(SPACE, start)) < stop:
        if at and span[at - 1] != SPACE:
            return at
        start = at + 1
    return stop


def last_border(span: str, start: int, stop: int) -> int:
    while (at := span.rfind(SPACE, start, stop)) > start:
        if span[at - 1] != SPACE:
            return at
        stop = at
    return start


def transfer(p: Pieces, before: str, core: str, beyond: str, origin: int) -> np.ndarray:
    """Best scores from each state at the beginning of ``core`` to each state at its end, less the greatest of them.

    ``before``: the character in front; ``origin``: how many characters of the word there are in front.
    """
    n, states = len(core), p.longest
    out = np.full((states, states), NEVER, dtype=np.int64)
    span, shift = before + core + beyond, len(before)
    first = border(span, shift, shift + n)
    if first == shift + n:  # no word begins here: from every state on its own
        for e in range(min(states, n + len(beyond) + 1)):
            score, _ = p.best(core + beyond, {e: 0}, n, origin)
            for f, s in enumerate(score[n:n + states]):
                out[e, f] = s
        return level(out)
    last = last_border(span, first, shift + n)
    right, _ = p.best(span[last:], {0: 0}, shift + n - last)
    for e in range(min(states, first - shift + 1)):
        left, _ = p.best(span[shift:first], {e: 0}, first - shift, origin)
        if left[-1] > NEVER:
            for f, s in enumerate(right[shift + n - last:shift + n - last + states]):
                if s > NEVER:
                    out[e, f] = left[-1] + s
    return level(out)


def chunk_ids(p: Pieces, before: str, core: str, beyond: str, origin: int, e: int, f: int) -> np.ndarray:
    """Ids of the pieces that begin in ``core``, from state ``e`` to state ``f``."""
    n, span, shift = len(core), before + core + beyond, len(before)
    first = border(span, shift, shift + n)
    if first == shift + n:
        _, back = p.best(core + beyond, {e: 0}, n, origin)
        return np.array(p.traced(core + beyond, back, e, n + f), dtype=np.int32)
    last = last_border(span, first, shift + n)
    _, back = p.best(span[shift:first], {e: 0}, first - shift, origin)
    ids = p.traced(span[shift:first], back, e, first - shift)
    _, back = p.best(span[last:], {0: 0}, shift + n - last)
    tail = p.traced(span[last:], back, 0, shift + n - last + f)
    return np.concatenate([np.array(ids, dtype=np.int32), p.words(split(span[first:last])), np.array(tail, dtype=np.int32)])


def level(m: np.ndarray) -> np.ndarray:
    """Only differences matter for the best way; so sums stay small."""
    return np.where(m > NEVER, m - m.max(), NEVER)


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(max, +) product; what is impossible stays so."""
    sums = np.where((x[:, :, None] > NEVER) & (y[None] > NEVER), x[:, :, None] + y[None], NEVER)
    return level(sums.max(axis=1))


def _runs(rows: DataFrame, keys: list[str], order: str, fold: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``fold`` of the rows of each ``keys``, which come first and in order of ``order``; the document's id is the first."""
    def make():
        class Each:
            def __init__(self):
                self.key, self.rows = None, []

            def __call__(self, doc, *rest):
                key = str(doc), *rest[:len(keys) - 1]
                if key != self.key:
                    yield from self.close()
                    self.key = key
                self.rows.append((doc.decode() if isinstance(doc, bytes) else doc, *rest))

            def close(self):
                rows, self.rows = self.rows, []
                yield from fold(rows) if rows else ()
        return Each()

    return map_rows(rows.repartition(*keys).sortWithinPartitions(*keys, order), make, schema)


def _matrix(m: list[int]) -> np.ndarray:
    return np.array(m, dtype=np.int64).reshape(int(len(m) ** 0.5), -1)


def _grouped(rows: list[tuple]) -> Iterator[tuple]:
    doc, mark, g, _, m = rows[0]
    total = _matrix(m)
    for *_, m in rows[1:]:
        total = product(total, _matrix(m))
    yield doc, mark, g, total.ravel().tolist()


def best_states(ms: list[np.ndarray], into: np.ndarray, onward: np.ndarray) -> tuple[list, list]:
    """Best ways to each state before each matrix (``into`` leads to the first), and on from each state behind it."""
    to, after = [into], [onward]
    for m in ms[:-1]:
        to.append(product(to[-1][None], m)[0])
    for m in reversed(ms[1:]):
        after.append(product(m, after[-1][:, None])[:, 0])
    return to, after[::-1]


def _only(size: int) -> np.ndarray:
    out = np.full(size, NEVER, dtype=np.int64)
    out[0] = 0
    return out


def _over_groups(rows: list[tuple]) -> Iterator[tuple]:
    ms = [_matrix(m) for *_, m in rows]
    to, after = best_states(ms, _only(len(ms[0])), _only(len(ms[0])))
    for (doc, mark, g, _), x, y in zip(rows, to, after, strict=True):
        yield doc, mark, g, x.tolist(), y.tolist()


def _in_group(rows: list[tuple]) -> Iterator[tuple]:
    ms = [_matrix(r[4]) for r in rows]
    to, after = best_states(ms, *(np.array(x, dtype=np.int64) for x in rows[0][5:]))
    both = [np.where((a > NEVER) & (b > NEVER), a + b, NEVER) for a, b in
            zip([*to, product(to[-1][None], ms[-1])[0]], [product(ms[0], after[0][:, None])[:, 0], *after], strict=True)]
    states = [int(b.argmax()) for b in both]
    for (doc, mark, _, k, *_), e, f in zip(rows, states[:-1], states[1:], strict=True):
        yield doc, mark, k, e, f


ROW = "k int, n_chunks int, ids array<int>, score long, round_trip boolean"


def encoded(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``doc`` (id), ``mark`` (hash of the text), and the ids of every chunk: ``k`` of ``n_chunks``, ``ids``, ``score``,
    ``round_trip`` (whether they decode to the text they came from)."""
    data = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    kind = f"doc {data.schema['doc'].dataType.simpleString()}, mark long"

    def whole_texts():
        p = pieces(vocabulary)

        class Each:
            def __init__(self):
                self.held, self.many = [], 0

            def __call__(self, doc, mark, body):
                whole = p.normal((body or b"").decode())
                self.held.append((doc.decode() if isinstance(doc, bytes) else doc, mark, whole, split(whole)))
                self.many += len(whole)
                if self.many > HELD:
                    yield from self.close()

            def close(self):
                held, self.held, self.many = self.held, [], 0
                p.learn(words for *_, words in held)
                for doc, mark, whole, words in held:
                    ids = p.words(words)
                    yield doc, mark, 0, 1, ids, p.score(ids), p.decode(ids) == whole
        return Each()

    def first_pass():
        p = pieces(vocabulary)

        def each(doc, mark, body):
            doc = doc.decode() if isinstance(doc, bytes) else doc
            whole = p.normal(body.decode())
            count = -(-len(whole) // chunk)
            for k in range(count):
                s, t = k * chunk, min((k + 1) * chunk, len(whole))
                parts = whole[s - 1:s] if s else "", whole[s:t], whole[t:t + p.longest - 1]
                origin = s - last_border(whole, 0, s + 1)
                yield doc, mark, k, count, transfer(p, *parts, origin).ravel().tolist(), list(parts), origin
        return each

    is_long = F.coalesce(F.length("text") >= chunk, F.lit(False))  # a space comes in front
    short = map_rows(data.where(~is_long), whole_texts, f"{kind}, {ROW}")
    cut = saved(map_rows(data.where(is_long), first_pass, f"{kind}, k int, n_chunks int, m array<long>, parts array<string>, origin long"), "pieces")
    keys = ["doc", "mark"]
    # equal rows give equal chunks: one of each takes part in the scan, all find their states by the join
    cut = cut.withColumn("g", F.floor(F.col("k") / GROUP).cast("int"))
    one = cut.select(*keys, "g", "k", "m").dropDuplicates([*keys, "k"])
    groups = _runs(one.select(*keys, "g", "k", "m"), [*keys, "g"], "k", _grouped, f"{kind}, g int, m array<long>")
    ends = _runs(groups, keys, "g", _over_groups, f"{kind}, g int, into array<long>, onward array<long>")
    ends = ends.select(F.col("doc").alias("d"), F.col("mark").alias("w"), F.col("g").alias("h"), "into", "onward")
    full = one.join(ends, one["doc"].eqNullSafe(ends["d"]) & (F.col("mark") == F.col("w")) & (F.col("g") == F.col("h")))
    full = full.select(*keys, "g", "k", "m", "into", "onward")
    states = _runs(full, [*keys, "g"], "k", _in_group, f"{kind}, k int, e int, f int").select(F.col("doc").alias("d"), F.col("mark").alias("w"), F.col("k").alias("j"), "e", "f")

    def last_pass():
        p = pieces(vocabulary)

        class Each:
            def __init__(self):
                self.held, self.many = [], 0

            def __call__(self, doc, mark, k, n_chunks, parts, origin, e, f):
                self.held.append((doc.decode() if isinstance(doc, bytes) else doc, mark, k, n_chunks, parts, origin, e, f))
                self.many += len(parts[1])
                if self.many > HELD:
                    yield from self.close()

            def close(self):
                held, self.held, self.many = self.held, [], 0
                p.learn(split(parts[1]) for _, _, _, _, parts, *_ in held)
                for doc, mark, k, n_chunks, (before, core, beyond), origin, e, f in held:
                    ids = chunk_ids(p, before, core, beyond, origin, e, f)
                    yield doc, mark, k, n_chunks, ids, p.score(ids), p.decode(ids) == (core + beyond)[e:len(core) + f]
        return Each()

    known = cut.join(states, cut["doc"].eqNullSafe(states["d"]) & (F.col("mark") == F.col("w")) & (F.col("k") == F.col("j")))
    long_ones = map_rows(known.select("doc", "mark", "k", "n_chunks", "parts", "origin", "e", "f"), last_pass, f"{kind}, {ROW}")
    return short.unionByName(long_ones)


def decoded(encoded_rows: DataFrame, vocabulary: str) -> DataFrame:
    """``doc``, ``mark``, ``k``, ``span``: the normal text of each chunk's ids; in order they are the document's."""
    kind = f"doc {encoded_rows.schema['doc'].dataType.simpleString()}, mark long"

    def make():
        p = pieces(vocabulary)

        def each(doc, mark, k, ids):
            yield doc.decode() if isinstance(doc, bytes) else doc, mark, k, p.decode(np.array(ids, dtype=np.int32))
        return each

    return map_rows(encoded_rows.select("doc", "mark", "k", "ids"), make, f"{kind}, k int, span string")
