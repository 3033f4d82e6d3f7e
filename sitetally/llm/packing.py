"""Hierarchical packing of documents into token sequences of several context sizes.

A document's ids are cut into full windows of the longest context; what is left over is routed to the smallest context
size (tier) that holds it. Each tier is packed into sequences of its own size, from the longest down: the longest piece
opens a sequence, its gap is filled with the largest fitting pieces of this and the shorter tiers, and what then remains
is filled by the beginning of a shorter piece, so that sequences end up full. What is left at the end of a task is cut at
powers of two. Every sequence is thus full, or has a power of two of tokens. Step groups hold ``STEP_TOKENS`` tokens each,
of one size of sequence and of any task, so that steps cost the same; only the last group of a size may hold less.

Packing needs no shuffle: each task packs its own partition, holding at most ``POOL`` left-over pieces. Sequence ids are
the partition's number and a counter. An executor lost: the partition is read and packed again with the same result.
NULL text: the end id only. NULL or repeated ids: each row is a document of its own. No rows: no sequences.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, saved

TIERS = (2048, 1024, 512, 256)
END_ID = 1
POOL = 4096
STEP_TOKENS = 1 << 18
PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, nth long"


class Packer:
    """Pieces are (length, number of the piece, document, start, ids, tokens of the document), kept sorted by length."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, pool: int = POOL, with_ids: bool = False):
        self.tiers, self.limit, self.task, self.with_ids = tiers, pool, task, with_ids
        self.pools: dict[int, list] = {t: [] for t in tiers}
        self.tokens = dict.fromkeys(tiers, 0)
        self.count = self.sequences = 0
        self.in_tier: dict[int, int] = {}

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        most, n = self.tiers[0], len(ids)
        whole = n - n % most
        for start in range(0, whole, most):
            yield from self._emit(most, [(most, 0, doc, start, ids[start:start + most], n)])
        if whole < n:
            self._put(n - whole, doc, whole, ids[whole:], n)
        if sum(map(len, self.pools.values())) >= self.limit:
            yield from self._pack(last=False)

    def close(self) -> Iterator[tuple]:
        yield from self._pack(last=True)

    def _put(self, length: int, *rest) -> None:
        self.count += 1
        tier = min(t for t in self.tiers if t >= length)
        insort(self.pools[tier], (length, self.count, *rest))
        self.tokens[tier] += length

    def _take(self, tier: int, at: int) -> tuple:
        piece = self.pools[tier].pop(at)
        self.tokens[tier] -= piece[0]
        return piece

    def _emit(self, tier: int, pieces: list[tuple]) -> Iterator[tuple]:
        sequence = (self.task << 40) + self.sequences
        self.sequences += 1
        nth = self.in_tier.get(tier, 0)
        self.in_tier[tier] = nth + 1
        offset = 0
        for length, _, doc, start, ids, total in pieces:
            row = (doc, start, length, crc32(ids.astype("<u4").tobytes()), total, sequence, offset, tier, nth)
            yield (*row, ids.tolist()) if self.with_ids else row
            offset += length

    def _fitting(self, tier: int, gap: int) -> tuple | None:
        """The longest piece of this or a shorter tier that fits, else the beginning of the shortest one, cut."""
        lower = [t for t in self.tiers if t <= tier and self.pools[t]]
        for t in lower:
            if k := bisect_right(self.pools[t], (gap, float("inf"))):
                return self._take(t, k - 1)
        if not lower:
            return None
        length, k, doc, start, ids, total = self._take(lower[-1], 0)
        self._put(length - gap, doc, start + gap, ids[gap:], total)
        return gap, k, doc, start, ids[:gap], total

    def _pack(self, last: bool) -> Iterator[tuple]:
        for tier in self.tiers:
            while self.pools[tier]:
                if not last and sum(self.tokens[t] for t in self.tiers if t <= tier) < tier:
                    break
                row = [self._take(tier, -1)]
                gap = tier - row[0][0]
                while gap and (piece := self._fitting(tier, gap)):
                    row.append(piece)
                    gap -= piece[0]
                yield from self._powers(row) if gap else self._emit(tier, row)

    def _powers(self, row: list[tuple]) -> Iterator[tuple]:
        """Sequences with a power of two of tokens, the longest first, from pieces that do not fill a sequence."""
        total = sum(p[0] for p in row)
        while total:
            size = 1 << (total.bit_length() - 1)
            taken, room = [], size
            while room:
                length, k, doc, start, ids, n = row.pop(0)
                take = min(length, room)
                taken.append((take, k, doc, start, ids[:take], n))
                if take < length:
                    row.insert(0, (length - take, k, doc, start + take, ids[take:], n))
                room -= take
            yield from self._emit(size, taken)
            total -= size


def in_steps(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """``nth`` sequence of a size in its task -> ``step_group``: the sequences of each size are numbered over all tasks, from
    their numbers per task alone, and dealt to steps in that order; so all steps but the last one of a size are full."""
    task = F.shiftright("sequence_id", 40)
    counts = pieces.groupBy(F.col("tier").alias("_tier"), task.alias("_task")).agg((F.max("nth") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_tier").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_tier", "_task", F.coalesce(before, F.lit(0)).alias("_before"))
    group = F.shiftleft(F.col("tier").cast("long"), 40) + F.floor((F.col("_before") + F.col("nth")) * F.col("tier") / step_tokens)
    joined = pieces.join(counts, (F.col("tier") == F.col("_tier")) & (task == F.col("_task")))
    kept = [c for c in pieces.columns if c not in ("nth", "ids")]
    return joined.select(*kept, group.alias("step_group"), *(["ids"] if "ids" in pieces.columns else []))


def packed(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
           tiers: tuple[int, ...] = TIERS, pool: int = POOL, with_ids: bool = False,
           step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id``, place in the document, place in its sequence, tier and step group (and ids)."""
    data = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def make():
        from pyspark import TaskContext

        from .byte_bpe import encoder as shared

        encoder, packer = shared(vocabulary), Packer(TaskContext.get().partitionId(), tiers, pool, with_ids)

        class Each:
            close = packer.close

            def __call__(self, doc, body):
                ids = encoder.encode((body or b"").decode())
                doc = doc.decode() if isinstance(doc, bytes) else doc
                return packer.add(doc, np.append(ids, np.uint32(END_ID)))
        return Each()

    kind = data.schema["doc_id"].dataType.simpleString()
    return in_steps(saved(map_rows(data, make, f"doc_id {kind}, {PIECE}" + ", ids array<long>" * with_ids), "pieces"), step_tokens)
