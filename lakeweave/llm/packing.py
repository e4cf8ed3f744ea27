"""Mixture-controlled packing: deficit round-robin over source queues fills fixed windows of token ids."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.llm.common import stored
from lakeweave.llm.tokens import SPACED, TokenCache, crc_of, texts_of

WINDOW = 1024
SLOT = 128
MAX_QUEUES = 1024
_CELLS_AT_ONCE = 1 << 20


class RoundRobin:
    """Deficit round-robin over queues of known length, in closed form.

    A round stands for one window. It grants every queue that is not empty its share of the window; the queue sends whole
    slots for what it has been granted so far and carries the rest, less than a slot, into the next round (an ending queue sends all it has).
    What a queue has sent before a round depends on its length, its weight and the number of the round only: ids may be cut
    anywhere. So any task can enter the schedule at any round with the right deficits, and the windows of
    all tasks join without gaps.
    """

    def __init__(self, lengths: np.ndarray, weights: np.ndarray, window: int, slot: int):
        self.lengths, self.weights = lengths.astype(np.int64), weights.astype(np.float64)
        self.window, self.slot = window, slot
        total = int(self.lengths.sum())
        self.rounds = math.ceil(total / window)
        # Granted tokens of all queues are a piecewise linear function of the tokens granted per unit of weight.
        ends = np.unique(self.lengths / self.weights)
        self.level = np.concatenate(([0.0], ends))
        self.granted = np.array([np.minimum(self.lengths, self.weights * v).sum() for v in self.level])

    def sent(self, rounds: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Ids that a queue has sent before a round. Non-decreasing in the round."""
        level = np.interp(rounds * float(self.window), self.granted, self.level)
        length = self.lengths[queue]
        grant = self.weights[queue] * level
        done = (rounds >= self.rounds) | (grant >= length * (1 - 1e-12))
        return np.where(done, length, np.minimum(length, np.floor(grant / self.slot).astype(np.int64) * self.slot))

    def round_of(self, queue: int, slots: np.ndarray) -> np.ndarray:
        """The round in which a queue sends each of its slots."""
        need = np.minimum((slots + 1) * self.slot, self.lengths[queue])
        guess = np.ceil(np.interp(need / self.weights[queue], self.level, self.granted) / self.window).astype(np.int64) - 1
        found = np.clip(guess, 0, self.rounds - 1)
        while True:  # rounding may put the guess a round off
            late = (found > 0) & (self.sent(found, queue) >= need)
            early = self.sent(found + 1, queue) < need
            if not (late | early).any():
                return found
            found = found - late + early

    def places(self, queue: int, rounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each round: the place in the whole sequence where the queue's turn starts, and what it has sent before."""
        every = np.arange(len(self.lengths))
        start = np.empty(len(rounds), dtype=np.int64)
        step = max(1, _CELLS_AT_ONCE // len(every))
        for at in range(0, len(rounds), step):
            r = rounds[at : at + step, None]
            before = self.sent(r, every[None, :])
            turn = (self.sent(r + 1, every[None, :queue]) - before[:, :queue]).sum(axis=1) if queue else 0
            start[at : at + step] = before.sum(axis=1) + turn
        return start, self.sent(rounds, queue)

    def pieces(self, queue: int, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cuts of documents that lie at ``starts`` in the queue: document, its first id, length, place in the sequence."""
        first, last = starts // self.slot, (starts + lengths - 1) // self.slot
        many = last - first + 1
        doc = np.repeat(np.arange(len(starts)), many)
        slot = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        slots, back = np.unique(slot, return_inverse=True)
        rounds, turn = np.unique(self.round_of(queue, slots), return_inverse=True)
        start, sent = self.places(queue, rounds)
        place_of_slot = (start - sent)[turn] + slots * self.slot
        low = np.maximum(starts[doc], slot * self.slot)
        high = np.minimum(starts[doc] + lengths[doc], (slot + 1) * self.slot)
        place = place_of_slot[back] + low - slot * self.slot
        # A slot is shorter than a window, so it crosses one border at most.
        border = (place // self.window + 1) * self.window
        over = np.nonzero(place + high - low > border)[0]
        cut = low[over] + border[over] - place[over]
        doc, low, high, place = (np.concatenate((x, y)) for x, y in ((doc, doc[over]), (low, cut), (high, high[over]), (place, border[over])))
        high[over] = cut
        order = np.lexsort((low, doc))
        doc, low, high, place = doc[order], low[order], high[order], place[order]
        # Slots of one turn follow each other: one piece, as long as document and window are the same.
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + (high - low)[:-1]) | (place[1:] % self.window == 0)
        at = np.nonzero(new)[0]
        return doc[at], low[at] - starts[doc[at]], np.add.reduceat(high - low, at) if len(at) else at, place[at]


def _encode(tokenizer_path: str, end_id: int):
    """Ids of each document in the type of the cache, its length, and its place among the task's ids of its source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TokenCache.of(tokenizer_path, SPACED)
        task, used = TaskContext.get().partitionId(), {}
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                ids, lengths, places = [], [], []
                for source, found in zip(part.column(1).to_pylist(), cache.encode(texts_of(part.column(2))), strict=True):
                    ids.append(np.append(found, np.uint32(end_id)).astype(cache.width).tobytes())
                    lengths.append(len(found) + 1)
                    places.append(used.get(source, 0))
                    used[source] = places[-1] + lengths[-1]
                tasks = pa.array([task] * len(part), pa.int32())
                columns = [*part.columns[:2], tasks, pa.array(places, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "task", "place", "n", "ids"])

    return run


def _cut(schedule: RoundRobin, width: str, with_ids: bool):
    """Pieces of each document with their window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, base, n = (batch.column(c).to_numpy() for c in ("queue", "at", "n"))
            ids = batch.column("ids")
            for q in np.unique(queue):
                rows = np.nonzero(queue == q)[0]
                doc, start, length, place = schedule.pieces(int(q), base[rows], n[rows])
                for low in range(0, len(doc), 8192):
                    high = min(low + 8192, len(doc))
                    row = rows[doc[low:high]]
                    parts, last, flat = [], -1, None
                    for r, a, m in zip(row.tolist(), start[low:high].tolist(), length[low:high].tolist(), strict=True):
                        if r != last:
                            last, flat = r, np.frombuffer(ids[r].as_buffer(), dtype=width).astype("<u4")
                        parts.append(flat[a : a + m])
                    columns = [
                        batch.column("doc_id").take(pa.array(row)), batch.column("source").take(pa.array(row)), pa.array(start[low:high]), pa.array(length[low:high]),
                        pa.array([crc_of(x) for x in parts], pa.int64()), pa.array(n[row]),
                        pa.array(place[low:high] // schedule.window), pa.array(place[low:high] % schedule.window),
                    ]
                    names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                    if with_ids:
                        columns.append(pa.array([x.tobytes() for x in parts], pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, window: int = WINDOW, slot: int = SLOT,
    weights: Mapping[str | None, float] | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pack all documents ``(doc_id, text, source)`` into sequences of ``window`` ids.

    One row per piece: ``(doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, and the ids as 32-bit integers if
    ``with_ids``. Every id lies in one piece; only the last sequence is shorter than the window.

    Each source is a queue, and its target proportion of every window is its weight among the queues that are not empty; without ``weights`` it is its
    share of all ids, so that all queues last to the end. The proportions hold in every window but for less than a slot per queue.
    The largest ``MAX_QUEUES`` - 1 sources have their own queue, all others share one, which bounds the schedule that every task gets.

    A null or empty text is its end id alone; a null source is a source; null ids and repeated rows are packed like any other. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = stored(
        docs.select("doc_id", "source", "text").mapInArrow(_encode(tokenizer_path, end_id), f"doc_id {kind}, source string, task int, place long, n long, ids binary"),
        "pack_ids",
    )
    amounts = stored(encoded.groupBy("source", "task").agg(F.sum("n").alias("amount")), "pack_amounts")
    totals = amounts.groupBy("source").agg(F.sum("amount").alias("total"))
    largest = totals.orderBy(F.desc("total"), F.col("source").asc_nulls_first()).limit(MAX_QUEUES - 1).collect()
    everything = totals.agg(F.sum("total")).first()[0] or 0
    lengths = [r.total for r in largest]
    weight = [float(weights.get(r.source, 1.0)) if weights else float(r.total) for r in largest]
    rest = everything - sum(lengths)
    if rest:
        lengths.append(rest)
        weight.append(1.0 if weights else float(rest))
    if not lengths:
        return spark.createDataFrame([], f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    schedule = RoundRobin(np.array(lengths), np.array(weight), window, slot)
    queues = spark.createDataFrame([(r.source, i) for i, r in enumerate(largest)], "source string, queue int").withColumnRenamed("source", "_s")
    queue = F.coalesce("queue", F.lit(len(largest))).alias("queue")
    by_queue = amounts.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "task", "amount", queue)
    before = W.partitionBy("queue").orderBy("task", "source").rowsBetween(W.unboundedPreceding, -1)
    bases = by_queue.select(F.col("source").alias("_s"), F.col("task").alias("_t"), "queue", F.coalesce(F.sum("amount").over(before), F.lit(0)).alias("base"))
    # One row per task and source. As a stored table its size is known, so the ids stay where they are while it is small.
    placed = encoded.join(stored(bases, "pack_bases"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("task") == F.col("_t")))
    width = TokenCache.of(tokenizer_path, SPACED).width.str
    rows = placed.select("doc_id", "source", "n", "ids", "queue", (F.col("base") + F.col("place")).alias("at"))
    schema = f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_cut(schedule, width, with_ids), schema + (", ids binary" if with_ids else ""))
