"""Packing of tokenised documents into windows by minimum bin slack.

Each window takes the largest remaining length as its seed. A bitset holds the
sums that multisets of the other remaining lengths reach (one shift for each
power of two of a length's count); the highest sum within the window is chosen
and its counts are read back through the kept bitsets. Where no multiset fills
the window, one document is cut to fill it.

Documents are packed in blocks of a task's own rows: no shuffle, memory bounded
by a block, and a lost task gives the same rows again.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from terrafold.llm.common import text_or_empty
from terrafold.llm.tokens import encoder

#: Ids that are packed together; a longer document makes a block of its own.
BLOCK_IDS = 1 << 21

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def best_multiset(counts: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Counts by length whose sum is the highest that does not exceed ``room``.

    counts: (length, how many there are).
    """
    reached, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, left in counts:
        if length > room:
            continue
        take = 1
        left = min(left, room // length)
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            left -= take
            take *= 2
            if reached >> room & 1:
                break
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


class _Pool:
    """Remaining parts of documents, by length."""

    def __init__(self):
        self.lengths: list[int] = []
        self.parts: dict[int, list[tuple[int, int]]] = {}
        self.total = 0

    def put(self, length: int, doc: int, start: int) -> None:
        if length not in self.parts:
            insort(self.lengths, length)
            self.parts[length] = []
        self.parts[length].append((doc, start))
        self.total += length

    def take(self, length: int) -> tuple[int, int]:
        part = self.parts[length].pop()
        if not self.parts[length]:
            del self.parts[length]
            del self.lengths[bisect_right(self.lengths, length) - 1]
        self.total -= length
        return part

    def cut(self, length: int) -> tuple[int, int]:
        """The first ``length`` ids of the shortest part that is longer."""
        longer = self.lengths[bisect_right(self.lengths, length)]
        doc, start = self.take(longer)
        self.put(longer - length, doc, start + length)
        return doc, start


def pack_lengths(lengths: list[int], window: int = 4096) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every id once.

    All sequences are full, but for what remains at the end: it is less than a
    window and goes to sequences whose lengths are powers of two.
    """
    pool, sequences = _Pool(), []
    for doc, length in enumerate(lengths):
        start = 0
        while length - start >= window:
            sequences.append([(doc, start, window)])
            start += window
        if length > start:
            pool.put(length - start, doc, start)
    sizes = []
    while pool.total:
        if pool.total >= window:
            size = window
        else:
            sizes = sizes or [1 << b for b in range(pool.total.bit_length()) if pool.total >> b & 1]
            size = sizes.pop()
        sequences.append(_fill(pool, size))
    return sequences


def _fill(pool: _Pool, size: int) -> list[tuple[int, int, int]]:
    fitting = bisect_right(pool.lengths, size)
    filled, room = [], size
    if fitting:
        seed = pool.lengths[fitting - 1]
        filled.append((*pool.take(seed), seed))
        room -= seed
        counts = [(x, len(pool.parts[x])) for x in reversed(pool.lengths[: bisect_right(pool.lengths, room)])]
        for length, times in best_multiset(counts, room).items():
            for _ in range(times):
                filled.append((*pool.take(length), length))
                room -= length
    while room:
        if pool.lengths[-1] > room:
            filled.append((*pool.cut(room), room))
            room = 0
        else:  # every part left is shorter than the room
            length = pool.lengths[-1]
            filled.append((*pool.take(length), length))
            room -= length
    return filled


def _blocks(batches, path: str, end_id: int) -> Iterator[list[tuple[int, bytes]]]:
    coder, block, held = encoder(path), [], 0
    end = end_id.to_bytes(4, "little")
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = coder.encode(text.as_py()) + end
            block.append((doc_id, ids))
            held += len(ids) // 4
            if held >= BLOCK_IDS:
                yield block
                block, held = [], 0
    if block:
        yield block


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of the documents' ids, each with its sequence and place in it.

    A document is the ids of its text, then ``end_id``. Null and empty texts
    hold the end alone. Repeated rows are documents of their own; rows whose id
    is null are packed too. An empty table gives no piece. Other columns are
    left behind, whatever their names. Sequences are numbered by task and order
    within the task, so numbers are unique but not without gaps.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for block in _blocks(batches, path, end_id):
            rows = []
            for sequence in pack_lengths([len(ids) // 4 for _, ids in block], window):
                offset = 0
                for doc, start, length in sequence:
                    doc_id, ids = block[doc]
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, piece, len(ids) // 4, number, offset))
                    offset += length
                number += 1
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(run, PIECES)
