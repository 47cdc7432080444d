"""Removal of byte strings that an earlier document holds, by suffix arrays.

Every window of ``length`` bytes has a key, the least hash of the shorter
strings in it, so equal windows have equal keys wherever they stand. Documents
lie in chunks; a chunk reports its distinct keys, and learns which of them
another document has too. Only windows of such keys go on, as segments (runs of
neighbouring windows of one key), each distinct one once a chunk. Segments of
one key meet in a shard; the shard's suffix array and permuted common prefixes
group its equal windows, and each group's least document goes back to the
chunks, which then remove what an earlier document has. Only a key of several
distinct segments needs sorting: where all segments of a key are one string,
its windows are known to be equal.

A key of many segments, such as that of a signature line in documents that
differ around it, is split: its windows go on one by one, each by the hash of
all its bytes, to shards of their own.

Chunks number about the square root of the bytes, so that a key that every
document holds comes once from each chunk; shards of segments grow with the
bytes. No step holds more than one chunk or one shard. Documents move once.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from terrafold.llm.common import worker_store
from terrafold.llm.suffix import permuted_common_prefixes, suffix_array

#: Bytes of the strings whose hashes make a window's key; windows in a segment;
#: bytes that are hashed at a time; the number of chunks for a root of bytes;
#: chunks for one shard of segments, and the most bytes of documents for one.
PART, RUN, STRIP, CHUNKS_PER_ROOT, CHUNKS_PER_SHARD, SHARD_BYTES = 24, 256, 1 << 17, 1 / 32, 4, 1 << 23
#: Distinct segments, summed over chunks, beyond which a key is split by windows;
#: windows that are hashed at a time.
SPLIT, WINDOWS = 4096, 1 << 15

_STEP = 0x9E3779B97F4A7C15
_NO_DOC = np.iinfo(np.int64).max


def _tables(size: int):
    """Random values of bytes, and powers of an odd number and of its inverse."""
    kept = worker_store()
    if kept.get("powers_size", 0) < size:
        powers = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            line = np.full(size + 1, base, np.uint64)
            line[0] = 1
            powers.append(np.multiply.accumulate(line))
        kept["powers"], kept["powers_size"] = powers, size
    values = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return values, *kept["powers"]


def _hashes(data, values, powers, inverse):
    """A hash of the PART bytes from each place."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * powers[:n], out=sums[1:])
    return _mixed((sums[PART:] - sums[:-PART]) * inverse[: n - PART + 1])


def _mixed(found):
    """Hashes whose bits depend on all bits."""
    found = found ^ (found >> np.uint64(31))
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    return found


def _least(values, width: int):
    """The least of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    if reach < width:
        values = np.minimum(values[: len(values) - (width - reach)], values[width - reach :])
    return values


def windows(texts: list[bytes], length: int):
    """Segments of texts: (key, start in the joined texts, bytes, text number).

    A segment is a run of windows of one key within one text, RUN of them at most.
    """
    parts, at, first = [], 0, 0
    empty = (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STRIP):
            size += len(texts[last])
            last += 1
        strip = texts[first:last]
        if size >= length:
            key, start, wide, number = _strip_windows(strip, length)
            parts.append((key, start + at, wide, number + first))
        at += size
        first = last
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else empty


def _strip_windows(texts: list[bytes], length: int):
    data = np.frombuffer(b"".join(texts), np.uint8)
    values, powers, inverse = _tables(len(data))
    keys = _least(_hashes(data, values, powers, inverse), length - PART + 1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number = np.repeat(np.arange(len(texts)), sizes)[: len(keys)]
    ends = np.cumsum(sizes)
    valid = np.arange(len(keys)) + length <= ends[number]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (number[1:] != number[:-1]) | ~valid[:-1]
    fresh |= ~valid
    heads = np.flatnonzero(fresh)
    run = np.diff(np.append(heads, len(keys)))
    real = valid[heads]
    heads, run = heads[real], run[real]
    if len(run) and run.max() > RUN:
        pieces = -(-run // RUN)
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        left = np.repeat(run, pieces) - turn * RUN
        heads = np.repeat(heads, pieces) + turn * RUN
        run = np.minimum(left, RUN)
    return keys[heads], heads, run + length - 1, number[heads]


def _hashes_at(data: bytes, starts, length: int):
    """A hash of the ``length`` bytes from each start."""
    values, powers, _ = _tables(length)
    data, found = np.frombuffer(data, np.uint8), np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), WINDOWS):
        part = starts[at : at + WINDOWS, None] + np.arange(length)
        found[at : at + WINDOWS] = (values[data[part]] * powers[:length]).sum(axis=1, dtype=np.uint64)
    return _mixed(found)


class _Chunk:
    """A chunk's documents in a fixed order, and their segments by shard."""

    def __init__(self, table, length: int, shards: int, slots: int = 1):
        ids = table.column("doc_id").to_pylist()
        texts = [t or b"" for t in table.column("bytes").to_pylist()]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i], i))
        self.ids = [ids[i] for i in self.order]
        self.texts = [texts[i] for i in self.order]
        # rows without id neither remove nor lose anything
        seen = [t if d is not None else b"" for d, t in zip(self.ids, self.texts)]
        self.data = b"".join(seen)
        self.ends = np.cumsum([len(t) for t in seen])
        key, start, wide, number = windows(seen, length)
        shard = ((key >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
        rest = key & np.uint64((1 << 40) - 1)
        by = np.lexsort((rest, shard))
        self.length, self.many_slots = length, slots
        self.shard, self.rest, self.start, self.wide, self.key = shard[by], rest[by], start[by], wide[by], key[by]
        self.slot = ((key[by] >> np.uint64(17)) % np.uint64(slots)).astype(np.int64)
        doc = np.array([d if d is not None else _NO_DOC for d in self.ids], np.int64)
        self.doc = doc[number[by]]
        change = np.ones(len(by), bool)
        change[1:] = (self.shard[1:] != self.shard[:-1]) | (self.rest[1:] != self.rest[:-1])
        self.head = np.flatnonzero(change)
        self.group = np.cumsum(change) - 1

    def shards(self):
        """(shard, first and last distinct key of it)."""
        held = self.shard[self.head]
        cuts = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(held))):
            yield int(held[a]), int(a), int(b)

    def flags(self, replies: dict[int, bytes]):
        """A bit for each distinct key, from the bits of each shard."""
        found = np.zeros(len(self.head), bool)
        for shard, a, b in self.shards():
            if replies.get(shard):
                found[a:b] = np.unpackbits(np.frombuffer(replies[shard], np.uint8))[: b - a]
        return found

    def counts(self):
        """Distinct segments of each distinct key; those that agree in both ends and width count as one."""
        ends = self.start + self.wide - PART
        content = _hashes_at(self.data, np.concatenate([self.start, ends]), PART)
        n = len(self.start)
        content = _mixed(content[:n] * np.uint64(_STEP) + content[n:] + self.wide.astype(np.uint64))
        by = np.lexsort((content, self.group))
        group, content = self.group[by], content[by]
        fresh = np.ones(n, bool)
        fresh[1:] = (group[1:] != group[:-1]) | (content[1:] != content[:-1])
        return np.bincount(group[fresh], minlength=len(self.head))

    def split(self, numbers):
        """Replace the segments of these distinct keys by their windows, whose key is the hash of their bytes."""
        if not len(numbers):
            return
        hot = np.zeros(len(self.head), bool)
        hot[numbers] = True
        hot = hot[self.group]
        times = self.wide[hot] - self.length + 1
        turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start = np.repeat(self.start[hot], times) + turn
        key = _hashes_at(self.data, start, self.length)
        slot = ((key >> np.uint64(17)) % np.uint64(self.many_slots)).astype(np.int64)
        both = lambda old, new: np.concatenate([old[~hot], new])
        self.doc, self.group = both(self.doc, np.repeat(self.doc[hot], times)), both(self.group, np.repeat(self.group[hot], times))
        self.start, self.wide = both(self.start, start), both(self.wide, np.full(len(start), self.length))
        self.key, self.slot = both(self.key, key), both(self.slot, slot)

    def slots(self):
        """(slot, numbers of its segments): where segments meet those of other chunks."""
        order = np.argsort(self.slot, kind="stable")
        held = self.slot[order]
        cuts = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(held))):
            yield int(held[a]), order[a:b]

    def distinct(self, own):
        """Distinct texts of segments, and the text of each."""
        starts, ends = self.start[own].tolist(), (self.start[own] + self.wide[own]).tolist()
        known: dict[bytes, int] = {}
        which = np.fromiter(
            (known.setdefault(self.data[s:e], len(known)) for s, e in zip(starts, ends)), np.int64, len(own)
        )
        return list(known), which


def _packed_40(values) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked_40(data: bytes):
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.reshape(-1).view("<u8")


KEYS = "shard long, chunk long, keys binary, twice binary, counts binary"
SHARED = "chunk long, shard long, shared binary, split binary"
SEGMENTS = "slot long, chunk long, used binary, n long, packed binary"
VERDICTS = "chunk long, slot long, used binary, runs binary"
_RUN = np.dtype([("text", "<i4"), ("start", "<i4"), ("end", "<i4"), ("doc", "<i8")])


def _table(schema: str, rows: list[tuple]):
    import pyarrow as pa

    fields = [x.split() for x in schema.split(",")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def _report_keys(length: int, shards: int):
    def run(table):
        chunk = _Chunk(table, length, shards)
        number = table.column("chunk")[0].as_py()
        least, most = np.full(len(chunk.head), _NO_DOC), np.full(len(chunk.head), -_NO_DOC)
        if len(chunk.head):
            least = np.minimum.reduceat(chunk.doc, chunk.head)
            most = np.maximum.reduceat(chunk.doc, chunk.head)
        several, rest = least != most, chunk.rest[chunk.head] if len(chunk.head) else chunk.rest
        counts = np.minimum(chunk.counts(), 65535).astype("<u2")
        return _table(
            KEYS,
            [(s, number, _packed_40(rest[a:b]), np.packbits(several[a:b]).tobytes(), counts[a:b].tobytes()) for s, a, b in chunk.shards()],
        )

    return run


def _find_shared(table):
    rows = table.to_pylist()
    keys = [_unpacked_40(r["keys"]) for r in rows]
    _, back, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = times > 1
    twice = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8))[: len(k)] for r, k in zip(rows, keys)])
    np.logical_or.at(shared, back, twice.astype(bool))
    counts = np.concatenate([np.frombuffer(r["counts"], "<u2") for r in rows])
    split = np.bincount(back, counts) > SPLIT
    flags, splits, at, out = shared[back], (shared & split)[back], 0, []
    for r, k in zip(rows, keys):
        own, hot = flags[at : at + len(k)], splits[at : at + len(k)]
        at += len(k)
        if own.any():
            out.append((r["chunk"], r["shard"], np.packbits(own).tobytes(), np.packbits(hot).tobytes() if hot.any() else b""))
    return _table(SHARED, out)


def _send_segments(length: int, shards: int, slots: int):
    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return _table(SEGMENTS, [])
        chunk = _Chunk(left, length, shards, slots)
        number = left.column("chunk")[0].as_py()
        reply = lambda name: chunk.flags(dict(zip(right.column("shard").to_pylist(), right.column(name).to_pylist())))
        shared, hot = reply("shared"), np.flatnonzero(reply("split"))
        chunk.split(hot)
        shared = shared[chunk.group]
        # what was split comes back to the chunk as it is
        out = [(-1 - number, number, b"", 0, zlib.compress(hot.tobytes(), 1))] if len(hot) else []
        for slot, numbers in chunk.slots():
            used = shared[numbers]
            if not used.any():
                continue
            own = numbers[used]
            texts, which = chunk.distinct(own)
            least, most = np.full(len(texts), _NO_DOC), np.full(len(texts), -_NO_DOC)
            np.minimum.at(least, which, chunk.doc[own])
            np.maximum.at(most, which, chunk.doc[own])
            widths = np.fromiter(map(len, texts), "<i4", len(texts))
            key = np.zeros(len(texts), np.uint64)
            key[which] = chunk.key[own]
            packed = zlib.compress(b"".join([least.tobytes(), most.tobytes(), key.tobytes(), widths.tobytes(), *texts]), 1)
            out.append((slot, number, np.packbits(used).tobytes(), len(texts), packed))
        return _table(SEGMENTS, out)

    return run


def _unpacked(n: int, packed: bytes):
    """(least documents, highest documents, keys, texts) of one chunk's segments."""
    data = zlib.decompress(packed)
    least, most = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n)
    ends = (np.cumsum(np.frombuffer(data, "<i4", n, 24 * n)) + 28 * n).tolist()
    return least, most, np.frombuffer(data, np.uint64, n, 16 * n), [data[s:e] for s, e in zip([28 * n, *ends[:-1]], ends)]


def least_documents(texts: list[bytes], docs, length: int):
    """For each window of distinct texts, in turn: the least document that holds an equal one.

    docs: the least document of each text. Returns (documents, first window of
    each text and the end).
    """
    if not texts:
        return docs[:0], np.zeros(1, np.int64)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    data[ends] = 1
    order = suffix_array(data, 258)
    common = permuted_common_prefixes(data, order, 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(-1, ends)))
    window = np.arange(len(data)) + length <= ends[owner]
    ranked = order[window[order]]
    joined = common[ranked] >= length
    # a suffix between two windows of one group would be a window of it too
    group = np.cumsum(~joined)
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.minimum.reduceat(docs[owner[ranked]], heads) if len(heads) else docs[:0]
    found = np.empty(len(data), np.int64)
    found[ranked] = least[np.cumsum(np.append(True, group[1:] != group[:-1])) - 1] if len(heads) else 0
    counts = np.fromiter((len(t) - length + 1 for t in texts), np.int64, len(texts))
    return found[window], np.append(0, np.cumsum(counts))


def runs_of_least(texts: list[bytes], keys, docs, length: int):
    """(text, first window, window after the last, least document) of runs of windows, by text.

    Distinct texts of one key each; a key's only text has its own least document.
    """
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    windows_of = np.fromiter((len(t) - length + 1 for t in texts), np.int64, len(texts))
    several = np.flatnonzero(times[back] > 1)
    alone = np.flatnonzero(times[back] == 1)
    least, first = least_documents([texts[i] for i in several], docs[several], length)
    head = np.ones(len(least), bool)
    head[1:] = least[1:] != least[:-1]
    head[first[:-1]] = True
    at = np.flatnonzero(head)
    owner = np.searchsorted(first, at, side="right") - 1
    begin, stop = at - first[owner], np.append(at[1:], len(least))[: len(at)] - first[owner]
    text = np.concatenate([several[owner], alone])
    begin = np.concatenate([begin, np.zeros(len(alone), np.int64)])
    stop = np.concatenate([stop, windows_of[alone]])
    doc = np.concatenate([least[at], docs[alone]])
    by = np.argsort(text, kind="stable")
    return text[by], begin[by], stop[by], doc[by]


def _judge(length: int):
    def run(table):
        rows = table.to_pylist()
        if rows[0]["slot"] < 0:
            return _table(VERDICTS, [(r["chunk"], r["slot"], b"", r["packed"]) for r in rows])
        known: dict[bytes, int] = {}
        places = []
        for r in rows:
            own_least, own_most, key, texts = _unpacked(r["n"], r.pop("packed"))
            which = np.fromiter((known.setdefault(t, len(known)) for t in texts), np.int64, len(texts))
            places.append((which, own_least, own_most, key))
        docs, keys = np.full(len(known), _NO_DOC), np.zeros(len(known), np.uint64)
        for which, own_least, _, key in places:
            np.minimum.at(docs, which, own_least)
            keys[which] = key
        owner, begin, stop, doc = runs_of_least(list(known), keys, docs, length)
        run_first = np.searchsorted(owner, np.arange(len(known) + 1))
        out = []
        for r, (which, _, most, _) in zip(rows, places):
            times = run_first[which + 1] - run_first[which]
            text = np.repeat(np.arange(len(which)), times)
            index = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(run_first[which], times)
            useful = doc[index] < most[text]
            text, index = text[useful], index[useful]
            if len(index):
                runs = np.empty(len(index), _RUN)
                runs["text"], runs["start"], runs["end"], runs["doc"] = text, begin[index], stop[index], doc[index]
                out.append((r["chunk"], r["slot"], r["used"], zlib.compress(runs.tobytes(), 1)))
        return _table(VERDICTS, out)

    return run


def _remove(length: int, shards: int, slots: int):
    def run(left, right):
        import pyarrow as pa

        chunk = _Chunk(left, length, shards, slots)
        cover = np.zeros(len(chunk.data) + 1, np.int32)
        verdicts = {r["slot"]: r for r in right.to_pylist()}
        for slot in [x for x in verdicts if x < 0]:
            chunk.split(np.frombuffer(zlib.decompress(verdicts.pop(slot)["runs"]), np.int64))
        for slot, numbers in chunk.slots() if verdicts else ():
            if slot not in verdicts:
                continue
            used = np.unpackbits(np.frombuffer(verdicts[slot]["used"], np.uint8))[: len(numbers)].astype(bool)
            own = numbers[used]
            _, which = chunk.distinct(own)
            runs = np.frombuffer(zlib.decompress(verdicts[slot]["runs"]), _RUN)
            first = np.searchsorted(runs["text"], which, "left")
            times = np.searchsorted(runs["text"], which, "right") - first
            segment = np.repeat(own, times)
            index = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
            earlier = runs["doc"][index] < chunk.doc[segment]
            segment, index = segment[earlier], index[earlier]
            np.add.at(cover, chunk.start[segment] + runs["start"][index], 1)
            np.add.at(cover, chunk.start[segment] + runs["end"][index] + length - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        begins = np.append(0, chunk.ends[:-1])
        spans, kept = [], []
        for text, begin, end in zip(chunk.texts, begins, chunk.ends):
            own = gone[begin:end]
            if not own.any():
                spans.append([])
                kept.append(text)
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
            spans.append(edges.tolist())
            kept.append(np.frombuffer(text, np.uint8)[~own].tobytes())
        found = left.select(["rest", "doc_id", "bytes"]).take(pa.array(chunk.order))
        found = found.append_column("removed", pa.array(spans, pa.list_(pa.int64())))
        return found.append_column("kept", pa.array(kept, pa.binary()))

    return run


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Documents with ``removed`` and ``kept``, the bytes that no earlier document has.

    A byte goes if it lies in a string of ``length`` bytes that also starts in a
    document of a smaller doc_id; strings are judged on the input and never
    cross documents. ``removed`` lists begins and ends of the maximal removed
    runs in turn; ``kept`` joins the remaining bytes. All other columns stay, but
    for ones of these two names. Null texts are empty. Rows without id neither
    remove nor lose anything; rows of one id do not remove from one another. An
    empty table gives no row. ``length`` is 24 at least.
    """
    if length < PART:
        raise ValueError(f"length must be {PART} or more")
    rest = docs.drop("removed", "kept")
    size = rest.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(math.sqrt(size) * CHUNKS_PER_ROOT))
    others = [n for n in rest.columns if n not in ("doc_id", "text")]
    rows = rest.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(chunks)).alias("chunk"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("bytes"),
        F.struct(F.lit(None).cast("int").alias("none"), *(F.col(f"`{n}`") for n in others)).alias("rest"),
    )
    # rows without id lose nothing and stay where they are
    apart = rows.where(F.col("doc_id").isNull())
    apart = apart.select("rest", "doc_id", F.coalesce("bytes", F.lit(b"")).alias("bytes"))
    apart = apart.withColumns({"removed": F.array().cast("array<long>"), "kept": F.col("bytes")})
    by_chunk = rows.where(F.col("doc_id").isNotNull()).groupBy("chunk")
    slots = max(1, chunks // CHUNKS_PER_SHARD, size // SHARD_BYTES)
    keys = by_chunk.applyInArrow(_report_keys(length, chunks), KEYS)
    shared = keys.groupBy("shard").applyInArrow(_find_shared, SHARED)
    segments = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_send_segments(length, chunks, slots), SEGMENTS)
    verdicts = segments.groupBy("slot").applyInArrow(_judge(length), VERDICTS)
    fields = [rows.schema["rest"], StructField("doc_id", LongType()), StructField("bytes", BinaryType())]
    fields += [StructField("removed", ArrayType(LongType())), StructField("kept", BinaryType())]
    remove = _remove(length, chunks, slots)
    found = by_chunk.cogroup(verdicts.groupBy("chunk")).applyInArrow(remove, StructType(fields))
    found = found.unionByName(apart)
    own = {"doc_id": F.col("doc_id"), "text": F.col("bytes").cast("string").alias("text")}
    return found.select(*(own[n] if n in own else F.col(f"rest.`{n}`") for n in rest.columns), "removed", "kept")


def n_removed(removed: Column) -> Column:
    """Bytes in the removed runs."""
    signed = F.transform(removed, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, b: a + b)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """The documents, their texts without what :func:`remove_repeats` removes.

    A run that ends within a character leaves the whole character. Null texts
    stay null; empty texts, repeated rows and rows without id stay. All other
    columns stay, whatever their names; an empty table gives none.
    """
    row = F.struct(*(F.col(f"`{n}`") for n in docs.columns))
    found = remove_repeats(docs.select("doc_id", "text", row.alias("row")), length)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # bytes of a character after its first are 10xxxxxx
    inner = lambda at: F.hex(data.substr(at + 1, F.lit(1))).rlike("^[89AB]")
    ahead = lambda at: F.when(inner(at), F.when(inner(at + 1), F.when(inner(at + 2), at + 3).otherwise(at + 2)).otherwise(at + 1)).otherwise(at)
    back = lambda at: F.when(inner(at), F.when(inner(at - 1), F.when(inner(at - 2), at - 3).otherwise(at - 2)).otherwise(at - 1)).otherwise(at)
    edges = F.transform("removed", lambda at, i: F.when(i % 2 == 0, ahead(at.cast("int"))).otherwise(back(at.cast("int"))))
    edges = F.concat(F.array(F.lit(0)), edges, F.array(F.octet_length("text").cast("int")))
    found = found.withColumn("edges", F.when(F.size("removed") > 0, edges))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("edges") / 2).cast("int") - 1), lambda i: i * 2)
    parts = F.transform(pairs, lambda i: data.substr(F.get("edges", i) + 1, F.greatest(F.get("edges", i + 1) - F.get("edges", i), F.lit(0))))
    text = F.when(F.col("edges").isNull(), F.col("text")).otherwise(F.array_join(F.transform(parts, lambda p: p.cast("string")), ""))
    found = found.select("row", text.alias("text"))
    return found.select(*(F.col("text") if n == "text" else F.col(f"row.`{n}`") for n in docs.columns))
