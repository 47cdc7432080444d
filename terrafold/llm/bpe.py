"""BPE encoding by tree concatenation, and decoding.

A long text is halved until its parts are short. Parts are encoded on their
own; then two neighbours are put together: a window around their join is
encoded, and grows until two tokens in a row on its left agree in place and id
with the left part, and two on its right with the right part. What lies between
comes from the window, the rest from the parts. A window that covers both parts
is their encoding. Texts beyond ``SPREAD`` characters are cut into rows first,
so that many tasks encode one text.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, functions as F

from terrafold.llm.common import text_or_empty
from terrafold.llm.tokens import Encoder, encoder

#: Characters of the longest text that one task encodes, of its share of a
#: longer one, of a part that is encoded at once, and of a first window's side.
SPREAD, SHARE, LEAF, WINDOW = 1 << 16, 1 << 15, 4096, 64

ENCODED = "doc_id long, n_tokens long, ids binary, decoded binary"


def _width(text: str) -> int:
    """Bytes that the tokens of a text cover: normalised, without white space."""
    if text.isascii():
        return sum(map(len, text.encode().split()))
    text = unicodedata.normalize("NFC", text)
    text = "".join(c.lower() for c in text if not c.isspace() or "\x1c" <= c <= "\x1f")
    return len(text.encode("utf-8", "replace"))


def _agreed(part: list[int], window: list[int], spans: list[int], join: int, whole: int) -> tuple[int, int] | None:
    """Where tokens of a part's end and of a window stand at equal places.

    join: bytes of the window left of the join. whole: the number of tokens in
    the part of which ``part`` is the end. Returns (index in the part, index in
    the window) of the first of two equal tokens, the nearest to the join.
    """
    places, at = {}, 0
    for i in range(len(part) - 1, -1, -1):
        at += spans[part[i]]
        places[at] = i
    at, found = 0, None
    for k, token in enumerate(window):
        distance = join - at
        if distance <= 0:
            break
        i = places.get(distance)
        if k >= 2 and i is not None and i + 1 < len(part) and k + 1 < len(window):
            if part[i] == token and part[i + 1] == window[k + 1] and distance > spans[token] + spans[part[i + 1]]:
                found = (i + whole - len(part), k)
        at += spans[token]
    return found


def join(coder: Encoder, left: memoryview, right: memoryview, text: str, low: int, mid: int, high: int) -> memoryview:
    """Ids of text[low:high] from those of its parts up to and from ``mid``."""
    size = WINDOW
    while True:
        first, last = max(low, mid - size), min(high, mid + size)
        window = memoryview(coder.encode(text[first:last].encode("utf-8", "replace"))).cast("I")
        if (first, last) == (low, high):
            return window
        tokens, spans = window.tolist(), coder.spans
        total = sum(spans[t] for t in tokens)
        before, after = _width(text[first:mid]), _width(text[mid:last])
        if before + after == total:
            near = 2 * size + 16
            here = (0, 0) if first == low else _agreed(left[-near:].tolist(), tokens, spans, before, len(left))
            there = None
            if last == high:
                there = (0, 0)
            elif here:
                there = _agreed_after(right[:near].tolist(), tokens, spans, before)
            if here and there:
                i, k = here
                if last == high:
                    return _joined(left[:i], window[k:])
                m, n = there
                if k <= n:
                    return _joined(left[:i], window[k:n], right[m:])
        size *= 2


def _agreed_after(part: list[int], window: list[int], spans: list[int], join: int) -> tuple[int, int] | None:
    """As ``_agreed``, right of the join: (index in the part, index in the window)."""
    places, at = {}, 0
    for m, token in enumerate(part):
        places[at] = m
        at += spans[token]
    at = -join
    for n, token in enumerate(window[:-3]):
        m = places.get(at)
        if at > 0 and m is not None and m > 0 and m + 1 < len(part):
            if part[m] == token and part[m + 1] == window[n + 1]:
                return m, n
        at += spans[token]
    return None


def _joined(*parts: memoryview) -> memoryview:
    return memoryview(b"".join(parts)).cast("I")


def _middle(text: str, low: int, high: int) -> int:
    """A place near the middle that does not part marks from their letter; 0 if none is."""
    for mid in range((low + high) // 2, low, -1):
        if not (unicodedata.combining(text[mid]) or "ᅠ" <= text[mid] <= "ᇿ"):
            return mid
    return 0


def encode_text(coder: Encoder, text: str, low: int = 0, high: int | None = None, leaf: int = LEAF) -> memoryview:
    """Ids of text[low:high], by halves."""
    high = len(text) if high is None else high
    mid = _middle(text, low, high) if high - low > leaf else 0
    if not mid:
        return memoryview(coder.encode(text[low:high].encode("utf-8", "replace"))).cast("I")
    left, right = encode_text(coder, text, low, mid, leaf), encode_text(coder, text, mid, high, leaf)
    return join(coder, left, right, text, low, mid, high)


def join_parts(coder: Encoder, parts: list[str], ids: list[bytes]) -> memoryview:
    """Ids of the parts' text, neighbours put together two by two."""
    text, ends, at = "".join(parts), [], 0
    for part in parts:
        ends.append((at, at + len(part)))
        at += len(part)
    held = [memoryview(x).cast("I") for x in ids]
    while len(held) > 1:
        pairs = range(0, len(held) - 1, 2)
        odd = len(held) % 2
        merged = [join(coder, held[i], held[i + 1], text, ends[i][0], ends[i][1], ends[i + 1][1]) for i in pairs]
        spans = [(ends[i][0], ends[i + 1][1]) for i in pairs]
        held, ends = merged + held[len(held) - odd :], spans + ends[len(ends) - odd :]
    return held[0]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, ids (little-endian unsigned 32 bits), decoded text.

    Whole texts; null and empty ones have no id and decode to the empty text.
    Repeated rows give repeated rows, an empty table none. Other columns are
    left behind, whatever their names.
    """

    def whole(batches):
        import pyarrow as pa

        coder = encoder(path)
        for batch in batches:
            ids = []
            for text in batch.column(1):
                text = text.as_py()
                ids.append(coder.encode(text) if len(text) <= LEAF else encode_text(coder, text.decode("utf-8", "replace")).tobytes())
            yield _rows(coder, batch.column(0), ids)

    def _rows(coder, doc_ids, ids):
        import pyarrow as pa

        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        decoded = pa.array([coder.decode(x) for x in ids], pa.binary())
        names = ["doc_id", "n_tokens", "ids", "decoded"]
        return pa.RecordBatch.from_arrays([doc_ids, counts, pa.array(ids, pa.binary()), decoded], names)

    def share(batches):
        import pyarrow as pa

        coder = encoder(path)
        for batch in batches:
            texts = [x.decode("utf-8", "replace") for x in batch.column("part").to_pylist()]
            ids = [encode_text(coder, x).tobytes() for x in texts]
            columns = [batch.column(n) for n in ("row", "doc_id", "n", "part")] + [pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n", "part", "ids"])

    def together(table):
        import pyarrow as pa

        coder = encoder(path)
        table = table.sort_by("n")
        texts = [x.decode("utf-8", "replace") for x in table.column("part").to_pylist()]
        ids = join_parts(coder, texts, table.column("ids").to_pylist()).tobytes()
        return pa.Table.from_batches([_rows(coder, table.column("doc_id").slice(0, 1).combine_chunks(), [ids])])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    short = rows.where(F.length("text") <= SPREAD).select("doc_id", F.col("text").cast("binary").alias("text"))
    shares = (
        rows.where(F.length("text") > SPREAD)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("n", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / SHARE).cast("int"))))
        .select("row", "doc_id", "n", F.expr(f"substring(text, n * {SHARE} + 1, {SHARE})").cast("binary").alias("part"))
        .repartition("row", "n")
        .mapInArrow(share, "row long, doc_id long, n int, part binary, ids binary")
    )
    return short.mapInArrow(whole, ENCODED).unionByName(shares.groupBy("row").applyInArrow(together, ENCODED))
