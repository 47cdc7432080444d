"""Periodic runs of words, by online sparse diagonal dynamic programming.

The diagonal of lag q holds the pairs of words q apart. Word by word, an equal
earlier word q back lengthens the match on its diagonal, an unequal one ends
it; a diagonal that ends long enough is a run and is emitted at once. Most
diagonals never matter: only those that may still become a run are opened.

- A run of period q and length max(6, 4 q) or more repeats words no further
  than q apart for at least 3 q words (5 for q = 1). Texts without such a
  stretch, by the distance to each word's last occurrence, are done.
- Of a run's windows of k words, 2 q <= k <= 3 q, one lies a period behind its
  start, and its nearest earlier equal window is exactly q back (the window
  holds two periods, so its own smallest period is q). A diagonal opens only
  there, at most once for each k; the lengths k grow by halves, so a word opens
  few diagonals, whatever the number of its earlier occurrences. This also
  leaves out multiples of a smallest period.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from terrafold.llm.common import text_or_empty

LEAST, TIMES = 6, 4
#: Words looked at together, but for a longer text.
TOGETHER = 1 << 19
FAR = np.int64(1) << 40

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"doc_id long, n_words long, runs {RUNS}, collapsed binary"


def window_lengths(longest: int) -> list[int]:
    """Lengths k such that each period a text of so many words can have is between k/3 and k/2 for one of them."""
    found, q = [], 1
    while max(LEAST, TIMES * q) <= longest:
        found.append(3 * q)
        q = 3 * q // 2 + 1
    return found


def _mixed(a, b):
    """Hashes of pairs of 64-bit hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _last_seen(words, starts):
    """The distance from each word to its last occurrence in the same text."""
    order = np.argsort(words, kind="stable")
    distance = np.full(len(words), FAR)
    same = words[order[1:]] == words[order[:-1]]
    distance[order[1:][same]] = (order[1:] - order[:-1])[same]
    of = np.repeat(starts[:-1], np.diff(starts))
    distance[distance > np.arange(len(words)) - of] = FAR
    return distance


def openings(words, starts) -> list[dict[int, list[int]]]:
    """For each text, the lags of the diagonals that open at a place (its number in the text).

    words: numbers of the words of all texts in turn; starts: where each text
    begins, and the end.
    """
    sizes = np.diff(starts)
    found: list[dict[int, list[int]]] = [{} for _ in sizes]
    lengths = window_lengths(int(sizes.max(initial=0)))
    distance = _last_seen(words, starts)
    hopeful = []
    for k in lengths:
        # a text's first word is far from any, so stretches do not cross texts
        breaks = np.flatnonzero(distance > k // 2)
        long = np.diff(np.append(breaks, len(words))) > max(LEAST - 1, k)
        hopeful.append(np.unique(np.searchsorted(starts, breaks[long], "right") - 1))
    wanted = np.unique(np.concatenate(hopeful)) if hopeful else []
    if not len(wanted):
        return found
    # windows of the hopeful texts alone
    at = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in wanted])
    ends = np.append(0, np.cumsum(sizes[wanted]))
    text = np.repeat(np.arange(len(wanted)), sizes[wanted])
    hashes, held = _mixed(words[at].astype(np.uint64), text.astype(np.uint64)), 1
    for k, texts in zip(lengths, hopeful):
        if not len(texts):
            continue
        while held < k:
            wider = min(k, 2 * held)
            hashes = _mixed(hashes[: len(hashes) - (wider - held)], hashes[wider - held :])
            held = wider
        inside = np.isin(wanted, texts)
        place = np.flatnonzero(inside[text[: len(hashes)]])
        place = place[place + k <= ends[text[place] + 1]]
        order = place[np.argsort(hashes[place], kind="stable")]
        lag = np.zeros(len(at), np.int64)
        same = hashes[order[1:]] == hashes[order[:-1]]
        lag[order[1:][same]] = (order[1:] - order[:-1])[same]
        lag[lag > k // 2] = 0
        # a diagonal that is open already is not opened again
        first = np.flatnonzero((lag > 0) & (lag != np.append(0, lag[:-1])))
        for i, q in zip((first + k - 1).tolist(), lag[first].tolist()):
            d = text[i]
            found[wanted[d]].setdefault(i - int(ends[d]), []).append(q)
    return found


def runs_of(words: list, opened: dict[int, list[int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of a text's runs, by start, then period."""
    active: dict[int, int] = {}
    found = []

    def ended(lag: int, end: int) -> None:
        length = active.pop(lag) + lag
        if length >= max(LEAST, TIMES * lag):
            found.append((end - length, length, lag))

    places = sorted(opened, reverse=True)
    at, n = 0, len(words)
    while at < n and (active or places):
        if not active:
            at = max(at, places[-1])
        word = words[at]
        for lag in list(active):
            if words[at - lag] == word:
                active[lag] += 1
            else:
                ended(lag, at)
        if places and places[-1] == at:
            for lag in opened[places.pop()]:
                if lag not in active:
                    back = at
                    while back >= lag and words[back] == words[back - lag]:
                        back -= 1
                    if back < at:
                        active[lag] = at - back
        at += 1
    for lag in list(active):
        ended(lag, n)
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def _together(texts):
    """Texts' words in groups of a bounded number of words, or a longer text alone."""
    group, held = [], 0
    for text in texts:
        words = text.split()
        if group and held + len(words) > TOGETHER:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and ``collapsed``: each text's periodic runs of words.

    Words end at ASCII white space. A run is a stretch of six words or more,
    and of four periods or more, that repeats with its smallest period and that
    no neighbouring word extends. Runs come by start, then period. ``collapsed``
    (UTF-8) joins with blanks the words that stand in no run beyond its first
    period. Null, empty and blank texts have no words, no runs and an empty
    rest. Repeated rows get equal rows, an empty table none. Other columns are
    left behind, whatever their names.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            sizes, runs, rests = [], [], []
            for group in _together(t.as_py() for t in batch.column(1)):
                numbers: dict[bytes, int] = {}
                ids = [[numbers.setdefault(w, len(numbers)) for w in words] for words in group]
                starts = np.append(0, np.cumsum([len(x) for x in ids]))
                flat = np.fromiter((i for x in ids for i in x), np.int64, int(starts[-1]))
                for words, numbered, opened in zip(group, ids, openings(flat, starts)):
                    found = runs_of(numbered, opened) if opened else []
                    sizes.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    rests.append(b" ".join(kept_words(words, found)))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, schema), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, FOUND)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of what ``find`` gives."""
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents, the end of one text in ten (by a checksum of its id) made to repeat its own words.

    With h = crc32(decimal id), g = floor(h / 10), n words: where h % 10 = 0 and
    n > 0, from word a = g % n on the p = 1 + floor((n - a) / (3 + g % 8)) words
    there repeat to the end. A text without id stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    # no words: nothing to repeat
    rows = rows.withColumn("n", F.expr("nullif(size(words), 0)")).withColumn("a", F.expr("int(g % n)"))
    rows = rows.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = "slice(flatten(array_repeat(slice(words, a + 1, p), int(4 + g % 8))), 1, n - a)"
    edited = F.expr(f"array_join(concat(slice(words, 1, a), {again}), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))
