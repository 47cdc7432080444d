"""Quality scores by gradient-boosted trees over document statistics.

The statistics of a text go into few bins each; trees of a fixed depth grow on
histograms of gradients per bin. The trees lie in flat arrays (a feature and a
bin per inner node, a value per leaf), so that numpy walks all rows of a batch
through a tree one level at a time.

The fit takes a bounded sample of labelled rows, chosen by a hash of their id;
statistics and scores cover every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Labelled rows that the fit takes at most.
SAMPLE = 20_000
BINS, DEPTH, TREES, RATE, LEAST_WEIGHT, RIDGE = 64, 4, 60, 0.2, 2.0, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_spread", "upper", "digit", "space", "letter", "marks", "bars", "stops",
    "commas", "high_bytes", "distinct_words", "top_word", "repeats", "repeats_2", "lines", "line_bytes", "distinct_lines",
    "upper_words", "marked_words", "short_words", "long_words", "top_mark", "entropy", "distinct_pairs",
)

_SHOUT = bytes(range(65, 91))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,|'-")


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a UTF-8 text, in the order of FEATURES."""
    import math
    from itertools import islice
    from operator import eq

    import numpy as np

    size = len(text)
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = lambda codes: float(counts[list(codes)].sum()) / max(size, 1)
    lengths = np.fromiter(map(len, words), np.int32, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x]
    held = counts[counts > 0] / max(size, 1)
    per_word = lambda x: x / max(n, 1)
    return [
        math.log1p(size),
        math.log1p(n),
        float(lengths.mean()) if n else 0.0,
        float(lengths.std()) if n else 0.0,
        share(_SHOUT),
        share(range(48, 58)),
        share(b" \n\t\r"),
        share(range(97, 123)),
        share(_MARKS),
        share(b"|"),
        share(b"."),
        share(b","),
        float(counts[128:].sum()) / max(size, 1),
        per_word(len(seen)),
        per_word(max(seen.values(), default=0)),
        per_word(sum(map(eq, words, islice(words, 1, None)))),
        per_word(sum(map(eq, words, islice(words, 2, None)))),
        math.log1p(len(lines)),
        math.log1p(size / max(len(lines), 1)),
        len(set(lines)) / max(len(lines), 1),
        per_word(sum(map(bytes.isupper, words))),
        per_word(sum(not w.isalnum() and w[-1:] not in b".," and w.isascii() for w in words)),
        per_word(int((lengths <= 2).sum())),
        per_word(int((lengths >= 15).sum())),
        float(counts[list(_MARKS)].max()) / max(size, 1),
        float(-(held * np.log2(held)).sum()) if size else 0.0,
        len(set(zip(words, islice(words, 1, None)))) / max(n - 1, 1),
    ]


@dataclass
class Trees:
    """Boosted trees in flat arrays; inner nodes of a tree in level order."""

    edges: object  # feature by bin limit
    feature: object  # tree by inner node
    limit: object  # tree by inner node: rows of a higher bin go right
    leaf: object  # tree by leaf
    base: float

    def binned(self, x):
        import numpy as np

        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x):
        """Chance of label 1 for each row of statistics."""
        import numpy as np

        bins, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[rows, feature[node]] > limit[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x, y) -> Trees:
    """Fit trees to rows of statistics and labels 0 or 1."""
    import numpy as np

    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    x = x.reshape(len(y), len(FEATURES))
    edges = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in x.T] if len(y) else [np.zeros(0)] * len(FEATURES)
    mean = (y.sum() + 1) / (len(y) + 2)
    trees = Trees(edges, [], [], [], float(np.log(mean / (1 - mean))))
    bins = trees.binned(x) if len(y) else np.zeros((0, len(FEATURES)), np.int64)
    total = np.full(len(y), trees.base)
    for _ in range(TREES if 0 < y.sum() < len(y) else 0):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = y - chance, chance * (1 - chance)
        feature, limit = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            start, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for j in range(len(FEATURES)):
                place = (node - start) * BINS + bins[:, j]
                g = np.bincount(place, slope, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(place, bend, width * BINS).reshape(width, BINS).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
                at = gain.argmax(1)
                found = gain[np.arange(width), at]
                better = found > best
                best[better] = found[better]
                feature[start : start + width][better] = j
                limit[start : start + width][better] = at[better]
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > limit[node])
        place = node - (2**DEPTH - 1)
        g, h = np.bincount(place, slope, 2**DEPTH), np.bincount(place, bend, 2**DEPTH)
        leaf = RATE * g / (h + RIDGE)
        total = total + leaf[place]
        for held, part in ((trees.feature, feature), (trees.limit, limit), (trees.leaf, leaf)):
            held.append(part)
    return trees


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no fit sees: a fifth of the ids, by checksum."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for labels (doc_id, quality), from at most ``sample`` of them.

    Held-out rows, null ids and labels other than 0 and 1 take no part. With
    labels of one kind only, every score is the share of that kind.
    """
    import numpy as np

    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("of").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("of"))
        .groupBy("of")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("of"), "of")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # at most ``sample`` rows of two numbers
    rows = texts.join(F.broadcast(wanted), F.col("doc_id") == F.col("of")).select("doc_id", "quality", "text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [statistics(t or b"") for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "x"])

    learned = rows.mapInArrow(run, "doc_id long, quality int, x array<double>").toPandas().sort_values("doc_id", kind="stable")
    return grow(np.array(learned["x"].tolist()), learned["quality"].to_numpy())


def score(docs: DataFrame, trees: Trees, column: str = "score") -> DataFrame:
    """The documents with their chance of label 1; every other column stays.

    Whole texts; null and empty ones get the score of empty statistics. A
    column that already bears the name is replaced. Repeated rows get equal
    scores, an empty table none.
    """
    kept = docs.drop(column)
    schema = StructType([*kept.schema.fields, StructField(column, DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            x = np.array([statistics((t or "").encode("utf-8", "replace")) for t in texts]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.score(x))], [*batch.schema.names, column])

    return kept.mapInArrow(run, schema)


def kept(docs: DataFrame, trees: Trees, least: float) -> DataFrame:
    """The documents that score ``least`` or more, with all their columns, whatever their names.

    Null and empty texts have the score of empty statistics; repeated rows fare
    alike; an empty table gives none.
    """
    row = F.struct(*(F.col(f"`{n}`") for n in docs.columns))
    scored = score(docs.select("text", row.alias("row")), trees, "score")
    return scored.where(F.col("score") >= least).select("row.*")
