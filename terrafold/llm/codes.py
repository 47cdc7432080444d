"""Short codes for vectors: a codebook for each part, fitted over balls of parts.

A vector is cut into equal parts; a part's code is its codebook's nearest
entry. The vectors are kept in chunks. Each chunk holds, for each part, a tree
of balls built by the anchors hierarchy: anchors steal the points nearer to
them until about sqrt(n) anchors stand (the middle), a large anchor is cut in
the same way (down), and the two balls that fit the smallest common one are
put together until one is left (up). A ball caches the sum and number of its
points.

A round walks each tree with the list of entries that may own points of a ball.
Below a ball the list only shrinks: an entry goes if another is nearer to the
whole ball. With one entry left the ball is owned, and its cached sum and
number count at once; only mixed leaves compare points. Balls only decide what
cannot tie, so codes are those of the full comparison, ties included.

Sums leave a task as one row for each entry, place and limb of 32 bits, so that
they are exact, whatever the components.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from terrafold.session import drop_path, scratch_path

#: Rows and components of a chunk at most, and points of a leaf that is not cut.
CHUNK, CELLS, LEAF = 8192, 1 << 22, 256
LIMB = 32


def _whole(vectors, scale: int):
    """floor(scale * x) of an array of doubles; Python integers where 64 bits or doubles do not hold them."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(scale))
    if vectors.size and not np.abs(scaled).max() < 2.0**53:
        exact = [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * float(scale))) for x in vectors.ravel().tolist()]
        return np.array(exact, dtype=object).reshape(vectors.shape)
    return scaled.astype(np.int64)


def _limit(width: int) -> int:
    """Components below it have distances that doubles hold exactly."""
    return int((2.0**53 / max(width, 1)) ** 0.5) // 2


def squared(points, entries):
    """Exact squared distances, points by entries; Python integers where doubles do not hold them."""
    large = _limit(points.shape[1])
    for side in (points, entries):
        if side.size and not (abs(side.max()) < large and abs(side.min()) < large):
            gap = points.astype(object)[:, None, :] - entries.astype(object)[None, :, :]
            return (gap * gap).sum(axis=2) if gap.shape[2] else np.zeros(gap.shape[:2], object)
    gap = points.astype(float)[:, None, :] - entries.astype(float)[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


class Balls:
    """A tree of balls over the points of one part of a chunk.

    points are in tree order, ``order`` gives their rows. Ball b holds the
    points first[b]:last[b]; its children come before it, the root is last.
    """

    def __init__(self, points):
        self.points, self.order = points, np.arange(len(points))
        self.balls = []
        if len(points):
            if points.dtype == object:
                self._leaf(0, len(points))
            else:
                self._build(points.astype(float), 0, len(points))
        self._seal()

    def _leaf(self, low: int, high: int) -> int:
        self.balls.append((low, high, -1, -1))
        return len(self.balls) - 1

    def _anchors(self, values):
        """Owner of each point among about sqrt(n) anchors, or fewer where they would own few points."""
        n = len(values)
        owner, near = np.zeros(n, np.int64), np.sqrt(((values - values[0]) ** 2).sum(1))
        pivots = [values[0]]
        for k in range(1, min(int(np.ceil(n**0.5)), 4 * n // LEAF + 2)):
            far = int(near.argmax())
            if not near[far] > 0:
                break
            pivots.append(values[far])
            apart = np.sqrt(((np.array(pivots) - values[far]) ** 2).sum(1))
            # a point nearer to its anchor than half the way to the new one stays
            open_ = np.flatnonzero(near * 2 > apart[owner])
            away = np.sqrt(((values[open_] - values[far]) ** 2).sum(1))
            won = away < near[open_]
            owner[open_[won]], near[open_[won]] = k, away[won]
        return owner, len(pivots)

    def _build(self, values, low: int, high: int) -> int:
        """Balls over points low:high (``values`` are theirs); the number of the top one."""
        if high - low <= LEAF:
            return self._leaf(low, high)
        owner, anchors = self._anchors(values)
        if anchors == 1:
            return self._leaf(low, high)  # all equal: one distance decides
        turn = np.argsort(owner, kind="stable")
        values = values[turn]
        self.points[low:high] = self.points[low:high][turn]
        self.order[low:high] = self.order[low:high][turn]
        ends = np.cumsum(np.bincount(owner, minlength=anchors))
        parts = [(a, b) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()) if b > a]
        centers = np.array([values[a:b].mean(0) for a, b in parts])
        radii = np.array([np.sqrt(((values[a:b] - c) ** 2).sum(1)).max() for (a, b), c in zip(parts, centers)])
        pairs = self._upward(centers, radii, np.array([b - a for a, b in parts], float))
        # a common ball covers neighbours in tree order
        tree: list = list(range(len(parts)))
        for x, y in pairs:
            tree.append((x, y))
        leaves, stack = [], [len(tree) - 1]
        while stack:
            node = tree[stack.pop()]
            if isinstance(node, tuple):
                stack += [node[1], node[0]]
            else:
                leaves.append(node)
        turn = np.concatenate([np.arange(*parts[p]) for p in leaves])
        values = values[turn]
        self.points[low:high] = self.points[low:high][turn]
        self.order[low:high] = self.order[low:high][turn]
        at, numbers = low, {}
        for p in leaves:
            size = parts[p][1] - parts[p][0]
            numbers[p] = self._build(values[at - low : at - low + size], at, at + size)
            at += size
        for k, (x, y) in enumerate(pairs, start=len(parts)):
            x, y = sorted((numbers[x], numbers[y]), key=lambda b: self.balls[b][0])
            self.balls.append((self.balls[x][0], self.balls[y][1], x, y))
            numbers[k] = len(self.balls) - 1
        return numbers[len(tree) - 1]

    @staticmethod
    def _upward(centers, radii, sizes):
        """Which two balls are put together in turn: those of the smallest common ball."""
        n = len(centers)
        total = 2 * n - 1
        center, radius, size = np.zeros((total, centers.shape[1])), np.zeros(total), np.zeros(total)
        center[:n], radius[:n], size[:n] = centers, radii, sizes

        def common(i, others):
            apart = np.sqrt(((center[others] - center[i]) ** 2).sum(1))
            return np.maximum(np.maximum(radius[others], radius[i]), (apart + radius[others] + radius[i]) / 2)

        cost = np.full((total, total), np.inf)
        for i in range(1, n):
            cost[i, :i] = common(i, np.arange(i))
        pairs, live = [], list(range(n))
        for new in range(n, total):
            i, j = divmod(int(cost[:new, :new].argmin()), new)
            pairs.append((j, i))
            size[new] = size[i] + size[j]
            center[new] = (center[i] * size[i] + center[j] * size[j]) / size[new]
            radius[new] = max(np.sqrt(((center[x] - center[new]) ** 2).sum()) + radius[x] for x in (i, j))
            for x in (i, j):
                cost[x, :] = np.inf
                cost[:, x] = np.inf
                live.remove(x)
            cost[new, live] = common(new, np.array(live, np.int64)) if live else np.inf
            live.append(new)
        return pairs

    def _seal(self):
        """Centers, radii, sums and numbers of all balls."""
        n, width = len(self.balls), self.points.shape[1]
        table = np.array(self.balls, np.int64).reshape(n, 4)
        self.first, self.last, self.left, self.right = table.T
        total = np.vstack([np.zeros((1, width), self.points.dtype), np.cumsum(self.points, axis=0)])
        self.sums = total[self.last] - total[self.first]
        self.center, self.radius = np.zeros((n, width)), np.full(n, np.inf)
        if n and self.points.dtype != object:
            self.center = self.sums / (self.last - self.first)[:, None]
            leaves = np.flatnonzero(self.left < 0)
            leaves = leaves[np.argsort(self.first[leaves])]
            own = np.repeat(self.center[leaves], (self.last - self.first)[leaves], axis=0)
            self.radius[leaves] = np.sqrt(np.maximum.reduceat(((self.points - own) ** 2).sum(1), self.first[leaves]))
            for b in np.flatnonzero(self.left >= 0).tolist():
                gap = self.points[self.first[b] : self.last[b]] - self.center[b]
                self.radius[b] = np.sqrt(np.einsum("ij,ij->i", gap, gap).max())
        del self.balls

    def packed(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def unpacked(cls, data: bytes) -> Balls:
        tree = cls.__new__(cls)
        vars(tree).update(pickle.loads(data))
        return tree

    def owned(self, entries):
        """(ball, entries that may own its points): balls with one entry, and mixed leaves.

        Every point is in one ball; the list of a mixed leaf is ascending.
        """
        if not len(self.first):
            return
        with np.errstate(over="ignore", invalid="ignore"):
            places = np.array([[float(min(max(x, -(10**300)), 10**300)) for x in e] for e in entries.tolist()]).reshape(entries.shape)
            stack = [(len(self.first) - 1, np.arange(len(entries)))]
            while stack:
                ball, held = stack.pop()
                if len(held) > 1 and self.radius[ball] < np.inf:
                    gap = places[held] - self.center[ball]
                    away = (gap * gap).sum(1)
                    near = int(away.argmin())
                    step = places[held] - places[held[near]]
                    # the plane between two entries must lie clear of the ball, rounding included
                    reach = 2 * self.radius[ball] * np.sqrt((step * step).sum(1))
                    farther = away - away[near] > reach * (1 + 1e-9) + 1e-9 * (away + away[near] + 1)
                    held = held[~farther]
                if len(held) == 1 or self.left[ball] < 0:
                    yield ball, held
                else:
                    stack += [(self.left[ball], held), (self.right[ball], held)]

    def statistics(self, entries, counts, sums) -> None:
        """Add each entry's number of points and their sum."""
        code = np.full(len(self.order), len(entries))
        for ball, held in self.owned(entries):
            if len(held) == 1:
                counts[held[0]] += int(self.last[ball] - self.first[ball])
                sums[held[0]] += self.sums[ball]
            else:
                at = slice(self.first[ball], self.last[ball])
                code[at] = held[squared(self.points[at], entries[held]).argmin(axis=1)]
        mixed = code < len(entries)
        points, code = self.points[mixed], code[mixed]
        counts += np.bincount(code, minlength=len(entries))
        if points.dtype == object:
            np.add.at(sums, code, points)
        else:
            for place in range(points.shape[1]):  # whole numbers that doubles hold
                sums[:, place] += np.bincount(code, points[:, place], len(entries)).astype(np.int64)

    def assigned(self, entries):
        """(entry, squared distance) of each row, in the order of rows."""
        code, error = np.zeros(len(self.order), np.uint8), np.zeros(len(self.order))
        for ball, held in self.owned(entries):
            at = slice(self.first[ball], self.last[ball])
            away = squared(self.points[at], entries[held])
            best = away.argmin(axis=1)
            code[self.order[at]] = held[best]
            if away.dtype == object and error.dtype != object:
                error = error.astype(np.int64).astype(object)
            error[self.order[at]] = away[np.arange(len(best)), best]
        return code, error if error.dtype == object else error.astype(np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector is there, with finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _chunks(rows: DataFrame, parts: int, scale: int, size: int) -> DataFrame:
    """One row for each chunk of ``size`` rows or fewer: ids, labels, and a tree of balls for each part.

    Rows of large components make chunks of their own, so that the others stay in doubles.
    """
    kinds = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        def of_one(column):
            return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

        def sealed(held):
            table = pa.Table.from_batches(held)
            ids, labels, vectors = (table.column(i).combine_chunks() for i in range(3))
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)
            with np.errstate(over="ignore"):
                small = np.abs(values * float(scale)).max(axis=1, initial=0) < _limit(values.shape[1] // parts) - 1
            for mask in (small, ~small):
                if mask.any():
                    cut = np.split(_whole(values[mask], scale), parts, axis=1)
                    trees = [Balls(np.ascontiguousarray(c)).packed() for c in cut]
                    columns = [of_one(x.filter(pa.array(mask))) for x in (ids, labels)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, size - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
                if n == size:
                    yield from sealed(held)
                    held, n = [], 0
        if n:
            yield from sealed(held)

    return rows.select("id", "label", "vector").mapInArrow(run, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees array<binary>")


def _refitted(chunks: DataFrame, books: list) -> list:
    """Codebooks after one round: each entry the floor of the mean of the parts it owns."""

    def run(batches):
        import pyarrow as pa

        counts = [np.zeros(len(b), object) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for trees in batch.column(0):
                for part, tree in enumerate(trees.as_py()):
                    Balls.unpacked(tree).statistics(books[part], counts[part], sums[part])
        found = []
        for part, (times, total) in enumerate(zip(counts, sums)):
            for entry in np.flatnonzero(times).tolist():
                for place, value in enumerate([times[entry], *total[entry].tolist()]):
                    found += [(part, entry, place, *limb) for limb in _limbs(int(value))]
        columns = list(zip(*found)) or [()] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "place", "limb", "value"])

    rows = chunks.select("trees").mapInArrow(run, "part int, entry int, place int, limb int, value long")
    # one row for each entry, place and limb, whatever the number of vectors
    total = rows.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()
    exact: dict[tuple[int, int, int], int] = {}
    for part, entry, place, limb, value in total:
        exact[part, entry, place] = exact.get((part, entry, place), 0) + (value << (LIMB * limb))
    after = []
    for part, book in enumerate(books):
        book = book.astype(object)
        for entry in range(len(book)):
            times = exact.get((part, entry, 0), 0)
            if times:
                book[entry] = [exact.get((part, entry, p + 1), 0) // times for p in range(book.shape[1])]
        after.append(_narrow(book))
    return after


def _limbs(value: int):
    """(number, limb): limbs of 32 bits, the last with the sign."""
    at = 0
    while not -(1 << (LIMB - 1)) <= value < 1 << (LIMB - 1):
        yield at, value & ((1 << LIMB) - 1)
        value, at = value >> LIMB, at + 1
    yield at, value


def _narrow(book):
    """64-bit integers where they hold a codebook."""
    small = all(-(1 << 53) < x < 1 << 53 for x in book.ravel().tolist())
    return book.astype(np.int64) if small else book


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, list]:
    """Codes of vectors, and the codebooks: (rows, one integer array for each part).

    vectors: id, label, vector. rows: id, label, code (a byte for each part),
    error (long, squared distances summed over the parts). A component x counts
    as floor(scale * x). Each part's codebook starts as that part of the vectors
    of the smallest ids (ties by vector, then all in turn; null ids last) and is
    refitted in so many rounds; an entry that owns nothing stays.

    Vectors that are null or hold null or non-finite components get no row; nor
    do those of another length than most of the first ``entries`` (ties: the
    longer). A length that does not divide into the parts is an error. Fewer
    rows than entries give fewer entries, an empty table no rows and empty
    codebooks. Repeated rows are rows of their own. An error beyond a long is
    null. Ids and labels may be null; other columns are left behind.
    """
    spark = vectors.sparkSession
    rows = vectors.select("id", "label", F.col("vector").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    by_id = (F.col("id").asc_nulls_last(), F.col("vector").asc())
    first = [r.vector for r in rows.orderBy(*by_id).select("vector").limit(entries).collect()]
    lengths = [len(v) for v in first]
    width = max(sorted(set(lengths), reverse=True), key=lengths.count, default=0)
    if width % parts:
        raise ValueError(f"vectors of {width} components do not divide into {parts} parts")
    rows = rows.where(F.size("vector") == width)
    if set(lengths) - {width}:
        first = [r.vector for r in rows.orderBy(*by_id).select("vector").limit(entries).collect()]
    start = _whole(np.array(first, float).reshape(len(first), width), scale)
    books = [_narrow(b.astype(object)) for b in np.split(start, parts, axis=1)]
    path = scratch_path(spark, "balls")
    size = max(1, min(CHUNK, CELLS // max(width, 1)))
    _chunks(rows, parts, scale, size).write.parquet(path)
    chunks = spark.read.parquet(path)
    for _ in range(rounds if first else 0):
        books = _refitted(chunks, books)

    id_kind, label_kind = (vectors.schema[n].dataType.simpleString() for n in ("id", "label"))

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels, trees = (batch.column(i).slice(row, 1) for i in range(3))
                found = [Balls.unpacked(t).assigned(books[part]) for part, t in enumerate(trees[0].as_py())]
                codes = np.stack([c for c, _ in found], axis=1)
                errors = [int(e) for e in sum(e for _, e in found)]
                errors = pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())
                codes = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.flatten(), labels.flatten(), codes, errors], ["id", "label", "code", "error"])

    coded = scratch_path(spark, "codes")
    chunks.mapInArrow(encode, f"id {id_kind}, label {label_kind}, code binary, error long").write.parquet(coded)
    drop_path(spark, path)
    return spark.read.parquet(coded), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows of ``compress`` with their errors summed over equal labels, nulls together.

    A sum beyond a long, or of an error that is null, is null.
    """
    total = F.sum(F.col("error").cast("decimal(19,0)")).try_cast("long")
    sums = coded.groupBy("label").agg(F.when(F.count("error") == F.count(F.lit(1)), total).alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def listed(books: list) -> str:
    """All entries' components by part, entry and place, comma-joined."""
    return ",".join(str(int(x)) for book in books for x in book.ravel().tolist())
