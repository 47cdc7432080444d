"""Exact search for the highest inner products, by columnar branch and bound.

Vectors lie in blocks, one row of a block's matrix per dimension. For a query,
dimensions are taken in the order of its own mass, at first those that hold most
of it, then a few at a time. After each step a candidate's product so far, plus the product of what remains of both
masses, bounds its score; candidates whose bound is below the k-th best lower
bound are compacted away. A block of queries first meets one block of
candidates; the k-th best score of this meeting is the floor that candidates of
all other blocks have to reach, from their first step on. Blocks of like vectors
still return about k rows a query each. Vectors
with large components lie in blocks of their own, whose products are counted in
Python integers where 64 bits do not hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from terrafold.llm.common import checkpointed

#: Vectors in a block, on average; dimensions in a step; the share of a query's
#: mass that its first step may leave; the share of candidates from which on
#: they are compacted; components that are sooner multiplied than bounded.
CANDIDATES, QUERIES, STEP, FIRST, SPARSE, FEW = 4096, 512, 8, 0.08, 0.5, 1 << 15
#: Components from which on a vector lies in a block of wide ones.
WIDE = 1 << 20
#: Partitions for a block of candidates, so that few blocks share one, and the most of them.
SPREAD, MOST_PARTITIONS = 4, 20_000
#: Copies of a row that are made at a time.
COPIES = 4096

_LEAST, _MOST = -(2**63), 2**63 - 1
_NEAR = "place int, vec_id long, score long, copies long"
_PILOT = """asked long, home long, ids binary, matrix binary, times binary, floors binary,
 near array<struct<place: int, vec_id: long, score: long, copies: long>>"""


def usable_of(name: str, scale: int = 1) -> Column:
    """Whether an array is there and all its components, times ``scale``, are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < F.lit(float("inf")))
    return F.coalesce(F.forall(F.col(name), lambda c: F.coalesce(finite(c), F.lit(False))), F.lit(False))


def whole_of(name: str, scale: int) -> Column:
    """Components times ``scale``, rounded down, as doubles; those from 2**53 on are whole as they are."""
    floor = lambda c: F.when(F.abs(c) < F.lit(2.0**53), F.floor(c).cast("double")).otherwise(c)
    return F.transform(F.col(name), lambda c: floor(c.cast("double") * scale))


def search_block(query, own: int | None, ids, columns, masses, copies, k: int, floor: int, rows=None, squares=None):
    """(score, place in the block, copies) of the block's best k for one query, ties to smaller ids.

    columns: dimension by candidate. masses: each candidate's squared mass.
    own: the query's place in the block, of which one copy takes no part.
    floor: a score that k candidates elsewhere are known to reach.
    rows, squares: ``columns`` by candidate, and its squares, if they are kept.
    """
    import numpy as np

    if own is not None:
        copies = copies.copy()
        copies[own] -= 1
    q_float = query.astype(np.float64)
    order = np.argsort(-np.abs(q_float), kind="stable")
    query = query[order]
    parts = q_float[order] ** 2
    whole_q = rest_q = float(np.dot(q_float, q_float))
    bounded = np.isfinite(whole_q) and bool(np.isfinite(masses).all())
    # what rounding may add to a mass that was reached by subtraction
    blur = len(query) * 1e-15
    keep = copies > 0
    if bounded and floor > _LEAST:
        keep &= np.sqrt(masses * whole_q) * (1 + 1e-9) + 1 >= float(floor)
    # until few are left all candidates go on, and ``keep`` says which count; then
    # those left, at ``alive``, are held by candidate, with the dimensions from ``base`` on
    alive, held, base, at = np.arange(len(ids)), None, 0, 0
    score, whole_x, rest_x = np.zeros(len(ids), columns.dtype), masses, masses
    while True:
        left = np.count_nonzero(keep)
        if left < SPARSE * len(keep):
            alive, score, rest_x, whole_x = alive[keep], score[keep], rest_x[keep], whole_x[keep]
            held = (columns.T if rows is None else rows).take(alive, axis=0)[:, order[at:]] if held is None else held[keep, at - base :]
            base, keep = at, np.ones(left, bool)
        if at == len(order) or not left:
            break
        few = held is not None and left * (len(order) - at) <= FEW
        to = _step(parts, at, rest_q, whole_q) if bounded and not few else len(order)
        part = columns.take(order[at:to], axis=0) if held is None else held[:, at - base : to - base].T
        score = score + query[at:to] @ part
        if to < len(order):
            if held is None and squares is not None:
                gone = np.ones(to - at, squares.dtype) @ squares.take(order[at:to], axis=0)
            else:
                seen = part.astype(np.float64, copy=False)
                gone = np.einsum("ij,ij->j", seen, seen)
            rest_x = rest_x - gone
            rest_q -= float(parts[at:to].sum())
            open_x = np.maximum(rest_x, 0) + whole_x * blur
            slack = np.sqrt(open_x * (max(rest_q, 0.0) + whole_q * blur)) * (1 + 1e-9) + 1
            known = score.astype(np.float64)
            slack += np.abs(known) * 1e-14
            least = float(floor)
            if left > k:
                low = np.where(keep, known - slack, -np.inf)
                least = max(least, np.partition(low, len(low) - k)[len(low) - k])
            keep &= known + slack >= min(least, float(_MOST))
        at = to
    alive, score = alive[keep], score[keep]
    if score.dtype == object:
        score = np.array([max(_LEAST, min(_MOST, int(s))) for s in score], np.int64)
    score = score.astype(np.int64)
    keep = score >= floor
    if np.count_nonzero(keep) > k:
        keep &= score >= np.partition(score, len(score) - k)[len(score) - k]
    score, alive = score[keep], alive[keep]
    best = np.lexsort((ids[alive], -score))[:k]
    return score[best], alive[best], copies[alive[best]]


def _step(parts, at: int, rest: float, whole: float) -> int:
    """Where a step from ``at`` ends: the first goes on until it holds most of the query's mass."""
    to = min(at + STEP, len(parts))
    if at == 0:
        rest -= float(parts[:to].sum())
        while to < len(parts) and rest > FIRST * whole:
            rest -= float(parts[to : to + STEP].sum())
            to = min(to + STEP, len(parts))
    return to


def _packed(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """A row per block: ids, numbers of copies and matrix, dimension by vector, as bytes."""

    def run(frame):
        import numpy as np
        import pandas as pd

        matrix = np.array(frame["vector"].tolist(), np.float64).reshape(len(frame), dims)
        ids = frame["id"].to_numpy(np.int64)
        by = np.lexsort((*matrix.T[::-1], ids))
        matrix = matrix[by].T
        kind = np.int16 if np.abs(matrix).max(initial=0) < 2**15 else np.float64
        out = {"ids": ids[by], "times": frame["copies"].to_numpy(np.int64)[by], "matrix": np.ascontiguousarray(matrix.astype(kind))}
        return pd.DataFrame({key: [frame[key].iloc[0]], **{n: [x.tobytes()] for n, x in out.items()}})

    return rows.groupBy(key).applyInPandas(run, f"{key} long, ids binary, times binary, matrix binary")


def _unpacked(ids: bytes, matrix: bytes, dims: int):
    """(ids, whole components as doubles, dimension by vector)."""
    import numpy as np

    ids = np.frombuffer(ids, np.int64)
    kind = np.int16 if len(matrix) == 2 * dims * len(ids) else np.float64
    return ids, np.frombuffer(matrix, kind).reshape(dims, len(ids)).astype(np.float64)


def _exact(values, kind):
    """Whole doubles as numbers of ``kind``; beyond 64 bits as Python integers."""
    import numpy as np

    if kind is not object:
        return values.astype(kind)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(v) for v in values.ravel()]
    return out


def _meeting(row, dims: int, k: int):
    """For each query of a row's block: its place, and what :func:`search_block` finds in the row's candidates."""
    import numpy as np

    ids, columns = _unpacked(row.ids, row.matrix, dims)
    q_ids, queries = _unpacked(row.q_ids, row.q_matrix, dims)
    copies, floors = np.frombuffer(row.times, np.int64), np.frombuffer(row.floors, np.int64)
    with np.errstate(over="ignore"):
        masses = np.einsum("ij,ij->j", columns, columns)
        widest = float(np.abs(columns).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
    kind = np.float64 if widest < 2**52 else np.int64 if widest < 2**62 else object
    if max(widest, masses.max(initial=0)) < 2**24:
        kind = np.float32  # whole numbers up to 2**24 are exact in it
    wholes, asked = _exact(columns, kind), _exact(queries, kind)
    by_row = np.ascontiguousarray(wholes.T)
    squares = wholes * wholes if kind is np.float32 else None
    starts, ends = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    for i in range(len(q_ids)):
        same = np.flatnonzero((columns[:, starts[i] : ends[i]] == queries[:, i : i + 1]).all(axis=0))
        own = int(starts[i] + same[0]) if len(same) else None
        score, near, times = search_block(asked[:, i], own, ids, wholes, masses, copies, k, int(floors[i]), by_row, squares)
        yield i, score, ids[near], times


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows.

    is_query: a condition on the column ``id``. Vectors that are null or hold
    null or non-finite components (times ``scale``, as doubles), and rows without
    id, take no part. A shorter vector counts as ended by zeros. Rows that repeat
    an id are queries and candidates of their own: a query meets every row but
    its own, and each of several queries of one id has its ranks 1 to k. Products
    are exact; a score beyond a long counts as the nearest long. Equal scores
    rank by id. A table with fewer vectors gives fewer rows, an empty one none;
    other columns are left behind, whatever their names.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("x")).where(F.col("id").isNotNull())
    rows = rows.where(usable_of("x", scale)).select("id", whole_of("x", scale).alias("vector"))
    wide = F.exists("vector", lambda c: F.abs(c) >= F.lit(float(WIDE)))
    rows = rows.withColumns({"wide": wide, "asks": F.coalesce(is_query, F.lit(False))})
    count = lambda of: F.count(F.when(of, 1))
    size = rows.agg(
        F.max(F.size("vector")).alias("dims"),
        count(~F.col("wide")).alias("narrow"),
        count(F.col("wide")).alias("wide"),
        count(F.col("asks") & ~F.col("wide")).alias("q_narrow"),
        count(F.col("asks") & F.col("wide")).alias("q_wide"),
    ).first()
    dims = max(1, size["dims"] or 1)
    zeros = F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vector"))
    # equal rows are one, with their number
    rows = rows.withColumn("vector", F.concat("vector", zeros)).groupBy("id", "vector", "wide", "asks").agg(F.count("*").alias("copies"))

    def place(narrow: int, wide: int) -> Column:
        at = F.xxhash64("id", "vector")
        return F.when(F.col("wide"), F.pmod(at, F.lit(wide)) + narrow).otherwise(F.pmod(at, F.lit(narrow))).cast("long")

    blocks = [max(1, -(-size[n] // CANDIDATES)) for n in ("narrow", "wide")]
    ask_blocks = [max(1, -(-size[n] // QUERIES)) for n in ("q_narrow", "q_wide")]
    partitions = max(sum(blocks), min(SPREAD * sum(blocks), MOST_PARTITIONS))
    held = _packed(rows.withColumn("block", place(*blocks)), "block", dims).repartition(partitions, "block")
    asked = _packed(rows.where("asks").withColumn("asked", place(*ask_blocks)), "asked", dims)
    asked = asked.select("asked", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("times").alias("q_times"))

    def pilot(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples():
                floors = np.full(len(row.q_ids) // 8, _LEAST, np.int64)
                near = []
                if row.ids is not None:
                    row = row._replace(floors=floors.tobytes())
                    for i, score, ids, times in _meeting(row, dims, k):
                        reached = np.searchsorted(np.cumsum(times), k)
                        if reached < len(score):
                            floors[i] = score[reached]
                        near += [{"place": i, "vec_id": int(v), "score": int(s), "copies": int(n)} for v, s, n in zip(ids, score, times)]
                out = (row.asked, row.home, row.q_ids, row.q_matrix, row.q_times, floors.tobytes(), near)
                yield pd.DataFrame([out], columns=["asked", "home", "ids", "matrix", "times", "floors", "near"])

    home = F.pmod(F.col("asked"), F.lit(blocks[0]))
    first = asked.withColumns({"home": home, "block": home, "floors": F.lit(b"")}).repartition(partitions, "block")
    first = checkpointed(first.hint("merge").join(held, "block", "left").mapInPandas(pilot, _PILOT))

    def meet(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples():
                places, scores, ids, copies = zip(*_meeting(row, dims, k))
                sizes = [len(x) for x in scores]
                each = {"query_id": _longs(row.q_ids), "times": _longs(row.q_times), "place": places}
                out = {"asked": row.asked, **{n: np.repeat(x, sizes) for n, x in each.items()}}
                yield pd.DataFrame(out | {"vec_id": np.concatenate(ids), "score": np.concatenate(scores), "copies": np.concatenate(copies)})

    others = F.filter(F.sequence(F.lit(0), F.lit(sum(blocks) - 1)).cast("array<long>"), lambda b: b != F.col("home"))
    rest = first.select(
        F.explode(others).alias("block"),
        "asked",
        F.col("ids").alias("q_ids"),
        F.col("matrix").alias("q_matrix"),
        F.col("times").alias("q_times"),
        "floors",
    ).repartition(partitions, "block")
    rest = rest.hint("merge").join(held, "block").drop("block")
    rest = rest.mapInPandas(meet, f"asked long, query_id long, times long, {_NEAR}")

    def listed(batches):
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples():
                ids, times = _longs(row.ids), _longs(row.times)
                found = pd.DataFrame([{"asked": row.asked, "query_id": ids[n["place"]], "times": times[n["place"]], **n} for n in row.near])
                if len(found):
                    yield found[["asked", "query_id", "times", "place", "vec_id", "score", "copies"]]

    start = first.select("asked", "ids", "times", "near").mapInPandas(listed, f"asked long, query_id long, times long, {_NEAR}")
    near = start.unionByName(rest)
    # no more than k copies of a row can be among a query's k best
    near = near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    rank = Window.partitionBy("asked", "place").orderBy(F.col("score").desc(), "vec_id")
    best = near.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    # equal queries of one id: their rows, a part at a time
    best = best.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / COPIES).cast("int"))))
    left = F.least(F.col("times") - F.col("part") * COPIES, F.lit(COPIES)).cast("int")
    return best.withColumn("turn", F.explode(F.sequence(F.lit(1), left))).select("query_id", "rank", "vec_id", "score")


def _longs(data: bytes) -> list[int]:
    import numpy as np

    return np.frombuffer(data, np.int64).tolist()
