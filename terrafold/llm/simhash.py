"""SimHash near-duplicates, by the generalised pigeonhole principle.

The 64 bits are grouped into partitions of correlated bits. Partition i gets a
threshold t_i >= -1 with sum(t_i + 1) = distance + 1: two fingerprints within
the distance then agree up to t_i bits in some partition. A dynamic programme
chooses the thresholds with the least estimated number of candidates, from how
often each partition's values occur. Fingerprints meet under a partition's value
(both sides spread to values half of t_i bits away); where that part is exact,
the other bits are cut into distance + 1 blocks of which one must be equal, so
that groups stay small. Meeting pairs are verified on all bits.

Only distinct fingerprints meet, and a group sends a spanning forest of its
links, never all its pairs. Components come from the forests' edges.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from terrafold.llm.common import checkpointed, text_or_empty
from terrafold.llm.components import components

BITS, PARTS = 64, 4
#: Pairs that a group holds before they are cut to their forest.
HELD = 1 << 20
#: Rows beyond which a spot is cut into blocks that meet in pairs, a task of its own each.
SPOT = 4096

#: The bits of each byte.
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text: a bit is 1 if set in over half the hashes."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if shingle == 1:
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
    elif len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        whole = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(whole[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    table = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(table[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *carried: str) -> DataFrame:
    """(doc_id, fingerprint as a long, carried columns) of every whole text.

    A-Z are lowered; words end at ASCII white space. Fewer words than a shingle
    make one shingle; a text without words (null, empty, blank) has fingerprint
    zero. Repeated rows are kept. Other columns are left behind.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.array([fingerprint_of(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *carried])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"), *carried)
    kinds = [f", `{n}` {rows.schema[n].dataType.simpleString()}" for n in carried]
    return rows.mapInArrow(run, "doc_id long, fingerprint long" + "".join(kinds))


def grouped_bits(rows: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """The bits in groups of one size, each with the bits it correlates with most."""
    def run(batches):
        import pandas as pd

        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = ((batch["fingerprint"].to_numpy().view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
            total += bits.T @ bits
            n += len(bits)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "times": [*total.ravel(), float(n)]})

    # one sum for each pair of bits, whatever the number of rows
    summed = rows.select("fingerprint").mapInPandas(run, "cell int, times double").groupBy("cell").agg(F.sum("times").alias("times"))
    cells = np.zeros(BITS * BITS + 1)
    found = summed.toPandas()
    cells[found["cell"]] = found["times"]
    n = max(cells[-1], 1.0)
    both = cells[:-1].reshape(BITS, BITS) / n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    bound = np.abs(both - np.outer(mean, mean)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    while left:
        size = BITS // parts if len(groups) < parts - 1 else len(left)
        group = [min(left, key=lambda b: (-bound[b, sorted(left)].sum(), b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(min(left, key=lambda b: (-bound[b, group].sum(), b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _extracted(values, bits: list[int]):
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def _balls(width: int, radius: int):
    """Bit masks of at most ``radius`` ones."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.uint64)


def candidate_costs(rows: DataFrame, groups: list[list[int]], distance: int) -> list[list[float]]:
    """Estimated work of each partition at thresholds -1, 0, 1, …, distance.

    From the exact number of fingerprints for each value of a partition's first
    16 bits: a table of at most 2**16 counts per partition.
    """
    groups, widths = [g[:16] for g in groups], [len(g) for g in groups]
    def run(batches):
        import pandas as pd

        for batch in batches:
            values = batch["fingerprint"].to_numpy().view(np.uint64)
            for i, bits in enumerate(groups):
                seen, times = np.unique(_extracted(values, bits), return_counts=True)
                yield pd.DataFrame({"part": i, "value": seen.astype(np.int64), "times": times})

    counted = rows.select("fingerprint").mapInPandas(run, "part int, value int, times long").groupBy("part", "value").agg(F.sum("times").alias("times"))
    found, costs = counted.toPandas(), []
    for i, bits in enumerate(groups):
        table = np.zeros(1 << len(bits))
        own = found[found["part"] == i]
        table[own["value"]] = own["times"]
        values = np.arange(len(table), dtype=np.uint64)
        n, line = table.sum(), [0.0]
        for t in range(distance + 1):
            reach = 2 * ((t + 1) // 2)
            masks = _balls(len(bits), min(reach, 2))
            near = sum(table[(values ^ m).astype(np.int64)] for m in masks)
            pairs = float((table * near).sum()) * (8.0 ** max(0, reach - 2))
            pairs /= 2.0 ** (widths[i] - len(bits))
            line.append(pairs + 4 * n * len(_balls(widths[i], min((t + 1) // 2, 2))) * 9.0 ** max(0, (t + 1) // 2 - 2))
        costs.append(line)
    return costs


def thresholds(costs: list[list[float]], distance: int) -> list[int]:
    """Thresholds with sum(t + 1) = distance + 1 and the least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for line in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(line, start=-1):
                total = spent + t + 1
                if total <= distance + 1 and (total not in after or cost + more < after[total][0]):
                    after[total] = (cost + more, [*chosen, t])
        best = after
    return best[distance + 1][1]


def forest(a, b, weight, n: int):
    """Numbers of the pairs (a, b) that make a spanning forest of least weight among n rows."""
    label, chosen = np.arange(n), []
    order = np.argsort(weight, kind="stable")
    cuts = np.flatnonzero(np.diff(weight[order])) + 1
    for level in np.split(order, cuts):
        while len(level):
            left, right = label[a[level]], label[b[level]]
            level, left, right = (x[left != right] for x in (level, left, right))
            if not len(level):
                break
            # each component hooks to one of a lesser label, so no circle closes
            upper, first = np.unique(np.maximum(left, right), return_index=True)
            chosen.append(level[first])
            label[upper] = np.minimum(left, right)[first]
            while not np.array_equal(label, label[label]):
                label = label[label]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def spots(rows: DataFrame, distance: int, parts: int = PARTS) -> DataFrame:
    """(spot, id, fingerprint): rows within the distance meet in some spot.

    A spot of many rows is cut into blocks, and each two blocks make a spot of
    their own, so that every pair still meets and no spot is large.
    """
    groups = grouped_bits(rows, parts)
    chosen = thresholds(candidate_costs(rows, groups, distance), distance)
    plan = []
    for i, t in enumerate(chosen):
        if t < 0:
            continue
        rest = [b for j, g in enumerate(groups) if j != i for b in g]
        blocks = [rest[k :: distance + 1] for k in range(distance + 1)] if t == 0 and distance <= 3 else [[]]
        for k, block in enumerate(blocks):
            plan.append((len(plan), groups[i], (t + 1) // 2, block, len(groups[i])))

    def spread(batches):
        import pyarrow as pa

        for batch in batches:
            ids, prints = batch.column(0), batch.column(1)
            values = prints.to_numpy().view(np.uint64)
            for number, bits, radius, block, width in plan:
                key = _extracted(values, bits) | (_extracted(values, block) << np.uint64(width))
                for mask in _balls(width, radius):
                    spot = ((key ^ mask) | np.uint64(number << 58)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(spot), ids, prints], ["spot", "id", "fingerprint"])

    met = rows.select("id", "fingerprint").mapInArrow(spread, "spot long, id long, fingerprint long")
    # at most one row for each SPOT rows; Spark sends it to all tasks only while it is small
    large = met.groupBy("spot").count().where(F.col("count") > SPOT)
    large = large.select(F.col("spot").alias("of"), F.ceil(F.col("count") / SPOT).alias("blocks"))
    met = met.join(large, F.col("spot") == F.col("of"), "left").drop("of")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    met = met.select("*", F.explode(F.coalesce(every, F.array(F.lit(None).cast("long")))).alias("other"))
    # spots that fall together by their hashes only meet in vain
    pair = F.xxhash64("spot", F.least(own, F.col("other")), F.greatest(own, F.col("other")))
    return met.select(F.when(F.col("blocks").isNull(), F.col("spot")).otherwise(pair).alias("spot"), "id", "fingerprint")


def links(rows: DataFrame, distance: int, parts: int = PARTS) -> DataFrame:
    """(a, b): edges that connect ids whose fingerprints are within the distance.

    rows: (id, fingerprint). The edges of each group of candidates are a
    spanning forest of its links, the links of fewest bits first, so ids that
    links within some number of bits connect are connected by edges within it.
    """

    def meet(batches):
        import pyarrow as pa

        def found(spot, ids, prints):
            order = np.lexsort((ids, spot))
            spot, ids, prints = spot[order], ids[order], prints[order]
            pairs, step, at = [], 1, np.arange(len(spot))

            def settled():
                a, b, bits = (np.concatenate([p[i] for p in pairs]) for i in range(3))
                kept = forest(a, b, bits, len(spot))
                return [(a[kept], b[kept], bits[kept])]

            while True:
                at = at[at + step < len(spot)]
                at = at[spot[at] == spot[at + step]]
                if not len(at):
                    break
                bits = np.bitwise_count(prints[at] ^ prints[at + step])
                near = bits <= distance
                pairs.append((at[near], at[near] + step, bits[near]))
                if step % 64 == 0 and sum(len(p[0]) for p in pairs) > HELD:
                    pairs = settled()
                step += 1
            pairs = settled() if pairs else [(at, at, at)]
            return pa.RecordBatch.from_arrays([pa.array(ids[pairs[0][0]]), pa.array(ids[pairs[0][1]])], ["a", "b"])

        kept = None
        for batch in batches:
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now)]
            if not len(now[0]):
                continue
            whole = int(np.searchsorted(now[0], now[0][-1], "left"))
            kept = [x[whole:] for x in now]
            if whole:
                yield found(*[x[:whole] for x in now])
        if kept is not None:
            yield found(*kept)

    met = spots(rows, distance, parts)
    return met.repartition("spot").sortWithinPartitions("spot").mapInArrow(meet, "a long, b long")


def _groups(prints: DataFrame, distance: int) -> DataFrame:
    """(of, group): each distinct fingerprint, and the least one that links of its group reach."""
    same = checkpointed(prints.select(F.col("fingerprint").alias("id"), "fingerprint").distinct())
    found = components(links(same, distance))
    return same.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("of"), F.coalesce("component", "id").alias("group")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (long), component_id: the least doc_id reachable by links.

    Two fingerprints that differ in at most ``distance`` bits are linked. Null
    and empty texts share fingerprint zero. Repeated rows each get their row, as
    do several texts of one id, which link nothing by their id alone. Rows
    without id keep a null component only where no linked row has an id. An
    empty table gives no row; other columns are left behind.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    # least ids of equal fingerprints, then of groups, so that no hot group moves whole
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    grouped = least.join(_groups(prints, distance), F.col("fingerprint") == F.col("of")).select("of", "group", "least")
    grouped = checkpointed(grouped)
    named = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.select("of", "group").join(named, "group").select("of", "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("of")).select("doc_id", "fingerprint", "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each group of :func:`near_duplicates`, whole, with all its columns.

    It is the row of the least doc_id (null ids last); of several with that id
    the choice is by a hash of their content, so it does not change when a task
    runs again. Equal rows are copies of each other. Texts without words (null,
    empty, blank) make one group with what is near them. Any names of other
    columns are fine. An empty table gives none.
    """
    row = F.struct(*(F.col(f"`{n}`") for n in docs.columns))
    rows = docs.select(row.alias("row"), "doc_id", "text").withColumn("content", F.xxhash64(F.to_json("row"), F.col("text")))
    prints = checkpointed(fingerprints(rows, shingle, "content"))
    # copies collapse before the groups are joined
    counted = prints.groupBy("fingerprint", "doc_id", "content").agg(F.count(F.lit(1)).alias("times"))
    grouped = counted.join(_groups(prints, distance), F.col("fingerprint") == F.col("of"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content", "times")
    first = checkpointed(grouped.groupBy("group").agg(F.min(order).alias("first")))
    first = first.select(F.col("first.doc_id").alias("first_id"), F.col("first.content").alias("of"), "first.times")
    chosen = F.col("doc_id").cast("long").eqNullSafe(F.col("first_id")) & (F.col("content") == F.col("of"))
    found = rows.join(first, chosen).select("row", "doc_id", "content", "times")
    repeated = found.where("times > 1").dropDuplicates(["doc_id", "content"])
    return found.where("times = 1").unionByName(repeated).select("row.*")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
