"""Secrets: assignments, access keys and hex strings, and strings of high entropy.

The method adds candidate strings whose Shannon entropy, in some window of
fixed length, reaches the limit of their character class (hex, or letters and
digits). The window slides along the string: one count goes up, one down, and
the sum of c * log2(c) changes by those two alone. An allow-list suppresses
strings that are known not to be secrets. Everything is Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from terrafold.llm.common import text_or_empty
from terrafold.llm.spans import SPAN, once, scored, with_places

#: The base patterns; repeats of one class are possessive, and
#: least lengths stand in the pattern where that finds the same matches.
BASE = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Bits of entropy in a window, by class.
LIMITS = {"hex": 3.0, "mixed": 3.6}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What words lack: a capital with one small letter, but for words of two letters, and seven consonants in a row.
UNLIKE_WORDS = (
    r"(?!By|Id|Is|To|Of|In|On|Or|As|At|Up|No|If|My|Do|Go|It|An)[A-Z][a-z](?![a-z])|[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{7}"
)
#: Strings that are not secrets: without a letter, words and numbers joined by
#: signs or digit-free, and identifiers of the usual 8-4-4-4-12 form. Repeated
#: groups are possessive: they neither retry nor recurse along a long string.
ALLOWED = (
    r"^[^A-Za-z]*$|^(?!.*(?:" + UNLIKE_WORDS + r"))(?:[^0-9]*|[A-Za-z]*[0-9]{0,4}|(?:[A-Za-z]++|[0-9]++)(?:[+/_=-]++(?:[A-Za-z]++|[0-9]++))*+[+/_=-]*+)$"
    r"|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
)


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def top_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest entropy of a window along a string of at least its length."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    codes = F.filter(codes, lambda c: c > 0)
    leaving = F.concat(F.array_repeat(F.lit(0), window), codes)
    moves = F.zip_with(codes, leaving, lambda a, b: F.struct(a.alias("come"), b.alias("go")))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
        F.lit(0.0).alias("weight"),
        F.lit(0).alias("n"),
        F.lit(0.0).alias("best"),
    )

    def move(state: Column, step: Column) -> Column:
        come, go = step["come"], step["go"]
        same = come == go
        had, has = state["counts"][come], state["counts"][go]
        up = F.when(same, 0.0).otherwise(_weight(had + 1) - _weight(had))
        down = F.when(same | (go == 0), 0.0).otherwise(_weight(has - 1) - _weight(has))
        weight = state["weight"] + up + down
        n = state["n"] + 1
        bits = F.log2(F.lit(float(window))) - weight / window
        counts = F.transform(
            state["counts"], lambda c, j: c + (j == come).cast("int") - ((j == go) & (go > 0)).cast("int")
        )
        return F.struct(
            counts.alias("counts"),
            weight.alias("weight"),
            n.alias("n"),
            F.when(n >= window, F.greatest(state["best"], bits)).otherwise(state["best"]).alias("best"),
        )

    # the last ``window`` steps of the longer list have nothing that comes
    return F.aggregate(F.filter(moves, lambda m: m["come"].isNotNull()), start, move, lambda s: s["best"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: (start, rank, kind, end, value, score) by place, then kind.

    Base spans are all kept, with score 1. An ``entropy`` span is a candidate of
    high entropy, or what assignments and access keys leave of it at 20
    characters or more; one that holds a hex string and more than words beside
    it stays whole and overlaps it. Its score is the entropy over the highest
    possible. Kinds are found apart, so base spans may overlap. Places
    are code points, the end exclusive. Null and empty texts have no span;
    repeated rows get equal rows; an empty table gives none. Other columns are
    left behind, whatever their names.
    """
    return _located(docs.select("doc_id", "text")).select("row.doc_id", "spans")


def spans_of(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a column of their secrets' (start, end), apart and in order.

    A column that already bears the name is replaced; others stay as they are.
    """
    found = _apart(_located(docs))
    return found.select(*(F.col(f"row.`{n}`") for n in docs.columns if n != name), F.col("apart").alias(name))


def _apart(found: DataFrame) -> DataFrame:
    """Adds ``apart``: the spans' places, overlapping ones as one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(merged: Column, s: Column) -> Column:
        last = F.get(merged, F.size(merged) - 1)
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        wider = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        overlaps = (F.size(merged) > 0) & (last["end"] > s["start"])
        return F.when(overlaps, F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), wider)).otherwise(F.concat(merged, own))

    return found.withColumn("apart", F.aggregate("spans", none, add))


def redacted(docs: DataFrame, mark: str) -> DataFrame:
    """The documents, each secret in the text replaced by a mark; overlapping secrets are one.

    Null and empty texts, repeated rows and all other columns, whatever their
    names, stay as they are; an empty table gives none.
    """
    found = _apart(_located(docs)).withColumn("text", F.col("row.text"))
    end = lambda i: F.coalesce(F.get("apart", i)["end"], F.lit(0).cast("long"))
    start = lambda i: F.coalesce(F.get("apart", i)["start"], F.length("text").cast("long"))
    between = F.transform(
        F.sequence(F.lit(0), F.size("apart")),
        lambda i: F.col("text").substr((end(i - 1) + 1).cast("int"), (start(i) - end(i - 1)).cast("int")),
    )
    text = F.when(F.size("apart") == 0, F.col("text")).otherwise(F.array_join(between, mark))
    found = found.select("row", text.alias("text"))
    return found.select(*(F.col("text") if n == "text" else F.col(f"row.`{n}`") for n in docs.columns))


def _located(docs: DataFrame) -> DataFrame:
    """(row, spans) of documents: a struct of all their columns, and their secrets."""
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in docs.columns)).alias("row"), text_or_empty().alias("text"))
    rows = with_places(rows, BASE | {"entropy": CANDIDATE})
    long_enough = lambda s: F.length(F.regexp_extract(s["value"], BASE["assign"], 2)) >= 6
    rows = rows.withColumn("assign", F.filter("assign", long_enough))
    base = F.concat(*(scored(kind, order, lambda s: F.lit(1.0)) for order, kind in enumerate(BASE)))
    unlike = lambda v: ~v.rlike(ALLOWED)
    rows = rows.withColumn("base", base).withColumn("entropy", F.filter("entropy", lambda s: unlike(s["value"])))
    rows = rows.withColumn("cuts", F.array_sort(F.concat("assign", "access")))
    rows = rows.withColumn("entropy", F.flatten(F.transform("entropy", lambda s: _uncovered(s, F.col("cuts")))))
    # a hex string is a base span itself; words beside it make no secret
    beside = lambda s: F.exists(F.split(s["value"], BASE["hex"]), lambda v: (v != "") & unlike(v))
    rows = rows.withColumn("entropy", F.filter("entropy", lambda s: unlike(s["value"]) & beside(s)))
    most = float(min(WINDOW, len(ALPHABET)))
    added = scored("entropy", len(BASE), lambda s: top_entropy(s["value"]) / F.log2(F.lit(most)))
    limit = lambda s: F.when(s["value"].rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).otherwise(LIMITS["mixed"])
    rows = rows.withColumn("entropy", F.filter(added, lambda s: s["score"] * F.log2(F.lit(most)) >= limit(s)))
    return rows.select("row", once(F.array_sort(F.concat("base", "entropy"))).alias("spans"))


def _uncovered(s: Column, cuts: Column) -> Column:
    """The parts of a span that no cut covers, those as long as a window."""

    def parted(so_far: Column, start: Column) -> Column:
        value = s["value"].substr((so_far["at"] - s["start"] + 1).cast("int"), (start - so_far["at"]).cast("int"))
        part = F.array(F.struct(so_far["at"].alias("start"), start.alias("end"), value.alias("value")))
        return F.when(start - so_far["at"] >= WINDOW, F.concat(so_far["parts"], part)).otherwise(so_far["parts"])

    touching = F.filter(cuts, lambda c: (c["start"] < s["end"]) & (s["start"] < c["end"]))
    first = F.struct(s["start"].alias("at"), F.array().cast(SPAN).alias("parts"))
    step = lambda so_far, c: F.struct(F.greatest(so_far["at"], c["end"]).alias("at"), parted(so_far, c["start"]).alias("parts"))
    return F.aggregate(touching, first, step, lambda so_far: parted(so_far, s["end"]))
