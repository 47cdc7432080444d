"""Places of regular expressions in texts, by Spark expressions alone.

A text split at the matches, and the matches themselves, give every match's
place: the lengths so far, in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPAN = "array<struct<start:bigint,end:bigint,value:string>>"
#: Characters of a text's chunk.
CHUNK = 1024


def with_places(frame: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """A column for each name: (start, end, value) of the leftmost matches in turn.

    Texts without a match are looked at once; the patterns must not match the
    empty string.
    """
    for name, pattern in patterns.items():
        frame = frame.withColumn(f"found_{name}", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    for name, pattern in patterns.items():
        some = F.size(f"found_{name}") > 0
        frame = frame.withColumn(f"between_{name}", F.when(some, F.split(F.col(text), pattern, -1)))
    for name in patterns:
        steps = F.zip_with(
            F.col(f"between_{name}"),
            F.col(f"found_{name}"),
            lambda b, f: F.struct(F.length(b).cast("long").alias("gap"), F.length(f).cast("long").alias("long"), f.alias("value")),
        )
        frame = frame.withColumn(f"steps_{name}", steps)
    # a growing list is copied at each step, so it grows within blocks of about the root of the steps
    for name in patterns:
        steps, size = F.col(f"steps_{name}"), F.ceil(F.sqrt(F.size(f"steps_{name}"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.size(steps), size), _block(steps, size))
        frame = frame.withColumn(f"blocks_{name}", F.when(steps.isNotNull(), blocks))
    for name in patterns:
        blocks = F.col(f"blocks_{name}")
        later = lambda so_far, b: F.concat(so_far, F.array(F.element_at(so_far, -1) + b["at"]))
        begins = F.aggregate(blocks, F.array(F.lit(0).cast("long")), later)
        frame = frame.withColumn(f"begins_{name}", F.slice(begins, F.lit(1), F.size(blocks)))
    for name in patterns:
        moved = F.flatten(F.zip_with(f"blocks_{name}", f"begins_{name}", lambda b, at: F.transform(b["spans"], _moved(at))))
        frame = frame.withColumn(name, F.coalesce(moved, F.array().cast(SPAN)))
    return frame.drop(*(f"{p}_{n}" for n in patterns for p in ("found", "between", "steps", "blocks", "begins")))


def _block(steps: Column, size: Column) -> Callable[[Column], Column]:
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))
    return lambda at: F.aggregate(F.slice(steps, at, size), first, _next_place)


def _moved(by: Column) -> Callable[[Column], Column]:
    return lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["value"].alias("value"))


def _next_place(so_far: Column, step: Column) -> Column:
    start = so_far["at"] + step["gap"]
    end = start + F.coalesce(step["long"], F.lit(0).cast("long"))
    span = F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value"))
    spans = F.when(step["value"].isNull(), so_far["spans"]).otherwise(F.concat(so_far["spans"], F.array(span)))
    return F.struct(end.alias("at"), spans.alias("spans"))


def once(column: Column) -> Column:
    """A column that is computed once: filters on it stay above, and repeat none of its steps."""
    return F.explode(F.array(column))


def scored(name: str, order: int, score: Callable[[Column], Column]) -> Column:
    """Spans of one kind with their score, in a form that sorts by place, then kind."""
    return F.transform(
        F.col(name),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("rank"),
            F.lit(name).alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            score(s).alias("score"),
        ),
    )


def chunked(text: Column) -> Column:
    """A text cut into CHUNK characters each, so that a place in it is found without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def around(chunks: str, before: int, after: int) -> Callable[[Column], Column]:
    """The text near a span, in small letters, without the span itself.

    chunks: the name of a column of :func:`chunked`; no side is longer than a chunk.
    """

    def part(first: Column, size: Column) -> Column:
        at = F.floor(first / CHUNK).cast("int")
        both = F.concat_ws("", F.get(chunks, at), F.get(chunks, at + 1))
        return both.substr((first - at * CHUNK + 1).cast("int"), size.cast("int"))

    def near(s: Column) -> Column:
        first = F.greatest(s["start"] - before, F.lit(0))
        return F.lower(F.concat_ws(" ", part(first, s["start"] - first), part(s["end"], F.lit(after))))

    return near


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined with commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
