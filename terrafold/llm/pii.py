"""Personal data: patterns propose, checksums confirm, nearby words adjust.

Email addresses, network addresses, card and international phone numbers are
found by their patterns and kept if they pass their checks. The method adds
account numbers (IBAN, confirmed by mod 97), and national phone and social
security numbers, which need a word nearby that says what they are. Everything
is Spark expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from terrafold.llm.common import text_or_empty
from terrafold.llm.spans import around, chunked, listed, once, scored, with_places

#: The base patterns, in an order of matching that cannot retry
#: within a run of letters or digits (possessive repeats, one start per run).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_phone": r"(?<![+0-9(.-])(?<![+0-9][\x20(-])(?<![+0-9][\x20-]\()(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Words that speak for a kind, as a pattern on small letters.
CONTEXT = {
    "email": r"e-?mail|contact|write to|correo|courriel|adresse",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": r"card|visa|credit|debit|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel\b|mobile|fax|telefon|téléphone|teléfono",
    "iban": r"iban|bank|account|konto|compte|cuenta",
    "national_phone": r"phone|call|tel\b|mobile|fax|telefon|téléphone|teléfono",
    "ssn": r"\bssn\b|social security|tax id",
}
#: A span's score: what its pattern is worth, a checksum that holds, a word nearby.
WORTH = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.7, "iban": 0.2, "national_phone": 0.4, "ssn": 0.4}
CHECKSUM, NEARBY, KEEP, BEFORE, AFTER = 0.5, 0.3, 0.6, 48, 24


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(number)),
        F.lit(0),
        lambda t, i: t + _luhn_part(number.substr(F.length(number) - i + 1, F.lit(1)).cast("int"), i),
    )
    return total % 10 == 0


def _luhn_part(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)


def mod_97(account: Column) -> Column:
    """Whether an account number without blanks leaves 1, its first four signs moved to the end."""
    signs = F.split(F.concat(account.substr(F.lit(5), F.length(account)), account.substr(1, 4)), "")
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    rest = F.aggregate(signs, F.lit(0), lambda t, c: F.when(c == "", t).otherwise((t * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97))
    return rest == 1


def _passes(kind: str, value: Column) -> Column:
    number = digits(value)
    if kind == "ip":
        return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$")
    if kind == "card":
        return F.length(number).between(14, 19) & luhn(number)
    if kind == "phone":
        return F.length(number).between(10, 15)
    if kind == "iban":
        account = F.regexp_replace(value, " ", "")
        return F.length(account).between(15, 34) & mod_97(account)
    return F.lit(True)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda s: _passes(kind, s["value"])


def _score(kind: str, near: Callable[[Column], Column]) -> Callable[[Column], Column]:
    worth = WORTH[kind] + (CHECKSUM if kind in ("card", "iban") else 0.0)
    return lambda s: F.least(F.lit(1.0), F.lit(worth) + F.when(near(s).rlike(CONTEXT[kind]), NEARBY).otherwise(0.0))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: (start, rank, kind, end, value, score) by place, then kind.

    Base kinds keep every span that passes its check; added kinds those whose
    score reaches KEEP. Kinds are found apart, so spans of two may overlap.
    Places are code points, the end exclusive. Null and empty texts have no
    span; repeated rows get equal rows; an empty table gives none. Other columns
    are left behind, whatever their names.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    kinds = BASE | ADDED
    rows = with_places(rows, kinds)
    near = around("chunks", BEFORE, AFTER)
    rows = rows.withColumns({kind: F.filter(kind, _check(kind)) for kind in kinds})
    some = F.greatest(*(F.size(kind) for kind in kinds)) > 0
    rows = rows.withColumn("chunks", F.when(some, chunked(F.col("text"))))
    parts = []
    for order, kind in enumerate(kinds):
        found = scored(kind, order, _score(kind, near))
        parts.append(found if kind in BASE else F.filter(found, lambda s: s["score"] >= KEEP))
    return rows.select("doc_id", once(F.array_sort(F.concat(*parts))).alias("spans"))


def digest(found: DataFrame, base: dict[str, str]) -> DataFrame:
    """Counts and digest of the base spans, and all spans as one string."""
    of_base = F.filter("spans", lambda s: s["kind"].isin(list(base)))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
