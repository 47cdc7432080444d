"""Scalar functions on names, ids, tag values and tag maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Unicode white space plus the four ASCII separators, as a regex class.
_SPACE = r"[\s\x1c-\x1f]"
_EDGE_SPACE = rf"(?U)^{_SPACE}+|{_SPACE}+$"

# Most values are plain ASCII; these cheap tests spare them the Unicode patterns.
_MAY_HAVE_EDGE_SPACE = r"^[^!-~]|[^!-~]$"
_MAY_BE_UNSAFE = r"[^-A-Za-z0-9_.]"


def strip(text: Column) -> Column:
    """Remove all white space at both ends, not only blanks."""
    bare = F.regexp_replace(text, _EDGE_SPACE, "")
    return F.when(F.rlike(text, F.lit(_MAY_HAVE_EDGE_SPACE)), bare).otherwise(text)


def norm_value(text: Column) -> Column:
    """Tag value in the form the whitelist uses."""
    return strip(F.lower(text))


def sanitize_name(text: Column) -> Column:
    """Name that is safe as a folder or file name."""
    safe = F.regexp_replace(strip(text), r"(?U)[^-\w.]", "_")
    return F.substring(
        F.when(F.rlike(text, F.lit(_MAY_BE_UNSAFE)), safe).otherwise(text), 1, 40
    )


def unescaped(path: Column) -> Column:
    """File path or name without the escapes of a URI; a plus sign stays."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)


def source_label(file_name: Column) -> Column:
    """Safe label of an input file, without its map-file ending."""
    bare = F.replace(file_name, F.lit(".pbf"), F.lit(""))
    return sanitize_name(F.replace(bare, F.lit(".geojsonseq"), F.lit("")))


def subtags_of(text: Column) -> Column:
    """Values of a comma list, trimmed, blanks dropped; "all" gives none."""
    parts = F.filter(F.transform(F.split(text, ","), strip), lambda p: p != "")
    return F.when(F.lower(strip(text)) == "all", F.array().cast("array<string>")).otherwise(
        parts
    )


def parse_subtags(argument: str | None) -> list[str] | None:
    """Driver-side form of :func:`subtags_of` for a command line argument.

    ``None`` keeps the whitelist, an empty list accepts every value.
    """
    if argument is None:
        return None
    if argument.strip().lower() == "all":
        return []
    return [part.strip() for part in argument.split(",") if part.strip()]


def parse_id(text: Column) -> Column:
    """Whole number, or 0 when the text is not one."""
    return F.coalesce(strip(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def first_present(props: Column, keys: Sequence[str], default: str) -> Column:
    """Value of the first key that is present; a present null reads as ""."""
    out = F.lit(default)
    for key in reversed(keys):
        out = F.when(F.map_contains_key(props, key), F.coalesce(props[key], F.lit(""))).otherwise(
            out
        )
    return out


def tags_json(props: Column) -> Column:
    """Tags as a JSON object, without the ``@`` attributes."""
    return F.to_json(F.map_filter(props, lambda k, v: ~F.startswith(k, F.lit("@"))))


def last_wins(props: Column) -> Column:
    """Keep the last value of a key that a JSON object repeats."""
    keys, values = F.map_keys(props), F.map_values(props)
    unique = F.array_distinct(keys)
    rebuilt = F.map_from_arrays(
        unique,
        F.transform(
            unique,
            lambda k: F.element_at(values, (-F.array_position(F.reverse(keys), k)).cast("int")),
        ),
    )
    return F.when(F.size(unique) < F.size(keys), rebuilt).otherwise(props)
