"""Tag selections and run settings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from terrafold.schema import ALL_TAGS, MAX_LINE_BYTES, PROFILES


def profile_tags(selection: str = "all") -> list[str]:
    """Tag keys of a profile name, of "all", or of a comma list of keys."""
    name = selection.strip().lower()
    if name in ("", "all"):
        return list(ALL_TAGS)
    if name in PROFILES:
        return list(PROFILES[name])
    return [tag.strip() for tag in selection.split(",") if tag.strip()]


@dataclass
class RunConfig:
    """Settings of one extraction run."""

    tags: Sequence[str] = field(default_factory=lambda: list(ALL_TAGS))
    formats: Sequence[str] = ("parquet",)
    subtags: Sequence[str] | None = None
    skip_mode: str = "standard"
    table: str | None = None
    keep_unidentified: bool = False
    max_line_bytes: int = MAX_LINE_BYTES
    min_file_bytes: int = 0
