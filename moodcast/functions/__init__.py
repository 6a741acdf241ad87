"""Column-level helpers (JVM expressions only) and distribution tails."""

from .columns import (
    class_of_compound,
    comment_date,
    date_parts,
    flag,
    reading_date,
    rounded,
    slug_of,
    temperature_label,
    tokens,
)

__all__ = [
    "class_of_compound",
    "comment_date",
    "date_parts",
    "flag",
    "reading_date",
    "rounded",
    "slug_of",
    "temperature_label",
    "tokens",
]
