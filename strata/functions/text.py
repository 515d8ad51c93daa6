"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generated contact address is 'info@' + name + '.com' where
# the name loses the literal ' (Head Office)' suffix and every space.
HEAD_OFFICE_SUFFIX = " (Head Office)"


def email_from_name(name) -> Column:
    """Fallback contact e-mail built from a company name (literal, not regex).

    Other characters (commas, brackets, '#') are kept; a null name gives null.
    """
    name = F.col(name) if isinstance(name, str) else name
    cleaned = F.replace(F.replace(name, F.lit(HEAD_OFFICE_SUFFIX), F.lit("")), F.lit(" "), F.lit(""))
    return F.concat(F.lit("info@"), F.lower(cleaned), F.lit(".com"))


def contains_or_false(c, fragment: str) -> Column:
    """Literal substring test where a null value counts as no match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.contains(fragment), F.lit(False))
