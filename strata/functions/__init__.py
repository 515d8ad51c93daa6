"""Column-expression helpers (pure functions Column -> Column, all JVM-side)."""

from strata.functions.casts import (
    NULL_TOKENS,
    null_tokens_to_null,
    nullable_bigint,
    number_to_text,
    to_timestamp_coerce,
    truthy,
)
from strata.functions.dates import calendar_columns
from strata.functions.text import email_from_name

__all__ = [
    "NULL_TOKENS",
    "null_tokens_to_null",
    "nullable_bigint",
    "number_to_text",
    "to_timestamp_coerce",
    "truthy",
    "calendar_columns",
    "email_from_name",
]
