"""Text-to-type conversions with the warehouse's null and error semantics.

All helpers build native Catalyst expressions, so they stay inside
whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a CSV reader treats as missing (the default
# missing-value markers of the pandas CSV reader the warehouse was built on).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The only timestamps the warehouse can represent are those of a
# signed 64-bit nanosecond clock; anything outside becomes null (the
# end-of-time sentinel 9999-12-31 on currently valid rows, for instance).
NS_MIN = "1677-09-21 00:12:43.145225"
NS_MAX = "2262-04-11 23:47:16.854775"

# Digits with a sign, which the cast to a whole number takes within blanks and control characters, or with a fraction of zeros.
WHOLE_NUMBER = r"^(?:[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z|[+-]?[0-9]+\.0*$)"
# Text that begins with a year of six digits beyond those of a timestamp (294247), as large ids do.
YEAR_TOO_FAR = r"^[\x00-\x20\x7f]*[+-]?(?:29424[89]|2942[5-9][0-9]|294[3-9][0-9]{2}|29[5-9][0-9]{3}|[3-9][0-9]{5})(?:[^0-9]|\z)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(c, tokens=NULL_TOKENS) -> Column:
    """Map every missing-value token (exact match, untrimmed) to null."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def in_range(ts: Column, lo: str | None = NS_MIN, hi: str | None = NS_MAX) -> Column:
    """Whether a timestamp lies within the bounds (None: no bound)."""
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (ts >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        ok = ok & (ts <= F.lit(hi).cast("timestamp_ntz"))
    return ok


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Text to ``timestamp_ntz`` without a range; unparseable text is null.

    Without ``fmt`` the ISO forms (``yyyy-MM-dd``, ``yyyy-MM-dd HH:mm:ss[.f]``,
    ``T`` separator) are accepted.  With ``fmt`` a Spark datetime pattern is
    used and the text is parsed straight to a zone-less timestamp, so the
    result does not depend on the session time zone; ``try_to_timestamp``
    only decides which rows are parseable (the strict parser then never sees
    a bad value, even with ANSI mode on).
    """
    c = _col(c).cast("string")
    if fmt is None:
        # the cast raises and catches an overflow on such years, which costs many times the match
        return F.when(~c.rlike(YEAR_TOO_FAR), c.try_cast("timestamp_ntz"))
    f = F.lit(fmt)
    return F.when(F.try_to_timestamp(c, f).isNotNull(), F.to_timestamp_ntz(c, f))


def to_timestamp_coerce(c, fmt: str | None = None, lo: str | None = NS_MIN, hi: str | None = NS_MAX) -> Column:
    """Parse text to ``timestamp_ntz``; unparseable or out of ``lo``..``hi`` -> null.

    The bounds are those of the warehouse's clock unless others (or None) are
    given; ``cast_failures`` reports how many values either rule nulls.
    """
    ts = parse_timestamp(c, fmt)
    return F.when(in_range(ts, lo, hi), ts)


def _exact_bigint(c: Column) -> Column:
    """``'12'``, ``'12.0'``, ``'+12.000'`` and exponents to bigint, by their digits; else null.

    With an exponent the point is shifted in the text, so no digit is rounded:
    the number is whole if no digit but zeros stands behind the point.
    """
    text = F.trim(c.cast("string"))
    # other text is not given to the cast: a cast that fails builds an error, which costs many times the match
    whole = F.when(text.rlike(WHOLE_NUMBER), F.substring_index(text, ".", 1).try_cast("bigint"))
    # a rare case of many steps: within an array function it stays out of the generated code
    shifted = F.element_at(F.transform(F.array(text), _shifted_bigint), 1)
    return F.coalesce(whole, F.when(text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,9})?$"), shifted))


def _shifted_bigint(text: Column) -> Column:
    """A decimal number of the accepted shape to bigint if it is whole and of the type's range; else null."""
    mantissa = F.regexp_replace(F.substring_index(F.lower(text), "e", 1), "^[+-]", "")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    point = F.length(F.substring_index(mantissa, ".", 1)) + F.when(F.lower(text).contains("e"), F.substring_index(F.lower(text), "e", -1).try_cast("int")).otherwise(0)
    whole = F.regexp_replace(digits, "0+$", "")
    core = F.regexp_replace(whole, "^0+", "")
    behind = point - F.length(whole)  # zeros between the last digit and the point
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return (F.when(core == "", F.lit(0).cast("bigint"))
            .when((behind >= 0) & (behind + F.length(core) <= 19), F.concat(sign, core, F.repeat(F.lit("0"), behind)).try_cast("bigint")))


def nullable_bigint(c, strict: bool = True) -> Column:
    """Numbers written as text (``'12'``, ``'12.0'``) to nullable bigint, exact over its whole range.

    Null and the text ``NaN`` stay null.  Anything else that is no whole number
    of the type (``'12.5'``, ``'abc'``, ``'1,234'``, beyond 64 bits) is an error
    when ``strict``, else it becomes null and ``cast_failures`` counts it.
    """
    c = _col(c)
    value = _exact_bigint(c)
    if not strict:
        return value
    missing = c.isNull() | (F.lower(F.trim(c.cast("string"))) == "nan")
    wrong = F.raise_error(F.concat(F.lit("non-integral value for an integer column: "), c.cast("string"))).cast("bigint")
    return F.coalesce(value, F.when(~missing, wrong))


def _number(c: Column) -> Column:
    """Text to double if it is a decimal number or one of the words for infinity and not-a-number; else null.

    The cast alone also takes type suffixes (``1d``, ``2f``) and hexadecimal.
    """
    if_text = F.trim(c.cast("string")).rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$")
    return F.when(if_text, c.try_cast("double"))


def strict_double(c, strict: bool = True) -> Column:
    """Text to double; text that is no number is an error when ``strict``, else null."""
    c = _col(c)
    value = _number(c)
    if not strict:
        return value
    wrong = F.raise_error(F.concat(F.lit("not a number for a double column: "), c.cast("string"))).cast("double")
    return F.coalesce(value, F.when(c.isNotNull(), wrong))


def cast_failed(c, kind: str, fmt: str | None = None) -> Column:
    """Whether a value present in the source has none in the silver type (``kind`` as in a table definition)."""
    c = _col(c)
    present = c.isNotNull() & (F.lower(F.trim(c.cast("string"))) != "nan")
    value = {"bigint": lambda: nullable_bigint(c, strict=False), "double": lambda: _number(c),
             "timestamp": lambda: to_timestamp_coerce(c, fmt), "number_text": lambda: _number(c.cast("string"))}.get(kind)
    return value().isNull() & present if value else F.lit(False)  # the text is looked at where there is no value


def number_to_text(c, integral: bool = False) -> Column:
    """A float column rendered as plain decimal text, NaN/null -> null.

    Integral values keep one decimal (``8302039293929.0``) as the float-typed
    source column printed them; ``integral=True`` drops the ``.0``.  Text that
    is a plain decimal already keeps its digits, whatever their number; other
    values (exponents, numeric columns) are written out from the double.
    """
    c = _col(c)
    d = _number(c.cast("string"))
    valid = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))
    text = F.trim(c.cast("string"))
    plain = text.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$")
    written = F.when(d == F.floor(d), F.format_string("%.0f", d)).otherwise(F.format_string("%.340f", d))
    txt = F.when(plain, text).otherwise(written)
    # no plus sign, no zeros before the whole part or after the fraction
    txt = F.regexp_replace(F.regexp_replace(txt, r"^[+]?(-?)0*(?=[0-9])", "$1"), r"[.]0*$|([.][0-9]*[1-9])0+$", "$1")
    if integral:
        txt = F.substring_index(txt, ".", 1)
    else:
        txt = F.when(txt.contains("."), txt).otherwise(F.concat(txt, F.lit(".0")))
    return F.when(valid, txt)


def truthy(c) -> Column:
    """Numeric flag to boolean with Python truthiness: 0 -> false, else true; null/NaN -> true."""
    c = _col(c)
    return F.coalesce(F.when(~F.isnan(c.cast("double")), c.cast("double") != 0), F.lit(True))
