"""Column expressions for typed cleaning of raw rental text (SCL1-SCL18).

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
Semantics follow pandas where the reference used pandas: bad text becomes
null (never an error, since ANSI mode raises on a failed plain cast), and a
null comparison counts as false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the cleaning rules.
BATHROOM_NUMBER_PATTERN = r"(\d+\.?\d*)"
MONEY_STRIP_PATTERN = r"[$,]"
TRUE_TEXT, FALSE_TEXT = "t", "f"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def money_to_double(c) -> Column:
    """SCL1: '$2,315.00' -> 2315.0; unparseable text or 'nan' -> null."""
    stripped = F.regexp_replace(_c(c), MONEY_STRIP_PATTERN, "")
    return nan_to_null(stripped.try_cast("double"))


def percent_to_double(c) -> Column:
    """SCL2: '97%' -> 97.0; bad -> null."""
    return nan_to_null(F.replace(_c(c), F.lit("%"), F.lit("")).try_cast("double"))


def first_number_or(text, fallback) -> Column:
    """SCL3: first number in ``text``; null text -> ``fallback``; text
    without a number -> null."""
    text = _c(text)
    num = F.regexp_extract(text, BATHROOM_NUMBER_PATTERN, 1).try_cast("double")
    return F.when(text.isNull(), _c(fallback)).otherwise(num)


def tf_to_bool(c) -> Column:
    """SCL4: 't' -> true, 'f' -> false, anything else -> null."""
    c = _c(c)
    return F.when(c == TRUE_TEXT, F.lit(True)).when(c == FALSE_TEXT, F.lit(False))


def to_date_or_null(c) -> Column:
    """SCL5: date text -> DateType, unparseable -> null."""
    return _c(c).try_cast("date")


def json_string_list(c) -> Column:
    """SCL6: JSON array text -> array<string>; null or malformed -> []."""
    return F.coalesce(F.from_json(_c(c), "array<string>"), F.array().cast("array<string>"))


def literal_string_list(c) -> Column:
    """SCL7: Python list literal (single quotes, None) -> array<string>;
    null or malformed -> [].  Only the bare token None is a null."""
    as_json = F.regexp_replace(_c(c), r"(?<=[\[,]|[\[,] )None(?=\s*[\],])", "null")
    return F.coalesce(F.from_json(as_json, "array<string>"), F.array().cast("array<string>"))


def list_length(c) -> Column:
    """SCL8."""
    return F.size(_c(c))


def title_trim(c) -> Column:
    """SCL9: title case, then trim (null stays null): a letter after anything
    but a letter is a capital, also behind a hyphen or an apostrophe."""
    marked = F.regexp_replace(F.lower(_c(c)), r"(?<!\p{L})(?=\p{L})", "\u0001")
    parts = F.split(marked, "\u0001")
    return F.trim(F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), ""))


def round_half_even(c, scale: int = 5) -> Column:
    """SCL10: numpy-style rounding (half to even)."""
    return F.bround(_c(c), scale)


def cap_upper(c, cap) -> Column:
    """SCL11: clip above; null stays null (``least`` alone skips nulls)."""
    c = _c(c)
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    return F.when(c.isNotNull(), F.least(c, cap))


def floor_lower(c, floor) -> Column:
    """SCL12: clip below; null stays null."""
    c = _c(c)
    floor = floor if isinstance(floor, Column) else F.lit(floor)
    return F.when(c.isNotNull(), F.greatest(c, floor))


def replace_value(c, old, new) -> Column:
    """SCL13."""
    c = _c(c)
    return F.when(c == old, F.lit(new)).otherwise(c)


def fill_text(c, value: str = "") -> Column:
    """SCL14."""
    return F.coalesce(_c(c), F.lit(value))


def is_short_text(c, min_len: int = 5) -> Column:
    """SCL15: fewer than ``min_len`` characters."""
    return F.length(_c(c)) < min_len


def flag_gt(c, threshold) -> Column:
    """SCL16: strict threshold flag; a null compares false."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.coalesce(_c(c) > t, F.lit(False))


def drop_if_present(df, cols):
    """SCL18: drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def existing_columns(df, wanted):
    """SCL32: the requested columns that exist, in request order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]
