"""Column-name handling: normalising, tokens, affixes, type families."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def normal_name(name: Column) -> Column:
    """Lower case, runs of anything but letters and digits become one underscore."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "_"), "^_+|_+$", ""
    )


def tokens(name: Column) -> Column:
    """Distinct nonempty words of a normalised name."""
    return F.array_distinct(F.filter(F.split(name, "_"), lambda t: t != ""))


def any_of(tests) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | test
    return result


def ends_with_any(name: Column, endings) -> Column:
    return any_of(F.endswith(name, F.lit(e)) for e in endings)


def starts_with_any(name: Column, starts) -> Column:
    return any_of(F.startswith(name, F.lit(s)) for s in starts)


def contains_any(name: Column, words) -> Column:
    return any_of(F.contains(name, F.lit(w)) for w in words)


def strip_one_suffix(name: Column, suffixes) -> Column:
    """Drop the one known ending a key name carries."""
    return F.regexp_replace(name, "(" + "|".join(suffixes) + ")$", "")


def type_family(dtype: T.DataType) -> str:
    """date, numeric, string or other, from the Spark type itself."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    return "other"


def rolled_by_mean(name: str, rate_words) -> bool:
    """Ratios are averaged when rolled up, volumes are summed."""
    return any(word in name.lower() for word in rate_words)
