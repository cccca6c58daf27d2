"""Number → text formats used in reports.

``fixed`` rounds like DuckDB's ``printf`` (and like Python except at exact
decimal ties such as 0.0125, where Python looks at the binary value); this is
a documented divergence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, decimals: int) -> Column:
    """``f'{x:.{decimals}f}'`` without grouping commas."""
    return F.regexp_replace(F.format_number(x.cast("double"), decimals), ",", "")


def percent(x: Column, decimals: int = 2) -> Column:
    """``f'{x * 100:.2f}%'``."""
    return F.concat(fixed(x.cast("double") * 100, decimals), F.lit("%"))


def thousands(n: Column) -> Column:
    """``f'{n:,}'`` for integers."""
    return F.format_string("%,d", n.cast("bigint"))


def py_bool(b: Column) -> Column:
    """``str(bool)``: 'True' / 'False'."""
    return F.when(b, "True").when(~b, "False").otherwise("None")


def py_str_list(arr: Column) -> Column:
    """``str(sorted(list_of_str))`` → "['a', 'b']"."""
    quoted = F.transform(F.array_sort(arr), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def py_float_repr(x: Column) -> Column:
    """``repr(float)``: shortest round-trip digits with Python's switch to exponent form
    (exponent < -4 or >= 16), e.g. ``1e-05``, ``0.0001``, ``12345678.0``, ``1.5e+16``."""
    s = x.cast("double").cast("string")
    has_exp = s.contains("E")
    mant = F.substring_index(s, "E", 1)
    exp = F.when(has_exp, F.substring_index(s, "E", -1).cast("int")).otherwise(F.lit(0))
    sign = F.when(mant.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mabs = F.regexp_replace(mant, "^-", "")
    int_digit = F.substring_index(mabs, ".", 1)
    frac = F.substring_index(mabs, ".", -1)
    frac = F.when(frac == "0", F.lit("")).otherwise(frac)
    digits = F.concat(int_digit, frac)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    padded = F.rpad(digits, F.greatest(F.length(digits), exp + 1), F.lit("0"))
    int_part = F.substring(padded, F.lit(1), exp + 1)
    frac_part = F.substring(padded, exp + 2, F.lit(1000))
    big = F.concat(int_part, F.lit("."), F.when(frac_part == "", F.lit("0")).otherwise(frac_part))
    sci = F.concat(
        int_digit,
        F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"),
    )
    body = F.when(~has_exp, mabs).when(exp < -4, sci).when(exp >= 16, sci).when(exp < 0, small).otherwise(big)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s == "NaN", F.lit("nan"))
        .when(s == "Infinity", F.lit("inf"))
        .when(s == "-Infinity", F.lit("-inf"))
        .otherwise(F.concat(sign, body))
    )
