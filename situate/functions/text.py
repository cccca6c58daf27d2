"""String helpers with Python-like semantics (strip, blank tests, numeric coercion)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# the characters ``str.strip()`` removes: every code point Python calls whitespace (derived, not listed)
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading/trailing (unicode) whitespace; plain ``btrim``, no regex."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def blank_to_null(c: Column) -> Column:
    s = py_strip(c)
    return F.when(s != "", s)


def has_text(c: Column) -> Column:
    """Non-null and not blank after strip; null → False."""
    return F.coalesce(F.length(py_strip(c.cast("string"))) > 0, F.lit(False))


NUMBER_PATTERN = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))$"


def coerce_double(c: Column) -> Column:
    """X11: ``pd.to_numeric(errors='coerce')``: bad text → null.

    The text is checked by a pattern first and only then cast: under ANSI mode a failing
    ``try_cast`` costs an exception per row, the pattern test does not.
    """
    s = py_strip(c.cast("string"))
    return F.when(s.rlike(NUMBER_PATTERN), s.cast("double"))


def coerce_int(c: Column, bits: int = 31) -> Column:
    """``int(float(text))``: truncation toward zero, bad or out-of-range text → null."""
    d = coerce_double(c)
    return F.when(F.abs(d) < float(1 << bits), d.cast("bigint" if bits > 31 else "int"))


def join_address(a: Column, b: Column) -> Column:
    """Both parts stripped, blanks skipped, joined by one space ('' when none)."""
    return F.concat_ws(" ", blank_to_null(a), blank_to_null(b))


def truncate_text(c: Column, max_len: int = 180, keep: int = 177, suffix: str = "...") -> Column:
    """Cut to ``keep`` chars plus suffix when longer than ``max_len``."""
    return F.when(F.length(c) > max_len, F.concat(F.substring(c, 1, keep), F.lit(suffix))).otherwise(c)


def infer_is_free(use_fee: Column) -> Column:
    """Tri-state free flag. 'free' words win over paid words; '원' anywhere means paid."""
    t = F.lower(py_strip(use_fee))
    return (
        F.when(t.isNull() | (t == ""), F.lit(None).cast("boolean"))
        .when(t.contains("무료") | t.contains("free"), F.lit(True))
        .when(t.contains("유료") | t.contains("원"), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )
