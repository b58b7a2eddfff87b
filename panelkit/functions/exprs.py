"""Column expressions (all JVM-side, inside whole-stage codegen).

Spark 4 runs with ANSI on: a bad cast or a division by zero raises.  The
cleaning steps want "bad value -> NULL", so they use ``try_cast`` and
``try_divide`` instead of switching ANSI off.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: str | Column) -> Column:
    """Text or number -> double; unparsable -> NULL (to_numeric(coerce))."""
    return _c(c).try_cast("double")


def safe_int(c: str | Column) -> Column:
    """Text such as '2013.0' or '2013' -> int, through double.

    ``try_cast('2013.0' as int)`` is NULL, so the value goes through double
    first; the double -> int step truncates toward zero.
    """
    return _c(c).try_cast("double").try_cast("int")


def unit_price(numerator: str | Column, denominator: str | Column) -> Column:
    """Ratio with NULL for a NULL side or a zero denominator.

    A column that is entirely NULL gives NULL in every row, which is what the
    all-missing check of the original cleaning step produces.
    """
    return F.try_divide(_c(numerator), _c(denominator))


def normalize_name(c: str | Column) -> Column:
    """Strip surrounding whitespace (spaces, tabs, newlines)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def normalize_key(c: str | Column) -> Column:
    """Strip surrounding whitespace and upper-case."""
    return F.upper(normalize_name(c))


def hash_bucket(*cols: str | Column, buckets: int = 100, sep: str = "#") -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).

    Unlike ``randomSplit`` it does not depend on partition layout or row
    order, and DuckDB can compute the same value.
    """
    key = F.concat_ws(sep, *[_c(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def map_values(c: str | Column, mapping: Sequence[tuple[str, str]]) -> Column:
    """Look a code up in a literal map; unknown codes give NULL."""
    pairs: list[Column] = []
    for k, v in mapping:
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def not_in_codes(c: str | Column, codes: Iterable[int]) -> Column:
    """True when ``c`` is neither NULL nor an adjustment code.

    Compared as numbers, so '99999' and '99999.0' are both excluded; a key
    that is no number is no code and stays.
    """
    code = safe_double(c).isin([float(x) for x in codes])
    return _c(c).isNotNull() & ~F.coalesce(code, F.lit(False))
