"""Reusable column expressions.

Everything here compiles to JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key32(*cols: Column | str) -> Column:
    """Unsigned 32-bit hash of the '|'-joined key: first 8 hex digits of md5.

    md5 is used (not xxhash64) because the same number must come out of an
    external SQL engine for the oracle check; it is also independent of
    partitioning and executor, so recomputation after a lost task yields the
    same value.
    """
    key = F.concat_ws("|", *[_c(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket(*cols: Column | str, buckets: int = 100) -> Column:
    """Deterministic bucket in ``[0, buckets)`` of a row key."""
    return F.pmod(hash_key32(*cols), F.lit(buckets))


def split_buckets(frac: float, least: int = 100, most: int = 10**9) -> tuple[int, int]:
    """(buckets, cut): the power of ten from ``least`` on that holds ``frac`` exactly.

    0.8 is 80 of 100, 0.804 is 804 of 1000; a fraction without a short decimal form is
    cut at ``most`` buckets.
    """
    buckets = least
    while buckets < most and abs(frac * buckets - round(frac * buckets)) > 1e-9 * buckets:
        buckets *= 10
    return buckets, round(frac * buckets)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL for a zero denominator under ANSI mode."""
    return F.try_divide(_c(num), _c(den))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clamp into ``[lo, hi]``; NULL stays NULL."""
    c = _c(c)
    return F.when(c < F.lit(lo), F.lit(lo)).when(c > F.lit(hi), F.lit(hi)).otherwise(c)


def half_star_rating(quantity: Column | str, per_star: float = 5.0) -> Column:
    """Map a 1..50 quantity onto the 0.5..5.0 half-star scale."""
    return (F.ceil(_c(quantity) / F.lit(per_star)) / F.lit(2.0)).cast("double")


def md_cell(c: Column | str, decimals: int | None = None) -> Column:
    """One markdown table cell: numbers with fixed decimals, '|' escaped.

    The value is rounded (HALF_UP) before formatting so the text does not
    depend on how a formatter breaks binary ties.
    """
    c = _c(c)
    if decimals is not None:
        txt = F.format_string(f"%.{decimals}f", F.round(c, decimals))
    else:
        txt = c.cast("string")
    return F.replace(txt, F.lit("|"), F.lit("\\|"))


def md_row(*cells: Column) -> Column:
    """``| a | b | c |`` from already rendered cells."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
