"""The k-th largest of a column, found by counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16


def kth_largest(df: DataFrame, name: str, k: int) -> int | None:
    """The ``k``-th largest value of a 64-bit column, or None if there are fewer.

    Fixes 16 bits at a time, from the top: each pass counts rows by the next 16 bits of those
    that agree so far. Counts are combined before the shuffle; the driver gets at most 65,536.
    """
    if k < 1:
        return None
    value, at = F.col(name), 64
    fixed = 0
    rows = df.where(value.isNotNull()).select(name)
    while at:
        at -= DIGIT_BITS
        # Flipping the sign bit makes the order of the top digit that of unsigned numbers.
        digit = F.shiftrightunsigned(value, at).bitwiseAND((1 << DIGIT_BITS) - 1)
        digit = digit.bitwiseXOR(1 << (DIGIT_BITS - 1)) if at == 64 - DIGIT_BITS else digit
        counts = {r[0]: r[1] for r in rows.groupBy(digit.alias("digit")).count().collect()}
        found = None
        for d in sorted(counts, reverse=True):
            if k <= counts[d]:
                found = d
                break
            k -= counts[d]
        if found is None:
            return None
        rows = rows.where(digit == found)
        fixed = fixed << DIGIT_BITS | found
    fixed ^= 1 << 63
    return fixed - (1 << 64) if fixed >= 1 << 63 else fixed
