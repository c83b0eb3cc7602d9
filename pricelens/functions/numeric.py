"""Engine-independent money arithmetic.

ROUND and AVG on doubles differ between engines in the last bit, which
then changes report membership.  Both are therefore written as explicit
formulas that evaluate identically in any IEEE-754 engine:

* ``round2(x)``    = floor(x * 100 + 0.5) / 100   (half-up for x >= 0)
* ``exact_avg(x)`` = (sum of whole ten-thousandths) / 10000 / count(x)
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prices are summed exactly in units of 1/10000.
PRICE_UNITS = 10000


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def round2(x) -> Column:
    """Half-up rounding to cents, the same bits in Spark and DuckDB."""
    return F.floor(_col(x) * 100 + 0.5) / 100


def exact_avg(x) -> Column:
    """Average of a price column, exact for prices with up to 4 decimals; NULLs ignored.

    Each price becomes a whole number of ten-thousandths (a long), so the
    sum is exact and independent of row order, and the aggregate buffer
    is a fixed-width long: a (partial + final) HashAggregate without
    BigDecimal arithmetic.
    """
    c = _col(x)
    units = F.floor(c * PRICE_UNITS + 0.5)
    return F.sum(units) / PRICE_UNITS / F.count(c)


def pct_change(cur, prev) -> Column:
    """(cur - prev) / prev * 100; NULL when prev is 0 or NULL (no ANSI error)."""
    return F.try_divide(_col(cur) - _col(prev), _col(prev)) * 100


#: Splits a double into two halves of 26 bits each (2**27 + 1).
_SPLIT = 134217729.0


def fixed(x, digits: int) -> Column:
    """Text with ``digits`` decimals, rounded from the exact value of the double, ties to even.

    ``format_string`` rounds the shortest decimal form half up instead, so
    it shows 0.15 (which is a little less) as 0.2.  Here ``x * 10**digits``
    is taken as a double and its exact rounding error, so the comparison
    with one half is exact.  For magnitudes below 2**53 / 10**digits.
    """
    scale = float(10 ** digits)
    size = F.abs(_col(x))
    product = size * scale
    high = size * _SPLIT - (size * _SPLIT - size)
    error = (high * scale - product) + (size - high) * scale
    whole = F.floor(product)
    part = product - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    # a product rounded up to the next whole number comes down again only below one half
    units = whole + F.when(up, 1).otherwise(0)
    sign = F.when((_col(x) < 0), "-").otherwise("")
    base = 10 ** digits
    text = F.concat(sign, F.floor(units / base).cast("string"))
    if not digits:
        return text
    return F.concat(text, F.lit("."), F.lpad((units % base).cast("string"), digits, "0"))
