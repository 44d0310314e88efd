"""NULL-safe arithmetic, buckets, distances and connector decimals."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnOrName, as_col, as_lit

__all__ = [
    "safe_add",
    "safe_subtract",
    "safe_divide",
    "width_bucket",
    "haversine_distance",
    "log_natural",
    "uniform",
    "decode_decimal",
]

# Fixed values of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _zero_filled(fields) -> list[Column]:
    return [F.coalesce(as_col(f), F.lit(0)) for f in fields]


def safe_add(*fields: ColumnOrName) -> Column:
    return reduce(add, _zero_filled(fields))


def safe_subtract(*fields: ColumnOrName) -> Column:
    """First field minus all the others; NULL counts as 0."""
    return reduce(sub, _zero_filled(fields))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def width_bucket(value: ColumnOrName, low, high, buckets) -> Column:
    """0 below ``low``, ``buckets + 1`` at or above ``high``, else the 1-based bucket."""
    return F.width_bucket(
        as_col(value).cast("double"),
        as_lit(low).cast("double"),
        as_lit(high).cast("double"),
        as_lit(buckets).cast("bigint"),
    )


def haversine_distance(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    phi1, lam1, phi2, lam2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    chord = F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin((lam2 - lam1) / 2), 2
    )
    miles = F.lit(2.0 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord))
    return miles * F.lit(KM_PER_MILE) if unit == "km" else miles


def log_natural(value: ColumnOrName) -> Column:
    """NULL for values that are not positive."""
    return F.ln(as_col(value))


def uniform(seed: int) -> Column:
    """Uniform value in [0, 1); the seed is required so that a lost task recomputes the same rows."""
    return F.rand(seed)


def decode_decimal(value: ColumnOrName, precision: int = 18, scale: int = 2, encoding: str = "either") -> Column:
    """Decimal from a payload field, as the connector writes it.

    ``number`` reads plain numbers and ``bytes`` base64 text of a big-endian two's-complement unscaled integer of up to
    16 bytes; neither looks at the other form. ``either`` is for sources that mix them: a plain number wins, so bytes
    whose text looks like a number are read as one. Values beyond the precision are NULL.
    """
    if encoding not in ("number", "bytes", "either"):
        raise ValueError(f"encoding must be number, bytes or either, got {encoding!r}")
    text = as_col(value)
    target = f"decimal({precision},{scale})"
    plain = text.try_cast(target)
    if encoding == "number":
        return plain
    raw = F.try_to_binary(text, F.lit("base64"))
    digits = F.hex(raw)
    negative = F.substring(digits, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    # extend the sign to 16 bytes, read as a signed and an unsigned half
    extended = F.when(negative, F.lpad(digits, 32, "F")).otherwise(F.lpad(digits, 32, "0"))
    high = F.conv(F.substring(extended, 1, 16), 16, -10).cast("decimal(20,0)")
    low = F.conv(F.substring(extended, 17, 16), 16, 10).cast("decimal(20,0)")
    unscaled = F.try_add(F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)")), low)
    from_bytes = F.when(F.length(raw).between(1, 16), F.concat(unscaled.cast("string"), F.lit(f"E-{scale}")).try_cast(target))
    return from_bytes if encoding == "bytes" else F.coalesce(plain, from_bytes)
