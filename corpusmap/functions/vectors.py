"""Vector expressions on array columns, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: magnitudes from here on round to infinity in half precision.
HALF_OVERFLOW = 65520.0


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(doubles(v), lambda x: x * x)))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b) / (norm(a) * norm(b))


def normalize(v: Column) -> Column:
    """Unit-length vector; a zero vector stays zero. The length is worked out once per vector."""
    d = doubles(v)
    return F.aggregate(
        d,
        F.lit(0.0),
        lambda s, x: s + x * x,
        lambda s: F.when(s > 0, F.transform(d, lambda x: x / F.sqrt(s))).otherwise(d),
    )


def truncate_dims(v: Column, dims: int) -> Column:
    """First ``dims`` components, rescaled to unit length."""
    return normalize(F.slice(v, 1, dims))


def binarize(v: Column) -> Column:
    return F.transform(v, lambda x: x > 0)


def hamming_distance(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))


def has_invalid(v: Column) -> Column:
    """True if any component is null, NaN or infinite."""
    inf = F.lit(float("inf"))
    return F.exists(
        doubles(v), lambda x: x.isNull() | F.isnan(x) | (x == inf) | (x == -inf)
    )


def overflows_half(v: Column) -> Column:
    """True if a component would become infinite when stored in half precision."""
    return F.exists(doubles(v), lambda x: ~F.isnan(x) & (F.abs(x) >= HALF_OVERFLOW))


def round_half(x: Column) -> Column:
    """A number at half precision: 11 significant bits, steps of 2^-24 near zero, ties to even."""
    d = x.cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(d))), F.lit(-14))
    step = F.pow(F.lit(2.0), exponent - 10)
    rounded = F.rint(d / step) * step
    infinite = F.when(d > 0, float("inf")).otherwise(float("-inf"))
    return (
        F.when((d == 0) | F.isnan(d), d)
        .when(F.abs(d) >= HALF_OVERFLOW, infinite)
        .otherwise(rounded)
        .cast("float")
    )


def quantize_half(v: Column) -> Column:
    """Every component at half precision, kept as float."""
    return F.transform(v, round_half)


def vector_key(v: Column, digits: int = 4) -> Column:
    """Comma-joined integers, ``round(x * 10^digits)``: a printable form to compare vectors by."""
    scale = float(10**digits)
    return F.array_join(
        F.transform(doubles(v), lambda x: F.round(x * scale).cast("bigint").cast("string")), ","
    )
