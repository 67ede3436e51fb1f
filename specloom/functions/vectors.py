"""Column expressions over dense vectors and bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def _same_length(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit("vectors differ in length"))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of one length; NULL when either norm is zero."""
    return _same_length(a, b, F.try_divide(dot(a, b), norm(a) * norm(b)))


def cosine_pair(a: Column, b: Column) -> Column:
    """As ``cosine``, but 0 when either norm is zero."""
    return F.coalesce(cosine(a, b), F.lit(0.0))


def rounded(score: Column, decimals: int = 6) -> Column:
    """Round a score; adding zero turns -0.0 into 0.0."""
    return F.round(score, decimals) + F.lit(0.0)


def tanimoto_pair(a: Column, b: Column) -> Column:
    """Shared bits over bits set in either bitmap; NULL when both are empty."""
    both = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda s, x: s + x,
    )
    either = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y)).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda s, x: s + x,
    )
    return F.try_divide(both.cast("double"), either.cast("double"))


def bits_set(bitmap: Column) -> Column:
    return F.aggregate(
        bitmap, F.lit(0).cast("bigint"), lambda s, x: s + F.bit_count(x).cast("bigint")
    )
