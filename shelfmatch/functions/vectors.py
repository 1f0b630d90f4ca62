"""Vector expressions on ARRAY<FLOAT|DOUBLE> columns (V1, V2), arithmetic in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column | str) -> Column:
    """V1: unit vector; the zero vector is returned unchanged.

    The norm is bound once per row (a lambda variable over a one-element
    array); written inline inside ``transform`` it would be recomputed for
    every element.
    """
    bound = F.array(F.struct(_c(v).alias("v"), l2_norm(v).alias("n")))

    def scale(p: Column) -> Column:
        return F.when(p["n"] == 0, F.transform(p["v"], lambda x: x.cast("double"))).otherwise(
            F.transform(p["v"], lambda x: x.cast("double") / p["n"]))

    return F.get(F.transform(bound, scale), 0)


def cosine(a: Column | str, b: Column | str) -> Column:
    """V2: cosine similarity (inner product of the normalised vectors); 0.0 if either is zero."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))
