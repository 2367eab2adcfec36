"""SCL-11 and vector helpers as built-in array expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col) -> Column:
    return F.transform(_c(col), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine_plus_one(a, b) -> Column:
    """Cosine similarity shifted to [0, 2]; null when either vector is null or has zero norm."""
    na, nb = norm(a), norm(b)
    ok = _c(a).isNotNull() & _c(b).isNotNull() & (na > 0) & (nb > 0)
    return F.when(ok, dot(a, b) / (na * nb) + F.lit(1.0))


def usable(col) -> Column:
    """A vector that can be scored: not null, not empty, non-zero norm."""
    c = _c(col)
    return c.isNotNull() & (F.size(c) > 0) & F.exists(c, lambda x: x != 0)
