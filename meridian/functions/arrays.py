"""Lines of values as arrays, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dense(points: Column, size: Column, fill: Column | None = None) -> Column:
    """An array of ``size`` values from points (at, counted from 0, and value) in ascending order; ``fill``, or null, where there is none.

    ``points`` is a plain column; the work is linear in ``size``. A place twice or outside raises.
    """
    none = F.lit(None).cast("double") if fill is None else fill
    before = lambda k: F.when(k > 0, F.get(points, k - 1)["at"]).otherwise(F.lit(-1))
    parts = F.transform(points, lambda p, k: F.concat(F.array_repeat(none, p["at"] - before(k) - 1), F.array(p["value"])))
    last = F.when(F.size(points) > 0, F.get(points, F.size(points) - 1)["at"]).otherwise(F.lit(-1))
    ordered = F.forall(F.sequence(F.lit(0), F.greatest(F.size(points) - 1, F.lit(0))), lambda k: F.coalesce(F.get(points, k)["at"] > before(k), F.lit(True)))
    line = F.concat(F.flatten(parts), F.array_repeat(none, size - 1 - last))
    return F.when(points.isNull(), F.lit(None)).when(ordered & (last < size), line).otherwise(F.raise_error(F.lit("a place is twice in a line, or outside it")))
