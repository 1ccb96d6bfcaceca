"""Array helpers built from native expressions only.

Lambdas here refer only to their own arguments, never to an outer column:
when Spark inlines a projection into a pushed-down predicate, an outer
reference inside a lambda would be re-evaluated once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, values, output_col: str, keep: list[str] | None = None) -> DataFrame:
    """``map<value, count>`` of an array's non-null values, keys in sorted order.

    Sort the row's array, mark where a run of equal values starts, and turn
    consecutive run starts into lengths. All work stays inside the row
    (``O(n log n)``): no explode, shuffle or aggregation. ``values`` is a
    column name or expression; ``keep`` lists the columns carried along
    (default: all of ``df``).
    """
    keep = list(df.columns) if keep is None else list(keep)
    vals = F.col(values) if isinstance(values, str) else values
    s, flags, starts, keys = (f"_{output_col}_{x}" for x in ("sorted", "flags", "starts", "keys"))
    n = F.size(s)
    prev = F.when(n > 0, F.concat(F.array(F.lit(None).cast("string")), F.slice(s, 1, n - 1)))
    out = df.select(*keep, F.sort_array(F.filter(vals, lambda x: x.isNotNull())).alias(s))
    out = out.select(*keep, s, F.zip_with(s, prev, lambda a, b: b.isNull() | (a != b)).alias(flags))
    out = out.select(
        *keep,
        n.alias(s),
        F.filter(
            F.zip_with(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), flags, lambda i, f: F.when(f, i)),
            lambda x: x.isNotNull(),
        ).alias(starts),
        F.filter(F.zip_with(s, flags, lambda w, f: F.when(f, w)), lambda x: x.isNotNull()).alias(keys),
    )
    # ``s`` now holds the number of values.
    nxt = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.col(s) + 1))
    counts = F.zip_with(starts, nxt, lambda a, b: (b - a).cast("bigint"))
    counted = F.when(F.col(s) > 0, F.map_from_arrays(keys, counts)).otherwise(F.create_map().cast("map<string,bigint>"))
    return out.select(*keep, counted.alias(output_col))


def explode_nonempty(arr, *names: str) -> tuple[Column, Column]:
    """``(generator, non-null condition)`` for exploding a computed array or map.

    ``explode_outer`` plus a filter on its output gives the rows of
    ``explode``, but Spark infers no ``size(arr) > 0`` predicate that it would
    push below (and re-evaluate) the projection computing ``arr``.
    """
    col = F.col(arr) if isinstance(arr, str) else arr
    gen = F.explode_outer(col)
    gen = gen.alias(*names) if names else gen
    return gen, F.col(names[0]).isNotNull()
