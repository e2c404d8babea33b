"""Windows over sorted rows of a chromosome, by tiles of it: rows are sorted within tiles, and only what crosses a border is carried.

A tile of the genome, not a chromosome, is what one task sorts. Tiles that have rows are few: the genome by TILE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bases, or other units of the first column of the order, of a tile.
TILE = 1 << 20


def across(df: DataFrame, keys: list[str], order: list[str], tile: int = TILE, **columns: tuple[str, Column]) -> DataFrame:
    """df with a column for each of ``columns``: (kind, expression) over the rows with the same keys, in ascending order of the columns ``order``.

    Kinds: lag and lead, of the row before and after; max_before, of all rows before; min_after, of all rows after; sum, of all rows up to this one.
    The first column of the order is a number, by which rows fall into tiles; nulls of it are a tile of their own, before all others. lag,
    lead, max_before and min_after are null where there is no such row; of equal rows, any order.
    """
    rows = df.withColumns({"_tile": F.floor(F.col(order[0]) / tile), **{f"_x_{c}": e for c, (_, e) in columns.items()}})
    at = F.struct(*order)
    end = {"lag": lambda x: F.max_by(x, at), "lead": lambda x: F.min_by(x, at), "max_before": F.max, "min_after": F.min, "sum": F.sum}
    own = rows.groupBy(*keys, "_tile").agg(*[end[kind](F.col(f"_x_{c}")).alias(f"_e_{c}") for c, (kind, _) in columns.items()])
    w = Window.partitionBy(*keys).orderBy("_tile")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    carry = {"lag": lambda x: F.lag(x).over(w), "lead": lambda x: F.lead(x).over(w), "max_before": lambda x: F.max(x).over(before), "min_after": lambda x: F.min(x).over(after), "sum": lambda x: F.sum(x).over(before)}
    own = own.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_tile").alias("_t"), *[carry[kind](F.col(f"_e_{c}")).alias(f"_c_{c}") for c, (kind, _) in columns.items()])
    same = F.col("_tile").eqNullSafe(F.col("_t"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = rows.join(own, same)
    w = Window.partitionBy(*keys, "_tile").orderBy(*order)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    first = F.row_number().over(w) == 1
    last = F.lead(F.lit(1)).over(w).isNull()
    found = {}
    for c, (kind, _) in columns.items():
        x, carried = F.col(f"_x_{c}"), F.col(f"_c_{c}")
        found[c] = {
            "lag": F.when(first, carried).otherwise(F.lag(x).over(w)), "lead": F.when(last, carried).otherwise(F.lead(x).over(w)),
            "max_before": F.greatest(F.max(x).over(before), carried), "min_after": F.least(F.min(x).over(after), carried),
            "sum": F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(carried, F.lit(0)),
        }[kind]
    return rows.select(*df.columns, *[v.alias(c) for c, v in found.items()])
