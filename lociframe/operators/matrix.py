"""Matrices as cells (row, col, value): NaN is a missing value; and pairs of rows of vectors (label, v)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lociframe.functions import arrays as ar
from lociframe.sources.scratch import keep


def cells(vectors: DataFrame) -> DataFrame:
    """(row, col, value) of (label, v), columns from 0."""
    return vectors.select(F.col("label").alias("row"), F.posexplode("v").alias("col", "value"))


def vectors(matrix: DataFrame) -> DataFrame:
    """(label, v) of cells, in order of columns."""
    return matrix.groupBy(F.col("row").alias("label")).agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "value"))), lambda p: p.value).alias("v"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def scaled(m: DataFrame, mean: float, deviation: float) -> DataFrame:
    return m.withColumn("value", (F.col("value") - mean) / deviation)


def multiplied(m: DataFrame, c: float) -> DataFrame:
    return m.withColumn("value", F.col("value") * c)


def _normalised(m: DataFrame, key: str, ranged: bool) -> DataFrame:
    """By a small table of each row's or column's statistics, so that a long one is no window of one task."""
    x = F.when(~F.isnan("value"), F.col("value"))
    s = m.groupBy(key).agg(F.avg(x).alias("_m"), F.stddev_pop(x).alias("_s"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    value = (F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) if ranged else (F.col("value") - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0))
    return m.join(s, key).select("row", "col", F.coalesce(value, F.lit(ar.NAN)).alias("value"))


def row_normalised(m: DataFrame, ranged: bool = False) -> DataFrame:
    return _normalised(m, "row", ranged)


def col_normalised(m: DataFrame, ranged: bool = False) -> DataFrame:
    return _normalised(m, "col", ranged)


def _stats(m: DataFrame, key: str) -> DataFrame:
    x = F.when(~F.isnan("value"), F.col("value"))
    return m.groupBy(key).agg(F.sum(x).alias("sum"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("avg"), F.stddev_pop(x).alias("std"), F.count(x).alias("n"))


def col_stats(m: DataFrame) -> DataFrame:
    return _stats(m, "col").drop("n")


def row_stats(m: DataFrame) -> DataFrame:
    return _stats(m, "row").withColumn("cv", F.col("std") / F.nullif(F.col("avg"), F.lit(0.0)))


def col_sums(m: DataFrame) -> DataFrame:
    return m.where(~F.isnan("value")).groupBy("col").agg(F.sum("value").alias("sum"))


def cutoff(m: DataFrame, c: float, by: float = 0.0, above: bool = False) -> DataFrame:
    return m.withColumn("value", F.when(F.col("value") > c if above else F.col("value") < c, by).otherwise(F.col("value")))


def test(m: DataFrame, c: float, greater: bool = False, equal: bool = False) -> DataFrame:
    x = F.col("value")
    ok = (x > c if greater else x < c) | ((x == c) if equal else F.lit(False))
    return m.withColumn("value", F.when(ok, 1.0).otherwise(0.0))


def shrink(m: DataFrame) -> DataFrame:
    """Without columns whose values are all zero or missing."""
    used = m.where((F.col("value") != 0) & ~F.isnan("value")).select("col").distinct()
    return m.join(used, "col", "left_semi").select("row", "col", "value")


def diagonal_band(m: DataFrame, width: int) -> DataFrame:
    """Cells of numbered rows within ``width`` of the diagonal, the others NaN."""
    return m.withColumn("value", F.when(F.abs(F.col("row") - F.col("col")) <= width, F.col("value")).otherwise(ar.NAN))


def encode(m: DataFrame, bins: int) -> DataFrame:
    """bins times the column plus the value's whole part."""
    return m.select("row", "col", (F.col("col") * bins + F.col("value").cast("long")).alias("code"))


def relative(m: DataFrame, to: str = "previous") -> DataFrame:
    """Each cell by the row's previous or first column, which have none themselves."""
    w = Window.partitionBy("row").orderBy("col")
    base = F.lag("value").over(w) if to == "previous" else F.first("value").over(w)
    return m.withColumn("base", base).where("base IS NOT NULL" if to == "previous" else "col > 0").select("row", "col", (F.col("value") / F.nullif(F.col("base"), F.lit(0.0))).alias("value"))


def relative_all(m: DataFrame) -> DataFrame:
    """(row, col1, col2, value): all ratios of two columns of a row, the later by the earlier."""
    return m.alias("a").join(m.alias("b"), "row").where("a.col < b.col").select("row", F.col("a.col").alias("col1"), F.col("b.col").alias("col2"), (F.col("b.value") / F.nullif(F.col("a.value"), F.lit(0.0))).alias("value"))


def shuffled(vectors_: DataFrame, seed: int) -> DataFrame:
    """Elements of each row in an order given by seed and row."""
    pairs = F.transform("v", lambda x, i: F.struct(F.xxhash64(F.lit(seed), F.col("label").cast("string"), i).alias("h"), x.alias("x")))
    return vectors_.withColumn("v", F.transform(F.array_sort(pairs), lambda p: p.x))


#: Rows and cells of a block at most; columns of two blocks that are laid out at once; pairs of rows given at once.
BLOCK_ROWS, BLOCK_CELLS, BLOCK_COLUMNS, PAIRS_AT_ONCE = 1024, 1 << 18, 2048, 1 << 16


def _blocks(m: DataFrame, name: str) -> DataFrame:
    """(name) of cells, one row for each block of rows: an array of (row, cols, values), and w of cells that have it, missing values left out."""
    more = ["w"] if "w" in m.columns else []
    cell = F.collect_list(F.struct("col", "value", *more))
    rows = keep(m.where(~F.isnan("value")).groupBy("row").agg(cell.alias("c")).select("row", F.col("c.col").alias("cols"), F.col("c.value").cast("array<double>").alias("values"), *[F.col("c.w").alias(w) for w in more]), "rows")
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("cols")), F.lit(0))).first()
    parts = max(1, -(-n // BLOCK_ROWS), -(-size // BLOCK_CELLS), min(16, n // 64))
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(parts))).repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("row", "cols", "values", *more)).alias(name)).select(name)


def _pairs(a: DataFrame, b: DataFrame | None, each: Callable, fields: str, distinct: bool | None = None) -> DataFrame:
    """(row1, row2, …fields) of all rows of a with all of b, or of pairs of a's rows, the smaller first, that have a column in common.

    Rows are put into blocks, and every block of a meets every one of b in a task of its own: all pairs of rows are what is asked for, and
    none is moved or kept. each(chunks) gives (i, j, columns) of places of rows from chunks (cols, x, y, w, low), in which missing values are NaN;
    w are the arrays that a's cells carry for their columns, if they have a column w, and low each row's first value in both.
    """
    distinct = b is None if distinct is None else distinct
    b = a if b is None else b
    kind, other = (m.schema["row"].dataType.simpleString() for m in (a, b))

    def side(column, k):
        import pyarrow.compute as pc

        rows = column.slice(k, 1).flatten()
        cols, at = rows.field("cols"), np.repeat(np.arange(len(rows)), pc.list_value_length(rows.field("cols")).to_numpy(zero_copy_only=False))
        w = rows.field("w").flatten() if "w" in [f.name for f in rows.type] else None
        return rows.field("row"), at, rows.field("cols").flatten().to_numpy(zero_copy_only=False), rows.field("values").flatten().to_numpy(zero_copy_only=False), w

    def laid_out(side, cols):
        rows, at, of, values, _ = side
        out = np.full((len(rows), len(cols)), np.nan)
        k = np.minimum(np.searchsorted(cols, of), len(cols) - 1)
        met = cols[k] == of
        out[at[met], k[met]] = values[met]
        return out

    def carried(side, cols):
        of, w = side[2], side[4]
        if w is None:
            return None
        known, at = np.unique(of, return_index=True)
        return np.array(w.take(at[np.searchsorted(known, cols)]).to_pylist(), float)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                one, two = side(batch.column("a"), k), side(batch.column("b"), k)
                cols = np.intersect1d(one[2], two[2])
                chunks = [cols[c : c + BLOCK_COLUMNS] for c in range(0, len(cols), BLOCK_COLUMNS)]
                low = [x[3][np.unique(x[1], return_index=True)[1]] for x in (one, two)]
                for i, j, found in each((c, laid_out(one, c), laid_out(two, c), carried(one, c), low) for c in chunks):
                    if distinct:
                        first, second = (np.array(x[0].to_pylist()) for x in (one, two))
                        lower = first[i] < second[j]
                        i, j, found = i[lower], j[lower], {c: v[lower] for c, v in found.items()}
                    for at in range(0, len(i), PAIRS_AT_ONCE):
                        part = slice(at, at + PAIRS_AT_ONCE)
                        yield pa.RecordBatch.from_pydict({"row1": one[0].take(pa.array(i[part])), "row2": two[0].take(pa.array(j[part])), **{c: v[part] if isinstance(v, pa.Array) else pa.array(v[part], from_pandas=False) for c, v in found.items()}})

    met = _blocks(a, "a").crossJoin(_blocks(b, "b").hint("shuffle_replicate_nl"))
    return met.mapInArrow(run, f"row1 {kind}, row2 {other}, {fields}")


def _added(chunks, of: Callable, lowered: bool = False) -> dict:
    """The arrays (a row of x, a row of y) that ``of`` makes of each chunk, added up.

    ``lowered``: of values less their row's first, which ``low`` then has for x and y, so that sums of squares lose few places, and rows
    of one value have none.
    """
    total: dict = {}
    for _, x, y, w, low in chunks:
        if lowered:
            x, y, total["low"] = x - low[0][:, None], y - low[1][:, None], low
        for c, v in (of(x, y) if w is None else of(x, y, w)).items():
            total[c] = total[c] + v if c in total else v
    return total


def _sums(x, y) -> dict:
    """n, and the sums of x, y and their products over the columns that both rows have."""
    has_x, has_y = (~np.isnan(v) * 1.0 for v in (x, y))
    x, y = np.nan_to_num(x), np.nan_to_num(y)
    return {"n": has_x @ has_y.T, "x": x @ has_y.T, "y": has_x @ y.T, "xy": x @ y.T, "xx": (x * x) @ has_y.T, "yy": has_x @ (y * y).T}


def _chosen(n, columns: dict) -> tuple:
    """(i, j, columns) of the pairs that share a column."""
    i, j = np.nonzero(n > 0)
    return i, j, {c: v[i, j] for c, v in columns.items()}


def row_pairs(a: DataFrame, b: DataFrame | None = None) -> DataFrame:
    """(row1, row2, n, sum_x, sum_y, sum_xy, sum_xx, sum_yy) of all rows of a with all of b, or of pairs of a's rows, the smaller first."""

    def each(chunks):
        if s := _added(chunks, _sums):
            yield _chosen(s["n"], {"n": s["n"].astype(np.int64), **{f"sum_{c}": s[c] for c in ("x", "y", "xy", "xx", "yy")}})

    return _pairs(a, b, each, "n bigint, sum_x double, sum_y double, sum_xy double, sum_xx double, sum_yy double")


def _moments(s: dict) -> tuple:
    """Sums of squares and products about the means; squares that are no more than rounding are 0."""
    xx, yy = (s[c + c] - s[c] * s[c] / s["n"] for c in "xy")
    return np.where(xx <= 1e-13 * s["xx"], 0, xx), np.where(yy <= 1e-13 * s["yy"], 0, yy), s["xy"] - s["x"] * s["y"] / s["n"]


def correlations(a: DataFrame, b: DataFrame | None = None) -> DataFrame:
    """(row1, row2, r) of all rows of a with all of b, or all pairs of a; null where either does not vary."""

    def each(chunks):
        if s := _added(chunks, _sums, True):
            with np.errstate(all="ignore"):
                sxx, syy, sxy = _moments(s)
                yield _chosen(s["n"], {"r": sxy / np.sqrt(sxx * syy)})

    out = _pairs(a, b, each, "r double")
    return out.withColumn("r", F.nanvl("r", F.lit(None).cast("double")))


def differences(a: DataFrame, b: DataFrame, fold: float, pseudo: float = 0.0) -> DataFrame:
    """(row1, row2, n): columns in which one of the two is over ``fold`` times the other."""

    def over(x, y):
        n, shared = np.zeros((len(x), len(y)), np.int64), ~np.isnan(x) * 1.0 @ ~np.isnan(y).T
        for i, row in enumerate(x + pseudo):
            n[i] = ((row > fold * (y + pseudo)) | (y + pseudo > fold * row)).sum(axis=1)
        return {"n": n, "shared": shared}

    def each(chunks):
        if s := _added(chunks, over):
            yield _chosen(s["shared"], {"n": s["n"]})

    return _pairs(a, b, each, "n bigint")


def divided(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells of a by the first column of the same row of b."""
    first = b.where("col = 0").select("row", F.col("value").alias("_f"))
    return a.join(first, "row").select("row", "col", (F.col("value") / F.nullif(F.col("_f"), F.lit(0.0))).alias("value"))


def ratios(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row1, row2, col, value): each row of a by each of b, element by element; null by zero."""

    def each(chunks):
        import pyarrow as pa

        for cols, x, y, _, _ in chunks:
            for i, row in enumerate(x):
                j, k = np.nonzero(~np.isnan(y) & ~np.isnan(row))
                with np.errstate(all="ignore"):
                    value = pa.array(row[k] / y[j, k], mask=y[j, k] == 0)
                yield np.full(len(j), i), j, {"col": cols[k], "value": value}

    return _pairs(a, b, each, f"col {a.schema['col'].dataType.simpleString()}, value double")


def regressions(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row1, row2, c0, c1, chi2): least squares of b's rows on a's, chi2 by the number of columns; null where a's row does not vary."""

    def each(chunks):
        if s := _added(chunks, _sums, True):
            with np.errstate(all="ignore"):
                sxx, syy, sxy = _moments(s)
                c1 = sxy / sxx
                yield _chosen(s["n"], {"c0": s["y"] / s["n"] + s["low"][1] - c1 * (s["x"] / s["n"] + s["low"][0][:, None]), "c1": c1, "chi2": (syy - c1 * sxy) / s["n"]})

    out = _pairs(a, b, each, "c0 double, c1 double, chi2 double")
    return out.select("row1", "row2", *[F.when(F.abs("c1") < float("inf"), F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in ("c0", "c1", "chi2")])


def _poisson(seed: int, t: Column) -> Column:
    """How often the column ``col`` is drawn the t-th time."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), t, "col"), 11) / float(1 << 53)
    weight = F.lit(0)
    mass, below = 0.36787944117144233, 0.0
    for k in range(8):
        below += mass
        weight = F.when(u >= below, k + 1).otherwise(weight)
        mass /= k + 1
    return weight


def bootstrap_correlations(a: DataFrame, times: int, seed: int, b: DataFrame | None = None) -> DataFrame:
    """(row1, row2, mean, sd) of correlations over columns drawn with replacement ``times`` times; the draws follow from seed.

    All rows of a with all of b, or all pairs of a. How often a column is drawn is a Poisson number of mean 1, which a hash of seed, draw and
    column gives: all of its bits that a double can hold.
    """
    drawn = F.array(*[F.lit(k + 1) for k in range(times)])
    drawn = F.transform(drawn, lambda t: _poisson(seed, t))

    def sums(x, y, w):
        has_y, y0 = ~np.isnan(y) * 1.0, np.nan_to_num(y)
        out = {"shared": (~np.isnan(x) * 1.0) @ has_y.T}
        for t in range(times):
            wx, has = np.nan_to_num(x) * w[:, t], ~np.isnan(x) * w[:, t]
            out |= {(t, "n"): has @ has_y.T, (t, "x"): wx @ has_y.T, (t, "y"): has @ y0.T, (t, "xy"): wx @ y0.T, (t, "xx"): (wx * np.nan_to_num(x)) @ has_y.T, (t, "yy"): has @ (y0 * y0).T}
        return out

    def each(chunks):
        if s := _added(chunks, sums, True):
            rs, known = [], []
            with np.errstate(all="ignore"):
                for t in range(times):
                    xx, yy, xy = _moments({c: s[t, c] for c in ("n", "x", "y", "xy", "xx", "yy")})
                    r = xy / np.sqrt(xx * yy)
                    known.append(np.isfinite(r))
                    rs.append(np.where(known[-1], r, 0))
                n = np.sum(known, axis=0)
                mean = np.sum(rs, axis=0) / n
                sd = np.sqrt(np.sum([k * (r - mean) ** 2 for r, k in zip(rs, known)], axis=0) / n)
            yield _chosen(s["shared"], {"mean": mean, "sd": sd})

    out = _pairs(a.withColumn("w", drawn), a if b is None else b, each, "mean double, sd double", b is None)
    return out.select("row1", "row2", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("mean", "sd")])


def uncorrelated(vectors_: DataFrame, c: float) -> DataFrame:
    """Rows in order of label of which none correlates over c with one kept before.

    The correlated pairs come from a distributed join; a row goes if one kept before it is its partner, which
    is settled in rounds: rows without an earlier undecided partner are decided in each. Every round's table is kept
    in the shared folder.
    """
    m = cells(vectors_)
    edges = correlations(m).where(F.col("r") > c).select("row1", "row2")
    state = vectors_.select("label").withColumn("kept", F.lit(None).cast("boolean"))
    edges = keep(edges, "edges")
    while True:
        left = edges.join(state.select(F.col("label").alias("row1"), F.col("kept").alias("k1")), "row1")
        verdict = left.groupBy(F.col("row2").alias("label")).agg(F.max(F.coalesce(F.col("k1"), F.lit(False))).alias("beaten"), F.max(F.col("k1").isNull()).alias("open"))
        state = keep(state.join(verdict, "label", "left").select("label", F.coalesce("kept", F.when(F.col("beaten"), F.lit(False)).when(~F.coalesce("open", F.lit(False)), F.lit(True))).alias("kept")), "kept")
        if not state.where("kept IS NULL").take(1):
            break
    return vectors_.join(state.where("kept"), "label", "left_semi")


def pivoted(m: DataFrame, columns: list, fill: float = 0.0) -> DataFrame:
    """One row for each row, a column for each of ``columns``; absent cells as ``fill``."""
    return m.groupBy("row").pivot("col", columns).agg(F.sum("value")).na.fill(fill)


def locus(name: Column, kind: str) -> Column:
    """chrom, start or stop of chrom:start-stop."""
    part = {"chrom": r"^([^:]+):", "start": r":(\d+)-", "stop": r"-(\d+)$"}[kind]
    got = F.regexp_extract(name, part, 1)
    return got if kind == "chrom" else got.cast("long")
