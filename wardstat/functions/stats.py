"""Distributed statistics: one aggregation pass per statistics layer.

* ``long_values``: wide columns -> (column, value) rows with ``stack`` (a generator,
  no shuffle), so one groupBy serves all columns.
* ``exact_quantiles``: exact linear-interpolated quantiles (pandas / ``percentile_cont``
  definition) by counting, the same plan at every size: each round counts the rows, the
  smallest and the largest value of BINS equal bins of every interval that holds a wanted
  rank, and goes on in that rank's bin between its own extremes, until the bin is a single
  value. A task counts the batches of all columns into arrays (at most columns x ranks x
  BINS counts) that are summed by aggregation, so rows are never unpivoted, no task sees a
  column, and the driver gets at most columns x ranks x BINS rows a round.
* ``modes``: most frequent value, ties -> smallest, as two partial aggregations
  (per-value counts, then max count per column) and a broadcast of the
  one-row-per-column maximum.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BINS = 4096
MAX_ROUNDS = 200            # a round divides an interval by BINS; doubles need far fewer


def long_values(df: DataFrame, cols: list[str], cast: str | None = "double",
                keep_nulls: bool = False, key: str | None = None) -> DataFrame:
    """Unpivot ``cols`` into (column, value) (plus ``key`` if given)."""
    pairs = ", ".join(f"'{c}', {('CAST(`' + c + '` AS ' + cast + ')') if cast else '`' + c + '`'}" for c in cols)
    keep = [F.col(key)] if key else []
    out = df.select(*keep, F.expr(f"stack({len(cols)}, {pairs}) AS (column, value)"))
    return out if keep_nulls else out.where(F.col("value").isNotNull())


def _per_task(df: DataFrame, cols: list[str], make, schema: str) -> DataFrame:
    """Rows of a task's running sums: ``make()`` gives (add, result); ``add(column, values)`` gets the
    non-missing doubles of a batch and ``result()`` the arrays of ``schema`` at the end of the task."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        add, result = make()
        for b in batches:
            for c, x in zip(cols, b.columns):
                v = x.to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]                              # NULL arrives as NaN
                if len(v):
                    add(c, v)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in result()], names)
    return df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(run, schema)


def _extremes(df: DataFrame, cols: list[str]) -> dict:
    """{column: (n, -inf's, finite values, smallest and largest finite value)} of the columns with values."""
    def make():
        kept: dict = {}

        def add(c, v):
            n, neg, fin, low, high = kept.get(c, (0, 0, 0, np.inf, -np.inf))
            f = v[np.isfinite(v)]
            if len(f):
                low, high = min(low, f.min()), max(high, f.max())
            kept[c] = (n + len(v), neg + int((v == -np.inf).sum()), fin + len(f), low, high)

        def result():
            rows = [np.array([kept[c][k] for c in kept], dtype="i8" if k < 3 else "f8") for k in range(5)]
            return [np.array(list(kept), dtype=object).astype(str) if kept else np.array([], dtype=str), *rows]
        return add, result
    parts = _per_task(df, cols, make, "column string, n long, neg long, fin long, low double, high double")
    return {r["column"]: r for r in parts.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("neg").alias("neg"), F.sum("fin").alias("fin"), F.min("low").alias("low"),
        F.max("high").alias("high")).collect()}


def _bin_counts(df: DataFrame, intervals: list[tuple[str, float, float]]):
    """(interval, bin, n, low, high) rows: values of each (column, low, high) in BINS bins, monotone in
    the value, with the extremes of each bin. One batch of a column is one array operation."""
    bins, cols = BINS, list(dict.fromkeys(c for c, _, _ in intervals))
    # an interval that spans magnitudes is cut by the logarithm, others evenly
    wide = [not 0 < lo * hi or max(abs(lo), abs(hi)) > 2 * min(abs(lo), abs(hi)) for _, lo, hi in intervals]

    def make():
        k = len(intervals)
        n, low, high = np.zeros((k, bins), dtype="i8"), np.full((k, bins), np.inf), np.full((k, bins), -np.inf)

        def magnitude(x):                                        # monotone over all finite doubles, even in the exponent
            return np.sign(x) * (np.log(np.maximum(np.abs(x), 5e-324)) + 746.0)

        def add(c, v):
            for i, (column, lo, hi) in enumerate(intervals):
                if column != c:
                    continue
                x = v[(v >= lo) & (v <= hi)]
                if wide[i]:
                    share = (magnitude(x) - magnitude(lo)) / (magnitude(hi) - magnitude(lo))
                else:                                            # halves first, as hi - lo may overflow
                    share = (x / 2 - lo / 2) / (hi / 2 - lo / 2)
                at = np.clip((share * bins).astype("i8"), 0, bins - 1)
                n[i] += np.bincount(at, minlength=bins)
                np.minimum.at(low[i], at, x)
                np.maximum.at(high[i], at, x)

        def result():
            i, b = np.nonzero(n)
            return [i.astype("i4"), b.astype("i4"), n[i, b], low[i, b], high[i, b]]
        return add, result
    parts = _per_task(df, cols, make, "interval int, bin int, n long, low double, high double")
    return parts.groupBy("interval", "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()


def _select_ranks(df: DataFrame, wanted: dict[str, set[int]], ranges: dict[str, tuple[float, float]]) -> dict:
    """{(column, rank): value} of 0-based ranks among the finite values of a column."""
    found: dict[tuple[str, int], float] = {}
    # (column, low, high) -> {rank: rows of the column below low}
    open_ = {(c, *ranges[c]): dict.fromkeys(r, 0) for c, r in wanted.items() if r}
    for _ in range(MAX_ROUNDS):
        for key in [k for k in open_ if k[1] == k[2]]:
            found.update({(key[0], r): key[1] for r in open_.pop(key)})
        if not open_:
            return found
        keys = list(open_)
        rows = _bin_counts(df, keys)             # at most columns x ranks intervals
        bins: dict[int, list] = {}
        for r in rows:
            bins.setdefault(r["interval"], []).append((r["bin"], r["n"], r["low"], r["high"]))
        after: dict = {}
        for i, key in enumerate(keys):
            for rank, below in open_[key].items():
                for _, n, low, high in sorted(bins.get(i, [])):
                    if rank < below + n:
                        after.setdefault((key[0], low, high), {})[rank] = below
                        break
                    below += n
                else:
                    raise RuntimeError(f"rank {rank} of {key[0]} not found")
        open_ = after
    raise RuntimeError("quantile selection did not end")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles -> DataFrame(column, p, value); value NULL when a column has no values.
    NULL and NaN are missing; infinities take their place at the ends."""
    inf = float("inf")
    stat = _extremes(df, cols)
    targets, wanted = [], {}
    for c in cols:
        r = stat.get(c)
        for p in probs:
            if r is None:
                targets.append((c, p, None, None, 0.0))
                continue
            h = (r["n"] - 1) * p
            lo = int(math.floor(h))
            targets.append((c, p, lo, min(lo + 1, r["n"] - 1), h - lo))
            wanted.setdefault(c, set()).update(k - r["neg"] for k in targets[-1][2:4] if 0 <= k - r["neg"] < r["fin"])
    got = _select_ranks(df, wanted, {c: (r["low"], r["high"]) for c, r in stat.items()})

    def value(c: str, rank: int) -> float:
        k = rank - stat[c]["neg"]
        return -inf if k < 0 else inf if k >= stat[c]["fin"] else got[c, k]

    def between(c, lo, hi, frac):
        x = value(c, lo)
        return x if frac == 0.0 or value(c, hi) == x else x + frac * (value(c, hi) - x)
    rows = [(c, float(p), None if lo is None else float(between(c, lo, hi, f))) for c, p, lo, hi, f in targets]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def quantile_row(df: DataFrame, cols: list[str], probs: list[float], names=None) -> DataFrame:
    """One-row stats frame: column ``{name}`` per (column, p) pair, for broadcast joins."""
    q = exact_quantiles(df, cols, probs)
    names = names or {}
    aggs = []
    for c in cols:
        for p in probs:
            nm = names.get((c, p), f"{c}__q{int(round(p * 100))}")
            aggs.append(F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("value"))).alias(nm))
    # A statistics layer is materialized when computed (one tiny file): later layers and
    # every apply() read it instead of re-deriving it from its lineage.
    return cut_lineage(q.agg(*aggs))


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """DataFrame(column, mode): most frequent non-null value, ties -> smallest; NULL if none."""
    lv = long_values(df, cols, cast="string")
    counts = lv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    top = counts.groupBy("column").agg(F.max("cnt").alias("cnt"))
    picked = (counts.join(F.broadcast(top), ["column", "cnt"])
              .groupBy("column").agg(F.min("value").alias("mode")))
    spark = df.sparkSession
    all_cols = spark.createDataFrame([(c,) for c in cols], "column string")
    return all_cols.join(F.broadcast(picked), "column", "left")   # one row per column on both sides


def mode_row(df: DataFrame, cols: list[str], suffix: str = "__mode") -> DataFrame:
    m = modes(df, cols)
    return cut_lineage(m.agg(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c + suffix) for c in cols]))
