"""Operator 9: approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors get one more coordinate that lifts all of them to the
largest norm, so larger inner products are smaller distances. TABLES hash tables of m
Gaussian (2-stable) projections cut space into buckets floor((a.x + b) / w).

Probing: given a.q, the projection of a neighbour y at inner product s is normal with mean
(s / |q|^2) a.q and variance R^2 - s^2 / |q|^2, so each bucket of a table has an estimated
success probability. A query visits buckets in descending order of it until the tables
together would find its k-th neighbour with probability TARGET. s comes from a first round
over the likeliest buckets (FIRST of all vectors); its k-th best score is a lower bound of
the true one, so the estimate is on the safe side. Candidates that beat that bound are
merged over tables and reranked by exact inner products in double precision.

Scale: equal vectors are one point that keeps its k + 1 smallest ids (no more can matter), so
a vector held by a third of all rows is one candidate. Buckets are dealt to tasks in chunks
of CHUNK points, a chunk's points are the only rows a task holds; queries stream by.

Defined results: vectors that are null, empty, zero, of another length than most, or hold
null or non-finite components take no part, neither as query nor as candidate; null ids take
no part; ties go to the smaller vec_id; repeated rows (same id and vector) are one; fewer
candidates than k: all of them; empty table: no rows.

On vectors without structure (near-uniform directions) k-th neighbours are hardly nearer
than the rest, and reaching TARGET means visiting a large share of all buckets; the README
has figures.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, stored, take

K = 20
TABLES = 2
TARGET = 0.95
FIRST = 0.1                        # share of all points that the first round visits
BOUND_HITS = 4                     # hits of the first round, in multiples of k + 1
LEAST = 1000                       # points that every query visits at least
POINTS = 500                       # points aimed at in a bucket
CELLS = 3.5                        # occupied cells that one more projection gives, about
MAX_M = 8                          # bounds the bucket table (about 3.5^8 rows a table)
CHUNK = 4096
SEED = 9


def _phi(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, to 1.5e-7."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    erf = 1 - t * np.exp(-z * z) * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (
        -1.453152027 + t * 1.061405429))))
    return np.where(x >= 0, (1 + erf) / 2, (1 - erf) / 2)


class Tables:
    def __init__(self, dim: int, radius: float, n: int, tables: int = TABLES, width: float = 1.0):
        self.m = int(min(MAX_M, max(2, round(math.log(max(n / POINTS, 1.0)) / math.log(CELLS)))))
        rng = np.random.default_rng(SEED)
        self.radius, self.w = radius, width * radius
        self.a = rng.standard_normal((tables, self.m, dim + 1))
        self.b = rng.uniform(0, self.w, (tables, self.m))

    def project(self, x: np.ndarray, lifted: bool) -> np.ndarray:
        """(tables, n, m) projections of rows; candidates are lifted to the radius."""
        extra = np.sqrt(np.maximum(self.radius ** 2 - (x * x).sum(axis=1), 0.0)) if lifted else np.zeros(len(x))
        full = np.column_stack([x, extra])
        return np.einsum("nd,tmd->tnm", full, self.a) + self.b[:, None, :]

    def code(self, cells: np.ndarray) -> np.ndarray:
        """One long per row of cell numbers (clipped to -64..63; far cells share the last one)."""
        c = np.clip(cells, -64, 63).astype(np.int64) + 64
        return (c << (7 * np.arange(self.m))).sum(axis=-1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return self.code(np.floor(self.project(x, True) / self.w))

    def probes(self, q: np.ndarray, s: np.ndarray, codes: list[np.ndarray], sizes: list[np.ndarray],
               target: float, least: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(table, query index, bucket index) pairs: buckets in estimated success order until the
        table's share of ``target`` is reached and ``least`` points are visited."""
        f = self.project(q, False) - self.b[:, None, :]
        norm2 = np.maximum((q * q).sum(axis=1), 1e-300)
        rho, sd = s / norm2, np.sqrt(np.maximum(self.radius ** 2 - s * s / norm2, 1e-12 * self.radius ** 2))
        per_table = 1 - (1 - target) ** (1 / len(codes))
        out = []
        for t, (code, size) in enumerate(zip(codes, sizes)):
            cell = ((code[:, None] >> (7 * np.arange(self.m))) & 127) - 64
            logp = np.zeros((len(q), len(code)))
            for j in range(self.m):
                lo = cell[:, j] * self.w - self.b[t, j]
                mean = (rho * f[t, :, j])[:, None]
                left = np.where(cell[:, j] == -64, -np.inf, lo)
                right = np.where(cell[:, j] == 63, np.inf, lo + self.w)
                p = _phi((right - mean) / sd[:, None]) - _phi((left - mean) / sd[:, None])
                logp += np.log(np.maximum(p, 1e-300))
            order = np.argsort(-logp, axis=1, kind="stable")
            p = np.exp(np.take_along_axis(logp, order, axis=1))
            before = np.cumsum(p, axis=1) - p
            seen = np.cumsum(size[order], axis=1) - size[order]
            visit = (before < per_table) | (seen < least)
            qi, rank = np.nonzero(visit)
            out.append((t, qi, order[qi, rank]))
        return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    # 32-bit vectors stay so; any other numbers are kept in double precision
    raw = take(df, vec_id=id_col, v=vec_col)
    kind = "array<float>" if raw.schema["v"].dataType.simpleString() == "array<float>" else "array<double>"
    d = raw.select(F.col("vec_id").cast("long"), F.col("v").cast(kind))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = d.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)) \
         .where(~bad & F.exists("v", lambda x: x != 0))
    dim = d.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return d.where(F.size("v") == (dim["dim"] if dim else 0))


def search(df: DataFrame, k: int = K, id_col: str = "vec_id",
           vec_col: str = "embedding", target: float = TARGET, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible
    by ``every`` among all other rows."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    kind = rows.schema["v"].dataType.simpleString()
    newest = Window.partitionBy("v").orderBy("vec_id")
    # equal vectors: the k + 1 smallest ids. The limit on the rank is applied before the
    # exchange too, so a hot vector sends k + 1 rows a task
    kept = rows.distinct().withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= k + 1)
    points = stored(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                    .select(F.col("ids")[0].alias("pid"), "ids", "v"), "ann-points")
    asked = stored(rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
                   .join(points.select("v", "pid"), "v").select(F.col("vec_id").alias("query_id"), "pid", "v"), "ann-queries")
    n, dim, radius = points.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    tables = Tables(dim, float(radius), n)

    def hash_points():
        def run(b):
            v = _matrix(b["v"], dim)
            for t, code in enumerate(tables.cells(v)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, dtype=np.int32)), pa.array(code, pa.int64()),
                                                  b["pid"], b["v"]], ["t", "code", "id", "v"])
        return run
    hashed = stored(per_batch(points.select("pid", "v"), hash_points, f"t int, code long, id long, v {kind}"),
                    "ann-buckets")
    # at most MAX_M projections bound this table
    found = hashed.groupBy("t", "code").agg(F.count(F.lit(1)).alias("n")).orderBy("t", "code").collect()
    codes, sizes = [], []
    for t in range(TABLES):
        codes.append(np.array([r["code"] for r in found if r["t"] == t], dtype=np.int64))
        sizes.append(np.array([r["n"] for r in found if r["t"] == t], dtype=np.int64))
    chunks = [np.maximum(1, -(-s // CHUNK)) for s in sizes]
    chunk_of = F.create_map(*[x for t in range(TABLES) for c, n_c in zip(codes[t], chunks[t]) if n_c > 1
                              for x in (F.concat_ws(":", F.lit(t), F.lit(int(c))), F.lit(int(n_c)))] or
                            [F.lit(""), F.lit(1)])
    n_chunks = F.coalesce(F.try_element_at(chunk_of, F.concat_ws(":", "t", "code")), F.lit(1))
    placed = hashed.select("t", "code", F.pmod(F.xxhash64("id"), n_chunks).cast("int").alias("chunk"),
                           F.lit(0).alias("tag"), "id", F.lit(float("-inf")).alias("bound"), "v")

    def round_of(asking: DataFrame, share: float, least: float, per_point: float = math.inf) -> DataFrame:
        """(qid, pid, score): hits of the queries (pid, bound, v) in the buckets they visit, at
        most k + 1 of a chunk (no more can matter), and at most ``per_point`` for each of its
        points where only a bound is wanted."""
        def visit():
            def run(b):
                size = 256
                for at in range(0, len(b), size):
                    part = b.slice(at, size)
                    q = _matrix(part["v"], dim)
                    bound = part["bound"].to_numpy(zero_copy_only=False)
                    # without a bound yet: half the largest possible inner product
                    s = np.where(np.isfinite(bound), bound, 0.5 * radius * np.sqrt((q * q).sum(axis=1)))
                    for t, qi, bi in tables.probes(q, s, codes, sizes, share, least):
                        reps = chunks[t][bi]
                        qi, bi2 = np.repeat(qi, reps), np.repeat(bi, reps)
                        chunk = np.arange(len(qi)) - np.repeat(np.cumsum(reps) - reps, reps)
                        take = pa.array(qi)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(qi), t, dtype=np.int32)), pa.array(codes[t][bi2]),
                             pa.array(chunk.astype(np.int32)), pa.array(np.ones(len(qi), dtype=np.int32)),
                             part["pid"].take(take), part["bound"].take(take), part["v"].take(take)],
                            ["t", "code", "chunk", "tag", "id", "bound", "v"])
            return run
        probes = per_batch(asking.select("pid", "bound", "v"), visit,
                           f"t int, code long, chunk int, tag int, id long, bound double, v {kind}")

        def compare(batches):
            key, held = None, []
            names = ["qid", "pid", "score"]
            for b in batches:
                cols = [b[c].to_numpy(zero_copy_only=False) for c in ("t", "code", "chunk", "tag")]
                if not len(b):
                    continue
                new = np.ones(len(b), dtype=bool)
                new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
                edges = [*np.flatnonzero(new).tolist(), len(b)]
                for lo, hi in zip(edges, edges[1:]):
                    here = tuple(int(c[lo]) for c in cols[:3])
                    if here != key:
                        key, held = here, []
                    part = b.slice(lo, hi - lo)
                    ids, v = part["id"].to_numpy(zero_copy_only=False), _matrix(part["v"], dim)
                    if cols[3][lo] == 0:
                        held.append((ids, v))
                        continue
                    if not held:
                        continue
                    if len(held) > 1:
                        held = [tuple(np.concatenate(x) for x in zip(*held))]
                    cid, c = held[0]
                    bound = part["bound"].to_numpy(zero_copy_only=False)
                    score = v @ c.T
                    most = int(min(k + 1, math.ceil(per_point * len(cid)) if per_point < 1 else k + 1))
                    if score.shape[1] > most:
                        bound = np.maximum(bound, np.partition(score, score.shape[1] - most, axis=1)[:, -most])
                    qi, ci = np.nonzero(score >= bound[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[qi]), pa.array(cid[ci]), pa.array(score[qi, ci])], names)

        keys = ["t", "code", "chunk"]
        return (placed.unionByName(probes).repartition(*keys).sortWithinPartitions(*keys, "tag", "id")
                .mapInArrow(compare, "qid long, pid long, score double"))

    def best(hits: DataFrame) -> DataFrame:
        """The k + 1 best points of each query; a hit of several tables counts once."""
        one = hits.groupBy("qid", "pid").agg(F.max("score").alias("score"))
        w = Window.partitionBy("qid").orderBy(F.desc("score"), "pid")
        return one.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k + 1)

    distinct = asked.select("pid", "v").distinct().withColumn("bound", F.lit(float("-inf")))
    # any k + 1 points bound the k-th neighbour from below, so the first round sends only a few
    # times k + 1 hits a query, each chunk its best ones in proportion to its size
    visited = max(FIRST * n, LEAST)
    first = best(round_of(distinct, 0.0, visited, BOUND_HITS * (k + 1) / visited))
    # the last of k + 1 (the query's own point is among them) bounds the k-th neighbour; less a
    # rounding margin, as the scores of the two rounds come from different matrix products
    bounds = first.where(F.col("rn") == k + 1).select(F.col("qid").alias("pid"),
                                                      (F.col("score") - 1e-9 * float(radius) ** 2).alias("bound"))
    second = stored(distinct.drop("bound").join(bounds, "pid", "left")
                    .select("pid", "v", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")), "ann-second")
    top = best(round_of(second, target, LEAST))
    near = (top.join(points.select("pid", "ids"), "pid")
            .select("qid", "score", F.explode("ids").alias("vec_id"))
            .groupBy("qid").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))),
                                        1, k + 1).alias("near")))
    mine = asked.join(near, asked["pid"] == near["qid"]).select("query_id", F.slice(
        F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.s")).alias("score"))
