"""Operator 2: byte-balanced shards by histogram sort (DataFrame functions only).

Rows are ordered by the key (xxhash64 of the text, doc_id). The ``n_shards - 1`` splitters
of that order are found by counting: each round counts the exact bytes of every probe
interval (4,096 intervals of the key prefix, then 4,096 of each interval that still holds
an unresolved splitter), until the bytes below each splitter are within ``tolerance`` of a
shard of their target, or the key has no finer boundary. Then the rows move once, to
(shard, key interval), and get their slot there.

Equal texts are neighbours in the key order, so a group of copies stays in one shard unless
it is larger than the tolerance; then the second half of the key (doc_id) divides it.

Defined results: a null text has no bytes and sorts as the empty hash; a null doc_id sorts
first; rows equal in text and doc_id are one key and are never separated; empty table: no
rows, no splitters; fewer rows than shards: some shards stay empty.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, stored

TOLERANCE = 0.002                  # of a shard's bytes
UNIT_BYTES = 64 << 20              # a unit of the exchange is split beyond this
LEVELS = [("h", s) for s in (52, 40, 28, 16, 4, 0)] + [("d", s) for s in (52, 40, 28, 16, 4, 0)]
_MIN, _MAX = -(1 << 63), (1 << 63) - 1


def find_splitters(keyed: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Ascending (h, d) bounds; a row belongs right of a bound when (h, d) >= bound.
    The driver sees at most ``n_shards`` x 4,096 interval sums a round."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if total == 0:
        return []
    slack = tolerance * total / n_shards
    # target bytes -> (bytes below the open interval, its prefix at the level before)
    open_ = {total * k / n_shards: (0, ()) for k in range(1, n_shards)}
    found: dict[float, tuple[int, int]] = {}
    for depth, (col, shift) in enumerate(LEVELS):
        prefixes = sorted({p for _, p in open_.values()})
        rows = keyed
        if col == "h":
            keys = [F.shiftright("h", shift)]
            if depth:
                rows = rows.where(F.shiftright("h", LEVELS[depth - 1][1]).isin([p[0] for p in prefixes]))
                keys.insert(0, F.shiftright("h", LEVELS[depth - 1][1]))
        else:
            keys = [F.col("h"), F.shiftright("d", shift)]
            rows = rows.where(F.col("h").isin(sorted({p[0] for p in prefixes})))
            if LEVELS[depth - 1][0] == "d":
                before = F.shiftright("d", LEVELS[depth - 1][1])
                rows = rows.where(F.struct(F.col("h").alias("h"), before.alias("d")).isin(
                    [F.struct(F.lit(p[0]).cast("long").alias("h"), F.lit(p[1]).cast("long").alias("d"))
                     for p in prefixes]))
                keys.insert(1, before)
        sums: dict[tuple, list[tuple[int, int]]] = {}
        for r in rows.groupBy(*[k.cast("long").alias(f"k{i}") for i, k in enumerate(keys)]) \
                     .agg(F.sum("size").alias("bytes")).collect():
            sums.setdefault(tuple(r[:-2]), []).append((r[-2], r[-1]))
        still = {}
        for target, (below, prefix) in open_.items():
            cum, last = below, None
            for value, size in sorted(sums[prefix]):
                last = (value, cum, cum + size)
                if cum + size >= target:
                    break
                cum += size
            value, lo, hi = last
            near = (lo, value) if target - lo <= hi - target else (hi, value + 1)
            if abs(near[0] - target) <= slack or depth == len(LEVELS) - 1:
                bound = near[1] << shift
                found[target] = (bound, _MIN) if col == "h" else (prefix[0], bound)
            elif col == "h":
                still[target] = (lo, (value,))
            else:
                still[target] = (lo, (prefix[0], value))
        open_ = still
        if not open_:
            break
    return [found[t] for t in sorted(found)]


def _right_of(bound: tuple[int, int]):
    h, d = bound
    if h > _MAX:
        return F.lit(False)
    at_or_right = F.lit(True) if d <= _MIN else F.lit(False) if d > _MAX else F.col("d") >= F.lit(d)
    return (F.col("h") > F.lit(h)) | ((F.col("h") == F.lit(h)) & at_or_right)


def histogram_shards(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: float = TOLERANCE, overhead: int = 16) -> DataFrame:
    """(doc_id, text, size, shard, slot): every row of ``df`` in its shard, with a gapless slot.

    The text moves in one exchange. Its unit is a key interval of a shard (1/4,096 of the
    hashes); a unit above UNIT_BYTES (a hot text) is dealt over several tasks by doc_id, so
    no task holds more than a bounded piece. The unit table has one row per interval and per
    UNIT_BYTES of input, and is the only broadcast side.
    """
    base = (id_text(df, id_col, text_col)
            .withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(overhead))
            .withColumn("h", F.xxhash64("text"))
            .withColumn("d", F.coalesce("doc_id", F.lit(_MIN).cast("long"))))
    keyed = stored(base.select("h", "d", "size"), "shard-keys")
    bounds = find_splitters(keyed, n_shards, tolerance)
    shard = sum((_right_of(b).cast("int") for b in bounds), F.lit(0)) if bounds else F.lit(0)

    def placed(x: DataFrame) -> DataFrame:
        return x.withColumn("shard", shard).withColumn("unit", F.shiftright("h", 52).cast("int"))

    units = (placed(keyed).groupBy("shard", "unit").agg(F.sum("size").alias("bytes"))
             .where(F.col("bytes") > UNIT_BYTES)
             .select("shard", "unit", F.ceil(F.col("bytes") / UNIT_BYTES).cast("int").alias("pieces")))

    def dealt(x: DataFrame) -> DataFrame:
        return (placed(x).join(F.broadcast(units), ["shard", "unit"], "left")
                .withColumn("piece", F.pmod(F.xxhash64("d"), F.coalesce("pieces", F.lit(1))).cast("int")))

    before = Window.partitionBy("shard").orderBy("unit", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt(keyed).groupBy("shard", "unit", "piece").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("shard", "unit", "piece").orderBy("h", "d")
    return (dealt(base).withColumn("rn", F.row_number().over(inside))
            .join(F.broadcast(starts), ["shard", "unit", "piece"])
            .select("doc_id", "text", "size", "shard", (F.col("start") + F.col("rn") - 1).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The contract's columns of ``histogram_shards``."""
    return histogram_shards(docs, n_shards).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def balance_limit(total: int, n_shards: int, largest: int, tolerance: float = TOLERANCE) -> int:
    """Largest shard that the splitters allow: the mean, both slacks, and one row."""
    return math.ceil(total / n_shards * (1 + 2 * tolerance)) + largest
