"""Operator 3: mixing sources to target weights by a low-discrepancy schedule.

Targets: sources (by code point, null last) weigh WEIGHTS in turn and share SHARE of all
words; no target exceeds CAP times its source's size, the excess is shared again by weight.

Schedule: slot k of the mix takes the point frac(k * golden ratio) (64-bit integer
arithmetic, so reruns agree) through the cumulative targets to a source, and its rank among
the slots of that source says which block it takes. A source's stream is its documents in
hashed order, again from the start after each pass, cut into blocks of exactly ``block``
words; the last one ends at the target. Slots beyond a source's last block are left out,
and blocks that found no slot (a few per source at most, by the sequence's discrepancy)
follow at the end, so every source's taken words equal its target rounded down.

Ranks: slots are made in segments of SEGMENT; the counts by segment and source give every
segment its first ranks, so no task ranks a whole source. Documents get their place in the
stream by distributed prefix sums, so a source holding a third of all rows is in no single
task. The driver sees one row per source and checks their number (MAX_SOURCES).

Defined results: null text: no words, nothing taken; a source without words has target 0;
repeated rows are documents of their own (their order in the stream is by id and size);
null doc_ids take part; empty table: no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import global_prefix
from .common import stored, take

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 256                        # words of a slot
SEGMENT = 1 << 18                  # slots made by one row of the schedule's range
GOLDEN = 11400714819323198485      # 2^64 / golden ratio, odd
MAX_SOURCES = 100_000              # target table on the driver and in each task
SEED = 17


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[float]:
    """Target words of the sources, given in their order, with their weights in turn."""
    w = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), [i for i in range(len(sizes)) if sizes[i] > 0]
    left = min(share, cap) * sum(sizes)
    while open_:
        scale = left / sum(w[i] for i in open_)
        full = [i for i in open_ if w[i] * scale > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = w[i] * scale
            break
        for i in full:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def slot_sources(first: int, n: int, bounds: np.ndarray) -> np.ndarray:
    """Source index of the slots first .. first + n - 1; ``bounds``: cumulative targets as 64-bit points."""
    with np.errstate(over="ignore"):
        points = np.arange(first, first + n, dtype=np.uint64) * np.uint64(GOLDEN)
    return np.searchsorted(bounds, points, side="right")


def schedule(spark, need: list[int], goal: list[float]) -> DataFrame:
    """(slot, sid, rank): which block of which source each slot of the mix takes.

    need: blocks per source; goal: target words per source."""
    total, n_slots = sum(goal), sum(need)
    if not n_slots:
        return spark.createDataFrame([], "slot long, sid int, rank long")
    cum, points = 0.0, []
    for g in goal[:-1]:
        cum += g
        points.append(min(int(cum / total * 2.0 ** 64), 2 ** 64 - 1))
    bounds = np.array(points, dtype=np.uint64)
    wanted = np.array(need, dtype=np.int64)
    n_segments = math.ceil(n_slots / SEGMENT)
    segments = spark.range(0, n_segments, 1, max(1, min(n_segments, 4096)))

    def count(batches):
        for b in batches:
            for s in b["id"].to_pylist():
                c = np.bincount(slot_sources(s * SEGMENT, min(SEGMENT, n_slots - s * SEGMENT), bounds),
                                minlength=len(wanted))
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([c.tolist()], pa.list_(pa.int64()))],
                                                 ["segment", "counts"])

    # one row per segment of 2^18 slots: some hundred bytes of input per million words
    by = segments.mapInArrow(count, "segment long, counts array<long>") \
        .select("segment", F.posexplode("counts").alias("sid", "n"))
    w = Window.partitionBy("sid").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(by.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0))), "mix-starts")
    per_segment = starts.groupBy("segment").agg(F.sort_array(F.collect_list(F.struct("sid", "first"))).alias("firsts"))

    def rank(batches):
        for b in batches:
            for s, firsts in zip(b["segment"].to_pylist(), b["firsts"].to_pylist()):
                n = min(SEGMENT, n_slots - s * SEGMENT)
                src = slot_sources(s * SEGMENT, n, bounds)
                order = np.argsort(src, kind="stable")
                runs = np.bincount(src, minlength=len(wanted))
                local = np.empty(n, dtype=np.int64)
                local[order] = np.arange(n) - np.repeat(np.cumsum(runs) - runs, runs)
                ranks = local + np.array([f["first"] for f in firsts], dtype=np.int64)[src]
                keep = ranks < wanted[src]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.arange(n) + s * SEGMENT)[keep], pa.int64()), pa.array(src[keep].astype(np.int32)),
                     pa.array(ranks[keep], pa.int64())], ["slot", "sid", "rank"])

    inner = per_segment.repartition(max(1, min(n_segments, 4096)), "segment") \
        .mapInArrow(rank, "slot long, sid int, rank long")
    got = {r["sid"]: r["n"] for r in starts.groupBy("sid").agg(F.sum("n").alias("n")).collect()}
    late, free = [], n_slots                                   # each late block has a slot of its own
    for i, k in enumerate(need):
        lo = got.get(i, 0)
        if k > lo:
            late.append((i, lo, k, free))
            free += k - lo
    if not late:
        return inner
    tail = (spark.createDataFrame(late, "sid int, lo long, hi long, free long")
            .select("sid", "lo", "free", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("rank"))
            .select((F.col("free") + F.col("rank") - F.col("lo")).alias("slot"), "sid", "rank"))
    return inner.unionByName(tail)


def word_count(c):
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, share: float = SHARE, cap: float = CAP):
    """(places, pieces).

    places: (row_index, doc_id, source, size, source_size, target), one row per input row;
    pieces: (slot, row_index, doc_id, pass, start, words): the mix, slot by slot; ``start`` is
    the first word of the document that the piece takes."""
    spark = docs.sparkSession
    sized = stored(take(docs, doc_id=id_col, source=source_col, text=text_col)
                   .select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                           word_count(F.col("text").cast("string")).alias("size")), "mix-sizes")
    by = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
          .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect())
    if len(by) > MAX_SOURCES:
        raise ValueError(f"mix: more than {MAX_SOURCES} sources")
    sizes = [r["source_size"] for r in by]
    goal = targets(sizes, weights, share, cap)
    whole = [int(g) for g in goal]
    need = [math.ceil(t / block) for t in whole]
    starts = np.cumsum([0, *sizes[:-1]]).tolist() if sizes else []
    table = spark.createDataFrame(
        [(i, r["source"], s, g, t, int(c)) for i, (r, s, g, t, c) in enumerate(zip(by, sizes, goal, whole, starts))],
        "sid int, source string, source_size long, target double, whole long, before long")
    known = F.broadcast(table)                                 # at most MAX_SOURCES rows, checked above
    sized = sized.join(known, sized["source"].eqNullSafe(table["source"])).drop(table["source"])
    placed = global_prefix(sized.withColumn("o", F.xxhash64(F.lit(SEED), "doc_id")),
                           ["sid", "o", "doc_id", "size"], ["size"])
    # the document's first word in one pass of its source
    placed = stored(placed.withColumn("at", F.col("cum_size") - F.col("size") - F.col("before"))
                    .select("row_index", "doc_id", "source", "size", "sid", "source_size", "target", "whole", "at"),
                    "mix-places")
    passes = placed.where("size > 0 AND whole > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.floor((F.col("whole") - 1) / F.col("source_size")).cast("int"))))
    lo = F.col("pass") * F.col("source_size") + F.col("at")
    spans = passes.withColumn("lo", lo).withColumn("hi", F.least(F.col("lo") + F.col("size"), "whole")) \
        .where("lo < hi")
    cut = spans.withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    begin = F.greatest("lo", F.col("rank") * block)
    cut = cut.select("row_index", "doc_id", "sid", "pass", "rank", (begin - F.col("lo")).alias("start"),
                     (F.least("hi", (F.col("rank") + 1) * block) - begin).alias("words"))
    pieces = cut.join(schedule(spark, need, goal), ["sid", "rank"]) \
        .select("slot", "row_index", "doc_id", "pass", "start", "words")
    return placed.select("row_index", "doc_id", "source", "size", "source_size", "target"), pieces


def mix_documents(docs: DataFrame) -> DataFrame:
    """The contract's columns, and where the schedule put the document: its first and last slot
    of the mix and the number of its slots (null, null and 0 where nothing is taken)."""
    places, pieces = mix(docs)
    taken = pieces.groupBy("row_index").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
                                            F.max("slot").alias("last_slot"), F.count(F.lit(1)).alias("n_slots"))
    return places.join(taken, "row_index", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot", "last_slot", F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"))


def repeat_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, in the order of the mix: a row for each pass that
    takes at least half of the document's words (the ends of a source's stream are rounded to
    whole documents), sorted by the slot in which that pass begins. The rows are range-partitioned
    by slot, so the files written from them follow the schedule.
    Repeated rows of one doc_id are decided together, by the one that gets the most passes;
    a document without words is not taken."""
    places, pieces = mix(docs)
    size = places.select("row_index", "size")
    # one slot for each pass; a target is at most ``cap`` times its source, so there are few
    times = (pieces.groupBy("row_index", "doc_id", "pass").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
             .join(size, "row_index").where(F.col("words") * 2 >= F.col("size"))
             .groupBy("row_index", "doc_id").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
             .groupBy("doc_id").agg(F.max(F.struct(F.size("slots").alias("n"), "slots")).alias("most"))
             .select(F.col("doc_id").alias("__mixed_id"), F.col("most.slots").alias("__slots")))
    out = docs.join(times, docs["doc_id"].cast("long").eqNullSafe(times["__mixed_id"]))
    out = out.select(*[docs[c] for c in docs.columns], F.explode("__slots").alias("__slot"))
    return out.orderBy("__slot").drop("__slot")
