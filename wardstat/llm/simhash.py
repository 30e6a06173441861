"""Operator 7: SimHash near-duplicates with pivot distance tables.

Fingerprint: lower-cased (A-Z) words between ASCII white space, shingles of SHINGLE words
with repeats, XXH64 (seed 42) of each; a bit is 1 if it is set in over half of the hashes.

Pairs: distances to random references concentrate near 32 of 64 bits, so a pivot table
alone leaves about every third random pair of rows within one coordinate's reach and gives
nothing to partition by. Rows are therefore first dealt into blocks: the 64 bits are cut
into BLOCKS, and fingerprints at MAX_BITS or fewer differing bits agree on at least
BLOCKS - MAX_BITS of them, so every such pair meets under one of the block choices. In a
block, the table of Hamming distances to PIVOTS reference fingerprints discards each pair
whose largest coordinate difference exceeds MAX_BITS (triangle inequality), and the
survivors are verified by their differing bits. No pair within reach is lost.

A block with more than MAX_BLOCK fingerprints (a family of near copies) is dealt again on
the bits not yet agreed on, cut into MAX_BITS + 1 parts, of which one must be equal; each
round adds equal bits, so blocks shrink to 2^(bits left) at the latest. Equal fingerprints
are one node, so exact copies make no pairs; a block emits a spanning forest of its links,
not the links.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any
other; fewer words than SHINGLE: the whole sequence is one shingle; a null doc_id has a
null component unless a row of its component has an id; repeated rows share a component;
empty table: no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, per_batch, stored
from .graph import components

SHINGLE = 3
MAX_BITS = 3
BLOCKS = 6
PIVOTS = 16
MAX_BLOCK = 4096
SEED = 42
#: Reference fingerprints: pseudo-random, the same for every run.
REFERENCES = np.array([xxhash.xxh64_intdigest(b"reference %d" % i, SEED) for i in range(PIVOTS)], dtype=np.uint64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = text.lower().split() if text else []              # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):                           # bounded memory for any length
        h = np.array([digest(join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + (1 << 16)))],
                     dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    def make():
        def run(b):
            fps = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fps, pa.int64())], ["doc_id", "fp"])
        return run
    d = id_text(docs, id_col, text_col)
    return per_batch(d.select("doc_id", F.col("text").cast("binary").alias("text")), make, "doc_id long, fp long")


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(np.array(bits, dtype=int), parts) if len(p)]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def first_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    parts = _cut(list(range(64)), blocks)
    return [_mask(b for p in chosen for b in p) for chosen in combinations(parts, blocks - max_bits)]


def finer_masks(mask: int, max_bits: int = MAX_BITS) -> list[int]:
    """The given mask with one more part of the remaining bits; empty when none remain."""
    rest = [b for b in range(64) if not (mask >> b) & 1]
    return [_mask(b for b in range(64) if (mask >> b) & 1 or b in p) for p in _cut(rest, max_bits + 1)]


def forest(fp: np.ndarray, group: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Index pairs that span the links of each run of equal ``group`` (sorted).

    Pairs at distance o = 1, 2, ... within a run are compared at once: the pivot tables of both
    sides discard, the differing bits verify, and a union-find keeps the links that join."""
    n = len(fp)
    table = np.bitwise_count(fp[:, None] ^ REFERENCES[None, :]).astype(np.int8)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def roots() -> np.ndarray:
        lab = parent
        while True:
            up = lab[lab]
            if np.array_equal(up, lab):
                return lab
            lab = up

    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.arange(0)
    run_of = np.cumsum(np.r_[True, group[1:] != group[:-1]]) - 1 if n else starts
    out, left, o = [], np.arange(n), 0
    while len(left):
        o += 1
        if o % 16 == 0:                                       # runs that are one component are done
            lab = roots()
            whole = np.minimum.reduceat(lab, starts) == np.maximum.reduceat(lab, starts)
            left = left[~whole[run_of[left]]]
        left = left[left + o < n]
        left = left[group[left] == group[left + o]]
        a, b = left, left + o
        for p in range(table.shape[1]):                       # discard by the largest coordinate difference
            ok = np.abs(table[a, p] - table[b, p]) <= max_bits
            a, b = a[ok], b[ok]
        ok = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits      # verify the survivors
        a, b = a[ok], b[ok]
        if len(a) > 64:
            lab = roots()
            apart = lab[a] != lab[b]
            a, b = a[apart], b[apart]
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((i, j))
    return out


def _block_links(blocks: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) node pairs from rows (mask, val, fp, node), the rows of a block sorted together."""
    names = ["a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None

        def links(cols) -> pa.RecordBatch:
            mask, val, fp, node = cols
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (mask[1:] != mask[:-1]) | (val[1:] != val[:-1])
            pairs = forest(fp.view(np.uint64), np.cumsum(new), max_bits)
            a, b = (node[[p[k] for p in pairs]] if pairs else node[:0] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)

        for batch in batches:
            cols = [batch[c].to_numpy(zero_copy_only=False) for c in ("mask", "val", "fp", "node")]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            if not len(cols[0]):
                continue
            # the last block of the batch may go on in the next one
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            carry = [c[cut:] for c in cols]
            if cut:
                yield links([c[:cut] for c in cols])
        if carry is not None and len(carry[0]):
            yield links(carry)

    # the key goes through one more hash: parts of a fingerprint as they stand deal unevenly
    return (blocks.repartition("mask", "val").sortWithinPartitions("mask", "val", "fp")
            .mapInArrow(run, "a long, b long"))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, max_block: int = MAX_BLOCK) -> DataFrame:
    """(a, b): links between different fingerprints that span every component of the graph
    "at most ``max_bits`` differing bits". ``nodes`` (fp, node): one row per fingerprint."""
    masks = F.array(*[F.lit(m).cast("long") for m in first_masks(max_bits, blocks)])
    rows = nodes.select("fp", "node", F.explode(masks).alias("mask"))
    out = None
    while True:
        rows = rows.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stored(rows.groupBy("mask", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-blocks")
        crowded = sizes.where(F.col("n") > max_block).select("mask", "val")
        known = [r[0] for r in crowded.select("mask").distinct().collect()]      # masks: a few per round
        finer = {m: finer_masks(m, max_bits) for m in known if bin(m & (2**64 - 1)).count("1") < 64 - 12}
        # with 12 bits left a block holds at most 4,096 fingerprints, so it is never dealt again
        crowded = crowded.where(F.col("mask").isin(list(finer))) if finer else None
        paired = sizes.select("mask", "val")
        if crowded is not None:
            paired = paired.join(crowded, ["mask", "val"], "left_anti")
        part = _block_links(rows.join(paired, ["mask", "val"], "left_semi"), max_bits)
        out = part if out is None else out.unionByName(part)
        if crowded is None:
            return out
        cases = F.create_map(*[x for m, f in finer.items()
                               for x in (F.lit(m).cast("long"), F.array(*[F.lit(v).cast("long") for v in f]))])
        rows = (rows.join(crowded, ["mask", "val"], "left_semi")
                .select("fp", "node", F.explode(F.element_at(cases, F.col("mask"))).alias("mask")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    # min ignores null ids; a fingerprint of null ids only takes part under an id of its own
    # below all others, which is turned back into null at the end
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("own"))
                   .withColumn("node", F.coalesce("own", F.lit((1 << 63) - 1).cast("long")
                                                  - F.pmod(F.xxhash64("fp"), F.lit(1 << 40)))), "simhash-nodes")
    found = components(links(nodes.select("fp", "node"), max_bits))
    comp = (nodes.join(found, "node", "left")
            .select("fp", F.coalesce("root", "node").alias("component_id")))
    beyond = (1 << 63) - 1 - (1 << 40)
    return (fps.join(comp, "fp")
            .select("doc_id", "fp", F.when(F.col("component_id") <= beyond, F.col("component_id")).alias("component_id")))


def label_documents(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest
    doc_id stays. Rows without an id cannot be named and stay. Repeated rows of one doc_id:
    one stays."""
    groups = near_duplicates(docs, shingle, max_bits)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    if not repeated.limit(1).count():
        return kept
    ids = repeated.select("doc_id")
    return (kept.join(ids, "doc_id", "left_anti").select(*docs.columns)
            .union(kept.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)))
