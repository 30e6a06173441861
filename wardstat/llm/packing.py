"""Operator 5: vector bin packing of token pieces by the dot-product heuristic.

Every document is tokenized once (its ids and a closing id) and cut into pieces of at most
``capacity`` ids. A full piece is a sequence by itself. The others are dealt evenly into
groups of about GROUP pieces; in a group, each sequence takes, until nothing fits, the piece
whose demand vector (tokens, segments, loss-bearing tokens; each relative to its limit and
weighted by the group's mean demand) has the largest dot product with the room left. All
three limits hold for every sequence.

A group is bounded whatever the input (GROUP pieces, some 200 KB), and its last, partly
filled sequence is the only loss against packing all pieces together. Groups are dealt by
position in the stored piece table, so repeated rows and hot ids spread evenly and reruns of
a lost task see the same rows.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each;
null doc_ids take part; ties go to the earlier piece by (doc_id, start); an example that
exceeds a limit by itself raises ValueError in ``pack``; empty table: no rows.
"""
from __future__ import annotations

import base64
import json
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, per_batch, stored

CAPACITY = 2048
MAX_SEGMENTS = 128
GROUP = 4096
EOS = 1
CACHE = 250_000                    # words a tokenizing process remembers (about 50 MB)
LONG_WORD = 2000                   # longer runs without a blank go to the library with a linear-time merge
FULL = 1 << 61                     # sequence ids of full pieces start here

_AWKWARD = re.compile(r" (?:\s|\Z)")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, equal to those of the tokenizer file.

    A blank before a non-blank character always starts a new word of the byte-level
    pre-tokenizer, so a text is the sequence of its blank-separated pieces; each distinct
    piece is encoded once and remembered. Texts with longer white space go through whole, and
    texts that hold an added token of the file (<|endoftext|>) go to the library."""

    _shared: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        self.path, self.whole = path, None
        ranks_file = os.path.splitext(path)[0] + ".tiktoken"      # the same vocabulary as ranks
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f).get("added_tokens") or []]
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per process: tasks that a worker runs later find its words."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _by_library(self, text: str) -> bytes:
        if self.whole is None:                                    # rarely needed, so loaded when it is
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, text: str) -> bytes:
        if len(text) > LONG_WORD and len(text) > LONG_WORD * (text.count(" ") + 1):
            return self._by_library(text)
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(t in text for t in self.added):
            return self._by_library(text)
        if _AWKWARD.search(text):
            return self._encode(text)
        known, out = self.known, []
        words = text.split(" ")
        words[1:] = [" " + w for w in words[1:]]
        if words[0] == "":
            del words[0]
        get = known.get
        for w in words:
            e = get(w)
            if e is None:
                e = self._encode(w)
                if len(known) < CACHE and len(w) < 64:
                    known[w] = e
            out.append(e)
        return b"".join(out)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, eos: int = EOS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens)."""
    path = path or tokenizer_path()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def make():
        enc = Encoder.of(path)
        end = np.array([eos], dtype="<u4").tobytes()

        def run(b):
            rows = []
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                ids = memoryview(enc.ids(t) + end if t else end)
                n = len(ids) // 4
                rows += [(i, s, min(capacity, n - s), zlib.crc32(ids[4 * s:4 * min(n, s + capacity)]), n)
                         for s in range(0, n, capacity)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)
        return run
    return per_batch(id_text(docs, id_col, text_col), make, ", ".join(f"{n} long" for n in names))


def fill(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, position in it) of each example; ``demand`` (n, d) within ``limits`` (d)."""
    n = len(demand)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rel = demand / limits
    if (rel > 1).any():
        raise ValueError("pack: an example exceeds a limit by itself")
    weighted = rel * rel.mean(axis=0)                             # mean demand weighs the dimensions
    order = np.lexsort((np.arange(n), -weighted.sum(axis=1)))     # heaviest first; ties: input order
    # examples of one demand are interchangeable, so candidates are the first of each distinct demand
    kinds, kind = np.unique(demand[order], axis=0, return_inverse=True)
    queue = np.argsort(kind, kind="stable")                       # positions in ``order``, by kind
    ends = np.cumsum(np.bincount(kind, minlength=len(kinds)))
    head = np.concatenate([[0], ends[:-1]])
    by_head = np.argsort(queue[head], kind="stable")
    # kinds in the order of their first example; those of one weight stand together
    rel_k, weighted_k = rel[order][queue[head]][by_head], weighted[order][queue[head]][by_head]
    head, ends = head[by_head], ends[by_head]
    seq, pos = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    current, k, room = 0, 0, np.ones(demand.shape[1])
    while len(head):
        fits = (rel_k <= room + 1e-9).all(axis=1)
        if not fits.any():
            current, k, room = current + 1, 0, np.ones(demand.shape[1])
            continue
        at = np.flatnonzero(fits)
        likeness = weighted_k[at] @ room
        ties = at[likeness == likeness.max()]
        best = ties[int(np.argmin(queue[head[ties]]))]            # ties: the earliest example
        i = order[queue[head[best]]]
        seq[i], pos[i] = current, k
        room = room - rel_k[best]
        k += 1
        head[best] += 1
        if head[best] == ends[best]:
            keep = np.arange(len(head)) != best
            head, ends, rel_k, weighted_k = head[keep], ends[keep], rel_k[keep], weighted_k[keep]
    return seq, pos


def pack(examples: DataFrame, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS,
         max_loss: int | None = None, group: int = GROUP) -> DataFrame:
    """Adds (sequence_id, segment, offset) to rows with ``length``, ``loss_tokens`` and an order
    (doc_id, start). ``offset``: tokens before the example in its sequence."""
    limits = np.array([capacity, max_segments, max_loss or capacity], dtype=float)
    table = stored(examples, "pack-examples")
    # full pieces bypass ``fill``, so the limits of a single example are checked for all rows here
    over = (F.col("length") > limits[0]) | (F.col("loss_tokens") > limits[2])
    n, n_over = table.agg(F.count_if(F.col("length") < capacity), F.count_if(over)).first()
    if n_over:
        raise ValueError(f"pack: {n_over} examples exceed a limit by themselves")
    n_groups = max(1, round(n / group))
    numbered = table.withColumn("row", F.monotonically_increasing_id())
    whole = (numbered.where(F.col("length") == capacity)
             .withColumn("sequence_id", F.lit(FULL).cast("long") + F.col("row"))
             .withColumn("segment", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")))
    # mixing the bits of the row number deals the rows of one file over all groups
    rest = numbered.where(F.col("length") != capacity) \
        .withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(n_groups)))
    fields = [*examples.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["row long", "grp long", "sequence_id long", "segment long", "offset long"])

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "row"], na_position="first").reset_index(drop=True)
        demand = np.column_stack([pdf.length, np.ones(len(pdf)), pdf.loss_tokens]).astype(float)
        seq, pos = fill(demand, limits)
        out = pdf.assign(sequence_id=(pdf.grp.to_numpy() << 20) + seq, segment=pos)
        out = out.sort_values(["sequence_id", "segment"])
        out["offset"] = out.groupby("sequence_id").length.cumsum() - out.length
        return out

    packed = rest.groupBy("grp").applyInPandas(place, schema)
    cols = [f.name for f in fields] + ["sequence_id", "segment", "offset"]
    return whole.select(*cols).unionByName(packed.select(*cols))


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns. Every id but the first of a piece bears loss."""
    cut = pieces(docs, path).withColumn("loss_tokens", F.col("length") - 1)
    return pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
