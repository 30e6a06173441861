"""Operator 4: SpotSigs document fingerprints (DataFrame functions only).

A text is lower-cased and reduced to words (letters and digits). Every common word (anchor)
followed by a chain of CHAIN content words, common words between them skipped, is one
signature: "anchor content content". The set of signatures is the document's fingerprint;
two fingerprints are compared by the Jaccard coefficient of the sets. Sets whose sizes
differ by more than the wanted similarity allows are never intersected (the length
partitions of the method).

Words are matched once: a run of anchors is taken together with the chain behind it, so the work
is linear in the text, whatever its runs of anchors.

A text keeps its signatures however few they are. Only a text without any (no anchor followed
by a whole chain: many word lists and tables, scripts without blanks) has its adjacent word
pairs instead; against a text with signatures its likeness is 0.0.

Defined results: null and empty texts have no signature; two empty sets are alike (1.0), an
empty and a full one are not (0.0); a text of one word is its own signature; equal texts
have equal fingerprints; repeated rows are neighbours of each other in doc_id order, ties
by text hash; a null doc_id sorts first; empty table: no rows.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import global_prefix
from .common import id_text, stored

# Common words used as anchors, by language; code has its keywords.
ANCHORS = list(dict.fromkeys((
    "the of and to in is that for it as with by on be a an are this or "              # English
    "der die das und ist zu den mit von für ein eine im "                             # German
    "le la les de des du et en un une est que dans par pour "                         # French
    "el los las y por con "                                                           # Spanish
    "il di che per è della non sono "                                                 # Italian
    "o os do da em um uma não para "                                                  # Portuguese
    "het een van op niet voor zijn "                                                  # Dutch
    "och att det som av på är og til "                                                # Swedish, Danish, Norwegian
    "ja ei että oli "                                                                 # Finnish
    "w z na się nie że jest "                                                         # Polish
    "se je že pro s v i u za "                                                        # Czech, Slovak, South Slavic
    "și este cu din pe "                                                              # Romanian
    "az és egy hogy nem "                                                             # Hungarian
    "ve bir bu için ile "                                                             # Turkish
    "yang dan di ini dengan untuk "                                                   # Indonesian, Malay
    "và của là có được trong "                                                        # Vietnamese
    "и в на не что с это по к та що є у "                                             # Russian, Ukrainian
    "και το η ο του της να με "                                                       # Greek
    "في من على أن إلى و "                                                             # Arabic
    "של את על לא הוא "                                                                # Hebrew
    "if else return int new def var import").split()))                                # code
CHAIN = 2
BUCKET_BYTES = 16 << 20            # text bytes aimed at in a bucket of neighbouring documents
MAX_CUTS = 256                     # quantiles of the ids that the driver computes
MAX_BROADCAST_HEADS = 500_000      # first keys (28 bytes each) that are broadcast; more: a shuffle join
MAX_TASKS = 20_000                 # tasks of the exchange; beyond, a task has several buckets
_MIN = -(1 << 62)                  # order of a null id


def _any_of(words: list[str]) -> str:
    """A pattern of the words, grouped by first letter, so that a text's letter rules out most
    of them at once."""
    ends: dict[str, list[str]] = {}
    for w in sorted(words, key=lambda w: (-len(w), w)):
        ends.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(e)})" for c, e in sorted(ends.items())) + ")"


def _run_pattern(anchors: list[str], chain: int) -> str:
    """A whole run of anchors; group 1 is the run and, where one follows, the chain with the
    anchors in between. The next match starts behind the run, so an anchor is read as part of
    its own run and of the ``chain - 1`` chains at most that pass over it."""
    run = rf"(?:{_any_of(anchors)} )"
    return rf"(?<= )(?=({run}++(?:[^ ]++ (?:{run}*+[^ ]++ ){{{chain - 1}}})?)){run}++"


def normalized(text: Column) -> Column:
    """Words, single blanks between and around them; one blank for a text without words."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))),
                                                        r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def with_signatures(df: DataFrame, text: Column, out: str, anchors: list[str] = ANCHORS,
                    chain: int = CHAIN) -> DataFrame:
    """Adds ``out``: the sorted, distinct 64-bit hashes of the signatures of ``text``."""
    n, s, c = f"{out}__norm", f"{out}__runs", f"{out}__chains"
    words = F.length(n) - F.length(F.replace(F.col(n), F.lit(" "), F.lit(""))) - 1
    parts = F.transform(F.col(s), lambda x: F.split(F.rtrim(x), " "))
    parts = F.transform(parts, lambda p: F.struct(p.alias("words"), F.filter(p, lambda x: ~x.isin(anchors)).alias("chain")))
    parts = F.transform(F.filter(parts, lambda p: F.size(p["chain"]) == chain), lambda p: F.struct(
        F.array_distinct(F.slice(p["words"], 1, F.array_position(p["words"], F.get(p["chain"], 0)) - 1)).alias("run"),
        F.array_join(p["chain"], " ").alias("chain")))
    chains = F.flatten(F.transform(parts, lambda p: F.transform(
        p["run"], lambda x: F.xxhash64(F.concat(x, F.lit(" "), p["chain"])))))
    every = F.transform(F.regexp_extract_all(F.col(n), F.lit(r"(?<= )(?=([^ ]+ [^ ]+) )"), F.lit(1)),
                        lambda x: F.xxhash64(x))
    return (df.withColumn(n, normalized(text))
            .withColumn(s, F.regexp_extract_all(F.col(n), F.lit(_run_pattern(anchors, chain)), F.lit(1)))
            .withColumn(c, chains)
            .withColumn(out, F.array_sort(F.array_distinct(
                F.when(F.trim(n) == "", F.array().cast("array<bigint>"))
                .when(words == 1, F.array(F.xxhash64(n)))
                .when(F.size(c) > 0, F.col(c))
                .otherwise(every))))
            .drop(n, s, c))


def digest(sigs: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sigs, lambda x: x.cast("string")), ","), 256)


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0.0 without intersecting them when their sizes alone
    keep it below ``at_least``."""
    na, nb = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    return (F.when((na == 0) & (nb == 0), F.lit(1.0))
            .when((F.least(na, nb) == 0) | (F.least(na, nb) < F.greatest(na, nb) * F.lit(at_least)), F.lit(0.0))
            .otherwise(both / (na + nb - both)))


def length_partition(sigs: Column, at_least: float) -> Column:
    """Sets that can reach ``at_least`` lie in the same or in neighbouring partitions."""
    return F.floor(F.log(F.greatest(F.size(sigs), F.lit(1)).cast("double")) / F.lit(-math.log(at_least))).cast("int")


def with_next(df: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document with its successor by doc_id,
    the last with the first.

    Rows move once, to buckets of neighbouring ids; the first row of each bucket is copied to
    the bucket before it. The buckets' first keys are a small table of their own (one row per
    BUCKET_BYTES), joined by bucket and key; the driver sees at most MAX_CUTS quantiles.
    """
    base = id_text(df).withColumn("text", F.coalesce("text", F.lit(""))) \
                      .withColumn("d", F.coalesce("doc_id", F.lit(_MIN).cast("long")))
    size, lowest, highest = base.agg(F.sum(F.octet_length("text")), F.min("d"), F.max("d")).first()
    n = int(max(1, math.ceil((size or 0) / BUCKET_BYTES)))
    pieces = min(n, MAX_CUTS)
    cuts = sorted({int(c) for c in base.approxQuantile("d", [i / pieces for i in range(1, pieces)], 0.1 / pieces)}
                  ) if n > 1 else []
    # the quantiles of the ids bound the pieces; a piece is cut evenly when there are more
    # buckets than quantiles
    each = math.ceil(n / max(1, len(cuts)))
    if cuts:
        edges = F.array(*[F.lit(e).cast("long") for e in [lowest, *cuts, highest]])
        base = base.withColumn("piece", F.least(F.lit(len(cuts) + 1), F.size(F.filter(edges, lambda e: e <= F.col("d")))))
        lo, hi = (F.element_at(edges, F.col("piece") + k).cast("double") for k in (0, 1))
        base = base.withColumn("bucket", F.col("piece") * each + F.least(F.lit(each - 1), F.floor(
            (F.col("d") - lo) / F.greatest(hi - lo, F.lit(1.0)) * each)).cast("int")).drop("piece")
    else:
        base = base.withColumn("bucket", F.lit(0))
    # the order inside a bucket; the first row of a bucket is its smallest key
    base = base.withColumn("key", F.struct("d", F.xxhash64("text").alias("t")))
    firsts = stored(global_prefix(base.groupBy("bucket").agg(F.min("key").alias("first")), ["bucket"])
                    .select("row_index", F.col("bucket").cast("int").alias("bucket"), "first.d", "first.t"), "spot-heads")
    total = firsts.count()
    before = firsts.select(F.pmod(F.col("row_index") + 1, F.lit(max(1, total))).alias("row_index"),
                           F.col("bucket").alias("to"))
    head = firsts.join(before, "row_index").select(F.col("bucket").alias("hb"), F.col("d").alias("hd"),
                                                   F.col("t").alias("ht"), "to")
    # their number is known here: beyond the bound the join shuffles, with the same rows
    head = F.broadcast(head) if total <= MAX_BROADCAST_HEADS else head
    base = base.withColumn("copy", F.lit(False))
    # one copy of a head, also where equal rows repeat it
    extra = (base.join(head, (F.col("bucket") == F.col("hb")) & (F.col("key.d") == F.col("hd"))
                       & (F.col("key.t") == F.col("ht")))
             .groupBy("hd", "ht", "to").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
             .select("doc_id", "text", F.col("hd").alias("d"), F.col("to").alias("bucket"),
                     F.struct(F.col("hd").alias("d"), F.col("ht").alias("t")).alias("key"),
                     F.lit(True).alias("copy")))
    moved = base.unionByName(extra).repartitionById(max(1, min(total, MAX_TASKS)), F.col("bucket").cast("int"))
    signed = with_signatures(moved, F.col("text"), "sigs")
    # a copy comes last in its bucket whatever its key: the bucket of the last document holds
    # the very first one
    w = Window.partitionBy("bucket").orderBy("copy", "key")
    return (signed.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sigs", F.lead("sigs").over(w))
            .where(~F.col("copy")).select("doc_id", "text", "sigs", "next_text", "next_sigs"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, signatures, fingerprint)."""
    out = with_signatures(id_text(df, id_col, text_col), F.col("text"), "signatures")
    return out.withColumn("fingerprint", digest(F.col("signatures")))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """The contract's columns: each document, its edited text (the last quarter replaced by the
    start of the next document) and the likeness of their fingerprints."""
    d = with_next(docs)
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    d = d.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q)))
    d = with_signatures(d, F.col("edited"), "edited_sigs")
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    digest(F.col("sigs")).alias("fingerprint"), digest(F.col("edited_sigs")).alias("edited_fingerprint"),
                    likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                    likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
