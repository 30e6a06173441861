"""Operator 1: toxic passages by maximum-scoring segments over token log-odds.

Fit (on labelled rows): tokens are words and, as a second feature, the first PREFIX letters
of longer words. A feature's score is the log-odds of its share among toxic documents
against the others, with a Dirichlet prior that is the feature's share in the whole corpus
(prior weight: the toxic class's own size), less Z_MARGIN standard errors. Features that are
not above zero then carry no evidence; every token costs GAP.

Search: the linear-time scan over all tokens for all maximal scoring segments gives every
passage whose tokens argue for toxicity. A segment in which a word recurs scores as its best
part when each distinct word counts once in it (``once_each``); no better one lies outside the
segments. Scores are calibrated by extreme-value statistics: under clean text the best segment
of n tokens exceeds s with probability 1 - exp(-K n exp(-lambda s)), lambda solving
E[exp(lambda score)] = 1 over the scores of all tokens of the clean training documents (and
the prior) and K fitted to the best segments of those documents by the same scan. The expected
count of a segment is E = K n exp(-lambda s). A document's segments
are aggregated by the Poisson chance of the r best (``evidence``), and its score is the
log-odds base + ln(1 + 1/P).

The fit uses at most about MAX_LABELLED labelled rows (an unbiased slice by id hash beyond
that); corpus shares are counted over all documents. A feature is a candidate only if it
makes up MIN_SHARE of the toxic features, so there are at most 1/MIN_SHARE = 100,000, and
the fitted tables that tasks receive are bounded by that.

Defined results: null and empty texts have no passage and the base score; a document with
several label rows is toxic if one is; null labels and null ids are not learned from;
without toxic labels every score is the base; repeated rows score alike; empty table: no
rows.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, logit, per_batch

MAX_LABELLED = 200_000
MIN_SHARE = 1e-5
MIN_DOCS = 2                       # toxic documents a candidate feature must be in
PREFIX = 4
Z_MARGIN = 2.5
GAP = 0.5                          # cost of a token without evidence: keeps passages local
MAX_EXPECTED = 0.05                # a passage is significant up to this expected count
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)    # feature -> score > 0
    lam: float = 1.0
    k: float = 1.0
    base: float = 0.05

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """(position, score) of the words that score above zero."""
        s, out = self.scores, []
        for i, w in enumerate(words):
            p = "^" + w[:PREFIX] if len(w) > PREFIX else w
            if w in s or p in s:
                out.append((i, max(s.get(w, 0.0), s.get(p, 0.0))))
        return out

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """The maximal scoring segments (first word, last word, score), each distinct word
        counted once in a segment."""
        hits, out, k = self.hits(words), [], 0
        for a, b, s in maximal_segments(hits):
            while hits[k][0] < a:
                k += 1
            first = k
            while k < len(hits) and hits[k][0] <= b:
                k += 1
            mine = [(words[i], i, v) for i, v in hits[first:k]]
            out.append((a, b, s if len({w for w, _, _ in mine}) == len(mine) else once_each(mine)))
        return out


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(words: list[str]) -> set[str]:
    out = set(words)
    return out | {"^" + w[:PREFIX] for w in out if len(w) > PREFIX}


def maximal_segments(hits: list[tuple[int, float]], gap: float = GAP) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a token sequence in which
    the words of ``hits`` (ascending position, positive score) count their score and every
    other word counts -gap. Linear in the number of hits.

    Candidates are kept with the sums before (l) and after (r) them. A new candidate is
    joined back to the nearest earlier one whose l is below its own, if that one's r is not
    already at least its own."""
    kept: list[list] = []          # [l, r, first, last, index of the nearest earlier candidate with smaller l]
    total, at = 0.0, 0
    for i, s in hits:
        total -= gap * (i - at)
        cand = [total, total + s, i, i, -1]
        total += s
        at = i + 1
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= cand[0]:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= cand[1]:
                cand[4] = j
                kept.append(cand)
                break
            cand[0], cand[2] = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, r - l) for l, r, a, b, _ in kept]


def once_each(hits: list[tuple[str, int, float]], gap: float = GAP) -> float:
    """The largest score of a part of a segment with the ``hits`` (word, position, score > 0), if
    each distinct word counts its score once and every other token counts -gap.

    A part that scores above zero is not longer than the distinct scores allow, so only starts
    within that reach are kept up to date."""
    distinct = {w: s for w, _, s in hits}
    reach = sum(distinct.values()) / gap + len(distinct)
    f = np.zeros(len(hits))            # f[i]: score of the part from hit i to the present one
    last: dict[str, int] = {}
    best, lo, before = 0.0, 0, 0
    for j, (w, at, s) in enumerate(hits):
        while at - hits[lo][1] > reach:
            lo += 1
        old = max(lo, last.get(w, -1) + 1)
        f[lo:j] -= gap * (at - before - 1)
        f[lo:old] -= gap
        f[old:j + 1] += s
        best = max(best, float(f[lo:j + 1].max()))
        last[w], before = j, at
    return best


def solve_lambda(scores: list[float], shares: list[float], gap: float = GAP) -> float:
    """The positive root of sum p exp(lambda s) + (1 - sum p) exp(-lambda gap) = 1."""
    s, p = np.asarray(scores, float), np.asarray(shares, float)
    rest = max(1e-9, 1.0 - float(p.sum()))
    if not len(s) or float((s * p).sum()) - gap * rest >= 0:
        return 1.0

    def f(x: float) -> float:
        return float((p * np.exp(np.minimum(x * s, 700.0))).sum()) + rest * math.exp(-x * gap) - 1.0
    lo, hi = 0.0, 1e-3
    while f(hi) < 0 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _among(ids: pa.Array, known: np.ndarray) -> np.ndarray:
    """Which ids are known; compared as 64-bit integers also beside null ids."""
    return pc.is_in(ids, pa.array(known)).to_numpy(zero_copy_only=False)


def _labelled(labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, toxic) of at most about ``max_labelled`` rows."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    every = max(1, math.ceil(one.count() / max_labelled))
    return one.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """``docs`` (doc_id, text): the corpus; ``labels`` (doc_id, toxic): the rows to learn from.

    Three passes over the texts that matter (toxic ones for the candidates, clean and labelled
    ones for the calibration) and one over the whole corpus. The labelled ids that tasks receive are
    bounded by ``max_labelled``.
    """
    docs = id_text(docs)
    sample = _labelled(labels, max_labelled).toPandas()
    toxic_ids = np.sort(sample.doc_id[sample.toxic == 1].to_numpy("int64"))
    clean_ids = np.sort(sample.doc_id[sample.toxic == 0].to_numpy("int64"))
    base = (len(toxic_ids) + 0.05) / (len(sample) + 1.0)
    if not len(toxic_ids):
        return Model(base=min(base, 0.05))

    def toxic_counts():
        ids = toxic_ids

        def run(b):
            c: Counter = Counter()
            for t in b.filter(pa.array(_among(b["doc_id"], ids)))["text"].to_pylist():
                c.update(features(words_of(t)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.string()),
                                              pa.array(list(c.values()), pa.int64())], ["feature", "n"])
        return run

    counts = per_batch(docs, toxic_counts, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = counts.cache()
    mass_t = counts.agg(F.sum("n")).first()[0] or 0
    cand = counts.where((F.col("n") >= max(MIN_DOCS, math.ceil(MIN_SHARE * mass_t)))).toPandas()
    counts.unpersist()
    if not len(cand):
        return Model(base=min(base, 0.05))
    wanted = frozenset(cand.feature)

    def corpus_counts():
        ids = clean_ids

        def run(b):
            every, clean = Counter(), Counter()
            n_all = n_clean = 0
            known = _among(b["doc_id"], ids)
            for t, is_clean in zip(b["text"].to_pylist(), known):
                f = features(words_of(t))
                n_all += len(f)
                got = f & wanted
                every.update(got)
                if is_clean:
                    n_clean += len(f)
                    clean.update(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*every, ""], pa.string()), pa.array([*every.values(), n_all], pa.int64()),
                 pa.array([*(clean[f] for f in every), n_clean], pa.int64())], ["feature", "n", "n_clean"])
        return run

    stat = (per_batch(docs, corpus_counts, "feature string, n long, n_clean long").groupBy("feature")
            .agg(F.sum("n").alias("n"), F.sum("n_clean").alias("n_clean")).toPandas().set_index("feature"))
    mass, mass_c = int(stat.n.get("", 0)), int(stat.n_clean.get("", 0))
    prior = float(mass_t)                                     # weight of the prior: the toxic class's size
    y_t = cand.n.to_numpy(float)
    y_c = stat.n_clean.reindex(cand.feature).fillna(0).to_numpy(float)
    alpha = prior * np.maximum(stat.n.reindex(cand.feature).fillna(0).to_numpy(float), y_t) / max(1, mass)
    odds_t = (y_t + alpha) / np.maximum(mass_t + prior - y_t - alpha, 1e-9)
    odds_c = (y_c + alpha) / np.maximum(mass_c + prior - y_c - alpha, 1e-9)
    delta = np.log(odds_t) - np.log(odds_c)
    # what the counts support: the log-odds less Z_MARGIN standard errors. Among many rare
    # features some lean to one class by chance; theirs is below zero
    delta -= Z_MARGIN * np.sqrt(1 / (y_t + alpha) + 1 / (y_c + alpha))
    keep = delta > GAP
    model = Model(dict(zip(cand.feature[keep], (delta[keep] - GAP).tolist())), base=base)

    def clean_tokens():
        ids = clean_ids

        def run(b):
            c: Counter = Counter()
            known = _among(b["doc_id"], ids)
            for t in b.filter(pa.array(known))["text"].to_pylist():
                words = words_of(t)
                hits = model.hits(words)
                c.update(s for _, s in hits)
                c[0.0] += len(words) - len(hits)
            yield pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.float64()),
                                              pa.array(list(c.values()), pa.int64())], ["score", "n"])
        return run

    # every token of the clean documents, as the scan meets it, and the prior's features
    tokens = Counter({r["score"]: r["n"] for r in per_batch(docs, clean_tokens, "score double, n long")
                      .groupBy("score").agg(F.sum("n").alias("n")).collect()})
    total = sum(tokens.values()) + prior
    for s, a in zip(model.scores.values(), alpha[keep].tolist()):
        tokens[s] += a
    del tokens[0.0]
    model.lam = solve_lambda(list(tokens), [n / total for n in tokens.values()])

    def best_segments():
        tox, cl = toxic_ids, clean_ids

        def run(b):
            is_t, is_c = _among(b["doc_id"], tox), _among(b["doc_id"], cl)
            part = b.filter(pa.array(is_t | is_c))
            weight, n_c, none_t, none = 0.0, 0, 0, 0
            for t, toxic in zip(part["text"].to_pylist(), is_t[is_t | is_c]):
                words = words_of(t)
                segs = model.segments(words)
                if not segs:
                    none += 1
                    none_t += int(toxic)
                if not toxic:
                    n_c += 1
                    weight += len(words) * math.exp(-model.lam * max((s for *_, s in segs), default=0.0))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.float64()) for x in (weight, n_c, none_t, none)],
                                             ["weight", "n_clean", "none_toxic", "none"])
        return run

    r = per_batch(docs, best_segments, "weight double, n_clean double, none_toxic double, none double") \
        .agg(*[F.sum(c).alias(c) for c in ("weight", "n_clean", "none_toxic", "none")]).first()
    if r["weight"]:
        model.k = r["n_clean"] / r["weight"]
    # documents without any passage: the share of them that is toxic all the same
    model.base = min(max(((r["none_toxic"] or 0) + 0.05) / ((r["none"] or 0) + 1.0), 1e-4), 0.25)
    return model


def evidence(x: list[float]) -> float:
    """ln(1 + 1/P) of a document's segments, given their normalized scores (-ln E).

    In clean text the number of segments that score as the r-th best one does is Poisson with
    mean E of that one. P is the chance of r or more, for the r at which it is least, times the
    number of r tried; so the weak segments that a long text has by chance do not add up."""
    if not x:
        return 0.0
    best, tried = max(x), 0
    for r, v in enumerate(sorted(x, reverse=True), 1):
        if v < -math.log(r):                                  # E over r: more are expected than seen
            continue
        mean, term, tail = math.exp(-v), 1.0, 1.0
        for j in range(1, 1000):
            term *= mean / (r + j)
            tail += term
            if term < 1e-12:
                break
        best = max(best, r * v + mean + math.lgamma(r + 1) - math.log(tail))
        tried += 1
    best -= math.log(max(1, tried))
    return best if best > 30 else math.log1p(math.exp(best))


def score_words(words: list[str], model: Model) -> float:
    log_kn = math.log(max(model.k * len(words), 1e-300))
    x = [model.lam * s - log_kn for _, _, s in model.segments(words)]
    return 1.0 / (1.0 + math.exp(-min(700.0, logit(model.base) + evidence(x))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    def make():
        def run(b):
            out = [score_words(words_of(t), model) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(out, pa.float64())], ["doc_id", "score"])
        return run
    return per_batch(id_text(docs), make, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``."""
    at = docs.columns.index(text_col)

    def make():
        def run(b):
            keep = [score_words(words_of(t), model) < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))
        return run
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])     # names may clash by case
    return per_batch(plain, make, plain.schema).toDF(*docs.columns)


def passages(docs: DataFrame, model: Model, max_expected: float = MAX_EXPECTED) -> DataFrame:
    """(doc_id, first_word, last_word, score, expected, passage): every significant passage."""
    def make():
        def run(b) -> Iterator[pa.RecordBatch]:
            rows = []
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                words = words_of(t)
                found = [(a, z, s, model.k * len(words) * math.exp(-model.lam * s))
                         for a, z, s in model.segments(words)]
                if any(e <= max_expected for *_, e in found):
                    low = t.lower()
                    spans = [m.span() for m in _WORD.finditer(low)]
                    rows += [(i, a, z, s, e, low[spans[a][0]:spans[z][1]]) for a, z, s, e in found if e <= max_expected]
            names = ["doc_id", "first_word", "last_word", "score", "expected", "passage"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)
        return run
    return per_batch(id_text(docs), make, "doc_id long, first_word long, last_word long, score double, "
                                          "expected double, passage string")


def held_out(doc_id="doc_id"):
    """The rows that are never learned from: crc32 of the id's text mod 4 is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels.where(~held_out()).select("doc_id", "toxic"))
    return (score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
