"""Operator 6: license scans with a positional index of rare template words.

Templates are short license notices with a label and mandatory key phrases. Document
frequencies of all template words are counted over all documents; each template is filed
under its RARE words of highest IDF, with their positions. A file looks up every indexed
word it holds; postings of one template that agree on the relative position (file position
less template position) are one alignment. The score of an alignment with MIN_VOTES votes is the
IDF share of the template's words that stand at their place. Every mandatory phrase is filed
under its own rarest word as well, and one vote there is enough to verify it: where all
mandatory phrases of the template stand consecutively at their aligned place, the file gets the
template's label, whatever the words around them.

Beside this, the base phrases are counted wherever their words stand consecutively.

Words: after lower-casing A-Z, runs of digits, letters a-z and non-ASCII characters.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows
are scanned alike; a file may carry several labels; labels are distinct, sorted and
comma-joined; empty table: no rows (all template words then weigh alike).
"""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, take

# The base phrases and labels of the contract.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
RARE = 3
MIN_VOTES = 2                      # index words that must agree on a place (all, if a template has fewer)

_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words_of(text: bytes | str | None) -> list[bytes]:
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]


TEMPLATES = [
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "licensed under the apache license version 2.0", ("apache license version 2.0",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2",
             ("gnu general public license version 2",)),
    Template("agpl-3.0", "licensed under the gnu affero general public license version 3",
             ("affero general public license",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("cc-by-nc-4.0", "licensed under cc by-nc 4.0", ("cc by-nc 4.0",)),
    Template("cc-by-4.0", "licensed under cc by 4.0", ("cc by 4.0",)),
    Template("cc-by-sa-4.0", "licensed under cc by-sa 4.0", ("cc by-sa 4.0",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2.0", ("mozilla public license",)),
]


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of the consecutive words ``phrase``."""
    n, first = len(phrase), phrase[0]
    out, i = [], -1
    while True:
        try:
            i = words.index(first, i + 1)
        except ValueError:
            return out
        if words[i:i + n] == phrase:
            out.append(i)


class Index:
    """Positional index over the templates' and the mandatory phrases' rarest words."""

    def __init__(self, idf: dict[bytes, float], templates: list[Template] = TEMPLATES, rare: int = RARE):
        self.templates = [(t.label, words_of(t.text), [words_of(m) for m in t.mandatory]) for t in templates]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.keys: dict[bytes, list[tuple[int, int]]] = defaultdict(list)    # of the mandatory phrases
        self.votes, self.weight, self.needed = [], [], []
        for k, (_, words, mandatory) in enumerate(self.templates):
            chosen = sorted(set(words), key=lambda w: (-idf.get(w, 0.0), w))[:rare]
            for p, w in enumerate(words):
                if w in chosen:
                    self.postings[w].append((k, p))
            self.votes.append(min(MIN_VOTES, len(chosen)))
            self.weight.append(sum(idf.get(w, 0.0) for w in words) or 1.0)
            self.needed.append([(m, places(words, m)[0]) for m in mandatory])
            for m, p in self.needed[-1]:
                q = min(range(len(m)), key=lambda q: (-idf.get(m[q], 0.0), m[q], q))
                self.keys[m[q]].append((k, p + q))
        self.words = frozenset(self.postings) | frozenset(self.keys)

    def _stands(self, words: list[bytes], k: int, at: int) -> bool:
        return all(at + p >= 0 and words[at + p:at + p + len(m)] == m for m, p in self.needed[k])

    def scan(self, words: list[bytes]) -> tuple[set[str], float, list[tuple[str, int, int, float]]]:
        """(labels, best score, verified (label, first word, last word, score))."""
        votes: Counter = Counter()
        held = set()                                              # alignments at which the phrases stand
        for i, w in enumerate(words):
            if w in self.words:
                for k, p in self.postings.get(w, ()):
                    votes[k, i - p] += 1
                for k, p in self.keys.get(w, ()):
                    if self._stands(words, k, i - p):
                        held.add((k, i - p))
        labels, best, found = set(), 0.0, []
        for k, at in held.union(a for a, n in votes.items() if n >= self.votes[a[0]]):
            label, template, mandatory = self.templates[k]
            hit = sum(self.idf.get(w, 0.0) for p, w in enumerate(template)
                      if 0 <= at + p < len(words) and words[at + p] == w) / self.weight[k]
            best = max(best, min(1.0, hit))
            if (k, at) in held or not mandatory:
                labels.add(label)
                found.append((label, max(0, at), min(len(words), at + len(template)) - 1, min(1.0, hit)))
        return labels, best, found


def template_idf(docs: DataFrame, templates: list[Template] = TEMPLATES, text_col: str = "text") -> dict[bytes, float]:
    """ln((N + 1) / (df + 1)) + 1 of every template word, over all documents. The driver gets
    one count per template word."""
    vocab = frozenset(w for t in templates for w in words_of(t.text))

    def make():
        def run(b):
            c, n = Counter(), 0
            for t in b["text"].to_pylist():
                n += 1
                c.update(vocab.intersection(words_of(t)))
            c[b""] = n
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                             ["word", "n"])
        return run
    counts = per_batch(take(docs, text=text_col).select(F.col("text").cast("binary")), make, "word binary, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = {bytes(r["word"]): r["n"] for r in counts}
    n = df.get(b"", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1.0 for w in vocab}


def scan_documents(docs: DataFrame, templates: list[Template] = TEMPLATES, base=BASE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The contract's columns, and ``matches``: the verified notices (label, first and last word,
    score) of each file."""
    index = Index(template_idf(docs, templates, text_col), templates)
    phrases = [(words_of(p), label) for p, label in base]
    last_words = frozenset(p[-1] for p, _ in phrases)
    match = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                       ("score", pa.float64())])

    def make():
        def run(b):
            rows = []
            for t in b["text"].to_pylist():
                words = words_of(t)
                held = set(words)
                at, base_labels = [], set()
                if not held.isdisjoint(last_words):
                    for p, label in phrases:
                        if got := places(words, p):
                            at += got
                            base_labels.add(label)
                labels, score, found = (set(), 0.0, []) if held.isdisjoint(index.words) else index.scan(words)
                rows.append((len(words), len(at), min(at, default=None), max(at, default=None),
                             ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score,
                             [dict(zip(("label", "first_word", "last_word", "score"), m)) for m in sorted(found)]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(match)]
            cols = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
        return run
    d = take(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return per_batch(d, make, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                              "base_labels string, labels string, score double, "
                              "matches array<struct<label:string,first_word:long,last_word:long,score:double>>")
