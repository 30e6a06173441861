"""Operator 10: token counts of a unigram vocabulary by count-only Viterbi.

Blanks become U+2581 and the text is cut before each of them, as the tokenizer's
pre-tokenizer does. Within a word an Aho-Corasick automaton enumerates every vocabulary
piece at every end position; dynamic programming keeps, for each position, only the best
score and the number of pieces on its path. Ties are the tokenizer's: the first candidate
found wins, starts ascending, so of equal scores the longer last piece; a character that is
no piece by itself costs the lowest score less 10 and counts one piece per UTF-8 byte
(byte fallback). No piece is built, nothing is backtracked.

Scores are summed in 64 bit from left to right, as the tokenizer does, so ties and
near-ties fall alike.

Defined results: null and empty texts count 0; repeated rows count alike; empty table: no
rows. Memory is bounded by the longest word (texts without a blank are one word) and CACHE
remembered words.
"""
from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, per_batch

CACHE = 400_000
BLANK = "▁"
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of the public 32k piece list: rank scores -ln(rank), the special and byte
    pieces last. No training: the scores are a rule on the file's order."""
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    n = sp.get_piece_size()
    low = -math.log(n)
    out, rank = [], 1
    for i in range(n):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            out.append((sp.id_to_piece(i), low))
        else:
            out.append((sp.id_to_piece(i), -math.log(rank)))
            rank += 1
    return out


class Counter:
    _shared: dict[str | None, Counter] = {}

    def __init__(self, vocab: list[tuple[str, float]]):
        self.auto = ahocorasick.Automaton()
        for piece, score in vocab:
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    @classmethod
    def of(cls, path: str | None) -> Counter:
        if path not in cls._shared:
            cls._shared[path] = cls(vocabulary(path))
        return cls._shared[path]

    def word(self, w: str) -> tuple[int, float]:
        """(pieces, score) of the best path."""
        best, count = [0.0], [0]
        end, top, num, single = 0, None, 0, False
        unknown = self.unknown

        def close():
            nonlocal top, num
            if not single:
                s = unknown + best[end]
                if top is None or s > top:
                    top, num = s, count[end] + len(w[end].encode("utf-8"))
            best.append(top)
            count.append(num)

        for e, (length, score) in self.auto.iter(w):        # ends ascending, longest piece first
            while end < e:
                close()
                end, top, num, single = end + 1, None, 0, False
            s = score + best[e + 1 - length]
            if top is None or s > top:
                top, num = s, count[e + 1 - length] + 1
            if length == 1:
                single = True
        while end < len(w):
            close()
            end, top, num, single = end + 1, None, 0, False
        return count[-1], best[-1]

    def text(self, t: str | None) -> tuple[int, float]:
        if not t:
            return 0, 0.0
        t = t.replace(" ", BLANK)
        parts = t.split(BLANK)
        # every part but the first follows a blank; a first part gets one in front of it
        words = [BLANK + p for p in (parts if parts[0] else parts[1:])]
        n, total, known = 0, 0.0, self.known
        get = known.get
        for w in words:
            r = get(w)
            if r is None:
                r = self.word(w)
                if len(known) < CACHE and len(w) < 64:
                    known[w] = r
            n += r[0]
            total += r[1]
        return n, total


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, best_score) of every whole text."""
    def make():
        counter = Counter.of(path)

        def run(b):
            rows = [counter.text(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.float64())],
                                             ["doc_id", "n_tokens", "best_score"])
        return run
    return per_batch(id_text(docs, id_col, text_col), make, "doc_id long, n_tokens long, best_score double")
