"""Operator 13: phrase collocations, counted by broadcast double-array tries.

Words are 64-bit codes of (language, word), so phrases of different languages differ by their
words. The corpus is written once as code arrays (0 at the borders of pieces); every later pass
reads those.

Counting goes up by length. The frequent words are counted by an aggregate. For each further
length a pass finds the Apriori-safe candidates: phrases whose first words are a candidate, whose
next word is frequent and whose last words are a candidate, seen at least ``min_count`` times
(the last condition is checked before counting where one trie holds all shorter candidates).
Then all candidates of 2 to 4 words are counted: their double-array trie is broadcast, numpy
advances the states of all text positions at once, level by level (next = base[state] + symbol,
valid where check[next] = state), bincount adds up the accepting states, and the tasks' counts
are summed. Tries are built in shards of about SHARD candidates (by a hash), one pass over the codes each,
so a broadcast is bounded whatever the corpus; next words are looked up in slices of about SHARD
codes in the same way.

Codes are checked: every word has 64 further hash bits, and if two words of the corpus share a code,
all codes are made again with another seed.

Results: scores are integer divisions in decimals (exact beyond 64 bits). A candidate is dropped
if a longer candidate that holds it contiguously has 100 f(longer) >= 80 f. The first ``top`` of a
language come from a salted pre-selection, so no task ranks all phrases of a language.

Defined results: null text: empty; null lang: ``und``; empty and blank texts have no word; very
long texts are counted whole; repeated rows count each; further columns are ignored whatever
their names; a language without a candidate, and an empty table, give no rows. Rows do not depend
on partitions or order.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import BATCH_BYTES, BATCH_ROWS, stored, take

MIN_COUNT = 30
LONGEST = 4
COVERED = 80                       # percent of a phrase's places at which a longer one covers it
TOP = 2000
SHARD = 1 << 21                    # candidates of a broadcast trie (some 50 bytes each); codes of a word slice
WINDOW = 1 << 18                   # bytes of text that are tokenized at once
HELD = 1 << 18                     # distinct keys that a task holds before it passes counts on
#                                    (summed there, so they go to their key's task as they are)
FILTER_BITS = 26                   # 2^26 places: 8 MB, however many the candidates
SALTS = 64
DEC = "decimal(38,0)"
SEEDS = 8
CODE_BYTES = 1 << 19               # of a batch of codes
CODE_GROUP = 4 << 20               # bytes of a row group of the code table: a scan holds a group's codes at once


# ------------------------------------------------------------------ codes
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_CLASS = np.zeros(256, np.uint8)                       # 0 word, 1 blank, 2 border of a piece
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)      # odd multipliers of the two word hashes
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokenizer:
    """Words of a batch of texts as 64-bit codes and 64 further bits, by polynomial hashes over
    prefix sums: numpy on the batch's bytes, no loop over words."""

    def __init__(self, seed: int):
        self.seed, self.size, self.tables = seed, 0, []
        self.langs: list[str] = []
        self.lang_ids: dict[str, int] = {}

    def _powers(self, size: int):
        if size > self.size:
            self.size, self.tables = size, []
            for base in _BASES:
                base = (base * (2 * self.seed + 1)) & _MASK
                steps = [np.full(size + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
                for t in steps:
                    t[0] = 1
                self.tables.append([np.cumprod(t, dtype=np.uint64) for t in steps])
        return self.tables

    def windows(self, batch: pa.RecordBatch, size: int = 0):
        """Yields (codes, rest, langs, words): per window the codes of words and 0 at borders; for
        its words 64 further bits, numbers of languages, and their texts as (bytes, starts, ends).
        A window ends between words or texts, after about ``size`` bytes."""
        size = size or WINDOW
        col = batch.column("text").cast(pa.large_binary())
        if not len(col):
            return
        _, offsets, data = col.buffers()
        at = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        named = []
        for lang in batch.column("lang").to_pylist():
            if lang not in self.lang_ids:
                self.lang_ids[lang] = len(self.langs)
                self.langs.append(lang)
            named.append(self.lang_ids[lang])
        named = np.array(named, np.int64)
        salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], np.uint64)
        full = np.flatnonzero(at[1:] > at[:-1])               # texts with a byte
        first, named = at[:-1][full], named[full]
        low, stop = (int(at[0]), int(at[-1]))
        while low < stop:
            high = min(low + size, stop)
            if high < stop:                                # back to the last border of words or texts, or on to the next
                gap = np.flatnonzero(_CLASS[raw[low:high]])
                text = first[np.searchsorted(first, low, side="right"):np.searchsorted(first, high, side="right")]
                cut = max(low + int(gap[-1]) + 1 if len(gap) else low, int(text[-1]) if len(text) else low)
                while cut == low:
                    gap = np.flatnonzero(_CLASS[raw[high:high + size]])
                    k = np.searchsorted(first, high)
                    ends = [int(gap[0]) + high + 1] if len(gap) else []
                    ends += [int(first[k])] if k < len(first) else []
                    high = min(high + size, stop)
                    cut = min(ends) if ends and min(ends) <= high else stop if high == stop else low
                high = cut
            yield self._window(raw, low, high, first, named, salt)
            low = high

    def _window(self, raw, low, high, first, named, salt):
        x = _LOWER[raw[low:high]]
        kind = _CLASS[x]
        heads = first[np.searchsorted(first, low):np.searchsorted(first, high)] - low     # texts that begin here
        word = kind == 0
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        begin[heads] = word[heads]
        end = word.copy()
        end[:-1] &= ~word[1:]
        inner = heads[heads > 0] - 1
        end[inner] = word[inner]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        lang = named[np.searchsorted(first, starts + low, side="right") - 1]
        hashes = []
        value = x.astype(np.uint64) + np.uint64(1)
        for powers, inverse in self._powers(len(x)):
            total = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(value * powers[:len(x)], out=total[1:])
            hashes.append((total[ends] - total[starts]) * inverse[starts])
        own = salt[lang]
        code = _mix(hashes[0] ^ _mix(own + hashes[1] * np.uint64(0x2545F4914F6CDD1D))).view(np.int64)
        rest = _mix(hashes[1] + _mix(own ^ hashes[0]) * np.uint64(0x9FB21C651E98DF25)).view(np.int64)
        # borders: punctuation and beginnings of texts; one 0 for neighbours
        border = np.unique(np.concatenate([np.flatnonzero(kind == 2), heads]))
        places = np.concatenate([border * 2, starts * 2 + 1])
        order = np.argsort(places, kind="stable")
        codes = np.concatenate([np.zeros(len(border), np.int64), code])[order]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        return codes[keep], code, rest, lang, (x, starts, ends)


def texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    d = take(docs, text=text_col, lang=lang_col)
    return d.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(code, lang, word, f) of all words."""
    names = ["code", "rest", "lang", "word", "n"]

    def run(batches):
        tok = Tokenizer(seed)
        held, size = [], 0

        def merged():
            code, rest, lang, n = (np.concatenate([h[j] for h in held]) for j in (0, 1, 2, 4))
            # a clash inside a task stays two rows
            order = np.lexsort((rest, code))
            new = np.ones(len(order), bool)
            new[1:] = (code[order][1:] != code[order][:-1]) | (rest[order][1:] != rest[order][:-1])
            at = np.flatnonzero(new)
            one = order[at]
            return [code[one], rest[one], lang[one], pa.concat_arrays([h[3] for h in held]).take(pa.array(one)), np.add.reduceat(n[order], at)]

        def rows(h):
            known = pa.array(tok.langs, pa.string())
            for i in range(0, len(h[0]), 1 << 14):
                s = slice(i, i + (1 << 14))
                yield pa.RecordBatch.from_arrays([pa.array(h[0][s]), pa.array(h[1][s]), known.take(pa.array(h[2][s])),
                                                  h[3].slice(i, 1 << 14).cast(pa.string()), pa.array(h[4][s])], names)
        for b in batches:
            for _, code, rest, lang, (x, starts, ends) in tok.windows(b):
                order = np.lexsort((rest, code))
                new = np.ones(len(order), bool)
                new[1:] = (code[order][1:] != code[order][:-1]) | (rest[order][1:] != rest[order][:-1])
                at = np.flatnonzero(new)
                if not len(at):
                    continue
                one = order[at]
                many = np.diff(np.append(at, len(order)))
                text = x.tobytes()
                words = pa.array([text[i:j] for i, j in zip(starts[one].tolist(), ends[one].tolist())], pa.large_binary())
                held.append([code[one], rest[one], lang[one], words, many])
                size += len(one)
                if size > HELD // 2:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HELD // 4:
                        yield from rows(held[0])
                        held, size = [], 0
        if size:
            yield from rows(merged())
    part = _pass(docs, run, "code long, rest long, lang string, word string, n long")
    return part.repartition("code").groupBy("code", "lang", "word").agg(F.sum("n").alias("f"))


def whole_pieces(windows):
    """The windows' codes cut at borders only: no piece is divided, every row ends with 0."""
    held: list[np.ndarray] = []
    for codes in windows:
        borders = np.flatnonzero(codes == 0)
        if len(borders):
            cut = int(borders[-1]) + 1
            yield np.concatenate([*held, codes[:cut]])
            held = []
            codes = codes[cut:]
        if len(codes):
            held.append(codes)
    if held:
        yield np.concatenate([*held, np.zeros(1, np.int64)])


def encode(docs: DataFrame, seed: int) -> DataFrame:
    """(codes): rows of whole pieces, each with a 0 at its end."""
    def run(batches):
        tok = Tokenizer(seed)
        for b in batches:
            for codes in whole_pieces(w[0] for w in tok.windows(b)):
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.array(codes))], ["codes"])
    return _pass(docs, run, "codes array<bigint>")


def _stored_codes(codes: DataFrame) -> DataFrame:
    """Written to the shared folder in small row groups: rows are long arrays, and a columnar scan
    would hold thousands of them."""
    path = shared_path(codes.sparkSession, "tables/llm-codes")
    codes.write.option("parquet.block.size", CODE_GROUP).option("parquet.page.size.row.check.min", 4).parquet(path)
    return codes.sparkSession.read.parquet(path)


# ------------------------------------------------------------------ tries
@dataclass
class Trie:
    """symbols: sorted codes, symbol i + 1 for symbols[i]; a state's next by symbol c is
    base[state] + c where check there equals the state. State 0 is the root."""
    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    number: np.ndarray                 # of the phrase that ends in a state, else -1
    phrases: int

    def symbols_of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.symbols):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.symbols, codes), len(self.symbols) - 1)
        return np.where(self.symbols[at] == codes, at + 1, 0)


class _Slots:
    """The slots of a double array, as bits: the r-th of eight rows begins at slot r, so the slots from any
    offset on are a run of whole bytes of one row, and all places of a window are tested at once."""

    def __init__(self, size: int):
        self.rows = np.zeros((8, 0), np.uint8)
        self.grow(size)
        self.take(np.zeros(1, np.int64))

    def grow(self, size: int):
        self.rows = np.hstack([self.rows, np.zeros((8, size // 8 + 1), np.uint8)])

    def take(self, slots: np.ndarray):
        for r in range(8):
            at = slots[slots >= r] - r
            np.bitwise_or.at(self.rows[r], at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def room(self, offsets: np.ndarray, start: int) -> tuple[int, int]:
        """(window, slot): the first slot from window ``start`` (a byte) on that leaves all ``offsets`` free."""
        wide = 512 if len(offsets) < 16 else 8192
        shift, skip = (offsets & 7).tolist(), (offsets >> 3).tolist()
        while True:
            need = start + wide + skip[-1] + 1
            if need > self.rows.shape[1]:
                self.grow(8 * max(need - self.rows.shape[1], self.rows.shape[1] // 4))
            taken = self.rows[0, start:start + wide].copy()
            for i, (r, x) in enumerate(zip(shift, skip)):
                np.bitwise_or(taken, self.rows[r, start + x:start + x + wide], out=taken)
                if i % 32 == 31 and taken.min() == 255:
                    break
            free = np.flatnonzero(taken != 255)
            if len(free):
                low = ~int(taken[free[0]])
                return start, 8 * (start + int(free[0])) + (low & -low).bit_length() - 1
            start += wide

    def used(self) -> np.ndarray:
        return np.unpackbits(self.rows[0], bitorder="little").astype(bool)


def build_trie(phrases: np.ndarray) -> tuple[Trie, np.ndarray]:
    """The trie of distinct rows of LONGEST codes (0 after the last word), and the rows by number."""
    symbols = np.unique(phrases[phrases != 0])
    sym = np.where(phrases != 0, np.searchsorted(symbols, phrases) + 1, 0).astype(np.int64)
    by = np.lexsort(sym.T[::-1])
    sym, whose = sym[by], []
    # trie nodes level by level: a node is a distinct prefix; parent and symbol of each
    parent_of_row = np.zeros(len(sym), np.int64)
    parents, letters, ends, n = [], [], [np.zeros(1, bool)], 1
    alive = np.arange(len(sym))
    for level in range(phrases.shape[1]):
        alive = alive[sym[alive, level] > 0]
        if not len(alive):
            break
        p, c = parent_of_row[alive], sym[alive, level]
        new = np.ones(len(alive), bool)
        new[1:] = (p[1:] != p[:-1]) | (c[1:] != c[:-1])
        ids = n + np.cumsum(new) - 1
        parents.append(p[new])
        letters.append(c[new])
        last = np.ones(len(alive), bool) if level + 1 == phrases.shape[1] else sym[alive, level + 1] == 0
        end = np.zeros(int(new.sum()), bool)
        end[ids[last] - n] = True
        whose.append(alive[last])
        ends.append(end)
        parent_of_row[alive] = ids
        n += len(end)
    parent, letter = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, letters))
    end = np.concatenate(ends)
    # the children of a node are consecutive; places are dealt to the nodes with most children first
    order = np.argsort(parent, kind="stable")
    children, first, many = np.unique(parent[order], return_index=True, return_counts=True)
    slots = _Slots(len(symbols) + 2 * n + 16)
    place, base = np.zeros(n, np.int64), np.zeros(n, np.int64)
    start = width = 0
    for k in np.argsort(-many, kind="stable"):
        if many[k] == 1:
            break
        kids = order[first[k]:first[k] + many[k]]
        c = letter[kids]
        # windows that had no room are tried again by nodes of half as many children
        if int(many[k]).bit_length() != width:
            start, width = 0, int(many[k]).bit_length()
        start, slot = slots.room(c - c[0], start)
        base[children[k]] = slot - c[0]
        place[kids + 1] = slot + (c - c[0])
        slots.take(place[kids + 1])
    used = slots.used()
    single = np.flatnonzero(many == 1)
    kids = order[first[single]]
    free = np.flatnonzero(~used)
    if len(free) < len(kids):
        used = np.concatenate([used, np.zeros(len(kids), bool)])
        free = np.flatnonzero(~used)
    place[kids + 1] = free[:len(kids)]
    base[children[single]] = place[kids + 1] - letter[kids]
    size = int(place.max()) + 1
    out = Trie(symbols, np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32), int(end.sum()))
    out.base[place] = base
    out.check[place[1:]] = place[parent]
    out.number[place[end]] = np.arange(out.phrases)
    return out, phrases[by][np.concatenate(whose)] if whose else phrases[:0]


def advance(trie: Trie, codes: np.ndarray, depth: int):
    """Yields (length, positions, states): the positions whose next ``length`` codes are a path of
    the trie, and the states they lead to."""
    sym = trie.symbols_of(codes)
    pos = np.flatnonzero(sym)
    state = np.zeros(len(pos), np.int64)
    size = len(trie.base)
    for level in range(depth):
        inside = pos + level < len(sym)
        pos, state = pos[inside], state[inside]
        c = sym[pos + level]
        to = trie.base[state] + c
        ok = (c > 0) & (to >= 0) & (to < size)
        to = np.where(ok, to, 0)
        ok &= trie.check[to] == state
        pos, state = pos[ok], to[ok]
        yield level + 1, pos, state


# ------------------------------------------------------------------ passes over the codes
def _flat(batch: pa.RecordBatch) -> np.ndarray:
    c = batch.column(0)
    return c.flatten().to_numpy(zero_copy_only=False)


def _pass(df: DataFrame, run, schema: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    conf = df.sparkSession.conf
    rows = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    if int(rows) > BATCH_ROWS or int(rows) <= 0:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))

    def lean(batches):                 # a worker gives back what a batch took
        for b in batches:
            yield b
            pa.default_memory_pool().release_unused()
    return df.mapInArrow(lambda batches: run(lean(batches)), schema)


def _columns(length: int) -> list[str]:
    return [f"c{i}" for i in range(1, length + 1)]


def _places(columns: list[np.ndarray]) -> np.ndarray:
    """The places of phrases, given word by word, in the candidates' bitmap."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = _mix((h ^ c.view(np.uint64)) + np.uint64(_BASES[0]))
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bitmap(shards, length: int) -> np.ndarray:
    """Bits set at the places of the shards' phrases (arrays of rows, one shard at a time)."""
    marked = np.zeros(1 << FILTER_BITS, bool)
    for rows in shards:
        marked[_places([np.ascontiguousarray(rows[:, j]) for j in range(length)])] = True
    return np.packbits(marked, bitorder="little")


def _extensions(codes: DataFrame, trie, words, tails, length: int) -> DataFrame:
    """(key, n): places where a phrase of length - 1 words is followed by one of ``words`` (sorted
    codes) and the last length - 1 words may be a candidate too, as partial counts of the tasks; key:
    number of the phrase and place of the word in one (see _spelled). ``trie``, ``words``, ``tails``
    (bitmap; None for pairs): broadcasts."""
    def run(batches):
        t, known = trie.value, words.value
        wide = len(known) + 1
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh, size = [], 0

        def merged():
            every = np.concatenate([keys, *fresh])
            n = np.concatenate([counts, np.ones(len(every) - len(keys), np.int64)])
            order = np.argsort(every, kind="stable")
            every = every[order]
            at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
            return every[at], np.add.reduceat(n[order], at)

        def rows():
            for i in range(0, len(keys), 1 << 14):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 14)]), pa.array(counts[i:i + (1 << 14)])], ["key", "n"])
        for b in batches:
            x = _flat(b)
            for _, pos, state in advance(t, x, length - 1):
                pass
            # a phrase is never the last code: a border follows
            phrase = t.number[state].astype(np.int64)
            ok = phrase >= 0
            pos, phrase = pos[ok], phrase[ok]
            if tails is not None:
                place = _places([x[pos + j] for j in range(1, length)])
                ok = (tails.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                pos, phrase = pos[ok], phrase[ok]
            after = x[pos + length - 1]
            at = np.minimum(np.searchsorted(known, after), len(known) - 1)
            ok = known[at] == after
            fresh.append(phrase[ok] * wide + at[ok])
            size += len(fresh[-1])
            if size > HELD:
                keys, counts = merged()
                fresh, size = [], 0
                if len(keys) > HELD:
                    yield from rows()
                    keys, counts = keys[:0], counts[:0]
        if size:
            keys, counts = merged()
        yield from rows()
    return _pass(codes, run, "key long, n long", CODE_BYTES)


def _counts(codes: DataFrame, trie) -> DataFrame:
    """(key, n): a task's bincount of the accepting states; key: number of the phrase."""
    def run(batches):
        t = trie.value
        total = np.zeros(t.phrases, np.int64)
        for b in batches:
            for _, _, state in advance(t, _flat(b), LONGEST):
                phrase = t.number[state]
                total += np.bincount(phrase[phrase >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 1 << 14):
            s = seen[i:i + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(total[s])], ["key", "n"])
    return _pass(codes, run, "key long, n long", CODE_BYTES)


def _spelled(counted: DataFrame, phrases, words, length: int) -> DataFrame:
    """(c1 .. c<length>, n) of summed (key, n) rows; ``words`` None: the keys are phrases' numbers."""
    names = [*_columns(length), "n"]

    def run(batches):
        rows = phrases.value
        for b in batches:
            key, last = b.column(0).to_numpy(), []
            if words is not None:
                key, word = np.divmod(key, len(words.value) + 1)
                last = [pa.array(words.value[word])]
            yield pa.RecordBatch.from_arrays([pa.array(rows[key, j]) for j in range(length - len(last))] + last + [b.column(1)], names)
    return _pass(counted, run, ", ".join(f"{n} long" for n in names))


def _shards(phrases: DataFrame, shard: int) -> list[DataFrame]:
    """The rows, dealt evenly by a hash of their codes into parts of about ``shard`` rows."""
    n = phrases.count()
    k = max(1, -(-n // shard))
    cols = [c for c in phrases.columns if c.startswith("c")]
    return [phrases.where(F.pmod(F.xxhash64(*cols), F.lit(k)) == i) for i in range(k)] if n else []


def _fetch(part: DataFrame, length: int) -> np.ndarray:
    """A shard's phrases, padded with 0; its size is bounded by SHARD."""
    got = part.select(*_columns(length)).toArrow()
    out = np.zeros((got.num_rows, LONGEST), np.int64)
    for j in range(length):
        out[:, j] = got.column(j).to_numpy()
    return out


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang",
                  shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (lang, word, code, f) of all words and (c1 .. c4, len, f) of the phrases of
    2 to 4 words with at least ``min_count`` places; unused codes are 0."""
    spark = docs.sparkSession
    docs = texts(docs, text_col, lang_col)
    for seed in range(SEEDS):
        words = stored(count_words(docs, seed), "words")
        clash = words.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR code = 0")
        if clash.limit(1).count() == 0:
            break
    else:
        raise RuntimeError("collocations: no seed gives distinct codes")
    codes = _stored_codes(encode(docs, seed))
    frequent = stored(words.where(F.col("f") >= min_count).select(F.col("code").alias("c1")), "frequent")
    slices = [np.sort(_fetch(p, 1)[:, 0]) for p in _shards(frequent, shard)] if frequent.count() <= shard else None

    def word_slices():
        if slices is not None:
            yield from slices
        else:
            for p in _shards(frequent, shard):
                yield np.sort(_fetch(p, 1)[:, 0])

    levels = [frequent]
    for length in range(2, LONGEST + 1):
        cols, found = _columns(length), None
        parts = _shards(levels[-1], shard)
        # pairs need none: their last word is looked up itself
        tails = spark.sparkContext.broadcast(_bitmap((_fetch(p, length - 1) for p in parts), length - 1)) if length > 2 and parts else None
        for part in parts:
            trie, rows = (spark.sparkContext.broadcast(x) for x in build_trie(_fetch(part, length - 1)))
            for some in word_slices():
                known = spark.sparkContext.broadcast(some)
                # written before the broadcasts go
                often = (_extensions(codes, trie, known, tails, length).repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
                         .where(F.col("n") >= min_count))
                got = stored(_spelled(often, rows, known, length).select(*cols), f"phrases-{length}")
                found = got if found is None else found.unionByName(got)
                known.unpersist()
            trie.unpersist()
            rows.unpersist()
        if tails is not None:
            tails.unpersist()
        if found is None:
            break
        levels.append(found)
    counted = None
    every = None
    for length, level in enumerate(levels[1:], start=2):
        padded = level.select(*_columns(length), *[F.lit(0).cast("long").alias(c) for c in _columns(LONGEST)[length:]])
        every = padded if every is None else every.unionByName(padded)
    for part in _shards(every, shard) if every is not None else []:
        trie, rows = (spark.sparkContext.broadcast(x) for x in build_trie(_fetch(part, LONGEST)))
        got = stored(_spelled(_counts(codes, trie).repartition("key").groupBy("key").agg(F.sum("n").alias("n")), rows, None, LONGEST)
                     .withColumnRenamed("n", "f"), "phrase-counts")
        counted = got if counted is None else counted.unionByName(got)
        trie.unpersist()
        rows.unpersist()
    if counted is None:
        counted = spark.createDataFrame([], ", ".join(f"{c} long" for c in [*_columns(LONGEST), "f"]))
    size = sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in _columns(LONGEST)), F.lit(0))
    return words, counted.where(F.col("f") >= min_count).withColumn("len", size)


# ------------------------------------------------------------------ scores
def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED,
         text_col: str = "text", lang_col: str = "lang", shard: int = SHARD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases."""
    words, phrases = phrase_counts(docs, min_count, text_col, lang_col, shard)
    phrases = stored(phrases, "phrases")
    frequent = stored(words.where(F.col("f") >= min_count), "frequent-words")
    key, none = _columns(LONGEST), F.lit(0).cast("long")

    def keys(codes: list[Column]) -> Column:
        return F.struct(*[c.alias(k) for c, k in zip([*codes, *[none] * LONGEST], key)])
    c = [F.col(k) for k in key]
    # counts of all words and phrases by their codes; the two parts of every cut
    parts = frequent.select(keys([F.col("code")]).alias("part"), "f").unionByName(phrases.select(keys(c).alias("part"), "f"))
    cuts = F.array(*[F.when(F.col("len") > k, F.struct(F.lit(k).alias("k"), keys(c[:k]).alias("left"), keys(c[k:]).alias("right")))
                     for k in range(1, LONGEST)])
    cut = phrases.select(keys(c).alias("phrase"), F.col("f").alias("a"), F.inline(F.filter(cuts, lambda x: x.isNotNull())))
    score = F.expr(f"CAST(2000000 AS {DEC}) * CAST(a AS decimal(20,0)) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    scored = (cut.join(parts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
              .join(parts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right").withColumn("score", score))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("phrase", "a").agg(least).select("phrase", "a", "cut.score", "cut.l", "cut.r")
    # shorter phrases inside longer ones
    inner = F.array(*[F.when((F.col("len") >= i + m) & (F.col("len") > m), keys(c[i:i + m]))
                      for m in range(2, LONGEST) for i in range(LONGEST - m + 1)])
    cover = (phrases.select(F.col("f").alias("longer"), F.explode(F.filter(inner, lambda x: x.isNotNull())).alias("phrase"))
             .groupBy("phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(cover, "phrase", "left").where(
        F.col("longer").isNull() | (F.expr("CAST(longer AS decimal(20,0)) * 100") < F.expr(f"CAST(a AS decimal(20,0)) * {int(covered)}")))
    # the words' texts
    spelled = (kept.select("*", F.posexplode(F.array(*[F.col(f"phrase.{k}") for k in key])).alias("at", "code")).where("code <> 0")
               .join(frequent.select("code", "lang", "word"), "code")
               .groupBy("phrase", "a", "l", "r", "score").agg(F.first("lang").alias("lang"),
                                                              F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words")))
    named = spelled.select("lang", F.array_join("words.word", " ").alias("phrase"), "a", "l", "r", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    few = (named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(first))
           .where(F.col("rank") <= top).drop("salt", "rank"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    size = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
