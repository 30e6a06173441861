"""Brute-force checks of operators 11 to 13 on the smallest tables and on edge rows."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.llm import collocations, conversations, pii

SF = "/root/testdata/sf0.001"


# ---- 11 personal data

def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def brute_base(text):
    found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m.group())] for k, p, ok in BASE]
    return (*map(len, found), hashlib.sha256(",".join(sum(found, [])).encode()).hexdigest())


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return pii.fit(pii.id_text(docs).withColumn("text", F.coalesce("text", F.lit(""))))


def check_base(df, model):
    want = Counter((r["doc_id"], *brute_base(r["text"])) for r in df.select("doc_id", "text").collect())
    rows = pii.find_personal_data(df, model).collect()
    assert Counter(tuple(r)[:6] for r in rows) == want
    for r in rows:
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        keys = [(pii.KINDS.index(k), int(a)) for k, a, _ in spans]
        assert keys == sorted(keys) and len(spans) == sum(r[f"n_{k}"] for k in pii.BASE) + r["n_learned"]
        base = [":".join(x) for x in spans if x[0] in pii.BASE]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
        learned = sorted((int(a), int(b)) for k, a, b in spans if k not in pii.BASE)
        assert all(x[1] <= y[0] for x, y in zip(learned, learned[1:]))
    return {r["doc_id"]: r["spans"] for r in rows}


def test_personal_data_base_equals_brute_force(spark, model):
    got = check_base(spark.read.parquet(f"{SF}/documents.parquet"), model)
    assert any("email" in v for v in got.values())


def test_personal_data_edges(spark, model):
    rng = random.Random(11)
    alphabet = "a1 .@+-()5x,%_😀é2:9"
    texts = [None, "", " ", "a@b.c_d@e.f", "a.b@c", "1.2.3.4.5.6.7.8", "0255.1.2.3 256.1.1.1 00000000000000000001.2.3.4",
             "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "+1 (743) 555-3824.", "+1.......", "+49 30 1234-5678 9",
             "7" * 60000, "a" * 60000, "1.2." * 20000, "a@" * 20000, "a@b.c " * 5000, "x" * 30000 + "@y.z", "1 " * 30000,
             "😀 mail é.x@y.zz 10.0.0.1"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(5, 60))) for _ in range(1500)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, "a@b.c")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", *[F.lit("q").alias(c) for c in ("rid", "cand", "kind", "start", "end", "p", "__m0", "features", "TEXT2")])
    check_base(df, model)
    assert pii.find_personal_data(df.where("false")).count() == 0
    assert pii.find_personal_data(df.where("doc_id = 1")).count() == 4        # a model from four rows


def test_personal_data_learned_spans(spark, model):
    rows = [(1, 'le token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" de'), (2, "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff ok"),
            (3, "her social security number 123-45-6789 is"), (4, "order 123-45-6789 was sent"), (5, "plain words only, nothing else"),
            (6, "please call (743) 555-3824 today"), (7, "THE VERSCHIEDENERLEIWORTE HERE")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(
        spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] == "secret:12:52" and got[3] == "ssn:27:38" and got[6] == "local_phone:12:26"
    assert got[2] == got[4] == got[5] == got[7] == ""


def test_personal_data_held_out_accuracy(spark, model):
    """Planted values in surroundings that the fit never saw."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 10 = 3")
    p = pii.planted(pii.id_text(docs), 60).drop("context", "held_out")
    spans = pii.scan(p.select(F.col("rid").alias("doc_id"), "text").withColumn("doc_id", F.xxhash64("doc_id")), model=model)
    hit = (spans.where("kind IS NOT NULL AND NOT base").join(p.select(F.xxhash64("rid").alias("doc_id"), "lo", "hi"), "doc_id")
           .where("start < hi AND end > lo").select("doc_id").distinct().withColumn("hit", F.lit(1)))
    # a base span in place of the value (card, ip) decides nothing here
    base = spans.where("base").select("doc_id").distinct()
    r = (p.select(F.xxhash64("rid").alias("doc_id"), (F.col("wanted") != "").cast("int").alias("label")).join(base, "doc_id", "left_anti").join(hit, "doc_id", "left")
         .groupBy("label").agg(F.avg(F.coalesce("hit", F.lit(0)))).collect())
    rate = {x[0]: x[1] for x in r}
    assert rate[1] > 0.75 and rate[0] < 0.04, rate


# ---- 12 conversations

def cheapest(word):
    """(cost, audit) by trying all edits, best by cost and then by text, from the front."""
    best = {(0, 0): (0, "")}
    goal = None
    frontier = [(0, "", 0, 0)]
    import heapq
    seen = set()
    while frontier:                                    # uniform cost; ties by the edit string
        cost, audit, i, q = heapq.heappop(frontier)
        if i == len(word) and q in (0, 3):
            return cost, audit
        if (i, q) in seen:
            continue
        seen.add((i, q))
        to = (2, 2, 3, 2)[q]
        heapq.heappush(frontier, (cost + 2, audit + "I", i, to))
        if i < len(word):
            c = word[i]
            extra = c.isupper()
            heapq.heappush(frontier, (cost + 3, audit + "D", i + 1, q))
            if c != "x":
                heapq.heappush(frontier, (cost + 2 + extra, audit + "R", i + 1, to))
                step = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[q].get(c.lower())
                if step is not None:
                    heapq.heappush(frontier, (cost + extra, audit + "K", i + 1, step))


def test_automaton_gives_the_cheapest_and_least_edits():
    rng = random.Random(3)
    words = {"".join(w) for n in range(4) for w in itertools.product("suaoxSUAO", repeat=n)}
    words |= {"".join(rng.choices("suaoxSUAO", k=rng.randint(4, 12))) for _ in range(1500)}
    got = {w: (c, a) for w, c, a in conversations.solve(iter(sorted(w[::-1] for w in words)))}
    assert set(got) == words
    for w in words:
        assert got[w] == cheapest(w), w


def brute_conversation(rows):
    """rows: (conv_id, turn, role, text). Returns {conv_id: result row}."""
    out, by = {}, defaultdict(list)
    for c, t, role, text in rows:
        by[c]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[c] += [(t, role, text)] * (2 if kind == 3 else 1)
    for c, rs in by.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, word, counts = set(), "", Counter()
        for t, role, text in rs:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-"
            seen.add((role, text))
            counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            word += "x" if fault in "bd" else initial.upper() if fault == "t" else initial
        turns = {r[0] for r in rs} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        cost, audit = cheapest(word)
        state, i, fixed = 0, 0, []
        for letter in audit:
            to = (2, 2, 3, 2)[state]
            if letter == "I":
                fixed.append(("user" if to == 2 else "assistant", ""))
                state = to
                continue
            _, role, text = rs[i]
            i += 1
            if letter == "K":
                state = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[state][role[0]]
                fixed.append((role, text))
            elif letter == "R":
                state = to
                fixed.append(("user" if to == 2 else "assistant", text))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[c] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, sha)
    return out


def check_conversations(df):
    want = brute_conversation([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair_damaged(df).collect()}
    assert got == want
    return got


def test_conversations_equal_brute_force(spark):
    got = check_conversations(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert sum(r[5] for r in got.values()) > 0


def test_conversations_edges(spark):
    rng = random.Random(5)
    rows = []
    for c in [None, -3, *range(40)]:
        for _ in range(rng.randint(0, 9)):
            rows.append((c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice([None, "", " \t\n", "Yes.", "Yes.", "no", "Ü?\x0b ", "a\x00b!", "x" * 50000])))
    rows += [(900, t, "user", "same!") for t in range(3000)]           # one long conversation
    rows += rows[:30]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *[F.lit("z").alias(c) for c in ("word", "lost", "kind", "copy", "digest", "part", "audit", "cost", "TEXT2")])
    check_conversations(df)
    assert conversations.repair_damaged(df.where("false")).count() == 0


def test_dropped_conversation_is_returned(spark):
    c = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(c, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    row = conversations.repair_damaged(df).first()
    assert tuple(row) == (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows_follow_the_grammar(spark):
    rows = conversations.damage(conversations.rows_of(spark.read.parquet(f"{SF}/conversations.parquet")))
    plans = conversations.plan(rows)
    fixed = defaultdict(list)
    for r in conversations.repaired_rows(rows, plans).orderBy("conv_id", "position").collect():
        fixed[r["conv_id"]].append(r["role"][0])
    assert fixed and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in fixed.values())


# ---- 13 collocations

def brute_collocations(rows, min_count=30, top=2000, covered=80):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        dead = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= covered * c[p[i:j]]}
        rows_ = []
        for p, a in cand.items():
            if p not in dead:
                s, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top], start=1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def check_collocations(df, **kw):
    want = brute_collocations([(r["text"], r["lang"]) for r in df.select("text", "lang").collect()],
                              **{k: v for k, v in kw.items() if k != "shard"})
    got = sorted(tuple(r) for r in collocations.mine(df, **kw).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == want
    return got


def test_collocations_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(check_collocations(docs)) > 10


def test_collocations_in_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    assert len(check_collocations(docs, min_count=8, top=20, shard=300)) > 20


def test_collocations_edges(spark):
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("one", "xx"), ("a b c d e " * 3000, "en"), ("A B, c! d\ne" * 40, "en"),
            ("x" * 30000, "en"), ("ÄÖ ß é " * 50, None), ("b c\x0bd e " * 31, "und"), ("z z z z z z " * 10, "zz")] + [("a b", "q")] * 30
    df = spark.createDataFrame(rows, "text string, lang string")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("tokens", "codes", "code", "f", "n", "word", "c1", "len", "score", "TEXT2")])
    got = check_collocations(df)
    assert ("q", 1, "a b", 30, 30, 30, 60, 1000000) in got
    assert collocations.mine(df.where("false")).count() == 0
    check_collocations(df.where("lang = 'xx'"))


def test_bitmap_holds_every_candidate_of_all_shards():
    rng = np.random.default_rng(11)
    rows = rng.integers(-(1 << 62), 1 << 62, (5000, 4))
    rows[:, 3] = 0
    bits = collocations._bitmap([rows[:1000], rows[1000:4000]], 3)

    def held(x):
        place = collocations._places([np.ascontiguousarray(x[:, j]) for j in range(3)])
        return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    assert len(bits) == 1 << (collocations.FILTER_BITS - 3)
    assert held(rows[:4000]).all() and held(rows[4000:]).mean() < 0.05
    assert held(rows[:4000, [1, 0, 2]]).mean() < 0.05            # the order of the words counts
    assert not collocations._bitmap([], 3).any()


def test_trie_accepts_its_phrases_only():
    rng = np.random.default_rng(7)
    phrases = {tuple(rng.integers(1, 40, int(rng.integers(1, 5)))) for _ in range(900)}
    rows = np.zeros((len(phrases), 4), np.int64)
    for i, p in enumerate(phrases):
        rows[i, :len(p)] = p
    rows[rows > 0] = rows[rows > 0] * 7919 - 90000          # codes of either sign
    trie, spelled = collocations.build_trie(rows)
    assert sorted(map(tuple, spelled.tolist())) == sorted(map(tuple, rows.tolist()))
    text = rng.integers(0, 42, 20000).astype(np.int64)
    codes = np.where(text > 0, text * 7919 - 90000, 0)
    for k, pos, state in collocations.advance(trie, codes, 4):
        for i, s in zip(pos, state):
            if trie.number[s] >= 0:
                assert spelled[trie.number[s]].tolist()[:k] == codes[i:i + k].tolist()
    got = {(int(i), k) for k, pos, state in collocations.advance(trie, codes, 4) for i in pos[trie.number[state] >= 0]}
    want = {(i, k) for i in range(len(text)) for k in range(1, 5) if tuple(text[i:i + k]) in phrases and i + k <= len(text)}
    assert got == want


def test_tokenizer_windows():
    """Codes do not depend on where windows and batches end, nor on neighbours."""
    import pyarrow as pa
    rng = random.Random(2)
    texts = ["", "a", "A.b", " é É\t\x00 x", "!", "w" * 700] + ["".join(rng.choices("aBé .,\n\t", k=rng.randint(0, 90))) for _ in range(300)]
    langs = [rng.choice(["en", "de", "und"]) for _ in texts]

    def tokens(text, lang):
        out = []
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)):
            out += [0] + [(lang, w) for w in re.findall(r"[^\x20\x09]+", piece)]
        return out
    want = sum((tokens(t, n) for t, n in zip(texts, langs)), [])
    want = [x for x, y in zip(want, [None] + want) if x or y]
    for size in (1, 7, 64, 1 << 20):
        tok, got, names = collocations.Tokenizer(0), [], {}
        for i in range(0, len(texts), 50):
            b = pa.RecordBatch.from_arrays([pa.array(texts[i:i + 50]), pa.array(langs[i:i + 50])], ["text", "lang"])
            for codes, code, rest, lang, (x, starts, ends) in tok.windows(b, size):
                got += codes.tolist()
                for c, n, s, e in zip(code.tolist(), lang.tolist(), starts, ends):
                    assert names.setdefault(c, (tok.langs[n], x[s:e].tobytes().decode())) == (tok.langs[n], x[s:e].tobytes().decode())
        assert [names.get(x, 0) for x, y in zip(got, [None] + got) if x or y] == want, size
        rows = []
        for i in range(0, len(texts), 50):
            b = pa.RecordBatch.from_arrays([pa.array(texts[i:i + 50]), pa.array(langs[i:i + 50])], ["text", "lang"])
            rows += [r.tolist() for r in collocations.whole_pieces(w[0] for w in tok.windows(b, size))]
        assert all(r[-1] == 0 for r in rows)
        got = [0] + [names.get(x, 0) for r in rows for x in r]
        got = [x for x, y in zip(got, [None] + got) if x or y]
        assert got == (want if want[-1] == 0 else want + [0]), size
