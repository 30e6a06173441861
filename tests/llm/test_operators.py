"""Brute-force checks of the training-data operators on the smallest tables and on edge rows."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardstat.llm import (graph, licenses, mixing, nearest, packing, sharding, simhash, spotsigs, token_count,
                          toxicity, url_filter)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "The cat of the hill and the dog in the barn."),
        (5, "The cat of the hill and the dog in the barn."), (6, "The cat of the hill and the dog in the barn."),
        (None, "a row without an id"), (None, None), (7, "ÄÖ ß é " * 50), (8, "word " * 5000),
        (9, "  two  blanks \n and lines\n\n"), (10, "x" * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", None if i == 4 else "s%d" % ((i or 0) % 3), len(t or "")) for i, t in EDGE]
    d = spark.createDataFrame(rows, SCHEMA)
    # extra columns whose names clash with what the operators add
    return d.select("*", *[F.lit("x").alias(c) for c in ("size", "shard", "slot", "h", "bucket", "fp", "node", "score", "rank",
                                                  "sigs", "grp", "row", "key", "TEXT", "sid", "at", "target")])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def both(docs, edge):
    return [docs, edge]


# ---- 1 toxicity

def test_segments_equal_the_recursive_definition():
    def brute(x):                       # all maximal scoring segments, by their definition
        out = []

        def rec(lo, hi):
            best, where = 0.0, None
            for i in range(lo, hi):
                s = 0.0
                for j in range(i, hi):
                    s += x[j]
                    if s > best + 1e-12 or (where and abs(s - best) <= 1e-12 and j - i < where[1] - where[0]):
                        best, where = s, (i, j)
            if where:
                rec(lo, where[0])
                out.append((*where, round(best, 6)))
                rec(where[1] + 1, hi)
        rec(0, len(x))
        return out
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 25))
        hits = [(i, float(rng.integers(1, 400)) / 97) for i in range(n) if rng.random() < 0.35]
        x = [-0.5] * n
        for i, s in hits:
            x[i] = s
        assert [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(hits, 0.5)] == brute(x)


def test_lambda_solves_its_equation():
    lam = toxicity.solve_lambda([3.0, 5.0], [0.01, 0.001], 0.5)
    assert abs(0.01 * math.exp(3 * lam) + 0.001 * math.exp(5 * lam) + 0.989 * math.exp(-0.5 * lam) - 1) < 1e-6


@pytest.mark.parametrize("x", [[], [2.0], [-3.0], [5.0, 1.0, 0.2], [0.5] * 12, [40.0, 3.0], [-1.0] * 30])
def test_toxicity_evidence_is_the_poisson_chance(x):
    chances = []
    for r, v in enumerate(sorted(x, reverse=True), 1):
        mean = math.exp(-v)
        if mean <= r:
            chances.append(sum(math.exp(-mean) * mean ** k / math.factorial(k) for k in range(r, r + 60)))
    p = min([*(c * len(chances) for c in chances), *([math.exp(-max(x)) * max(1, len(chances))] if x else [])],
            default=None)
    assert toxicity.evidence(x) == pytest.approx(math.log1p(1 / p) if x else 0.0, rel=1e-9)


def test_each_word_counts_once_in_a_segment():
    rng = np.random.default_rng(7)
    for _ in range(200):
        at, hits = 0, []
        for _ in range(int(rng.integers(1, 14))):
            w = int(rng.integers(0, 5))
            hits.append((f"w{w}", at, 0.3 + 1.1 * w))
            at += int(rng.integers(1, 6))
        want = 0.0
        for i in range(len(hits)):
            for j in range(i, len(hits)):
                d = {w: s for w, _, s in hits[i:j + 1]}
                want = max(want, sum(d.values()) - 0.5 * (hits[j][1] - hits[i][1] + 1 - len(d)))
        assert toxicity.once_each(hits) == pytest.approx(want)


def test_toxic_passage_after_isolated_uses():
    bad = ["idiot", "moron", "scum", "filth"]
    model = toxicity.Model(dict.fromkeys(bad, 6.0), lam=1.0, k=0.05, base=0.02)
    alone = [w for b in bad for w in [b, *["x"] * 40]]
    passage = alone + bad
    assert max(s for *_, s in model.segments(passage)) == pytest.approx(24.0)
    assert toxicity.score_words(passage, model) > 0.99 > toxicity.score_words(alone[:41] + ["x"] * 127, model)
    assert model.segments(["idiot"] * 50) == [(0, 49, 6.0)]


def test_toxicity_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.score_documents(d, lab).collect()}
    assert len(got) == d.count()
    y = [(r["toxic"], got[r["doc_id"]]) for r in lab.collect()
         if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["doc_id"] in got]
    assert all(g["held_out"] for _, g in y) and len(y) > 500
    hit = Counter((t, g["predicted"]) for t, g in y)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.9
    assert hit[0, 1] / (hit[0, 1] + hit[0, 0]) < 0.02
    pos, neg = [g["score"] for t, g in y if t], [g["score"] for t, g in y if not t]
    auc = np.mean([[(p > q) + 0.5 * (p == q) for q in neg] for p in pos])
    assert auc > 0.97


def test_toxicity_edges(spark, docs, edge, empty):
    lab = spark.createDataFrame([(1, 0), (2, 0), (3, None), (None, 1), (5, 1), (6, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge, lab)
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(docs, lab.where("false"))
    assert not none.scores and all(r["score"] < 0.3 for r in toxicity.score(docs, none).collect())
    loud = toxicity.Model({"idiot": 6.0}, lam=1.0, k=0.01, base=0.02)
    found = toxicity.passages(spark.createDataFrame([(1, "you IDIOT, idiot there " + "x " * 50)], "doc_id long, text string"),
                              loud).collect()
    assert [(r["first_word"], r["last_word"], r["passage"]) for r in found] == [(1, 2, "idiot, idiot")]
    kept = toxicity.keep_clean(edge, loud)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


# ---- 2 sharding

@pytest.mark.parametrize("n", [40, 3])
def test_shards(docs, edge, empty, n):
    for d in (docs, edge, empty):
        src = sorted(((r["doc_id"], r["text"]) for r in d.collect()), key=str) if d is docs else None
        rows = sharding.histogram_shards(d, n).collect()
        assert len(rows) == d.count()
        if src:
            assert sorted(((r["doc_id"], r["text"]) for r in rows), key=str) == src
        slots = defaultdict(list)
        for r in rows:
            assert r["size"] == len((r["text"] or "").encode()) + 16
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        by = Counter()
        for r in rows:
            by[r["shard"]] += r["size"]
        if rows:
            # the splitters sit at the key boundaries nearest to their targets
            assert max(by.values()) <= sharding.balance_limit(sum(by.values()), n, 2 * max(r["size"] for r in rows))


def test_hot_text_is_divided(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"),
                                 F.when(F.col("id") % 3 > 0, F.lit("the same words")).otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    rows = sharding.shard_documents(d).collect()
    by = Counter()
    for r in rows:
        by[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(by) == set(range(40)) and max(by.values()) <= 1.03 * sum(by.values()) / 40


# ---- 3 mixing

def brute_targets(sizes):
    w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    fixed, total = {}, 1.5 * sum(sizes)
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed and sizes[i]]
        if not open_:
            break
        scale = (total - sum(fixed.values())) / sum(w[i] for i in open_)
        over = [i for i in open_ if w[i] * scale > 2 * sizes[i]]
        if not over:
            return [fixed.get(i, w[i] * scale if sizes[i] else 0.0) for i in range(len(sizes))]
        fixed.update({i: 2.0 * sizes[i] for i in over})
    return [fixed.get(i, 0.0) for i in range(len(sizes))]


@pytest.mark.parametrize("block", [256, 7])
def test_mix(docs, edge, empty, block):
    for d in (docs, edge):
        text = d.columns.index("text")
        raw = [(r["doc_id"], r[text], r["source"]) for r in d.collect()]
        size = Counter()
        for _, t, s in raw:
            size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
        want = dict(zip(order, brute_targets([size[s] for s in order])))
        places, pieces = mixing.mix(d, block)
        places, pieces = places.collect(), pieces.collect()
        assert len(places) == len(raw)
        taken, per_row, per_slot = Counter(), Counter(), Counter()
        source = {r["row_index"]: r for r in places}
        for p in pieces:
            r = source[p["row_index"]]
            taken[r["source"]] += p["words"]
            per_row[p["row_index"]] += p["words"]
            per_slot[p["slot"]] += p["words"]
            assert 0 <= p["start"] and p["start"] + p["words"] <= r["size"]
        for r in places:
            assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
            assert per_row[r["row_index"]] <= 2 * r["size"]
        assert all(taken[s] == int(want[s] + 1e-9) or abs(taken[s] - want[s]) <= 1 for s in want)
        assert sum(n != block for n in per_slot.values()) <= len(want)
    assert mixing.mix_documents(empty).count() == 0
    assert mixing.repeat_documents(docs).columns == docs.columns
    assert mixing.repeat_documents(empty).count() == 0


def test_every_prefix_of_the_mix_is_near_the_shares(docs):
    rows = mixing.mix_documents(docs).where("taken > 0").collect()
    places, pieces = mixing.mix(docs)
    source = {r["row_index"]: (r["source"], r["target"]) for r in places.collect()}
    goal = dict(source.values())
    words, slots = defaultdict(Counter), defaultdict(set)
    for r in pieces.collect():
        words[r["slot"]][source[r["row_index"]][0]] += r["words"]
        slots[r["doc_id"]].add(r["slot"])
    assert all(len(c) == 1 for c in words.values())
    got: Counter = Counter()
    for s in sorted(words):
        got.update(words[s])
        n = sum(got.values())
        for k, g in goal.items():
            assert abs(got[k] - n * g / sum(goal.values())) <= 4 * mixing.BLOCK
    assert {r["doc_id"]: (r["first_slot"], r["last_slot"], r["n_slots"]) for r in rows} == \
        {i: (min(s), max(s), len(s)) for i, s in slots.items() if i in {r["doc_id"] for r in rows}}


def test_mixed_documents_come_in_the_order_of_their_slots(docs):
    places, pieces = mixing.mix(docs)
    size = {r["row_index"]: r["size"] for r in places.collect()}
    passes = defaultdict(list)
    for r in pieces.collect():
        passes[r["row_index"], r["doc_id"], r["pass"]].append((r["slot"], r["words"]))
    want = sorted((min(p)[0], i) for (row, i, _), p in passes.items() if 2 * sum(n for _, n in p) >= size[row])
    got = [r["doc_id"] for r in mixing.repeat_documents(docs).select("doc_id").collect()]
    slot_of = defaultdict(list)
    for s, i in want:
        slot_of[i].append(s)
    seen: Counter = Counter()
    order = []
    for i in got:
        order.append(slot_of[i][seen[i]])
        seen[i] += 1
    assert order == sorted(order) and len(got) == len(want)


def test_schedule_is_low_discrepancy_and_repeatable(spark, docs):
    goal = [600.0, 300.0, 100.0]
    a = mixing.schedule(spark, [600, 300, 100], goal).orderBy("slot").collect()
    assert a == mixing.schedule(spark, [600, 300, 100], goal).orderBy("slot").collect()
    seen = Counter()
    for i, r in enumerate(a[:990]):
        assert r["rank"] == seen[r["sid"]]
        seen[r["sid"]] += 1
        assert all(abs(seen[s] - (i + 1) * goal[s] / 1000) < 4 for s in range(3))


# ---- 4 SpotSigs

def brute_sigs(text):
    words = [w for w in re.sub(r"[^\w]|_", " ", (text or "").lower()).split()]
    if not words:
        return frozenset()
    if len(words) == 1:
        return frozenset(words)
    stop, spots = set(spotsigs.ANCHORS), []
    for i, w in enumerate(words):
        if w in stop:
            chain = [x for x in words[i + 1:] if x not in stop][:2]
            if len(chain) == 2:
                spots.append((w, *chain))
    if spots:
        return frozenset(spots)
    return frozenset(zip(words, words[1:]))


def test_spotsigs(docs, edge):
    for d in (docs, edge):
        text = d.columns.index("text")
        raw = [(r["doc_id"], r[text] or "") for r in d.collect()]
        got = spotsigs.compare_with_edits(d).collect()
        assert len(got) == len(raw)
        if d is edge:
            assert {r["fingerprint"] for r in got if r["doc_id"] in (5, 6)}.__len__() == 1
            by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
            none = hashlib.sha256(b"").hexdigest()
            assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == none
            assert by_id[1]["n_chars"] == by_id[2]["n_chars"] == 0
            assert by_id[1]["near_next"] == by_id[2]["near_next"] == 1.0 and by_id[3]["near_next"] == 0.0
            assert by_id[4]["fingerprint"] != none and by_id[4]["near_next"] == 0.0
            assert by_id[6]["near_next"] == 0.0 and by_id[6]["n_chars"] == 44
            own = {i: t or "" for i, t in raw if i is not None}
            for i in (6, 7, 8, 9):
                e = own[i][:len(own[i]) - len(own[i]) // 4] + own[i + 1][:len(own[i]) // 4]
                a, b = brute_sigs(own[i]), brute_sigs(e)
                assert by_id[i]["near_edited"] == pytest.approx(len(a & b) / len(a | b), abs=1e-9)
            continue
        raw.sort()
        nxt = {i: raw[(k + 1) % len(raw)][1] for k, (i, _) in enumerate(raw)}
        own = dict(raw)

        def like(a, b):
            return 1.0 if not a and not b else len(a & b) / len(a | b)
        for r in got:
            t, n = own[r["doc_id"]], nxt[r["doc_id"]]
            q = len(t) // 4
            e = t[:len(t) - q] + n[:q]
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
            assert r["near_edited"] == pytest.approx(like(brute_sigs(t), brute_sigs(e)), abs=1e-9)
            assert r["near_next"] == pytest.approx(like(brute_sigs(t), brute_sigs(n)), abs=1e-9)
            assert (r["fingerprint"] == r["edited_fingerprint"]) == (brute_sigs(t) == brute_sigs(e))


def test_spotsigs_many_buckets(docs, monkeypatch):
    one = {tuple(r) for r in spotsigs.compare_with_edits(docs).collect()}
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", 20_000)
    assert {tuple(r) for r in spotsigs.compare_with_edits(docs).collect()} == one
    monkeypatch.setattr(spotsigs, "MAX_BROADCAST_HEADS", 0)
    monkeypatch.setattr(spotsigs, "MAX_TASKS", 3)
    assert {tuple(r) for r in spotsigs.compare_with_edits(docs).collect()} == one
    monkeypatch.setattr(spotsigs, "MAX_CUTS", 4)
    assert {tuple(r) for r in spotsigs.compare_with_edits(docs).collect()} == one
    assert spotsigs.compare_with_edits(docs.where("false")).count() == 0
    single = spotsigs.compare_with_edits(docs.limit(1)).first()
    assert single["near_next"] == 1.0


def test_spotsigs_keeps_the_signatures_of_sparse_texts(spark):
    plain = [f"w{i}" for i in range(60)]
    spotted = plain[:5] + ["the"] + plain[5:]                 # one signature in 61 words
    texts = [" ".join(spotted), " ".join(spotted[:40] + ["other"] * 5 + spotted[45:]), " ".join(plain)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in spotsigs.fingerprints(d).collect()}
    assert [len(got[i]["signatures"]) for i in range(3)] == [1, 1, 59]
    assert got[0]["signatures"] == got[1]["signatures"]
    rows = {r["doc_id"]: r for r in spotsigs.compare_with_edits(d).collect()}
    assert rows[0]["near_next"] == 1.0 and rows[0]["near_edited"] == 1.0
    for lang in ("и дом стоит", "και μεγάλο σπίτι", "yang besar rumah", "return value count"):
        one = spark.createDataFrame([(1, "kk " * 20 + lang)], "doc_id long, text string")
        assert len(spotsigs.fingerprints(one).first()["signatures"]) == 1


def test_spotsigs_runs_of_anchors_take_linear_time(spark):
    import time
    texts = ["the a " * 50 + "cat of to dog in " + "bird of the " * 3, "a " * 200_000 + "cat dog", "a " * 200_000,
             "a " * 50_000 + "cat " + "the " * 50_000, "x " + "a " * 50_000 + "yy zz"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: r["signatures"] for r in spotsigs.fingerprints(d).collect()}
    assert time.time() - began < 30
    assert [len(got[i]) for i in range(5)] == [len(brute_sigs(texts[0])), 1, 1, 4, 1]


# ---- 5 packing

def test_packing_round_trip(docs, edge, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    for d in (docs, edge):
        text = d.columns.index("text")
        want = Counter()
        for r in d.collect():
            ids = np.array(tok.encode(r[text] or "", add_special_tokens=False).ids + [1], dtype="<u4")
            for s in range(0, len(ids), 2048):
                want[r["doc_id"], s, zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)] += 1
        rows = packing.pack_documents(d).collect()
        assert Counter((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
        seqs = defaultdict(list)
        for r in rows:
            seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        for s in seqs.values():
            s.sort()
            assert [o for o, _ in s] == np.cumsum([0, *[n for _, n in s[:-1]]]).tolist()
            assert sum(n for _, n in s) <= 2048 and len(s) <= packing.MAX_SEGMENTS
        used = sum(r["length"] for r in rows)
        if d is docs:
            assert used / (2048 * len(seqs)) > 0.97
    assert packing.pack_documents(empty).count() == 0


def test_packing_emits_added_tokens(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())       # as it is in the file
    enc = packing.Encoder.of(packing.tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y \n", "<|endoftext|" * 3, "no token",
             "z" * 5000 + "<|endoftext|>" + "z" * 3000] + [r["text"] for r in docs.limit(50).collect()]
    for t in texts:
        assert np.frombuffer(enc.ids(t), dtype="<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    row = packing.pack_documents(spark.createDataFrame([(1, texts[0])], "doc_id long, text string")).first()
    assert row["doc_tokens"] == 5


def test_fill_respects_every_limit():
    rng = np.random.default_rng(5)
    demand = np.column_stack([rng.integers(1, 900, 500), np.ones(500), rng.integers(0, 300, 500)]).astype(float)
    limits = np.array([2048.0, 6, 500])
    seq, pos = packing.fill(demand, limits)
    for s in range(seq.max() + 1):
        mine = seq == s
        assert (demand[mine].sum(axis=0) <= limits + 1e-6).all() and sorted(pos[mine]) == list(range(mine.sum()))
    with pytest.raises(ValueError):
        packing.fill(np.array([[3000.0, 1, 1]]), limits)


def test_full_pieces_keep_the_loss_limit(spark):
    d = spark.createDataFrame([(1, 0, 8, 7), (2, 0, 3, 2)], "doc_id long, start long, length long, loss_tokens long")
    assert packing.pack(d, capacity=8, max_loss=7).count() == 2
    with pytest.raises(ValueError):
        packing.pack(d, capacity=8, max_loss=5)


# ---- 6 licenses

def test_licenses(docs, edge, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d in (docs, edge):
        text = d.columns.index("text")
        own = defaultdict(set)
        for r in d.collect():
            words = word.findall((r[text] or "").translate(lower))
            at, labels = [], set()
            for p, label in licenses.BASE:
                p = p.split()
                got = [i for i in range(len(words)) if words[i:i + len(p)] == p]
                at += got
                labels |= {label} if got else set()
            own[r["doc_id"]].add((len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
        rows = licenses.scan_documents(d).collect()
        assert len(rows) == d.count()
        for r in rows:
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in own[r["doc_id"]]
            labels = r["labels"].split(",") if r["labels"] else []
            assert labels == sorted(set(labels)) and set(filter(None, r["base_labels"].split(","))) <= set(labels)
            assert 0 <= r["score"] <= 1
    assert licenses.scan_documents(empty).count() == 0


def test_license_notices(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "x y\nLicensed under the Apache License, Version 2.0.", "apache license 1.1",
             "This work is licensed under the GNU General Public License, version 3.", "by the nc of cc 4.0 under license"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_documents(d).collect()}
    assert [got[i]["labels"] for i in range(5)] == ["cc-by-nc-4.0", "apache,apache-2.0", "apache", "gpl,gpl-3.0", ""]
    assert got[0]["score"] == pytest.approx(1.0) and got[1]["matches"][0]["first_word"] == 2


def test_license_phrases_in_other_wording(spark):
    texts = ["Licensed under the Mozilla Public License, version 2.0", "see GNU Affero General Public License"]
    # whatever the other files make rare: every text that holds a phrase has its label
    for others in ([], ["mozilla public license"] * 30, ["subject to v"] * 30, ["affero lesser cc"] * 30):
        d = spark.createDataFrame(list(enumerate(texts + others)), "doc_id long, text string")
        got = {r["doc_id"]: r["labels"] for r in licenses.scan_documents(d).collect()}
        assert got[0] == "mpl-2.0" and got[1] == "agpl-3.0,gpl"
    every = licenses.Index({})
    for t in licenses.TEMPLATES:
        assert t.label in every.scan(licenses.words_of("x " + t.mandatory[0] + " y"))[0]


# ---- 7 SimHash

def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs, edge, empty):
    for d in (docs, edge.where("doc_id IS NOT NULL")):
        text = d.columns.index("text")
        fp = {r["doc_id"]: brute_fp(r[text]) for r in d.collect()}
        want = brute_components(fp, [(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 3])
        got = simhash.label_documents(d).collect()
        assert len(got) == d.count()
        for r in got:
            assert r["fingerprint"] == f"{fp[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]]
    assert simhash.label_documents(empty).count() == 0
    rows = simhash.label_documents(edge).collect()
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None, 1}


@pytest.mark.parametrize("max_block", [4096, 8])
def test_links_keep_every_component(spark, max_block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(map(int, base))
    for f in list(map(int, base)) + [int(base[0])] * 200:       # chains and one large family
        for _ in range(3):
            f ^= sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False))
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, node long")
    links = simhash.links(nodes, max_block=max_block)
    got = dict(graph.components(links).collect())
    want = brute_components(range(len(fps)), [(a, b) for a, b in combinations(range(len(fps)), 2)
                                              if (fps[a] ^ fps[b]).bit_count() <= 3])
    assert {n: got.get(n, n) for n in want} == want


def test_keep_one(spark):
    t = "some words that stand here in a row and go on for a while until they end"
    d = spark.createDataFrame([(3, t), (1, t), (1, t), (2, "quite another text, not near the first one at all"), (None, t)],
                              "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(d).collect()) == ["1", "2", "None"]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}}


# ---- 8 URL rules

def test_urls(spark):
    urls = [None, "", "no scheme", "http://net", "http://net/", "HTTP://A.Net/EN/", "https://x.example.net/en/1?q=//a#f",
            "http://example.net/en", "http://my-example.net/en/", "http://m.example.com/de/x", "http://example.com/DE/",
            "ftp://ORG/fr/", "http://a.org/fr?x", "http://a.b.org/fr/#t", "x://y://net/", "http://a\nb.net/p", "://.net/"]
    d = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, "http://net")], "page_id long, url string")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

    def judge(u):
        host = path = ""
        if u and "://" in u:
            m = re.match(r"(?s)([^/?#]*)([^?#]*)", u.split("://", 1)[1])
            host, path = m[1].lower(), m[2]
        fit = [(len(h) + len(p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]
    got = url_filter.judge_pages(d).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(urls[r["page_id"]])
    assert url_filter.judge_pages(d.where("false")).count() == 0


def test_url_regex_rules(spark):
    d = spark.createDataFrame([(1, "http://a.com/x/ads/1"), (2, "http://a.com/x/b"), (3, "http://c.io/ads")], "page_id long, url string")
    got = url_filter.judge(d, [url_filter.Rule("block", "", "/", r"\bads\b"), url_filter.Rule("allow", "c.io")]).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow", 3: "allow"}
    assert {r["verdict"] for r in url_filter.judge(d, [], "block").collect()} == {"block"}


# ---- 9 nearest neighbours

def exact_nearest(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_nearest_recall(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = d.collect()
    want = exact_nearest(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64))
    got = defaultdict(list)
    for r in nearest.search(d).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == set(want)
    exact = {(q, v): s for q, n in want.items() for v, s in n}
    hit = sum((q, v) in exact for q, n in got.items() for v, _ in n)
    assert hit / len(exact) >= 0.9
    assert all(abs(exact[q, v] - s) < 1e-9 for q, n in got.items() for v, s in n if (q, v) in exact)


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]),
            (None, [1.0, 1.0]), (120, []), (140, [1.0])] + [(i, [2.0, 1.0]) for i in range(200, 260)] + [(3, [0.5, 0.1])] * 2
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    got = defaultdict(list)
    for r in nearest.search(d).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    keep = [(i, v) for i, v in dict((i, v) for i, v in rows if i is not None).items()
            if v and len(v) == 2 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    want = exact_nearest(np.array([i for i, _ in keep]), np.array([np.float32(v) for _, v in keep], dtype=np.float64))
    assert dict(got) == {q: [v for v, _ in n] for q, n in want.items()}
    assert nearest.search(d.where("false")).count() == 0


# ---- 10 token counts

def test_token_counts(docs, edge, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocab = token_count.vocabulary()
    tok = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_count.BLANK, prepend_scheme="always")
    for d in (docs, edge):
        text = d.columns.index("text")
        want = defaultdict(set)
        for r in d.collect():
            want[r["doc_id"]].add(len(tok.encode(r[text] or "").ids))
        got = token_count.count_tokens(d).collect()
        assert len(got) == d.count() and all(r["n_tokens"] in want[r["doc_id"]] for r in got)
    assert token_count.count_tokens(empty).count() == 0


def test_token_count_ties():
    vocab = [("<unk>", -9.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -4.0), ("c", -2.0), (token_count.BLANK, -0.5)]
    from tokenizers import Tokenizer, models
    tok = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False))
    c = token_count.Counter(vocab)
    for w in ("ab", "abc", "aabbcc", "abcab", "cab"):
        assert c.word(w)[0] == len(tok.encode(w).ids)
