"""Language model, ranked search and vector codes against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import lm_scoring, ranked_search, vector_codes
from starmart.llm.queries import QUERIES
from starmart.llm.store import table, written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# -- vector codes --------------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) and the codebooks, in plain Python integers."""
    kept = [
        (i, [math.floor(4096 * x) for x in v], label, v)
        for i, v, label in rows
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w : (p + 1) * w] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            fresh.append([
                [sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else e
                for k, e in enumerate(books[p])
            ])
        books = fresh
    out, by_label = [], Counter()
    for (i, _, label, _), c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    numbers = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=str), digest


def test_codes_are_exact(spark):
    """Ties, copies, negative halves, nulls in every column, vectors that cannot be cut."""
    rng = random.Random(3)
    centres = [[rng.uniform(-0.3, 0.3) for _ in range(16)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(300)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[8][1], 0), (301, [0.0] * 16, None)]
    rows += [(400 + i, rows[20][1], 2) for i in range(90)]
    rows += [(500, None, 1), (501, [], 1), (502, [1.0] * 15, 1), (503, [0.1] * 15 + [None], 1)]
    rows += [(504, [0.1] * 15 + [float("nan")], 1), (505, [float("-inf")] * 16, 1), (506, [0.5] * 24, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "1 AS code", "2 AS error", "'x' AS n").repartition(5)
    want, digest = brute_codes(rows)
    codes, books = vector_codes.compress(df)
    got = vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error")
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert vector_codes.books_digest(books) == digest


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.25] * 8, 1)], "vec_id long, embedding array<float>, label int")
    codes, books = vector_codes.compress(few)
    assert books.shape == (8, 2, 1)
    assert sorted(r["code"] for r in codes.collect()) == ["00" * 8, "01" * 8]
    codes, books = vector_codes.compress(few.limit(0))
    assert books is None and codes.count() == 0
    with pytest.raises(Exception, match="64-bit"):
        vector_codes.compress(few.unionByName(few.selectExpr("3L AS vec_id", "array_repeat(float(1e9), 8) AS embedding", "label")))


def test_blocks_skip_parts_and_lose_nothing():
    """Shortlists hold the nearest entry of each part, and settle blocks of close parts alone."""
    rng = np.random.default_rng(5)
    points = np.concatenate([c + rng.integers(-30, 30, (400, 8)) for c in rng.integers(-2000, 2000, (6, 8))])
    points = points[vector_codes.curve_order(points)]
    book = points[:: len(points) // 16][:16]
    blocks = vector_codes.Blocks(points)
    distance = np.square(points[:, None] - book[None]).sum(axis=2)
    at, entry, best = blocks.assigned(book)
    assert (entry == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()
    assert blocks.shortlists(book).sum() < 0.5 * len(blocks.low) * len(book)
    moments = blocks.moments(book)
    assert all((moments[e, 1:] == points[entry == e].sum(axis=0)).all() for e in range(16))
    assert moments[:, 0].sum() == len(points)


@pytest.mark.parametrize("d, bits", [(2, 4), (3, 3), (8, 2)])
def test_curve_visits_every_cell_by_single_steps(d, bits):
    cells = np.indices((1 << bits,) * d).reshape(d, -1).T
    keys = vector_codes.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(1 << (bits * d)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# -- ranked search -------------------------------------------------------------------------


def brute_search(docs, items, top=10):
    words = [(d, [w.translate(LOWER) for w in TERM.findall(t or "")]) for d, t in docs]
    total, length = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        asked = Counter(w.translate(LOWER) for w in TERM.findall(text or ""))
        found = []
        for d, w in words:
            tf, m = Counter(w), 25 + (75 * len(w) * total) // max(length, 1)
            score = sum(
                n * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, n in asked.items() if tf[t])
            if score > 0:
                found.append((-score, d is None, d or 0))
        found = heapq.nsmallest(top, found)
        out += [(item, k + 1, None if no else d, -s) for k, (s, no, d) in enumerate(found)]
    return sorted(out, key=str)


def searched(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS term").repartition(4)
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS rank")
    return sorted((tuple(r) for r in ranked_search.search(df, queries).collect()), key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    """Several segments a task, ties by the dozen, repeated words, other scripts, copies, nulls."""
    monkeypatch.setattr(ranked_search, "LEAF", 3)
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 20, 60])))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [docs[9], docs[9], (None, docs[5][1]), (3000, None), (3001, ""), (None, None)]
    docs += [(4000, "Ünï 漢字 W1,w1;W1"), (4001, "w2 " * 3000), (4002, "\x00\x7f !?")]
    items = [(k, " ".join(rng.choices(vocabulary, k=12))) for k in range(25)]
    items += [(100, "漢字 ünï"), (101, docs[5][1]), (102, None), (103, "?!"), (104, "nowhere"), (None, "w1 w2"), items[0]]
    want = brute_search(docs, items[:-1])
    assert searched(spark, docs, items) == want
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []


def test_search_skips_documents_and_no_better_one():
    """A segment's search scores few documents where one term is rare, and misses none."""
    rng = np.random.default_rng(2)
    segment = object.__new__(ranked_search.Segment)
    n = 4000
    segment.ids, segment.has, segment.lists = np.arange(n), np.ones(n, bool), {}
    impact = np.zeros((3, n), np.int64)
    impact[0, rng.choice(n, 3000, replace=False)] = rng.integers(1, 50, 3000)
    impact[1, rng.choice(n, 800, replace=False)] = rng.integers(1, 500, 800)
    impact[2, rng.choice(n, 15, replace=False)] = rng.integers(5000, 9000, 15)
    for t in range(3):
        slots = np.flatnonzero(impact[t])
        segment.lists[t] = ranked_search.Postings(slots, impact[t, slots])
    segment.range = {}
    best = ranked_search.Best(10)
    scored = segment.search({0: 1, 1: 2, 2: 1}, best)
    total = impact[0] + 2 * impact[1] + impact[2]
    assert best.found == sorted((-int(total[d]), False, int(d)) for d in range(n))[:10]
    assert scored < n / 4


def test_range_maxima(spark):
    rng = np.random.default_rng(4)
    slots = np.sort(rng.choice(1000, 137, replace=False))
    impacts = rng.integers(1, 30, 137)
    postings = ranked_search.Postings(slots, impacts)
    first = rng.integers(0, 1000, 500)
    last = np.minimum(first + rng.integers(0, 400, 500), 1000)
    got, doc = postings.largest(first, last)
    for a, b, v, d in zip(first, last, got, doc, strict=True):
        inside = impacts[(slots >= a) & (slots < b)]
        assert v == inside.max(initial=0)
        assert (d == -1) == (len(inside) == 0) and (d == -1 or a <= d < b)


def test_search_in_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 2)
    docs = [(i, f"common a{i % 7} b{i % 3}") for i in range(50)]
    items = [(k, f"a{k} b{k} common") for k in range(6)]
    assert searched(spark, docs, items) == brute_search(docs, items)


# -- language model ------------------------------------------------------------------------


def brute_counts(docs):
    words = [(d, WORD.findall((t or "").translate(LOWER))) for d, t in docs]

    def held(d):
        return d is not None and zlib.crc32(str(d).encode()) % 5 == 1

    counts = Counter(w for d, ws in words if not held(d) for w in ws)
    ends = sum(not held(d) for d, _ in words)
    total, distinct = counts.total() + ends, len(counts) + (ends > 0)

    def log(c):
        return math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))

    out = []
    for d, ws in words:
        known = sum(counts[w] > 0 for w in ws) + (ends > 0)
        out.append((d, held(d), len(ws) + 1, known, total, sum(log(counts[w]) for w in ws) + log(ends)))
    return out


def scored(df, **options):
    rows = lm_scoring.score(df, **options).collect()
    return [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows], rows


def close(got, want):
    key = lambda r: (str(r[:5]), round(r[5], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    return len(got) == len(want) and all(
        a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("dictionary", [0, 40, 100_000])
def test_counts_and_base_score(spark, odd_docs, monkeypatch, dictionary):
    """Whatever part of the words the dictionary holds."""
    monkeypatch.setattr(lm_scoring, "LONGEST", 12)
    whole = lm_scoring.vocabulary
    monkeypatch.setattr(lm_scoring, "vocabulary", lambda c, e, s, n: whole(c, e, s, n, dictionary))
    extra = spark.createDataFrame([(i, f"word{i % 9} word{i % 4} rare{i} tail") for i in range(60)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text", F_int("n_words"), "kept").unionByName(extra, allowMissingColumns=True)
    got, rows = scored(docs, single=10, endings=5, rounds=2)
    assert close(got, brute_counts([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def F_int(name):
    from pyspark.sql import functions as F

    return F.col(name).alias("round")


def test_nothing_to_score_and_nothing_to_learn(spark, no_docs):
    assert lm_scoring.score(no_docs).count() == 0
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    held = spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string")
    got, rows = scored(held)
    assert close(got, brute_counts([(i, "a b c") for i in ids]))
    assert {r["n_known"] for r in rows} == {0} and {r["train_tokens"] for r in rows} == {0}


def test_probabilities_sum_to_one(spark):
    """Over all classes after any context, and over a class's words and one unseen."""
    rng = np.random.default_rng(0)
    share = rng.random(37)
    model = lm_scoring.LogBilinear.start(share / share.sum(), 6)
    model = model.filled(model.flat() + rng.normal(0, 0.7, model.flat().shape))
    near, far, z = model.tables()
    p = np.exp(near[:, None, :].astype(float) + far[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-5)
    slow = (model.context[3] @ model.place[0] + model.context[8] @ model.place[1]) @ model.target.T + model.bias
    assert np.allclose(near[3] + far[8], slow, atol=1e-4)
    counts = spark.createDataFrame([(f"w{i}x{'ab'[i % 2]}".encode(), 50 - i) for i in range(45)], "word binary, c long")
    known = lm_scoring.vocabulary(written(counts, "counts"), 9, single=7, endings=1)
    logs = known.log_shares()
    assert known.class_tokens.sum() == known.tokens and known.class_words.sum() == known.distinct
    own, ending = known.numbers()
    inside = Counter()
    for i in range(45):
        w, c = f"w{i}x{'ab'[i % 2]}".encode(), 50 - i
        if w not in own:
            inside[ending.get(w[-2:], known.classes - 1)] += (c + 0.5) / 10 ** logs[ending.get(w[-2:], known.classes - 1)]
    for k in inside:
        assert math.isclose(inside[k] + 0.5 / 10 ** logs[k], 1)


def test_noise_contrast_learns_what_follows_what():
    """Classes that follow each other by rule become likely after each other."""
    rng = np.random.default_rng(1)
    n = 12
    texts = [(np.arange(60) * 5 + rng.integers(n)) % n for _ in range(150)]
    share = np.full(n, 1 / n)
    model = lm_scoring.LogBilinear.start(share, 8)
    for k in range(4):
        trainer = lm_scoring.Trainer(model, share, k, 0.05)
        for t in texts:
            near, far = lm_scoring._contexts(t.astype(np.uint16))
            trainer.learn(near[2:], far[2:], t.astype(np.uint16)[2:])
        model = trainer.trained()
    near, far, z = model.tables()
    a = np.arange(n)
    far_, near_, true = a, (a + 5) % n, (a + 10) % n
    assert (near[near_, true] + far[far_, true] - z[near_, far_]).min() > math.log(0.5)


def test_model_beats_the_unigram_on_held_out_documents(spark, sf_dir):
    """The score is a log probability over the same tokens, so the two can be compared."""
    rows = QUERIES["op11_lm_scoring"](spark, sf_dir).collect()
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows]
    assert close(got, brute_counts(docs))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_training_reads_every_document_once(spark, sf_dir):
    """The rounds share out the documents, and a task's tokens are those it has read."""
    docs = table(spark, sf_dir, "documents")
    rounds = docs.select(lm_scoring.round_of(docs["doc_id"]).alias("round")).groupBy("round").count().collect()
    assert {r["round"] for r in rounds} == set(range(lm_scoring.ROUNDS))
    assert sum(r["count"] for r in rounds) == docs.count()
