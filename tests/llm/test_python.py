"""Near-duplicates, passages, packing, the classifier, pages and pieces against brute force."""

import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from starmart.llm import html_extract, minhash, packing, passages, quality_classifier, sentence_pieces
from starmart.llm.html_dom import decoded, features, parse
from starmart.llm.queries import QUERIES
from starmart.llm.shingles import components
from starmart.llm.store import table
from starmart.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_groups(texts, size, percent):
    """doc_id -> (n, component) by comparing all that share a shingle."""
    sets = {d: shingle_set(t, size) for d, t in texts.items()}
    having = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            having[g].append(d)
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, s in sets.items():
        common = defaultdict(int)
        for g in s:
            for b in having[g]:
                if b > a:
                    common[b] += 1
        for b, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def near_copies(rng, count, n, changes):
    base = words(rng, n)
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_groups_equal_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_minhash_dedup"](spark, sf_dir).collect()}
    assert got == brute_groups(texts, 3, 85)


def test_chains_and_crowds(spark):
    """Groups whose members are not all alike, keys of many components, hot groups."""
    rng = random.Random(5)
    texts = []
    for changes in (1, 3, 6, 9, 14):
        texts += near_copies(rng, 40, 120, changes)
    template = words(rng, 90)
    texts += [" ".join(template + words(rng, 30)) for _ in range(60)]
    chain = words(rng, 200)
    for i in range(30):
        texts.append(" ".join(chain))
        chain = chain[5:] + words(rng, 5)
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.groups(docs, 3, 85).collect()}
    assert got == brute_groups(dict(enumerate(texts)), 3, 85)


def test_odd_rows_in_groups(spark, odd_docs, no_docs):
    got = minhash.groups(odd_docs, 3, 85).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[0]["n_shingles"] == by[2]["n_shingles"] == 0 and by[2]["component_id"] == 2 and by[2]["kept"]
    assert by[4]["n_shingles"] == 1 and by[5]["component_id"] == 4 and not by[5]["kept"]
    assert by[10]["component_id"] == 9 and by[None]["component_id"] is None and by[None]["kept"]
    assert minhash.groups(no_docs, 3, 85).count() == 0
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    left = minhash.near_dedup_stage(spark, odd_docs, "")
    assert left.columns == columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(str(i) for i in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11, None, None] if i != 5)


def test_texts_under_one_id_are_judged_each(spark):
    rng = random.Random(37)
    a, b, c, d = (" ".join(words(rng, 60)) for _ in range(4))
    rows = [(1, a), (2, a + " more"), (2, b), (2, c), (2, c + " z"), (3, d), (3, None), (3, d), (4, b + " y"), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = minhash.near_dedup_stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(1, a), (2, b), (2, c), (3, d), (3, None), (None, a)], key=str)


def test_a_crowd_around_the_threshold(spark):
    """Two thousand near copies of one text, most pairs of which are just above or below it."""
    rng = random.Random(41)
    template = words(rng, 70)
    texts = []
    for i in range(2000):
        text = list(template)
        for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4])):
            text[rng.randrange(70)] = f"v{rng.randrange(4)}" if i % 3 else f"u{rng.randrange(3000)}"
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.groups(docs, 3, 85).collect()}
    assert got == brute_groups(dict(enumerate(texts)), 3, 85)


def test_parities_bound_what_is_common():
    rng = np.random.default_rng(6)
    for n, changed in ((5, 1), (80, 10), (500, 60), (3000, 900)):
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        b = np.concatenate([a[changed:], rng.integers(0, 2**64, changed, dtype=np.uint64)])
        x, y = minhash.parities(np.unique(a)), minhash.parities(np.unique(b))
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= 2 * changed and (differ > changed / 4 or n == 3000)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert components(links.limit(0)).count() == 0


def brute_runs(texts, least=50):
    """doc_id -> words that lie in a run of at least ``least`` words which another document has."""
    having = defaultdict(set)
    split = {d: WORD.findall((t or "").translate(LOWER)) for d, t in texts.items()}
    for d, w in split.items():
        for i in range(len(w) - least + 1):
            having[tuple(w[i : i + least])].add(d)
    covered = defaultdict(set)
    for d, w in split.items():
        for i in range(len(w) - least + 1):
            if len(having[tuple(w[i : i + least])]) > 1:
                covered[d].update(range(i, i + least))
    return covered


def test_repeated_passages_are_found(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    got = defaultdict(set)
    for r in QUERIES["op8_substring_dedup"](spark, sf_dir).collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    want = brute_runs(texts)
    for d, places in want.items():
        assert places <= got[d]


@pytest.mark.parametrize("big", [4, 256])
def test_passages_in_other_company(spark, monkeypatch, big):
    monkeypatch.setattr(passages, "BIG_KEY", big)
    rng = random.Random(11)
    passage, line = words(rng, 80), words(rng, 30)
    edited = list(passage)
    edited[40] = "edited"
    texts = {}
    for i in range(30):  # a shared line of 30 words makes no passage
        texts[i] = words(rng, 100) + line + words(rng, 100)
    for i in (40, 41, 42):
        texts[i] = words(rng, 60) + passage + words(rng, 60)
    texts[43] = words(rng, 30) + edited + words(rng, 200)
    texts[44] = words(rng, 40) + line + words(rng, 20)
    texts[45] = passage[:45] + words(rng, 50)  # too short
    texts[46] = texts[5][:90] + words(rng, 70)  # repeats another document, not its line
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    rows = {(r["doc_id"], r["kept"]): r for r in passages.spans(passages.repeats(passages.searched(docs))).collect()}
    assert rows.keys() == {(40, True), (41, False), (41, True), (42, False), (42, True), (43, False), (5, True), (46, False)} or rows.keys() >= {
        (40, True), (41, False), (42, False), (43, False), (5, True), (46, False)}
    assert {d for d, _ in rows} == {5, 40, 41, 42, 43, 46}
    assert (rows[41, False]["start_word"], rows[41, False]["end_word"]) == (60, 140)
    assert rows[42, False]["first_doc_id"] == 40 and rows[43, False]["start_word"] == 30
    assert rows[46, False]["end_word"] == 90

    cut = passages.substring_dedup_stage(spark, docs.selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars"), "")
    left = {r["doc_id"]: r["text"].split() for r in cut.collect()}
    assert left[41] == texts[41][:60] + texts[41][140:] and left[40] == texts[40] and left[3] == texts[3]


@pytest.mark.parametrize("big", [2, 256])
def test_documents_joined_by_one_passage_are_compared_for_another(spark, monkeypatch, big):
    """1, 2 and 3 share P; 2 and 3 also share S, of which 1 has an edit that is not similar."""
    monkeypatch.setattr(passages, "BIG_KEY", big)
    rng = random.Random(17)
    texts, want = {}, {}
    for i in range(40):
        p, s = words(rng, 60), words(rng, 50)
        edit = list(s)
        edit[18], edit[34] = "one", "two"
        for k, tail in enumerate((edit, s, s)):
            texts[3 * i + k] = words(rng, 30) + p + words(rng, 30) + tail + words(rng, 30)
        want[3 * i + 1] = want[3 * i + 2] = set(range(120, 170))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    got = defaultdict(set)
    for r in passages.spans(passages.repeats(passages.searched(docs))).collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    assert all(places <= got[d] for d, places in want.items())


def test_pairs_of_a_key_are_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(passages, "TILE_DOCS", 8)
    rng = random.Random(23)
    passage = words(rng, 60)
    held = spark.createDataFrame(
        [(d, " ".join(words(rng, 20 + d) + passage[: 60 - d % 15] + words(rng, 20))) for d in range(40)], "doc long, text string")
    pairs = spark.createDataFrame(
        [(0, a, d) for d in range(40) for a in range(d)] + [(9, 100, 101)], "key long, a long, b long")
    got = [tuple(r) for r in passages.verified_by_key(pairs, held).collect()]
    want = [tuple(r) for r in passages.verified(pairs.select("a", "b"), held).collect()]
    assert sorted(got) == sorted(want) and {(r[0], r[3]) for r in got} >= {(0, 1), (15, 30)}
    # A text goes to few tiles, whatever the number of its pairs, and no tile is large.
    tiles = passages.tiled(pairs).selectExpr("tile", "explode(array(a, b)) AS doc").distinct().groupBy("tile").count().collect()
    assert sum(r["count"] for r in tiles) <= 2 * 5 * 40 + 2 < pairs.count() and max(r["count"] for r in tiles) <= 32


def test_odd_rows_in_passages(spark, odd_docs, no_docs):
    assert passages.spans(passages.repeats(passages.searched(no_docs))).count() == 0
    long = " ".join(words(random.Random(3), 90))
    rows = [(100, long, "en", "s", 1, 2, "k"), (100, long + " z", "en", "s", 1, 2, "k"), (101, long, "en", "s", 1, 2, "k"), (None, long, "en", "s", 1, 2, "k")]
    docs = odd_docs.union(spark.createDataFrame(rows, odd_docs.schema))
    texts = passages.searched(docs)
    found = passages.named(passages.spans(passages.repeats(texts)), texts).collect()
    assert {(r["doc_id"], r["kept"]) for r in found} == {(100, True), (100, False), (101, False)}
    left = passages.substring_dedup_stage(spark, docs, "")
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert left.count() == docs.count() - 1
    assert passages.substring_dedup_stage(spark, no_docs, "").count() == 0


def test_compact_windows_cover_all_passages():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 10**9, 90).astype(np.uint64)
    windows = passages.compact_windows(values, 10)
    for i in range(90):
        for j in range(i + 10, 91):
            at = i + int(values[i:j].argmin())
            assert any(low <= i and mid == at and j <= high for low, mid, high in windows)


def test_window_starts_are_those_of_the_tree():
    rng = np.random.default_rng(3)
    for size in (46, 47, 60, 300):
        values = rng.permutation(10**6)[:size].astype(np.uint64)
        tree = {(max(low, at - 45), min(at, high - 46), at) for low, at, high in passages.compact_windows(values)}
        assert set(zip(*(x.tolist() for x in passages.window_starts(values)), strict=True)) == tree


def brute_starts(values, least):
    """Each start's place of its least value, from the left."""
    return [i + int(values[i : i + least].argmin()) for i in range(len(values) - least + 1)]


def test_every_place_of_a_value_has_its_window():
    rng = np.random.default_rng(4)
    line = rng.integers(0, 10**9, 20)
    texts = [
        np.concatenate([line, rng.integers(0, 10**9, 60), line, rng.integers(0, 10**9, 60)]),
        np.tile(rng.integers(0, 10**9, 8), 20), np.full(90, 7), rng.integers(0, 4, 300),
        np.concatenate([rng.integers(0, 10**9, 50), np.zeros(30, int), rng.integers(0, 10**9, 50)]),
    ]
    for values in (t.astype(np.uint64) for t in texts):
        first, last, at = passages.window_starts(values)
        got = [max(int(a), i) for f, e, a in zip(first, last, at, strict=True) for i in range(f, e + 1)]
        assert got == brute_starts(values, passages.LEAST)


def test_a_line_that_stands_earlier_hides_no_repeat(spark):
    """Fifty words twice, of which twenty stand in one of the documents once before."""
    rng = random.Random(23)
    texts = {}
    for i in range(0, 120, 2):
        line, passage = words(rng, 20), words(rng, 15)
        passage = passage + line + words(rng, 15)
        texts[i] = words(rng, 20) + line + words(rng, 80) + passage + words(rng, 20)
        texts[i + 1] = words(rng, 40) + passage + words(rng, 40)
    joined = {d: " ".join(w) for d, w in texts.items()}
    docs = spark.createDataFrame(list(joined.items()), "doc_id long, text string")
    got = defaultdict(set)
    for r in passages.spans(passages.repeats(passages.searched(docs))).collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    want = brute_runs(joined)
    assert len(want) == 120 and all(places <= got[d] for d, places in want.items())


def test_chance_of_a_key_at_the_threshold():
    """Fifty words with one edited, so a similarity of 41/51: at least what any two of four gave."""
    rng, found, n = np.random.default_rng(8), 0, 3000
    for at in range(n):
        a = rng.integers(0, 2**63, passages.LEAST).astype(np.uint64)
        b = a.copy()
        edit = 5 + at % 37
        b[edit - 5 : edit] = rng.integers(0, 2**63, 5).astype(np.uint64)
        x, y = (tuple(passages.mixed(t ^ seed) for seed in passages._SEEDS) for t in (a, b))
        agree = [int(u.argmin()) for u, v in zip(x, y, strict=True) if u.min() == v.min()]
        found += len(agree) > 2 or (len(agree) == 2 and abs(agree[0] - agree[1]) >= passages.APART)
    assert found / n > 0.96


def test_common_passages_beside_others():
    """Whatever else a pair shares, and however often a passage repeats its own words."""
    rng = np.random.default_rng(6)
    new = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    x, parts = new(80), [new(46) for _ in range(4)]
    a, b = [new(60), x, new(200)], [new(90), x, new(300)]
    for part in parts:
        a += [part, new(11)]
        b += [part, new(11)]
    a, b = np.concatenate(a), np.concatenate(b)
    at_a, at_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for a0, a1, b0, b1 in passages.common_passages(a, b):
        at_a[a0:a1] = at_b[b0:b1] = True
    assert at_a[np.isin(a, b)].all() and at_b[np.isin(b, a)].all()

    loop = np.tile(new(10), 6)[:56]
    assert (30, 86, 70, 126) in passages.common_passages(np.concatenate([new(30), loop, new(50)]), np.concatenate([new(70), loop, new(9)]))
    one = np.full(20_000, 7, np.uint64)
    assert passages.common_passages(one, one[:900])

    p = new(48)  # 24 + 8 + 24 against 24 + 4 + 24: exactly 0.8
    pair = [np.concatenate([new(70), p[:24], new(n), p[24:], new(70)]) for n in (8, 4)]
    assert passages.common_passages(*pair) == [(70, 126, 70, 122)] and passages.common_passages(*pair[::-1]) == [(70, 122, 70, 126)]


def test_rare_shingles_find_insertions(spark):
    """A key of 300 documents, each its own class: halves with words put between them, in one or both."""
    rng = random.Random(29)
    texts = {}
    for i in range(0, 300, 2):
        half, long, short = [(34, 7, 0), (28, 4, 0), (28, 5, 1), (26, 2, 1), (60, 12, 3)][i // 2 % 5]
        p = words(rng, half), words(rng, half)
        own = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
        both = [own(30) + p[0] + own(n) + p[1] + own(30) for n in (long, short)]
        texts[i], texts[i + 1] = both if i % 4 else both[::-1]
    held = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc long, text string")
    known = passages.Words()
    made = {d: passages.shingled(known.hashes(" ".join(w)), passages.SHINGLE) for d, w in texts.items()}
    want = {(i, i + 1) for i in range(0, 300, 2) if passages.common_passages(made[i], made[i + 1])}
    assert len(want) >= 120
    rooted = held.selectExpr("1L AS key", "doc", "doc AS root")
    assert want <= {(r["a"], r["b"]) for r in passages.rare_pairs(rooted, held).collect()}


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for d, own in ids.items():
        at = 0
        for i, r in enumerate(sorted(pieces[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            assert r["ids_crc32"] == zlib.crc32(np.array(own[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
            assert r["length"] == 2048 or at == len(own)
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(map(len, ids.values())) // 2048)
    return len(sequences), least


def test_packing(spark, sf_dir, odd_docs, no_docs):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    used, least = check_packing(QUERIES["op7_best_fit_packing"](spark, sf_dir).collect(), texts)
    assert used <= 1.03 * least + 1
    odd = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packing(packing.pack(odd).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert packing.pack(odd_docs).select("doc_id").count() >= odd_docs.count()
    assert packing.pack(no_docs).count() == 0


def test_two_pieces_replace_the_smallest():
    # Greedy takes 60 + 30 and leaves 10 empty; 20 + 20 fill the gap of the 30 exactly.
    assert sorted(packing._fill([20, 30, 60], {20: 2, 30: 1, 60: 1}, 100), reverse=True) == [60, 20, 20]
    rng = random.Random(2)
    for _ in range(50):
        counts = {rng.randrange(1, 101): rng.randrange(1, 9) for _ in range(rng.randrange(1, 40))}
        steps = packing.plan(counts, 100)
        used = defaultdict(int)
        for times, chosen in steps:
            assert sum(n * k for n, k in chosen.items()) <= 100
            for n, k in chosen.items():
                used[n] += times * k
        assert used == counts


def test_classifier(spark, sf_dir, odd_docs, no_docs):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in quality_classifier.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    hits = total = 0
    for r in labels.collect():
        own = got[r["doc_id"]]
        assert own["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= own["score"] <= 1
        if own["held_out"]:
            total += 1
            hits += own["predicted"] == r["quality"]
    assert hits / total > 0.95
    odd = quality_classifier.classify(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in quality_classifier.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.classify(no_docs, labels).count() == 0


def test_held_out_labels_are_not_learnt_from(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    turned = labels.withColumn("quality", quality_classifier.F.expr("if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality)"))
    a = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


ARTICLE = "<article><h1>Title &amp; more</h1><p>First para,<br>still the first.</p><p>Second &lt;b&gt; para.</p></article>"


def test_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    odd = spark.createDataFrame(
        [(-1, None, None), (-2, "u", ""), (-3, "u", "just text"), (-4, "u", "<p>" * 3000 + "x"), (-5, "u", "<div class='a"), (None, "u", "a < b <<c")],
        "page_id long, url string, html string")
    whole = pages.select("page_id", "url", "html").union(odd).selectExpr("*", "1 AS text", "2 AS n_chars")
    got = html_extract.extract(whole).collect()
    assert len(got) == whole.count()
    by = {r["page_id"]: r for r in got}
    assert by[-1]["text"] == by[-2]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in got)
    exact = 0
    for r in pages.collect():
        want = article_text(r["html"])
        exact += by[r["page_id"]]["text"] == want
    assert exact >= 0.98 * pages.count()
    assert html_extract.extract(whole.limit(0)).count() == 0


def article_text(page):
    """The text of the page's article, its paragraphs split where they are in these pages."""
    import html

    inner = re.search(r"(?s)<article>(.*?)</article>", page).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
    return "\n".join(filter(None, parts))


def test_other_layouts():
    """Layouts the trees were not given, by the decoding of plain markup rules."""
    nodes = parse(f"<body><nav><a href=1>Home</a></nav>{ARTICLE}<div class='comment-list'><p>Nice</p></div><script>x='<p>no'</script></body>")
    kept = decoded(nodes, html_extract.by_markup(nodes))
    assert kept == ["Title & more", "First para, still the first.", "Second <b> para."]
    assert features(nodes).shape == (len(nodes), features(parse("x")).shape[1])


@pytest.mark.parametrize("tag", ["noscript", "template", "object", "svg", "select", "canvas", "math"])
def test_an_unclosed_tag_hides_nothing_after_it(tag):
    texts = lambda page: [n.text for n in parse(page) if n.text]
    want = ["Title & more", "First para, still the first.", "Second <b> para."]
    assert texts(f"<body><{tag} id='a'>{ARTICLE}</body>") == want
    assert texts(ARTICLE.replace("</h1>", f"</h1><{tag}>")) == want
    assert texts(f"<{tag}>{ARTICLE}<{tag}></{tag}>") == want  # a later one's closing tag is not its own
    if tag not in ("object", "math"):
        assert texts(f"<{tag}><{tag}>a</{tag}>b<!-- <{tag}> --></{tag}>{ARTICLE}") == want
    assert texts(f"{ARTICLE}<script>var a = '<p>no'") == want


def test_text_in_formulas_and_objects_is_read():
    page = "<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then <object data='a'>see text</object> there.</p>"
    assert [n.text for n in parse(page) if n.text] == ["If x=2 then see text there."]


def test_features_count_whole_texts_and_all_siblings():
    row = lambda page, tag: dict(zip(range(26), features(n := parse(page))[[x.tag for x in n].index(tag)][:26], strict=True))
    long = row("<p>" + "a" * 300 + "7" * 50 + "B" * 50 + "</p>", "p")
    assert long[13] == pytest.approx(50 * 100 / 420) and long[14] == pytest.approx(50 * 100 / 420)
    assert row("<p>x</p>" + "<div>y</div>" * 99, "p")[16] == pytest.approx(0.01)


def test_long_pages_are_learnt_from(spark):
    rng = random.Random(31)
    para = lambda: "<p>" + " ".join(words(rng, 120)) + ".</p>"
    rows = [(i, "u", "<nav><a href=1>Home</a></nav><article>" + "".join(para() for _ in range(40)) + "</article>") for i in range(6)]
    assert min(len(r[2]) for r in rows) > 20_000
    assert html_extract.learn(spark.createDataFrame(rows, "page_id long, url string, html string")) is not None


def test_nothing_is_kept_below_a_dropped_node():
    nodes = parse("<div><p>a</p></div><div><p>b</p></div>")
    places = [i for i, n in enumerate(nodes) if n.tag == "div"]
    logit = np.ones(len(nodes))
    logit[places[0]] = -50
    assert decoded(nodes, logit) == ["b"]


def test_pieces_equal_the_library(spark, sf_dir, odd_docs, no_docs):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=sentence_pieces.model_path())
    docs = table(spark, sf_dir, "documents")
    more = ["  two  blanks ", "tab\tand\nline\r\n", "😀 é ﬁ ① ", "a_b->c __init__", "x" * 3000 + "y" * 50, "▁ literal", "12,345.67"]
    whole = docs.select("doc_id", "text").union(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(more)], "doc_id long, text string")).union(odd_docs.where("doc_id IS NULL").select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in whole.collect()}
    for r in sentence_pieces.encoded(whole).collect():
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]]
        assert r["ids"] == model.encode(text)
        assert r["decoded"] == text.replace("▁", " ")
    assert sentence_pieces.encoded(no_docs).count() == 0


def test_fold_in_the_lattice_equals_the_one_outside(spark):
    pieces = sentence_pieces.Pieces(sentence_pieces.model_path())
    rng = random.Random(4)
    units = {"▁" + "".join(rng.choices("aeinrstlo", k=rng.randrange(0, 14))) for _ in range(300)} | {"▁", "x", "▁▁▁▁▁", "漢字", "()->{"}
    df = spark.createDataFrame([(u,) for u in units], "unit string")
    got = {r["unit"]: r["symbols"] for r in sentence_pieces.folded_paths(sentence_pieces.lattice(df, pieces)).collect()}
    assert got == {u: pieces.fold(u) for u in units}


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir):
    """Each stage against plain Python on that stage's own input."""
    from .test_native import brute_quality, brute_secrets

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    got = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        got[name] = (before, after)
    before, after = got["quality_rules"]
    fails = lambda t: (q := brute_quality(t))[0] < 20 or 100 * q[4] > 30 * q[0]
    assert after.keys() == {d for d, t in before.items() if not fails(t)}
    before, after = got["minhash_near_dedup"]
    assert after.keys() == {d for d, (_, c) in brute_groups(before, 5, 80).items() if c == d}
    before, after = got["substring_dedup"]
    assert not any(places for places in brute_runs(after, 56).values()) and len(after) >= 0.95 * len(before)
    before, after = got["secret_scans"]
    assert all(not brute_secrets(t) for t in after.values()) and all(after[d] == t for d, t in before.items() if "[SECRET]" not in after[d])
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(rows, list(after.items()))


def test_all_texts_of_a_repeated_id_are_searched(spark):
    """Two documents share a passage in texts that are not the smallest under their ids."""
    rng = random.Random(43)
    passage = words(rng, 80)
    one, two = [" ".join(words(rng, 20) + passage + words(rng, 20)) for _ in range(2)]
    plain = [" ".join(["a0", *words(rng, 60)]) for _ in range(3)]
    rows = [(1, plain[0]), (1, one), (1, one), (2, two), (2, plain[1]), (3, plain[2]), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    texts = passages.searched(docs)
    found = {(r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"], r["kept"])
             for r in passages.named(passages.spans(passages.repeats(texts)), texts).collect()}
    assert found == {(1, 20, 100, 1, True), (2, 20, 100, 1, False)}
    left = sorted((r["doc_id"] or 0, len(r["text"].split())) for r in passages.substring_dedup_stage(spark, docs, "").collect())
    assert left == [(0, 120), (1, 61), (1, 120), (1, 120), (2, 40), (2, 61), (3, 61)]


def test_the_dictionary_is_filled_whatever_the_counts(spark):
    """Units of one count only, more than fit: most of the room is used and never more."""
    flat = spark.range(20_001).selectExpr("concat('u', id) AS unit", "1L AS n")
    for most in (1_000, 5_000):
        assert 0.8 * most <= sentence_pieces.frequent(flat, most).count() <= most
    steep = spark.range(3_000).selectExpr("concat('u', id) AS unit", "if(id < 100, 1000 + id, 1 + id % 2) AS n")
    kept = sentence_pieces.frequent(steep, 500)
    assert 400 <= kept.count() <= 500 and kept.join(steep.where("n >= 1000"), "unit").count() == 100
    assert sentence_pieces.frequent(flat.limit(7), 1_000).count() == 7
    assert sentence_pieces.frequent(flat, 1).count() <= 1


def test_pipeline_of_odd_rows_and_of_none(spark, odd_docs, no_docs, tmp_path):
    """Nulls in every column, empty and repeated rows, clashing columns, no rows at all."""
    rng = random.Random(47)
    fine = " ".join(words(rng, 90))
    rows = [(500, fine, "en", "s", 1, 2, "k"), (500, fine, "en", "s", 1, 2, "k"), (501, fine + " end", "en", "s", 1, 2, "k")]
    rows += [(502, " ".join(words(rng, 40)), "en", "s", 1, 2, "k"), (502, " ".join(words(rng, 40)), None, None, None, None, None)]
    rows += [(None, " ".join(words(rng, 40)), "en", "s", 1, 2, "k")]
    odd_docs.union(spark.createDataFrame(rows, odd_docs.schema)).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    no_docs.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    whole = [r["doc_id"] for r in got if r["doc_id"] is None or r["doc_id"] >= 500]
    assert sorted(whole, key=str) == [500, 502, 502, None]
    assert len(got) <= len(whole) + 2
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_scores_equal_a_numpy_fit(spark, sf_dir):
    """Means, shrunk covariances and Mahalanobis distances, straight from the rows; labels twice."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labels = labels.select("doc_id", "quality").union(labels.select("doc_id", "quality").where("doc_id % 3 = 0"))
    stats = {r["doc_id"]: np.array(r["x"]) for r in quality_classifier.measured(docs).collect()}
    known = [(r["doc_id"], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    x, y = np.array([stats[d] for d, _ in known]), np.array([q for _, q in known])
    center, scale = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-9))
    z = (x - center) / scale
    own = [z[y == k] for k in (0, 1)]
    scatter = [(o - o.mean(axis=0)).T @ (o - o.mean(axis=0)) for o in own]
    pooled = sum(scatter) / (len(z) - 2)
    logs = []
    every = (np.array(list(stats.values())) - center) / scale
    for o, s in zip(own, scatter, strict=True):
        w = max(0.2, min(1, z.shape[1] / len(o)))
        cov = (1 - w) * s / (len(o) - 1) + w * pooled
        cov = 0.95 * cov + 0.05 * np.trace(cov) / len(cov) * np.eye(len(cov))
        away = every - o.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
        logs.append(np.log(len(o) / len(z)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance)
    want = dict(zip(stats, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60))), strict=True))
    for r in quality_classifier.classify(docs, labels).collect():
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-6


def test_passages_are_compared_once_and_tables_removed(spark, monkeypatch):
    rng = random.Random(11)
    shared = words(rng, 120)
    texts = [words(rng, 40) + shared + words(rng, 40) for _ in range(6)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    written, folders = passages.written, {}

    def kept(df, label, *rest):
        out = written(df, label, *rest)
        folders.setdefault(label, set()).add(out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/"))
        return out

    monkeypatch.setattr(passages, "written", kept)
    found = passages.repeats(passages.searched(docs))
    assert {(r["a"], r["b"]) for r in found.collect()} >= {(0, i) for i in range(1, 6)}
    # Every reader of what was found reads tables: no comparison is left to be run again.
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert "PythonMapInArrow" not in passages.spans(found)._jdf.queryExecution().executedPlan().toString()
    assert folders["windows"] and folders["joint_keys"]
    assert not [p for label in ("windows", "joint_keys", "members") for p in folders[label] if os.path.exists(p)]


def test_window_starts_of_several_rows():
    rng = np.random.default_rng(9)
    values = rng.integers(0, 30, (4, 300)).astype(np.uint64)
    row, *rest = passages.all_window_starts(values)
    for i in range(4):
        assert [x[row == i].tolist() for x in rest] == [x.tolist() for x in passages.window_starts(values[i])]


def test_the_edge_of_a_passage_makes_no_pairs(spark):
    """Texts that share one passage go on in their own ways: a key at its edge is of no other passage."""
    rng = random.Random(53)
    passage = words(rng, 68)
    texts = {i: words(rng, 30 + 3 * (i % 7)) + passage + words(rng, 60) for i in range(40)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = passages.repeats(passages.searched(docs))
    assert found.select("a", "b").distinct().count() < 3 * len(texts)
    got = defaultdict(set)
    for r in passages.spans(found).where("NOT kept").collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    for i in range(1, 40):
        at = 30 + 3 * (i % 7)
        assert set(range(at, at + 68)) <= got[i] <= set(range(at - 2, at + 70))


def test_stages_leave_no_tables_behind(spark):
    rng = random.Random(59)
    passage = words(rng, 80)
    rows = [(i, " ".join(words(rng, 90) + passage), "en", "s", 1) for i in range(6)]
    rows += [(9, rows[1][1] + " end", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = os.path.dirname(scratch_dir(spark, "any").removeprefix("file:"))
    before = set(os.listdir(folder))
    left = {}
    for stage, label, count in ((minhash.near_dedup_stage, "groups", 6), (passages.substring_dedup_stage, "cuts", 6)):
        docs = stage(spark, docs, "")
        assert {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before} == {label}
        before = set(os.listdir(folder))
        left[label] = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
        assert len(left[label]) == count
    assert left["cuts"] == {i: 90 if i else 170 for i in range(6)}
