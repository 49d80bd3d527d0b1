import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import op3_near_dedup, op5_suffix_dedup
from ledgerlake.llm.columns import WINDOW, Hasher, anchors, repeated_windows
from ledgerlake.llm.graph import components
from ledgerlake.llm.op3_near_dedup import drop_near_duplicates, near_duplicates
from ledgerlake.llm.op5_suffix_dedup import remove_repeats
from ledgerlake.llm.shingles import shingles, similar, sketches
from tests.llm.cases import collected, frame, odd_texts, repeated, text, words


def brute_set(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(rows))], [len(s) for s in sets]


def edited(seed, base, edits):
    rng = random.Random(seed)
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def near_texts():
    base, passage = text(50, 300), text(51, 80)
    out = [edited(i, base, i % 9) for i in range(60)]  # one large group of near copies
    out += [text(60 + i, 60) + "\n" + passage for i in range(40)]  # a passage that many share
    out += [text(200, 90)] * 5 + [text(200, 90).upper()] + ["one two three", "One  two\tthree", "one two"]
    for i in range(25):  # borderline pairs
        t = text(300 + i, 100)
        out += [t, edited(i, t, 2 + i % 4)]
    return out + odd_texts()


def check(rows, found):
    expected, sizes = brute_components(rows)
    got = sorted(((r.r_key is None, r.r_key or 0, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    want = sorted(((k is None, k or 0, n, c, k == c) for (k, _), n, c in zip(rows, sizes, expected)), key=str)
    assert got == want


@pytest.mark.parametrize("small", [200, 6])
def test_components_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(op3_near_dedup, "SMALL", small)  # 6: nodes branch, and are worked off in blocks
    monkeypatch.setattr(op3_near_dedup, "SMALL_SETS", small)
    docs = repeated(frame(spark, near_texts()))
    check([(r.doc_id, r.text) for r in docs.collect()], near_duplicates(docs).collect())


def test_null_keys_and_empty_tables(spark):
    t = text(1, 50)
    docs = spark.createDataFrame([(None, t), (5, t), (3, t + " x"), (None, text(2, 9)), (None, None)], "doc_id long, text string")
    check([(r.doc_id, r.text) for r in docs.collect()], near_duplicates(docs).collect())
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = frame(spark, near_texts())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected, _ = brute_components(rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for (k, _), c in zip(rows, expected) if k == c}


def test_pairs_that_leave_a_node_grow_with_its_labels(spark):
    rng = np.random.Generator(np.random.PCG64(7))
    base = rng.integers(0, 256, size=op3_near_dedup.FUNCTIONS, dtype=np.uint8)
    found = {}
    for n in (5, 60, 240):  # every two sketches are alike
        rows = []
        for i in range(n):
            sketch = base.copy()
            sketch[rng.choice(len(base), 30, replace=False)] = rng.integers(0, 256, size=30)
            rows.append((1, i, i, bytearray(sketch.tobytes()), 100))
        nodes = spark.createDataFrame(rows, "path long, id long, label long, sketch binary, size long")
        found[n] = op3_near_dedup._compare(nodes, 75).collect()
    assert len(found[5]) == 10 and not any(r.more for r in found[5])  # few labels: each pair is sent
    for n in (60, 240):
        assert len(found[n]) == n - 1 and all(r.more for r in found[n])
        assert {r.a for r in found[n]} | {r.b for r in found[n]} == set(range(n))


def test_thinned_pairs_are_the_best_spanning_forest():
    rng = np.random.Generator(np.random.PCG64(8))
    for n in (30, 31, 80):
        group = np.arange(n) % 3  # three groups without a pair between them
        a, b = np.triu_indices(n, 1)
        some = (group[a] == group[b]) & ((group[a] > 0) | (b - a == 3))  # the first is a path
        lo, hi, equal = a[some] * 7, b[some] * 7, rng.integers(163, 256, size=some.sum())
        keep, stands = op3_near_dedup._thinned(lo, hi, equal)
        wanted = 0
        parent = {}

        def find(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for k in np.argsort(-equal, kind="stable"):
            if find(lo[k]) != find(hi[k]):
                parent[find(lo[k])] = find(hi[k])
                wanted += equal[k]
        thin = (group[lo // 7] > 0) & (np.bincount(group[lo // 7])[group[lo // 7]] > 4 * np.bincount(group)[group[lo // 7]])
        assert stands.tolist() == thin.tolist()
        assert keep[~thin].all() and keep.sum() == n - 3
        assert equal[keep].sum() == wanted


@pytest.mark.parametrize("dense", [0, 4])
def test_links_beside_a_spanning_forest_are_found(spark, monkeypatch, dense):
    monkeypatch.setattr(op3_near_dedup, "DENSE", dense)
    monkeypatch.setattr(op3_near_dedup, "STARS", 1)
    texts = []
    for g in range(3):  # groups in which most pairs are alike by sketch and about half are links
        base = text(700 + g, 120)
        texts += [edited(800 + 100 * g + i, base, 1 + i % 5) for i in range(40)]
    docs = frame(spark, texts)
    check([(r.doc_id, r.text) for r in docs.collect()], near_duplicates(docs).collect())


def test_every_pair_of_a_large_node_meets(spark):
    nodes = spark.createDataFrame([(1, i, i % 2, 700, 350, 0) for i in range(700)],
                                  "path long, id long, label long, n long, others long, main long")
    for cut in (op3_near_dedup._blocks, op3_near_dedup._against_main):
        groups: dict = {}
        for r in cut(nodes, 400).collect():
            groups.setdefault(r.path, set()).add(r.id)
        met = {(a, b) for g in groups.values() for a in g for b in g if a < b and a % 2 != b % 2}
        assert len(met) == 350 * 350


def test_pairs_at_the_threshold_meet_at_full_depth():
    rng = np.random.Generator(np.random.PCG64(4))
    n = 2000
    left, right = [], []
    for _ in range(n):  # 600 of 800 elements are common
        x = rng.integers(1, 1 << 63, size=800, dtype=np.uint64)
        left.append(x[:700])
        right.append(np.concatenate([x[:600], x[700:]]))
    wide = [sketches(left), sketches(right)]
    coarse = [x.astype("u1") for x in wide]
    alike = np.count_nonzero(coarse[0] == coarse[1], axis=1) >= op3_near_dedup.LEAST_EQUAL
    met = np.zeros(n, dtype=bool)
    for tree in range(op3_near_dedup.TREES):
        pair = np.flatnonzero(wide[0][:, tree] == wide[1][:, tree])
        path = op3_near_dedup._step(np.full(len(pair), tree + 1, dtype=np.uint64), wide[0][pair, tree].astype(np.uint64))
        for _ in range(op3_near_dedup.DEPTH):  # no node ever is small: every one branches
            sides = []
            for sketch in coarse:
                to, row = op3_near_dedup._grandchildren(path, sketch[pair])
                sides.append(set(zip(pair[row].tolist(), to.tolist())))
            both = sorted(sides[0] & sides[1])
            pair = np.array([p for p, _ in both], dtype=np.int64)
            path = np.array([t for _, t in both], dtype=np.uint64)
        met[pair] = True
    assert np.count_nonzero(met & alike) >= n - 1


def test_shingles_and_similarity():
    t = text(3, 100)
    assert len(shingles(t.encode())) == len(brute_set(t))
    a, b = shingles(t.encode()), shingles(edited(1, t, 3).encode())
    x, y = brute_set(t), brute_set(edited(1, t, 3))
    for percent in range(0, 101, 5):
        assert similar(a, b, percent) == (100 * len(x & y) >= percent * len(x | y))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 2000 + i) for i in range(500)] + [(5000, 5000)]
    found = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000} | {2000 + i: 1000 for i in range(500)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- repeated strings -------------------------------------------------------------------------

def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[p:p + WINDOW] for d in data for p in range(len(d) - WINDOW + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - WINDOW + 1):
            if count[d[p:p + WINDOW]] > 1:
                gone[p:p + WINDOW] = b"\1" * WINDOW
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(9)
    base, passage = " ".join(words(1, 300)), " ".join(words(2, 90))
    out = [base, base[:700] + " something else " + base[700:], base[100:299], base[100:300], "a" * 1000, "ab" * 400,
           "é" * 150 + base[:250], None, "", "x" * 199, "x" * 200]
    for i in range(60):  # cut from one passage at all places
        a, b = rng.randint(0, 200), rng.randint(300, len(passage))
        out.append(" ".join(words(100 + i, 20)) + passage[a:b] + " ".join(words(300 + i, rng.randint(0, 40))))
    return out + [" ".join(words(5, 600))] * 3


@pytest.mark.parametrize("most", [1000, 4])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(op5_suffix_dedup, "MOST", most)  # 4: groups are split
    texts = repeat_texts()
    docs = frame(spark, texts).withColumnsRenamed({"lang": "removed", "source": "rid"})
    rows = collected(remove_repeats(docs))
    for r, expected in zip(rows, brute_repeats(texts), strict=True):
        kept = bytes(r["kept"])
        assert (r["n_bytes"], r["n_bytes"] - len(kept), len(r["removed"]), hashlib.sha256(kept).hexdigest()) == expected


def test_repeated_rows_repeat_each_other(spark):
    docs = repeated(frame(spark, odd_texts()[:7] + odd_texts()[8:]))
    texts = [r.text for r in docs.collect()]
    got = Counter((r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
                  for r in remove_repeats(docs).collect())
    assert got == Counter(brute_repeats(texts))
    assert remove_repeats(docs.limit(0)).count() == 0


def test_segments_of_equal_polynomial_hash(spark):
    """Sums of the bytes by powers of any odd base agree for these two, modulo 2**64: four-byte
    letters in the order of Thue and Morse, and the same with the letters changed about."""
    letters = "b28j", "hglu"
    first, second = ("".join(letters[(bin(i).count("1") + k) % 2] for i in range(32)) for k in (0, 1))
    gap = "xxqgotqnxwjwfotvqglqavmsnmktsxwxcpxhuujuanxueuymzifycytalizwnvrj"
    texts = [first + gap + second, second + gap + first]
    for r, expected in zip(collected(remove_repeats(frame(spark, texts))), brute_repeats(texts), strict=True):
        kept = bytes(r["kept"])
        assert (r["n_bytes"], r["n_bytes"] - len(kept), len(r["removed"]), hashlib.sha256(kept).hexdigest()) == expected


def test_columns_against_all_windows():
    texts = [(t or "").encode() for t in repeat_texts()]
    found = anchors(texts, Hasher())
    every = {(r, s + k) for r, s, n in zip(found["row"], found["start"], found["windows"]) for k in range(n)}
    assert every == {(d, p) for d, t in enumerate(texts) for p in range(len(t) - WINDOW + 1)}
    order = np.argsort(found["anchor"], kind="stable")
    group = np.unique(found["anchor"][order], return_inverse=True)[1]
    parts = [texts[found["row"][i]][found["start"][i]:found["start"][i] + found["windows"][i] + WINDOW - 1] for i in order]
    runs = repeated_windows(group, found["left"][order], found["windows"][order], np.ones(len(order), dtype=int), parts)
    got = {(found["row"][i], found["start"][i] + found["left"][i] + o) for i, r in zip(order, runs) for a, b in r
           for o in range(a, b + 1)}
    count = Counter(t[p:p + WINDOW] for t in texts for p in range(len(t) - WINDOW + 1))
    assert got == {(d, p) for d, t in enumerate(texts) for p in range(len(t) - WINDOW + 1) if count[t[p:p + WINDOW]] > 1}
