import random
import re

import numpy as np
import pytest

from ledgerlake.llm.op7_private_data import base_spans, disguised, examples, find_spans, luhn, private_data, train
from ledgerlake.llm.op10_toxicity import Chain, classify, features
from ledgerlake.llm.op10_toxicity import train as train_chain
from ledgerlake.llm.tagger import FORBIDDEN, KINDS, STRIDE, TAGS, WINDOW, Tagger, allowed, ids_of
from tests.llm.cases import collected, frame, odd_texts, repeated, words


def reference_spans(t):
    """The rules as they are written."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_rules_equal_their_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("a@@..1127-+ ()%é") for _ in range(rng.randint(0, 30)))
        assert base_spans(t) == reference_spans(t), t
    assert base_spans("a" * 200_000 + "1" * 200_000 + "." * 99_999) == []


def card(rng):
    digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))


def plain_words(seed, n):
    """Words without digits, which could else continue a number beside them."""
    return [w.translate(str.maketrans("0123456789", "klmnopqrst")) for w in words(seed, n)]


def private_texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        value = rng.choice([
            f"{rng.choice('abcd')}x.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
            ".".join(str(rng.randrange(1, 255)) for _ in range(4)), card(rng),
            f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"])
        w = plain_words(rng.random(), 30)
        out.append(" ".join(w[:12]) + " " + value + " " + " ".join(w[12:]) + f" in {rng.randrange(1900, 2030)}")
    return out


@pytest.fixture(scope="module")
def tagger(spark):
    return train(frame(spark, private_texts(1, 500)), steps=220)


def test_gradients():
    rng = np.random.default_rng(0)
    t = Tagger()
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    ids = rng.integers(0, 131, (7, 3))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [1, 2, 0, 0, 5, 6, 6], [0, 0, 0, 7, 8, 8, 0]]).T
    grads = t.loss(ids, tags)[1]
    for name, value in t.p.items():
        at = tuple(rng.integers(0, s) for s in value.shape) if name != "embedding" else (ids[2, 1], 3)
        old, around = value[at], []
        for step in (1e-4, -1e-4):
            value[at] = old + step
            around.append(t.loss(ids, tags)[0])
        value[at] = old
        assert abs((around[0] - around[1]) / 2e-4 - grads[name][at]) < 1e-5, name


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(1)
    t = Tagger()
    scores = [rng.normal(0, 1, (n, TAGS)) for n in (4, 3, 1)]
    for s, path in zip(scores, t._best(scores, t.p["transition"] + allowed())):
        best = max(np.ndindex(*(TAGS,) * len(s)), key=lambda p: sum(s[k, x] for k, x in enumerate(p))
                   + sum((t.p["transition"] + allowed())[a, b] for a, b in zip(p, p[1:]))
                   + (FORBIDDEN if p[0] and p[0] % 2 == 0 else 0))
        assert list(best) == path.tolist()


def test_held_out_disguised_spans(tagger):
    rng = random.Random(7)
    texts, truth = [], []
    for t in private_texts(2, 300):
        kind, a, b = base_spans(t)[0]
        found = disguised(kind, t[a:b], rng)
        texts.append(t[:a] + found + t[b:])
        truth.append((kind, a, a + len(found)))
    found = find_spans(texts, tagger)
    recall = np.mean([any(s[:3] == x for s in spans) for x, spans in zip(truth, found)])
    clean = [" ".join(words(900 + i, 60)) + f" {i * 37} and 4.0. {'ab12' * 5}" for i in range(200)]
    wrong = sum(map(len, find_spans(clean, tagger)))
    assert recall >= 0.85 and wrong <= 2


def test_windows_are_reconciled(tagger):
    """What is found does not depend on where a span lies within a long passage."""
    fill = " ".join(" ".join(plain_words(i, 4)) + f" in {1900 + i}" for i in range(60))
    found = 0
    for shift in range(0, WINDOW + STRIDE, 9):
        t = fill[:200 + shift] + " kx.44 (at) mail3.example.com " + fill[300:700]
        found += any(t[a:b] == "kx.44 (at) mail3.example.com" for _, a, b, _ in find_spans([t], tagger)[0])
    assert found >= 14  # of 16


def test_private_data_of_odd_rows(spark, tagger):
    texts = private_texts(3, 40) + odd_texts() + ["a@b.cd" * 3000, "1" * 50_000, "call +1 (415) 555-1234 or 10.0.0.1"]
    docs = repeated(frame(spark, texts))
    for model in (tagger, None):
        rows = collected(private_data(docs, model))
        assert len(rows) == docs.count()
        for r in rows:
            spans = [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]]
            assert spans == sorted(spans)
            assert [x for x, s in zip(spans, r["spans"]) if s["base"]] == sorted(base_spans(r["text"] or ""))
            assert model is not None or all(s["base"] for s in r["spans"])
    assert train(docs.limit(0)) is None and private_data(docs.limit(0), None).count() == 0


def test_training_takes_distinct_passages(spark):
    many = private_texts(8, 2000)
    docs = spark.createDataFrame([(t,) for t in many + many[:1] * 3000], "text string")
    seen = {}

    class Stop(Exception):
        pass

    from ledgerlake.llm import op7_private_data as op

    kept = op.examples

    def examples(passages, *more):
        seen["n"], seen["distinct"] = len(passages), len(set(passages))
        raise Stop

    op.examples = examples
    try:
        with pytest.raises(Stop):
            op.train(docs)
    finally:
        op.examples = kept
    assert seen["n"] == seen["distinct"] > 4 * 300


def test_places_inside_spans_are_no_counterexamples(spark):
    from ledgerlake.llm.op7_private_data import _contexts

    t = " ".join(f"a{i}@b{i}.example.com" for i in range(120))
    rows = _contexts(spark.createDataFrame([(t,)], "text string"), "text").collect()
    assert {r.kind for r in rows} == {0} and len(rows) == 120


def test_examples_are_labelled():
    ids, tags = examples(private_texts(4, 50))
    assert ids.shape == tags.shape == (150, WINDOW)
    assert ((tags[:, 1:] % 2 == 1) | (tags[:, 1:] == 0) | (tags[:, 1:] - tags[:, :-1] <= 1)).all()
    assert ids_of("aé1") .tolist() == [98, 129, 50]


# -- toxicity -----------------------------------------------------------------------------------

BAD = ["moron", "idiot", "trashy"]


def labelled(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = words(seed * 10 ** 4 + i, rng.randint(20, 200))
        toxic, junk = rng.random() < 0.2, rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD) + rng.choice(["", "s", "ic"]))
        if junk:
            w = [x + "%%%" for x in w]
        rows.append((" ".join(w), int(not junk), int(toxic)))
    return rows


def test_held_out_accuracy_and_chain():
    data = labelled(1, 1500)
    known = {c: np.array([r[k] for r in data], dtype=float) for k, c in ((1, "quality"), (2, "toxic"))}
    chain = Chain(("quality", "toxic")).fit([features(r[0]) for r in data], known)
    assert len(chain.models[1].of_numbers) == 1  # the second model sees the first category
    test = labelled(2, 400)
    found = np.array([chain.probabilities(r[0]) for r in test]) >= 0.5
    assert (found[:, 0] == [r[1] for r in test]).mean() > 0.98 and (found[:, 1] == [r[2] for r in test]).mean() > 0.98


def test_later_categories_use_earlier_ones():
    """A category that is the first one told again can only be learned through the chain."""
    data = labelled(3, 800)
    y = np.array([r[2] for r in data], dtype=float)
    chain = Chain(("toxic", "again")).fit([features(r[0]) for r in data], {"toxic": y, "again": y})
    assert chain.models[1].of_numbers[0] > 0.1


def test_capitals_count_over_the_whole_text():
    quiet, loud = "quiet words " * 25, "SHOUTED WORDS " * 70
    assert all("\tCAPITALS" in features(t) for t in (quiet + loud, loud + quiet))
    assert not any("\tCAPITALS" in features(t) for t in (quiet * 9 + loud, loud + quiet * 9))


def test_repeated_keys_are_one_example(spark, monkeypatch):
    rows = [(i % 50, r[0]) for i, r in enumerate(labelled(5, 200))] + [(0, "x"), (None, "y")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)], "doc_id long, quality int, toxic int")
    sizes = []
    monkeypatch.setattr(Chain, "fit_indexed", lambda self, indexed, names, labels: sizes.append(len(indexed)) or self)
    train_chain(docs, labels)
    assert sizes == [50]


def test_toxicity_of_odd_rows(spark):
    texts = [r[0] for r in labelled(4, 400)]
    docs = repeated(frame(spark, texts + odd_texts()))
    labels = spark.createDataFrame(
        [(i, r[1], r[2], "x") for i, r in enumerate(labelled(4, 400), 1)] + [(None, 1, 1, "x"), (3, None, None, "x"), (10 ** 6, 1, 1, "x")],
        "doc_id long, quality int, toxic int, text string")
    chain = train_chain(docs, labels)
    rows = collected(classify(docs, chain))
    assert len(rows) == docs.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    truth = {i: r[2] for i, r in enumerate(labelled(4, 400), 1)}
    assert np.mean([(r["p_toxic"] >= 0.5) == truth[r["doc_id"]] for r in rows if r["doc_id"] in truth]) > 0.98
    for none in (train_chain(docs, labels.limit(0)), train_chain(docs.limit(0), labels)):
        assert all(r["p_toxic"] < 0.5 for r in collected(classify(docs, none)))
    assert classify(docs.limit(0), chain).count() == 0
