import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import op11_quality_rules as rules
from ledgerlake.llm import op12_lexical_search as lexical
from ledgerlake.llm import op13_importance_resampling as resampling
from tests.llm.cases import LONG, collected, frame, odd_texts, repeated, text, words
from tests.llm.test_lines_and_leaks import brute_words

# -- quality rules ----------------------------------------------------------------------------


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))


def brute_normal(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(re.findall(r"[^\x20\x09-\x0D]+", line)))


def brute_quality(rows, least, share):
    """(host, text) -> counts, words left, kept, remaining text."""
    hosts, held = defaultdict(set), defaultdict(set)
    for host, t in rows:
        hosts[host].add(t or "")
        for line in (t or "").split("\n"):
            if brute_normal(line):
                held[host, brute_normal(line)].add(t)
    frequent = {k for k, docs in held.items() if len(docs) >= least and len(docs) > share * len(hosts[k[0]])}
    out = {}
    for host, t in rows:
        counts = brute_counts(t)
        lines = (t or "").split("\n")
        left = [x for x in lines if (host, brute_normal(x)) not in frequent]
        n = brute_counts("\n".join(left))[0]
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        kept = not failed and not (n < counts[0] and (n < 20 or n < 0.5 * counts[0]))
        out[host, t] = counts, n, failed, kept, None if t is None else "\n".join(left)
    return out


def line_texts():
    """Documents with lines that many share, in other spellings too."""
    rng = random.Random(4)
    foot = ["Read more   on our SITE today", "all rights are reserved by us", " ".join(words(70, 40)), "Page 3 | share & enjoy #tag"]
    out = []
    for i in range(120):
        body = [" ".join(words(3000 + 50 * i + k, 9)) for k in range(rng.randrange(1, 12))]
        for f in foot:
            if rng.random() < 0.3:
                body.insert(rng.randrange(len(body) + 1), rng.choice([f, f.upper(), "\t" + f.replace(" ", "  ") + " \r"]))
        out.append("\n".join(body))
    return out + [" ".join(words(1, 6) * 15), "\n".join(["the same line again"] * 20), "a b\n\n a b\na b", "###"] + odd_texts()


@pytest.mark.parametrize("least,share", [(5, 0.05), (2, 0.0), (20, 0.005)])
def test_quality_equals_brute_force(spark, least, share):
    docs = repeated(frame(spark, line_texts()).withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("s"), F.col("doc_id") % 2))))
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    expected = brute_quality([r[1:] for r in rows], least, share)
    found = rules.quality(docs, least=least, share=share)
    texts = dict((r[0], r[1:]) for r in rows)
    got = found.collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    for r in got:
        counts, n, failed, kept, _ = expected[texts[r.doc_id]]
        assert tuple(r[c] for c in rules.COUNTS) == counts
        assert (r.n_words_left, r.base_failed, r.kept) == (n, failed, kept), texts[r.doc_id]
    cleaned = rules.clean(docs, least=least, share=share)
    assert cleaned.columns == [c for c in docs.columns if c not in ("kept", "n_words")]
    want = Counter((k, expected[h, t][4]) for k, h, t in rows if expected[h, t][3])
    assert Counter((r.doc_id, r.text) for r in cleaned.collect()) == want


def test_quality_joins_by_shuffle_alike(spark, monkeypatch):
    docs = frame(spark, line_texts())
    first = collected(rules.quality(docs, least=3, share=0.0))
    monkeypatch.setattr(rules, "BROADCAST_LINES", 0)
    monkeypatch.setattr(rules.sized, "__defaults__", (0,))
    assert collected(rules.quality(docs, least=3, share=0.0)) == first


def test_copies_do_not_deplete_each_other(spark):
    same = text(50, 200)
    page = [text(1000 + i, 80) + "\n" + "shared foot of all pages\n" * 2 for i in range(60)]
    found = collected(rules.quality(frame(spark, [same] * 90 + page).withColumn("source", F.lit("one"))))
    assert all(r["kept"] and r["n_frequent_lines"] == 0 for r in found[:90])
    assert all(r["kept"] and r["n_frequent_lines"] == 1 and r["n_words_left"] == 80 for r in found[90:])


def test_depleted_documents_go(spark):
    shared = [" ".join(words(600 + k, 10)) for k in range(8)]
    texts = ["\n".join([*shared[:6], " ".join(words(7000 + i, 20 + i))]) for i in range(60)]
    found = collected(rules.quality(frame(spark, texts).withColumn("source", F.lit("one"))))
    assert [r["kept"] for r in found] == [20 + i >= 0.5 * (80 + i) for i in range(60)]


def test_quality_of_nothing(spark):
    docs = frame(spark, ["a"]).limit(0)
    assert rules.quality(docs).count() == 0 and rules.clean(docs).count() == 0
    with pytest.raises(ValueError):
        rules.quality(docs.drop("source"))


# -- lexical search ---------------------------------------------------------------------------

def brute_search(docs, items, k=10):
    held = [(key, Counter(brute_words(t))) for key, t in docs]
    held = [(key, c) for key, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, t in set(items):
        scored = []
        for key, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m))
                    for w in set(brute_words(t)) if w in c)
            if s > 0:
                scored.append((-s, key is None, key or 0))
        out += [(item, r, None if empty else key, -s) for r, (s, empty, key) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEMS = [(1, text(1, 20)), (2, text(2, 5) + " é"), (3, None), (4, " .. "), (5, "a0 a1 a2"), (None, text(3, 30)), (5, "A0, other"),
         (6, "nothing-of-this xyzzy"), (7, text(1, 20)), (7, text(1, 20))]


@pytest.mark.parametrize("block_bytes,cells", [(1 << 20, 1 << 20), (200, 1 << 20), (1 << 20, 7)])
def test_search_equals_brute_force(spark, monkeypatch, block_bytes, cells):
    monkeypatch.setattr(lexical, "CELLS", cells)
    texts = odd_texts() + [text(10 + i % 30, 5 + i % 40) for i in range(150)] + ["a0", "a0 a1", "A0 a0 a1 " * 30, ITEMS[0][1]] + ["a0 a2 a2"] * 40
    docs = repeated(frame(spark, texts)).withColumn("score", F.lit("clash")).withColumn("item_id", F.lit("clash"))
    docs = docs.unionByName(docs.limit(30).withColumn("doc_id", F.lit(None).cast("long")))
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, rank string")
    got = Counter(tuple(r) for r in lexical.search(docs, items, block_bytes=block_bytes).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_a_class_is_scored_once_and_expanded_by_id(spark, monkeypatch):
    docs = frame(spark, ["b1 b2 common"] * 500 + [text(i, 30) for i in range(40)])
    items = spark.createDataFrame([(1, "b1 b2")], "item_id int, text string")
    classes = lexical._classes(lexical._bags(docs, "doc_id", "text", lexical.Items([b"b1 b2"])), 540, 2700, 10).collect()
    assert [len(r.members) for r in classes if bytes(r.bag) == lexical.Items([b"b1 b2"]).bag([b"b1", b"b2"]).tobytes()] == [10]
    got = collected(lexical.search(docs, items), "rank")
    assert [r["doc_id"] for r in got] == list(range(1, 11)) and len({r["score"] for r in got}) == 1


def test_search_of_nothing(spark):
    docs, items = frame(spark, ["a"]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (frame(spark, ["", None, " "]), items)):
        assert lexical.search(d, i).columns == ["item_id", "rank", "doc_id", "score"] and lexical.search(d, i).count() == 0


# -- importance resampling ----------------------------------------------------------------------

def brute_sample(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    def features(t):
        w = brute_words(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    s, t = (Counter(b for x in texts for b in features(x)) for texts in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for key, x in docs:
        f = features(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute_words(x))))
    able = sorted([r for r in rows if r[4] >= least], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(r[:4], k) for k, r in enumerate(able[:percent * len(able) // 100], 1)]
    return Counter(r[:4] for r in rows), drawn


@pytest.mark.parametrize("options", [{}, {"percent": 50}, {"percent": 100}, {"percent": 0}, {"longest": 3, "buckets": 64, "percent": 33},
                                     {"least_words": 0, "percent": 70}])
def test_sample_equals_brute_force(spark, options):
    texts = odd_texts() + [text(10 + i % 90, 5 + i % 60) for i in range(160)] + [LONG]
    docs = frame(spark, texts).withColumn("rank", F.lit("clash")).withColumn("weight", F.lit("clash")).withColumn("row_", F.lit(1))
    docs = repeated(docs)
    # Null ids: one text, so that ties between them are copies.
    docs = docs.unionByName(docs.where("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")).crossJoin(spark.range(40)).drop("id"))
    target = [text(10, 50), None, "", text(11, 70)]
    found = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "spans", "n_tokens", "row_", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    brute = {k.removeprefix("least_").replace("words", "least") if k == "least_words" else k: v for k, v in options.items()}
    every, drawn = brute_sample([(r.doc_id, r.text) for r in docs.collect()], target, **brute)
    assert Counter(r[:4] for r in rows) == every
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, len(drawn) + 1))
    assert [r[:4] for r in sorted((r for r in rows if r[4]), key=lambda r: r[4])] == [r for r, _ in drawn]


def test_rows_of_one_score_and_id_are_dealt_over_tasks(spark):
    same = text(5, 40)
    docs = spark.createDataFrame([(1, same)] * 3000 + [(2, same + " x")] * 3, "doc_id long, text string")
    found = resampling.resample(docs, spark.createDataFrame([(same,)], "text string"), percent=50).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 1502))


def test_cutoff(spark):
    rng = random.Random(3)
    values = [rng.choice([-2 ** 62, 2 ** 62, 5, 6, rng.randrange(-50, 50)]) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for want in (1, 17, 150, 299, 300):
        v, less, upto = resampling._cutoff(rows, "v", want)
        assert v == sorted(values)[want - 1] and less == sum(x < v for x in values) and upto == sum(x <= v for x in values)


def test_sample_of_nothing(spark):
    docs, target = frame(spark, ["a " * 30] * 20), spark.createDataFrame([("a",)], "text string")
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert sum(r["rank"] is not None for r in resampling.resample(docs, target.limit(0)).collect()) == 2
