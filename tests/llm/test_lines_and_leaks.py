import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgerlake.llm import op2_line_dedup
from ledgerlake.llm.op2_line_dedup import chunks_of, dedup_lines
from ledgerlake.llm.op4_decontamination import decontaminate, find_leaks
from tests.llm.cases import collected, frame, odd_texts, repeated, text, words


def passage(seed, lines):
    rng = random.Random(seed)
    return [" ".join(words(rng.random(), 8)) for _ in range(lines)]


def brute_lines(rows):
    """Remove every chunk of several lines whose bytes came before, in order of key and place."""
    seen, out = {}, {}
    for key, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (t or "").encode()
        kept = []
        for n, (first, after, a, b) in enumerate(chunks_of(data)):
            chunk = data[a:b]
            if after - first >= 2 and seen.setdefault(chunk, (key, t, n)) != (key, t, n):
                continue
            kept.append(chunk)
        out[key, t] = None if t is None else b"\n".join(kept).decode()
    return out


def test_chunks_cover_the_text_and_resist_shifts():
    shared = passage(1, 40)
    one, other = passage(2, 7) + shared + passage(3, 5), passage(4, 12) + shared
    sets = []
    for lines in (one, other):
        data = "\n".join(lines).encode()
        chunks = chunks_of(data)
        assert b"\n".join(data[a:b] for _, _, a, b in chunks) == data
        assert all(after - first >= 2 for first, after, _, _ in chunks[:-1])
        sets.append({data[a:b] for _, _, a, b in chunks})
    common = sum(c.count(b"\n") + 1 for c in sets[0] & sets[1])
    assert common >= 30


def test_repeated_runs_of_lines_go(spark):
    shared = passage(1, 12)
    texts = ["\n".join(passage(10 + i, 4 + i % 3) + shared + passage(50 + i, 3)) for i in range(30)]
    texts += ["\n".join(["same line"] * 9), "\n".join(passage(7, 30) * 2)] + odd_texts()
    docs = repeated(frame(spark, texts))
    rows = collected(dedup_lines(docs))
    expected = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert len(rows) == docs.count()
    source = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r["text"] == expected[r["doc_id"], source[r["doc_id"]]]
        lines = source[r["doc_id"]].count("\n") + 1 if source[r["doc_id"]] else 0
        assert r["n_lines"] == lines
    assert sum(r["n_removed"] for r in rows) > 200
    left = {r["doc_id"] for r in collected(dedup_lines(docs, drop_emptied=True))}
    assert left == {r["doc_id"] for r in rows if not (r["n_lines"] and r["n_removed"] == r["n_lines"])}
    assert dedup_lines(docs.limit(0)).count() == 0


def test_exact_copies_leave_no_last_line(spark):
    texts = ["\n".join(passage(400 + i, n)) for i in range(12) for n in (2, 3, 5, 8)]
    assert all(after - first >= 2 for t in texts for first, after, _, _ in chunks_of(t.encode()))
    docs = spark.createDataFrame(list(enumerate(texts + texts)), "doc_id long, text string")
    assert {r.doc_id for r in dedup_lines(docs, drop_emptied=True).collect()} == set(range(len(texts)))


def test_null_keys(spark):
    shared = "\n".join(passage(3, 6))
    docs = spark.createDataFrame([(None, shared), (None, shared + "\nmore\nlines"), (2, shared)], "doc_id long, text string")
    rows = dedup_lines(docs).collect()
    expected = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(str, (r.text for r in rows))) == sorted(map(str, expected.values()))


def test_equal_hashes_of_unequal_bytes_stay(spark, monkeypatch):
    docs = frame(spark, ["\n".join(passage(i // 2, 2)) for i in range(12)])
    real = op2_line_dedup._chunk_hashes

    def weak(*args):  # every chunk gets one of two hashes
        from pyspark.sql import functions as F

        out = real(*args)
        return out.withColumn("hash", F.when(F.col("r_key") <= 2, F.lit(b"a")).otherwise(F.lit(b"b")))

    monkeypatch.setattr(op2_line_dedup, "_chunk_hashes", weak)
    gone = {r["doc_id"]: r["n_removed"] for r in collected(dedup_lines(docs))}
    assert gone[2] == 2 and sum(gone.values()) == 2  # only hash "a" stands for one text


def brute_runs(rows, words=50):
    """What stays, and how many lines go, as they lie in a chunk or a run of over 50 words that came before."""
    came, chunks, out = set(), {}, {}
    for key, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        lines, data, gone = (t or "").split("\n"), (t or "").encode(), set()
        for first in range(len(lines)):
            for after in range(first + 1, len(lines) + 1):
                run = tuple(lines[first:after])
                if run[0].split() and run[-1].split() and sum(len(x.split()) for x in run) > words:
                    if run in came:
                        gone |= set(range(first, after))
                    came.add(run)
        for n, (first, after, a, b) in enumerate(chunks_of(data)):
            if after - first >= 2 and chunks.setdefault(data[a:b], (key, t, n)) != (key, t, n):
                gone |= set(range(first, after))
        out[key, t] = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)
    return out


def test_repeated_runs_of_over_50_words_go_wherever_chunks_end(spark):
    rng = random.Random(8)
    texts = []
    for n in (1, 2, 3, 4, 5, 8):  # lines of a passage of 60 words, within documents of their own
        w = words(900 + n, 60)
        shared = [" ".join(w[60 * i // n:60 * (i + 1) // n]) for i in range(n)]
        for i in range(8):
            texts.append("\n".join(passage(rng.random(), rng.randrange(4)) + shared + passage(rng.random(), rng.randrange(4))))
    wide = [" ".join(words(950 + i, 55)) for i in range(2)]
    gaps = [wide[0], "", " ", wide[1]]
    short = [" ".join(words(960, 25)), "", " ".join(words(961, 25))]  # 50 words are not over 50
    for i in range(3):
        texts += ["\n".join(passage(rng.random(), 1) + x + passage(rng.random(), 1)) for x in (gaps, short, gaps[:1], [""] * 9)]
    texts += ["\n".join(["same line of a document of its own"] * 30), "\n".join(passage(7, 30) * 2)] + odd_texts()
    rows = list(enumerate(texts))
    found = collected(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), runs=True))
    expected = brute_runs(rows)
    for r, (key, t) in zip(found, rows, strict=True):
        assert (r["text"], r["n_removed"]) == expected[key, t]
    kept = [r["text"] or "" for r in found]
    assert all(sum(line in t.split("\n") for t in kept) == 1 for line in wide)
    assert sum(line in t.split("\n") for line in short[:1] for t in kept) == 3


# -- decontamination --------------------------------------------------------------------------

def brute_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_leaks(t, items, window=10):
    w = brute_words(t)
    hit, found = set(), set()
    for name, item in items:
        i = brute_words(item)
        n = min(window, len(i))
        grams = {tuple(i[k:k + n]) for k in range(len(i) - n + 1)} if n else set()
        for k in range(len(w) - n + 1) if grams else ():
            if tuple(w[k:k + n]) in grams:
                hit |= set(range(k, k + n))
                found.add("null" if name is None else str(name))
    return len(w), sorted(hit), sorted(found)


ITEMS = [(7, text(100, 35)), (10, text(101, 12)), (9, "Short item"), (12, "short ITEM two"), (None, text(102, 30)),
         (3, None), (4, " .. "), (7, text(103, 15)), (15, "a a a a a a a a a a a a"), (16, text(100, 20))]


def leaky_texts():
    rng = random.Random(5)
    pool = [t for _, t in ITEMS if t]
    out = []
    for i in range(40):
        parts = [" ".join(words(200 + i, 30))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(pool).split()
            a = rng.randrange(max(1, len(w) - 11))
            parts += [" ".join(w[a:a + rng.randint(8, 25)]).upper(), " ".join(words(rng.random(), rng.randrange(3)))]
        out.append(" ; ".join(parts))
    return out + odd_texts() + ["short item", "x short, item two é", "a " * 30, "a " * 9] + pool


def test_leaks_equal_brute_force(spark):
    docs = repeated(frame(spark, leaky_texts()))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block_bytes in (1 << 20, 300):  # one automaton; several, one after another
        rows = collected(find_leaks(docs, items, block_bytes=block_bytes))
        assert len(rows) == docs.count()
        for r in rows:
            n, hit, found = brute_leaks(r["text"], ITEMS)
            mine = sorted(k for x in r["hit_words"] for k in range(x["first"], x["after"]))
            assert (r["n_words"], mine, r["hit_items"], r["n_hit"]) == (n, hit, found, len(hit)), r["text"]


def test_decontaminated_texts(spark):
    docs = frame(spark, leaky_texts())
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs.withColumn("n_hit", F.lit("own"))
    done = decontaminate(docs, items)
    assert done.columns == docs.columns
    assert collected(done) == collected(decontaminate(docs, items, block_bytes=300))  # one pass, and block by block
    kept = {r["doc_id"]: r["text"] for r in collected(done) if r["n_hit"] == "own"}
    for r in docs.collect():
        n, hit, _ = brute_leaks(r.text, ITEMS)
        assert (r.doc_id in kept) == (len(hit) <= 0.5 * n)
        if r.doc_id in kept:
            w = brute_words(r.text)
            assert brute_words(kept[r.doc_id]) == [x for k, x in enumerate(w) if k not in set(hit)] or not hit
            if not hit:
                assert kept[r.doc_id] == r.text
    nothing = find_leaks(docs, items.limit(0)).collect()
    assert all(r.n_hit == 0 and r.hit_items == [] for r in nothing)
    assert find_leaks(docs.limit(0), items).count() == 0


def test_batches_with_and_without_hits_in_one_task(spark, tmp_path):
    leak = next(t for _, t in ITEMS if t)
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    for name, hit in (("first", {3}), ("second", {1700}), ("third", {2400, 1200})):
        texts = [" ".join(words(20_000 + i, 60)) + (" " + leak + " tail" if i in hit else "") for i in range(2500)]
        frame(spark, texts, 0).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        decontaminate(docs, items, coverage=0.6).write.parquet(f"{tmp_path}/{name}-out")
        got = collected(spark.read.parquet(f"{tmp_path}/{name}-out"))
        assert len(got) == 2500
        assert {r["doc_id"] for r in got if r["text"] != texts[r["doc_id"]]} == hit


def test_digest_of_items(spark, tmp_path):
    from ledgerlake.llm.op4_decontamination import query

    frame(spark, leaky_texts()).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for r, t in zip(collected(query(spark, str(tmp_path))), leaky_texts()):
        n, hit, found = brute_leaks(t, ITEMS)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
