import importlib
import random

import corpus_pipeline
from ledgerlake.llm.base import table
from ledgerlake.llm.queries import ORACLES, QUERIES
from tests.llm.cases import text, words
from tests.llm.test_lines_and_leaks import brute_leaks, brute_lines
from tests.llm.test_near_and_repeats import brute_components
from tests.llm.test_tokens import library  # noqa: F401

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def tables(spark, folder):
    rng = random.Random(1)
    bad = ["moron", "idiot", "scum"]
    texts = [text(1000 + i, rng.randint(40, 160)) for i in range(240)]
    toxic = {i for i in range(240) if i % 6 == 0}
    for i in toxic:
        w = texts[i].split(" ")
        for _ in range(4):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts[i] = " ".join(w)
    texts[31] = texts[33] = texts[32]  # exact copies
    texts[41] = texts[40].replace(texts[40].split()[7], "changed", 1)  # a near copy
    leak = text(5000, 40)
    texts[51] += "\n" + leak
    texts[53] = leak
    texts += ["", None]
    docs = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, text(5001, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, toxic, leak


def test_each_stage_against_brute_force(spark, tmp_path, library):  # noqa: F811
    rows, toxic, leak = tables(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]

    def run(name, frame):
        out = stages[name](spark, frame, str(tmp_path))
        path = f"{tmp_path}/{name.replace(' ', '_')}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    clean = run("toxicity", docs)
    assert clean.columns == docs.columns
    kept = {r.doc_id: r for r in clean.collect()}
    assert not toxic & set(kept) and set(kept) == {r[0] for r in rows} - toxic

    lines = run("line dedup", clean)
    expected = brute_lines([(r.doc_id, r.text) for r in kept.values()])
    got = {r.doc_id: r for r in lines.collect()}
    for (key, t), left in expected.items():
        if t and not left:
            assert key not in got
        else:
            assert got[key].text == left and (left is None or got[key].n_chars == len(left))
    assert lines.columns == docs.columns and 32 not in got and 33 not in got

    near = run("near dedup", lines)
    source = [(r.doc_id, r.text) for r in lines.collect()]
    named, _ = brute_components(source)
    assert {r.doc_id for r in near.collect()} == {k for (k, _), c in zip(source, named) if k == c}

    pure = run("decontamination", near)
    left = {r.doc_id: r.text for r in pure.collect()}
    for r in near.collect():
        n, hit, _ = brute_leaks(r.text, [(1, leak), (2, text(5001, 30))])
        assert (r.doc_id in left) == (len(hit) <= 0.5 * n)
    assert 53 not in left and not brute_leaks(left[51], [(1, leak)])[1]

    packed = run("packing", pure).collect()
    for key, t in left.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert sum(r.length for r in packed if r.doc_id == key) == len(ids) + 1
    sums: dict = {}
    for r in packed:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= 1024 and len(sums) == -(-sum(sums.values()) // 1024)


def test_stages_take_empty_tables_and_clashing_columns(spark, tmp_path):
    rows, *_ = tables(spark, str(tmp_path))
    odd = [(900, None), (901, ""), (902, " \n "), (903, "one"), (None, text(77, 60)), (904, text(78, 3000))]
    docs = spark.createDataFrame([(k, t, "en", "src", len(t or ""), -1.0, "x", True, 5) for k, t in odd],
                                 COLUMNS + ", p_toxic double, n_hit string, kept boolean, n_removed int")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.count() == 0
        found = stage(spark, docs, str(tmp_path))
        keys = sorted((r.doc_id is None, r.doc_id or 0) for r in found.select("doc_id").distinct().collect())
        if name != "packing":
            assert found.columns == none.columns == docs.columns
        assert [k for _, k in keys][:3] == [900, 901, 902] or name == "line dedup"
        assert (False, 904) in keys and (True, 0) in keys


def test_run_applies_all_stages(spark, tmp_path):
    tables(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 100


def test_registration():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_oracles_agree(spark):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {name} as from '/root/testdata/sf0.001/{name}.parquet'")
    for name, sql in ORACLES.items():
        mine, theirs = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas(), con.sql(sql).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        order = sorted(mine.columns)
        pd.testing.assert_frame_equal(mine[order].sort_values(order).reset_index(drop=True),
                                      theirs[order].sort_values(order).reset_index(drop=True), check_dtype=False)


def test_words_helper_is_stable():
    assert words(1, 3) == words(1, 3)
