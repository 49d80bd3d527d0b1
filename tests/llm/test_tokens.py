import random
import zlib

import pytest
from tokenizers import Tokenizer

from ledgerlake.llm.base import settle
from ledgerlake.llm.bpe import ByteBpe
from ledgerlake.llm.op1_token_counts import token_counts, vocabulary
from ledgerlake.llm.op6_best_fit_packing import pack, packed_documents, pieces
from ledgerlake.llm.packing import best_fit, complete
from tests.llm.cases import collected, frame, odd_texts, repeated


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def engine():
    return ByteBpe(vocabulary())


def test_ids_equal_the_library(library, engine):
    rng = random.Random(1)
    alphabet = list("abst'rvelmd  \n\t.,!0123é½² 　中文́\U0001f600") + ["<|endoftext|>", "'ll", " the"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "I'll don't 's\n's ''s", "ab" * 900]
    ids, counts = engine.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == library.encode(text, add_special_tokens=False).ids, text
        at += n
    assert (engine.count(texts) == counts).all()


def test_forgetting_changes_nothing(engine, monkeypatch):
    from ledgerlake.llm import bpe

    texts = odd_texts()[1:] + [f"word{i} and {i * 7}" for i in range(300)]
    whole = engine.count(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    small = ByteBpe(vocabulary())
    assert [int(small.count([t])[0]) for t in texts] == whole.tolist()


def test_counts_of_odd_rows(spark, library):
    docs = repeated(frame(spark, odd_texts()))
    rows = collected(token_counts(docs, vocabulary()))
    assert len(rows) == docs.count()
    for r in rows:
        text = r["text"] or ""
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert r["n_bytes"] == len(text.encode()) and r["over_limit"] == (r["n_tokens"] > 512)
    assert token_counts(docs.limit(0), vocabulary()).count() == 0


def test_pieces_and_packing(spark, library):
    docs = frame(spark, odd_texts() + [f"short {i}" for i in range(60)])
    full = pieces(docs, vocabulary()).collect()
    for doc in docs.collect():
        ids = library.encode(doc.text or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in full if r.doc_id == doc.doc_id), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in mine) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert [r.length for r in mine[1:]] == [1024] * (len(mine) - 1)
        assert len(mine) == -(-len(ids) // 1024) and [r.start for r in mine] == [
            sum(x.length for x in mine[:k]) for k in range(len(mine))]
    packed = packed_documents(docs, vocabulary()).collect()
    crc = {(r.doc_id, r.piece): zlib.crc32(bytes(r.ids)) for r in full}
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in packed} == crc and len(packed) == len(full)
    sequences: dict = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == -(-sum(r.length for r in packed) // 1024)


def test_packing_goes_on_over_blocks(spark):
    rng = random.Random(3)
    lengths = [rng.randint(1, 400) for _ in range(2000)] + [700] * 500 + [1024] * 3
    items = spark.createDataFrame([(i % 7, n, None) for i, n in enumerate(lengths)], "block int, length long, offset string")
    items = settle(items, "items")
    placed = pack(items, block=200).collect()
    sums: dict = {}
    for r in placed:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert sorted(r.length for r in placed) == sorted(lengths) and max(sums.values()) <= 1024
    assert len(sums) <= -(-sum(lengths) // 1024) + 4
    assert pack(items.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_completion_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 12) for _ in range(9)]

    def least(left):
        """Fewest bins by trying every bin for every item."""
        best = len(left)

        def place(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(left):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + left[k] <= 12:
                    bins[i] += left[k]
                    place(k + 1, bins)
                    bins[i] -= left[k]
            place(k + 1, bins + [left[k]])

        place(0, [])
        return best

    found = complete(lengths, 12)
    assert sorted(x for b in found for x in b) == sorted(lengths)
    assert len(found) <= len(best_fit(sorted(lengths, reverse=True), 12)) and len(found) == least(sorted(lengths, reverse=True))
