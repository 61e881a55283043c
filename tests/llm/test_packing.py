import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronofold.llm import packing, queries
from chronofold.llm.encoder import LAST, encoder
from samples import no_rows, odd_frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_pieces_of_texts_are_encoded_as_the_library_does(tokenizer):
    rng = random.Random(4)
    letters = [chr(i) for i in range(LAST + 1)] + list(" \n\t'\x85\xa0") * 30 + list("'s't're'll") * 10
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(8000)]
    texts += ["<|endoftext|>", "東京 😀\n\n a", "it's we'll 'S", "", "x" * 9000, " " * 500 + "a", "ǅɏ ɐ"]
    texts += texts[:100]
    ids, counts = encoder(PATH).encode(texts)
    whole = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder(PATH).by_pieces
    assert counts.tolist() == [len(x) for x in whole]
    assert ids.tolist() == [i for x in whole for i in x]


def test_other_tokenizers_go_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    ids, counts = encoder(path).encode(["Some Words here", ""])
    assert not encoder(path).by_pieces
    assert ids.tolist() == t.encode("Some Words here", add_special_tokens=False).ids and counts.tolist() == [len(ids), 0]


def plain_best_fit(lengths, size, most):
    """Bins as a list that is searched through."""
    opened, placed, made = [], [], 0
    for length in lengths:
        fitting = [b for b in opened if b[1] >= length]
        if fitting:
            found = min(fitting, key=lambda b: b[1])
            opened.remove(found)
        else:
            found, made = [made, size], made + 1
        placed.append((found[0], size - found[1]))
        found[1] -= length
        if found[1]:
            opened.append(found)
        if len(opened) > most:
            opened.remove(min(opened, key=lambda b: b[1]))
    return placed


@pytest.mark.parametrize("most", [1, 3, 50, 10_000])
def test_bins_by_search(most):
    rng = random.Random(most)
    for size in (1, 7, 100, 1024):
        lengths = [rng.randint(1, size) for _ in range(1500)]
        bins = packing.Bins(size, most)
        assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, size, most)
        assert bins.open <= most


def check(packed, expected, size):
    """Pieces are those expected, and lie gapless in sequences of at most ``size``."""
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(expected, key=repr)
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def expected_pieces(rows, tokenizer, size):
    out = []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        starts = [0, *range(len(ids) % size or size, len(ids), size)]
        for n, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            assert end - start == size or n == 0 and end - start < size
            out.append((key, n, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    return out


@pytest.mark.parametrize("size", [1, 16, 1024])
def test_odd_rows(spark, tokenizer, size):
    rows = [(r[0], r[1]) for r in odd_rows() if size > 1 or len(r[1] or "") < 500]
    df = odd_frame(spark).where("size IS NOT NULL")
    df = df if size > 1 else df.where("text IS NULL OR length(text) < 500")
    packed = packing.pack_documents(df, PATH, size).collect()
    check(packed, expected_pieces(rows, tokenizer, size), size)


def test_no_rows(spark):
    assert packing.pack_documents(no_rows(spark), PATH).count() == 0


def test_ids_of_sequences(spark, tokenizer):
    packed = packing.pack_documents(odd_frame(spark), PATH, 64, ids=True).cache()
    rows = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert rows[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    total = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows())
    assert sum(map(len, rows.values())) == total


def test_few_sequences(spark):
    """Random lengths fit into hardly more sequences than their sum needs, over several tasks."""
    lengths = [int(x) for x in np.random.default_rng(8).integers(1, 1025, 30_000)]
    df = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(lengths)], "key long, piece int, start long, length long")
    packed = packing.pack(df)
    n = packed.select("sequence_id").distinct().count()
    assert n <= 1.005 * sum(lengths) / 1024
    over = packed.groupBy("sequence_id").agg(F.sum("length").alias("s"), F.max(F.col("offset") + F.col("length")).alias("e"))
    assert over.where("s <> e OR s > 1024").count() == 0


def test_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 100)
    df = spark.createDataFrame([(i, 0, 0, i % 50 + 1) for i in range(1000)], "key long, piece int, start long, length long")
    packed = packing.pack(df, 64).collect()
    assert len({r["sequence_id"] >> 32 for r in packed}) == 10
    again = packing.pack(df, 64).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, packed))


def test_given_tables(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
    got = queries.op12_packing(spark, folder).collect()
    expected = expected_pieces(rows, tokenizer, 1024)
    n = check(got, expected, 1024)
    assert n <= 1.02 * -(-sum(e[3] for e in expected) // 1024)
