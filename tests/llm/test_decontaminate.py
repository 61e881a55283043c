import random

import pyarrow as pa
import pytest

from chronofold.llm import decontaminate as d
from samples import LOWER, PLAIN, no_rows, odd_frame, odd_rows, sentence


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def judged(text, items, width=13, percent=5):
    found = plain(text)
    hit, named = set(), set()
    for item, said in items:
        looked = plain(said)
        size = min(width, len(looked))
        runs = {tuple(looked[i : i + size]) for i in range(len(looked) - size + 1)} if looked else set()
        for i in range(len(found) - size + 1 if looked else 0):
            if tuple(found[i : i + size]) in runs:
                hit |= set(range(i, i + size))
                named.add("" if item is None else str(item))
    return len(found), len(hit), sorted(named), len(hit) > 0 and 100 * len(hit) >= percent * len(found)


def items():
    rng = random.Random(5)
    long = [(i, sentence(100 + i, 40)) for i in range(8)]
    return long + [(20, "Tiny, item!"), (21, "ONE"), (22, ""), (23, None), (9, long[0][1][:120]), (0, "again " + sentence(100, 20)), (None, sentence(300, 15)), (31, sentence(101, 13))] + [(40 + i, sentence(rng.random(), 3)) for i in range(3)]


def documents():
    passage = sentence(102, 40)
    texts = [sentence(1, 100), sentence(1, 50) + " " + passage + ". " + sentence(2, 500), passage.upper().replace(" ", "--\n")]
    texts += ["x " * 300 + sentence(103, 13), " ".join(plain(sentence(104, 40))[3:16]), " ".join(plain(sentence(104, 40))[3:15])]
    texts += ["a tiny item here one", "one\u00e9 o-n-e", None, "", "...", sentence(300, 15), " ".join([sentence(101, 40)] * 3), sentence(100, 20) + " " + sentence(100, 40)]
    return list(enumerate(texts))


@pytest.mark.parametrize("pass_bytes", [d.PASS_BYTES, 4000])
@pytest.mark.parametrize("width", [13, 5])
def test_agrees_with_brute_force(spark, monkeypatch, pass_bytes, width):
    monkeypatch.setattr(d, "PASS_BYTES", pass_bytes)
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string")
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    out = d.find_contamination(docs, bench, width=width)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()}
    assert got == {i: judged(t, items(), width) for i, t in documents()}


def test_removal(spark):
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string")
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    bad = {i for i, t in documents() if judged(t, items())[3]}
    kept = {r.doc_id for r in d.find_contamination(docs, bench, remove="documents").collect()}
    assert bad and kept == {i for i, _ in documents()} - bad
    cut = {r.doc_id: r.text for r in d.find_contamination(docs, bench, remove="spans").collect()}
    assert cut[0] == documents()[0][1] and cut[8] is None
    assert cut[1] == sentence(1, 50) + " . " + sentence(2, 500)
    assert all(judged(t, [x for x in items() if len(plain(x[1])) >= 13])[1] == 0 for t in cut.values())


def test_equal_hashes_are_told_apart_by_the_words(monkeypatch):
    import numpy as np

    bench = [("1", "a b c"), ("2", "d e f"), ("3", "a b c")]
    words = d.Words.windows
    monkeypatch.setattr(d.Words, "windows", lambda self, n: (words(self, n)[0], np.full(len(words(self, n)[0]), 7, np.uint64)))
    found = d.benchmark_windows([i for i, _ in bench], pa.array([t for _, t in bench]), 3)
    assert [w.members[a:b].tolist() for w in found.windows for a, b in zip(w.begins, w.begins[1:])] == [[0, 2], [1]]
    raw = b"x d e f y a b d"
    _, hits = d.hits(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), found)
    assert hits == {0: ([(1, 4)], {"2"})}


def test_what_is_sent_is_bounded():
    """Items of 4 MB: the arrays are what the bound counts, a few times the text."""
    import tracemalloc

    rng = random.Random(8)
    vocabulary = [sentence(i, 1) for i in range(5000)]
    texts = [" ".join(rng.choices(vocabulary, k=1000)) for _ in range(750)]
    size, words = sum(map(len, texts)), 750 * 1000
    column = pa.array(texts)
    tracemalloc.start()
    made = d.benchmark_windows([str(i) for i in range(750)], column, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made.nbytes() <= size + 10_000 + d.BYTES_PER_WORD * words
    # what is made on the way is a few times that, besides the work on a slice of texts
    assert made.nbytes() < 6.25 * size and peak < 40_000_000 + 4 * d.BYTES_PER_WORD * words


def test_an_item_that_very_many_share(spark):
    bench = spark.createDataFrame([(i, sentence(100, 20)) for i in range(300)] + [(7, sentence(100, 20))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, sentence(100, 20))], "doc_id bigint, text string")
    row = d.find_contamination(docs, bench).first()
    assert row.n_hit == 20 and row["items"] == sorted(str(i) for i in range(300))


def test_cutting_with_many_passes(spark, monkeypatch):
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string")
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    once = {tuple(r) for r in d.find_contamination(docs, bench, remove="spans").select("doc_id", "text", "n_hit").collect()}
    monkeypatch.setattr(d, "PASS_BYTES", 5000)
    assert {tuple(r) for r in d.find_contamination(docs, bench, remove="spans").select("doc_id", "text", "n_hit").collect()} == once
    with pytest.raises(ValueError, match="remove"):
        d.find_contamination(docs, bench, remove="all")


def test_odd_rows_benchmark(spark):
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    out = d.find_contamination(odd_frame(spark), bench)
    got = sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)) for r in out.collect())
    assert got == sorted(str((r[0], *judged(r[1], items()))) for r in odd_rows())
    assert d.find_contamination(no_rows(spark), bench).count() == 0
    clean = d.find_contamination(odd_frame(spark), bench.limit(0)).collect()
    assert not any(r.contaminated or r.n_hit for r in clean)
