import zlib

import numpy as np
import pytest

from chronofold.llm import quality_model as q
from chronofold.llm.queries import op2_quality
from samples import no_rows, odd_frame, odd_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    rows = op2_quality(spark, FOLDER).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    return rows, labels


def test_held_out_accuracy(scored):
    rows, labels = scored
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for p, y in judged if y == 1]
    bad = [p for p, y in judged if y == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_contract_of_the_query(spark, scored):
    rows, _ = scored
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    one = q.fit(docs, labels)
    other = q.fit(docs.selectExpr("doc_id", "text", "'x' as lang").repartition(5), flipped)
    assert one.bias == other.bias and (one.weights == other.weights).all()


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad!! words!!") for i in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int")
    model = q.fit(docs, labels, sample=10)
    again = q.fit(docs, labels, sample=10)
    assert (model.weights == again.weights).all()


def test_a_score_depends_on_its_text_alone():
    model = q.train([(*q.bag(t.encode()), y) for t, y in [("some plain words here", 1), ("spam spam spam!!", 0)] * 20])
    texts = ["some plain words", "", "spam spam", "é 東京 x", "x", "spam spam spam spam!!"]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = model.scores(np.frombuffer(b"".join(raw), np.uint8), at)
    alone = [model.scores(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert together.tolist() == alone
    bags = [q.bag(r) for r in raw]
    by_bag = [1 / (1 + np.exp(-(model.bias + model.weights[i] @ s))) for i, c in bags for s in [q.shares_of(i, c)]]
    assert np.allclose(together, by_bag)
    assert together[0] > 0.5 > together[5]


def test_character_grams_by_plain_counting():
    def bucket(gram):
        hashed = int.from_bytes(gram, "big") * 0x9E3779B1 & 0xFFFFFFFF ^ len(gram) * 0x85EBCA6B & 0xFFFFFFFF
        hashed = (hashed ^ hashed >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
        return (hashed >> 32 - q.BITS) + (2 << q.BITS)

    raw = [b"", b"a", b"ab", b"", b"abc", "é東 x".encode(), b"abcd abcd", b"\n"]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    parts = [(b, s) for group, b, s in q.features(np.frombuffer(b"".join(raw), np.uint8), at) if group == 2]
    assert len(parts) == len(q.CHARS)
    for n, (buckets, starts) in zip(q.CHARS, parts):
        got = [buckets[i:j].tolist() for i, j in zip(starts, starts[1:])]
        assert got == [[bucket(r[i : i + n]) for i in range(len(r) - n + 1)] for r in raw]


def test_slices_change_no_score(spark, monkeypatch):
    texts = [None, "", "a", "some plain words", "spam " * 50, "é 東京", "plain"] * 6
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    model = q.train([(*q.bag(t.encode()), y) for t, y in [("some plain words here", 1), ("spam spam spam!!", 0)] * 20])
    whole = sorted(map(tuple, q.score(df, model).collect()), key=lambda r: r[0])
    monkeypatch.setattr(q, "SLICE_BYTES", 7)
    assert sorted(map(tuple, q.score(df, model).collect()), key=lambda r: r[0]) == whole
    assert [r[0] for r in whole] == list(range(len(texts)))


def test_odd_rows_quality(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, None), (None, 1), (6, 1), (9, 7)], "doc_id bigint, quality int")
    model = q.fit(odd_frame(spark), labels)
    rows = q.score(odd_frame(spark), model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    none = q.fit(no_rows(spark), labels)
    assert {r.score for r in q.score(odd_frame(spark), none).collect()} == {0.5}
    assert q.score(no_rows(spark), model).count() == 0


def test_one_text_of_a_repeated_key_and_a_bound_on_bytes(spark):
    rows = [(1, f"text {i} of many") for i in range(300)] + [(i, f"good words {i}") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    learned = []

    def train(bags, **_):
        learned.append(bags)
        return q.Model(np.zeros(q.GROUPS << q.BITS), 0.0)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(q, "train", train)
        q.fit(docs, labels)
        q.fit(docs, labels, sample_bytes=2000)
        q.fit(docs, labels, sample=3)
    taught = [i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 5]
    assert len(learned[0]) == len(taught)
    size = lambda bags: sum(i.nbytes + c.nbytes for i, c, _ in bags)
    assert 0 < size(learned[1]) <= 2000 < size(learned[0]) and len(learned[2]) == 3


def test_training_steps_by_plain_gradient(monkeypatch):
    """Three steps against the gradient of the log loss by finite differences."""
    monkeypatch.setattr(q, "EPOCHS", 1)
    bags = [(*q.bag(t.encode()), y) for t, y in (("some plain words", 1), ("spam spam!!", 0), ("words again", 1))]
    used = np.unique(np.concatenate([i for i, _, _ in bags]))
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / q.DIM, 1 / q.DIM, (q.GROUPS << q.BITS, q.DIM))
    small, at = vectors[used], {int(b): n for n, b in enumerate(used)}
    out, bias = np.zeros((2, q.DIM)), np.zeros(2)
    order = rng.permutation(3)

    def loss(small, out, bias, ids, counts, label):
        groups = [sum(int(c) for i, c in zip(ids, counts) if i >> q.BITS == g) for g in range(q.GROUPS)]
        mean = sum(int(c) / groups[i >> q.BITS] / q.GROUPS * small[at[int(i)]] for i, c in zip(ids, counts))
        logits = out @ mean + bias
        return np.log(np.exp(logits).sum()) - logits[label]

    def slope(f, x, e=1e-6):
        grad = np.zeros_like(x)
        for n in np.ndindex(x.shape):
            up, down = x.copy(), x.copy()
            up[n] += e
            down[n] -= e
            grad[n] = (f(up) - f(down)) / (2 * e)
        return grad

    for step, k in enumerate(order):
        ids, counts, y = bags[k]
        rate = q.RATE * (1 - step / 3)
        grads = (
            slope(lambda v: loss(v, out, bias, ids, counts, y), small),
            slope(lambda v: loss(small, v, bias, ids, counts, y), out),
            slope(lambda v: loss(small, out, v, ids, counts, y), bias),
        )
        small = small - rate * len(ids) ** 0.5 * grads[0]
        out, bias = out - rate * grads[1], bias - rate * 0.1 * grads[2]
    model = q.train(bags)
    assert np.allclose(model.weights[used], small @ (out[1] - out[0]), atol=1e-6)
    assert abs(model.bias - (bias[1] - bias[0])) < 1e-6
