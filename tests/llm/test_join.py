import random
from collections import Counter

import pytest

from chronofold.llm import ngram_join
from chronofold.llm.components import components
from samples import classes, no_rows, odd_frame, odd_rows, sentence, shingle_set


def edited(text, n, rng):
    found = text.split()
    for _ in range(n):
        found[rng.randrange(len(found))] = "w%d" % rng.randrange(10**6)
    return " ".join(found)


def corpus():
    """Unrelated texts, pairs, chains of ever more edited copies, exact copies and one large group."""
    rng = random.Random(8)
    texts = [sentence(i, rng.randint(1, 150)) for i in range(120)]
    for i in range(30):
        texts.append(edited(sentence(i, 120), rng.randint(0, 5), rng))
    step = sentence(500, 200)
    for _ in range(25):
        step = edited(step, 2, rng)
        texts.append(step)
    group = sentence(900, 146)
    texts += [edited(group, rng.randint(1, 6), rng) for _ in range(150)]
    texts += [group] * 40 + [texts[3].upper()] * 2 + ["", " ", None]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small", [ngram_join.SMALL, 6])
def test_classes_agree_with_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_shingles) for r in ngram_join.near_duplicates(df).collect()}
    truth = classes(rows)
    assert len(got) == len(rows)
    wrong = [i for i, t in rows if got[i][0] != truth[shingle_set(t)][0]]
    # the join is sampled: of a group's outlying copies a few may be missed
    assert len(wrong) <= 0.005 * len(rows)
    assert all(got[i][2] == len(shingle_set(t)) for i, t in rows)
    assert all(got[i][1] <= truth[shingle_set(t)][1] for i, t in rows)
    linked = [i for i, t in rows if truth[shingle_set(t)][1]]
    assert sum(got[i][1] > 0 for i in linked) >= 0.995 * len(linked)


def test_recall_on_pairs_at_the_threshold(spark):
    rng = random.Random(4)
    rows, truth = [], 0
    for i in range(400):
        text = sentence(10_000 + i, 150)
        copy = edited(text, 3, rng)
        both = len(shingle_set(text) & shingle_set(copy)) / len(shingle_set(text) | shingle_set(copy))
        truth += both >= 0.8
        rows += [(2 * i, text), (2 * i + 1, copy)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sum(r.n_links for r in ngram_join.near_duplicates(df).collect()) / 2
    assert truth > 300 and found >= 0.99 * truth and found <= truth


def test_more_recall_takes_more_runs():
    assert ngram_join.runs_for(0.5) < ngram_join.runs_for(0.9) < ngram_join.runs_for(0.999)


def test_odd_rows_join(spark):
    got = ngram_join.near_duplicates(odd_frame(spark)).collect()
    truth = classes([(r[0], r[1]) for r in odd_rows()])
    expected = Counter((r[0], *truth[shingle_set(r[1])], len(shingle_set(r[1]))) for r in odd_rows())
    assert Counter(tuple(r) for r in got) == expected
    assert ngram_join.near_duplicates(no_rows(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(20)]
    links += [(7, 7), (8, 7), (7, 8)] + [(rng.randrange(9000, 9100), rng.randrange(9000, 9100)) for _ in range(60)]
    rng.shuffle(links)
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def changed(text, places, rng):
    found = text.split()
    for k in places:
        found[k] = "x%d" % rng.randrange(10**6)
    return " ".join(found)


def two_places(rng):
    p = rng.randrange(5, 85)
    return p, rng.randrange(p + 6, 95)


def classes_found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    return {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(df).collect()}


def test_similar_texts_in_a_crowd_are_compared(spark):
    """Pairs that share only what hundreds of others share too, so they meet in dense buckets alone."""
    rng = random.Random(11)
    text, texts = sentence(7000, 100), []
    for _ in range(200):
        places = two_places(rng)
        texts += [changed(text, places, rng) for _ in range(2)]
    got, truth = classes_found(spark, texts), classes(list(enumerate(texts)))
    assert {i: c for i, (c, _) in got.items()} == {i: truth[shingle_set(t)][0] for i, t in enumerate(texts)}


def test_islands_beside_a_large_group_join_it(spark):
    """Twins that are similar to each other and to a few outlying members of a large group."""
    rng = random.Random(12)
    text, texts = sentence(8000, 100), []
    for _ in range(200):
        p, q = two_places(rng)
        texts += [changed(text, [p], rng)] + [changed(text, [p, q], rng) for _ in range(2)]
    got, truth = classes_found(spark, texts), classes(list(enumerate(texts)))
    assert len({c for c, _ in truth.values()}) == 1
    assert {c for c, _ in got.values()} == {0}


@pytest.mark.parametrize("rows", [ngram_join.ROWS, 40])
def test_links_of_a_large_group_are_all_counted(spark, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "ROWS", rows)
    rng = random.Random(13)
    text = sentence(9000, 120)
    texts = [edited(text, rng.randint(1, 3), rng) for _ in range(200)]
    got, truth = classes_found(spark, texts), classes(list(enumerate(texts)))
    assert sum(n for _, n in got.values()) > 20 * 200
    assert got == {i: truth[shingle_set(t)] for i, t in enumerate(texts)}


def test_texts_of_one_template_go_through_deeper_trees(spark, monkeypatch):
    """Texts that share a third of their words with all others fill buckets without being alike."""
    rng = random.Random(14)
    texts = []
    for i in range(220):
        own = f"{sentence(9500, 60)} {sentence(30_000 + i, 65)}"
        texts += [own] + [edited(own, 2, rng) for _ in range(i % 3)]
    texts += [edited(sentence(9600, 120), 2, rng) for _ in range(60)]
    rng.shuffle(texts)
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    depths, compared, plain, gathered = [], [], ngram_join.trees, ngram_join.links_in_dense

    def trees(nodes, similarity, runs, levels, done=0):
        depths.append((levels, runs, done))
        return plain(nodes, similarity, runs, levels, done)

    def links_in_dense(dense, *rest):
        compared.append(sum(r["count"] ** 2 for r in dense.groupBy("path").count().collect()))
        return gathered(dense, *rest)

    monkeypatch.setattr(ngram_join, "trees", trees)
    monkeypatch.setattr(ngram_join, "links_in_dense", links_in_dense)
    truth = classes(list(enumerate(texts)))
    for wide in (ngram_join.WIDE, 12):
        monkeypatch.setattr(ngram_join, "WIDE", wide)
        assert classes_found(spark, texts) == {i: truth[shingle_set(t)] for i, t in enumerate(texts)}
    runs = [ngram_join.runs_for(ngram_join.RECALL, levels=n) for n in (3, 6, 12)]
    assert depths[:3] == [(3, runs[0], 0), (3, runs[0], 0), (6, runs[1], runs[0])]
    assert all(d == (12, runs[2], runs[0] + runs[1]) for d in depths[3:])
    # the group of like texts is still compared whole
    assert compared[1] < 0.75 * compared[0]


def test_agreement_of_buckets(spark):
    rng = random.Random(15)
    texts = [f"{sentence(9700, 100)} {sentence(40_000 + i, 100)}" for i in range(200)] + [edited(sentence(9800, 150), 1, rng) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = ngram_join.sketched(df, "text", "doc_id").selectExpr("key DIV 200 AS path", "key AS node", "sig").repartition(3)
    got = {r.path: r.agree for r in ngram_join.agreement(rows).collect()}
    assert 0.25 < got[0] < 0.42 and got[1] > 0.8


def test_recall_holds_at_other_similarities(spark):
    rng = random.Random(5)
    rows, truth = [], 0
    for i in range(300):
        text = sentence(20_000 + i, 150)
        copy = edited(text, 9, rng)
        both = len(shingle_set(text) & shingle_set(copy)) / len(shingle_set(text) | shingle_set(copy))
        truth += both >= 0.5
        rows += [(2 * i, text), (2 * i + 1, copy)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sum(r.n_links for r in ngram_join.near_duplicates(df, similarity=0.5).collect()) / 2
    assert truth > 200 and 0.99 * truth <= found <= truth
    assert ngram_join.runs_for(0.999, 0.5) > ngram_join.runs_for(0.999, 0.8) > 15
