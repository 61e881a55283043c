"""The stages one by one against plain Python, and all of them in a row."""

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from chronofold.llm import quality_model
from samples import classes, no_rows, odd_frame, odd_rows, sentence, shingle_set, words
from test_decontaminate import judged
from test_mixing import aims
from test_shards import check

FOLDER = "/root/testdata/sf0.001"


def load(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_stages():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality classifier",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "mixing sources to target weights",
        "sharding",
    ]
    assert contract.queries()["pipeline"] is pipeline.run


def one_of_each(rows):
    """Of each class the row with the smallest id; of equal rows one."""
    truth = classes([(r[0], r[1]) for r in rows])
    alone = [r for r in rows if truth[shingle_set(r[1])][0] is None]
    assert not alone or len({shingle_set(r[1]) for r in alone}) == len(alone)
    firsts = {r for r in rows if r[0] is not None and r[0] == truth[shingle_set(r[1])][0]}
    return Counter(firsts) + Counter(alone)


def test_one_document_of_each_class_stays(spark):
    rows = [r[:5] for r in odd_rows()] + [(20, sentence(2, 70) + " x", "xx", "b", 1), (21, "a b\x85", "xx", None, 4)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    kept = pipeline.keep_one_of_each(spark, spark.createDataFrame(rows, schema), FOLDER)
    got = Counter(tuple(r) for r in kept.collect())
    truth = classes([(r[0], r[1]) for r in rows])
    by_class = defaultdict(list)
    for row in got.elements():
        by_class[truth[shingle_set(row[1])][0]].append(row)
    assert set(by_class) == {c for c, _ in truth.values()}
    assert all(len(v) == 1 for v in by_class.values())
    # a null id sorts first, so in a class with one it stays
    assert got <= Counter(rows)


def test_stages_survive_odd_rows_and_no_rows(spark):
    columns = odd_frame(spark).columns
    for frame in (odd_frame, no_rows):
        docs = frame(spark)
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            rows = out.collect()
            if name != "sharding":
                assert out.columns == columns, name
            if frame is no_rows:
                assert rows == []


def test_mixed_rows_are_the_budget(spark):
    rows = [(i, sentence(i, 3 + i % 40), "xx", "abc"[i % 3] if i % 7 else None, i) for i in range(90)] + [(90, " ", "xx", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mixed = pipeline.mix_sources(spark, docs, FOLDER).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    taken, whole = defaultdict(int), {r[0]: r for r in rows}
    cut = 0
    for r in mixed:
        taken[r.source] += len(words(r.text))
        if tuple(r) != whole[r.doc_id]:
            cut += 1
            assert whole[r.doc_id][1].startswith(r.text) and r.n_chars == len(r.text)
    assert {s: int(t + 1e-9) for s, t in aims(sizes).items()} == taken
    assert cut <= len(sizes) and max(Counter(r.doc_id for r in mixed).values()) == 2


def test_all_stages_in_a_row(spark):
    docs = load(spark, "documents")
    rows = [tuple(r) for r in docs.collect()]
    model = quality_model.fit(docs, load(spark, "labels"))
    passed = {r.doc_id for r in quality_model.score(docs, model).where("predicted = 1").collect()}
    rows = [r for r in rows if r[0] in passed]
    rows = list(one_of_each(rows).elements())
    items = [tuple(r) for r in load(spark, "benchmark").select("item_id", "text").collect()]
    rows = [r for r in rows if not judged(r[1], items)[3]]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = sum(int(t + 1e-9) for t in aims(sizes).values())
    mixed = pipeline.mix_sources(spark, spark.createDataFrame(rows, docs.schema), FOLDER).collect()
    assert sum(len(words(r.text)) for r in mixed) == target
    out = pipeline.run(spark, FOLDER).withColumnRenamed("doc_id", "key").collect()
    check([(r.doc_id, r.text) for r in mixed], out, 16)


@pytest.mark.parametrize("stage", [pipeline.keep_quality, pipeline.remove_benchmarks])
def test_clean_documents_stay(spark, stage):
    docs = load(spark, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    kept = {r.doc_id for r in stage(spark, docs, FOLDER).collect()}
    good = {r.doc_id for r in load(spark, "labels").where("quality = 1").collect()}
    if stage is pipeline.remove_benchmarks:
        items = [tuple(r) for r in load(spark, "benchmark").select("item_id", "text").collect()]
        assert kept == {r.doc_id for r in docs.collect() if not judged(r.text, items)[3]}
    else:
        assert len(good & kept) >= 0.98 * len(good)
