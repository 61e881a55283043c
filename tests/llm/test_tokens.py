import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chronofold.llm import id_coder, token_files
from chronofold.sources.scratch import new_folder
from samples import no_rows, odd_frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_coder_round_trip():
    rng = np.random.default_rng(3)
    for ids in ([], [0], [65535], rng.integers(0, 65536, 9000), rng.integers(0, 2, 9000), np.zeros(id_coder.BLOCK * 2 + 1), rng.zipf(1.2, 30000) % 50000):
        ids = np.array(ids, np.int64)
        assert (id_coder.decode(id_coder.encode(ids)) == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=300))
def test_coder_round_trip_any(ids):
    assert id_coder.decode(id_coder.encode(np.array(ids, np.int64))).tolist() == ids


def test_coder_learns():
    phrase = np.random.default_rng(1).integers(0, 50000, 50)
    ids = np.tile(phrase, 80)
    assert len(id_coder.encode(ids)) * 8 < 2.5 * len(ids)


def test_coder_refuses_what_it_cannot_hold():
    for bad in ([-1], [65536]):
        with pytest.raises(ValueError):
            id_coder.encode(np.array(bad))


def test_coder_finds_damage():
    raw = bytearray(id_coder.encode(np.arange(3000) % 700))
    for at in (4, 8, 20, 200, len(raw) - 9):
        bad = bytearray(raw)
        bad[at] ^= 16
        with pytest.raises((ValueError, IndexError)):
            id_coder.decode(bytes(bad))
    with pytest.raises(ValueError):
        id_coder.decode(bytes(raw[:-1]))


def test_ids_of_texts(tokenizer):
    texts = ["<|endoftext|>", "it's we'll", "", "\x00\x01", "x" * 5000, "東京 😀\n\n a"]
    ids, counts = token_files.coded(texts, PATH)
    whole = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert counts.tolist() == [len(x) for x in whole]
    assert ids.tolist() == [i for x in whole for i in x]
    assert [len(r) for r in token_files.chunks(["a" * 200_000] * 3 + ["b" * 500_000, ""])] == [1, 1, 1, 1, 1]


def documents(rows, tokenizer):
    start, out = 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for key, text in order:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("lanes", [id_coder.LANES, 1])
def test_files_round_trip(spark, monkeypatch, tokenizer, lanes):
    monkeypatch.setattr(id_coder, "LANES", lanes)
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = token_files.token_round_trip(odd_frame(spark), PATH, ids=True).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == documents(rows, tokenizer)


def test_many_files(spark, small_conf, tokenizer):
    small_conf("spark.sql.adaptive.enabled", "false")
    rows = [(i * 7 % 500, f"document {i} {'word ' * (i % 50)}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = token_files.token_round_trip(df, PATH, ids=True)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == documents(rows, tokenizer)


def test_rows_of_one_key_are_spread(spark, small_conf, tokenizer):
    small_conf("spark.sql.adaptive.enabled", "false")
    rows = [(k, f"{i * 7 % 300} of {k}") for k in (None, 5) for i in range(300)] + [(6, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    folder = new_folder(spark, "tokens")
    manifest = token_files.write_tokens(df, folder, PATH)
    assert manifest.count() >= 6 and manifest.agg({"docs": "max"}).first()[0] < 250
    got = token_files.read_tokens(spark, manifest).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == documents(rows, tokenizer)


def test_all_orders_are_mixed():
    """What repeats after one id, and after two, costs less than its share of all ids; no order is left out."""
    rng = np.random.default_rng(5)
    follows = rng.permutation(64)
    by_one = np.zeros(4000, np.int64)
    for i in range(1, 4000):
        by_one[i] = follows[by_one[i - 1]] if i % 4 else rng.integers(64)
    few = rng.choice(8, 4000) * 31
    by_two = few.copy()
    for i in range(2, 4000):
        by_two[i] = (by_two[i - 1] * 3 + by_two[i - 2] * 5) % 11 if i % 3 else few[i] % 11
    even = rng.integers(0, 64, 4000)
    cost = lambda ids: len(id_coder.encode(ids)) * 8 / len(ids)
    assert cost(even) > 6 and cost(by_one) < 4 and cost(few) < 3.3 and cost(by_two) < 2.5
    ids = np.concatenate([by_one, few])
    mixer = id_coder.Mixer(1)
    for x in ids[:2000]:
        mixer.begin(1)
        node = np.ones(1, np.int32)
        for bit in range(id_coder.ID_BITS):
            value = np.array([x >> (id_coder.ID_BITS - 1 - bit) & 1], np.int32)
            chance = mixer.chance(1, bit, node)
            assert 0 < chance[0] < id_coder.ONE
            logits = mixer.logits[:, 0] * mixer.used[:, 0] >> id_coder.WEIGHT_BITS
            assert abs(np.clip(logits.sum(), -2047, 2047) - np.log(chance[0] / (4096 - chance[0])) * 256) < 300
            mixer.learn(1, bit, value)
            node = node * 2 + value
        mixer.end(1, np.array([x], np.int32))
    assert len({tuple(w) for w in mixer.weights[:, :, 0].tolist()}) > 4


def coded_by_executors(spark, rows, which):
    code = token_files.id_functions(spark)[which]
    df = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(rows)], "i int, given binary")
    return [bytes(r[0]) for r in df.select(code("given").alias("x"), "i").sort("i").select("x").collect()]


def test_executors_code_the_same_bytes(spark):
    rng = np.random.default_rng(8)
    kinds = [rng.integers(0, 65536, 2000), rng.integers(0, 2, 1500), np.zeros(1500), rng.zipf(1.2, 1500) % 50000]
    ids = [np.array(x, np.int64) for x in ([], [0], [65535], np.concatenate([*kinds, np.tile([7, 65535, 9], 500)]))]
    raw, coded = [x.astype("<u2").tobytes() for x in ids], [id_coder.encode(x) for x in ids]
    assert coded_by_executors(spark, raw, 0) == coded
    assert coded_by_executors(spark.newSession(), coded, 1) == raw


def test_executors_find_damage(spark):
    raw = id_coder.encode(np.arange(3000) % 700)
    bad = [bytearray(raw) for _ in range(5)]
    for b, at in zip(bad, (4, 8, 20, 200, len(raw) - 9)):
        b[at] ^= 16
    for b in (*bad, raw[:-1], raw[:7], b"", b"\xff" * 16):
        with pytest.raises(Exception, match="checksum of block 0 differs|coded ids are cut short"):
            coded_by_executors(spark, [b], 1)


def test_ids_pass_from_part_to_part(spark, tokenizer):
    rows = [(1, "a b" * token_files.PART), (2, "x"), (3, "c" * 50), (4, " d" * (token_files.PART - 1)), (None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = token_files.token_round_trip(df, PATH, ids=True).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == documents(rows, tokenizer)


def test_no_rows_no_file(spark):
    assert token_files.token_round_trip(no_rows(spark), PATH).count() == 0
