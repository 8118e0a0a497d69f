"""The corpus pipeline, stage by stage and as a whole."""

import re

import numpy as np
import pytest

import corpus_pipeline
from tallyguard.llm import tokens
from test_operators import covered, shingles

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, SMALL), "test")
        out[name] = (before.toPandas(), docs.toPandas())
    return out


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "best_fit_packing":
            assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rejected_documents_go(stages):
    before, after = stages["quality_classifier"]
    assert 0.6 * len(before) < len(after) < len(before) and after.doc_id.is_unique


def test_one_of_each_group_stays(stages):
    before, after = stages["minhash_near_dedup"]
    sets = {i: shingles(t or "", 5) for i, t in zip(before.doc_id, before.text)}
    kept = sorted(after.doc_id)
    for n, i in enumerate(kept):
        for j in kept[n + 1 :]:
            a, b = sets[i], sets[j]
            common = len(a & b)
            assert not (a and b and 100 * common >= 80 * (len(a) + len(b) - common)) or i > j


def test_repeats_are_cut_and_the_first_stays(stages):
    before, after = (x.sort_values("doc_id") for x in stages["suffix_array_dedup"])
    raw = [(t or "").encode() for t in before.text]
    size = corpus_pipeline.PASSAGE.size
    for text, old, hit in zip(after.text, raw, covered(raw, size, True)):
        left = np.frombuffer(old, np.uint8)[~hit]
        assert abs(len((text or "").encode()) - len(left)) <= 6 * (1 + int(hit.any()) * 8)
        if not hit.any():
            assert (text or "").encode() == old
    assert (after.n_chars == after.text.str.len()).all()


def test_passages_of_51_short_words_are_cut(spark):
    rng = np.random.default_rng(51)
    draw = lambda n: " ".join("".join(chr(c) for c in rng.integers(97, 123, rng.integers(1, 5))) for _ in range(n))
    long_, short, unlike = draw(51), draw(50), [draw(30) for _ in range(8)]
    assert max(len(short), len(long_)) < corpus_pipeline.PASSAGE.size
    texts = [
        f"{unlike[0]} Xa {long_} aX {unlike[1]}",
        f"{unlike[2]} Yb {long_} bY {unlike[3]}",
        f"{unlike[4]} Zc {short} cZ {unlike[5]}",
        f"{unlike[6]} Wd {short} dW {unlike[7]} {long_}",
    ]
    docs = spark.createDataFrame([(7 + i, t) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string")
    left = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, SMALL).collect()}
    whole = [texts[0], texts[1].replace(long_, ""), texts[2], texts[3].replace(long_, "")]
    assert [left[7 + i] for i in range(4)] == whole and len(left[11]) < 10
    apart = " ".join("a" * (1 + i % 2) for i in range(51))
    ones = spark.createDataFrame([(None, apart), (1, f"b {apart} c"), (1, f"c {apart} b")], "doc_id long, text string")
    assert sorted(r.text for r in corpus_pipeline.suffix_dedup(spark, ones, SMALL).collect()) == sorted([apart, "b  c", "c  b"])


def test_the_mix_repeats_documents(stages):
    before, after = stages["entropy_mixing"]
    copies = after.doc_id.value_counts()
    assert copies.max() <= 3 and set(after.doc_id) <= set(before.doc_id) and after.doc_id.duplicated().any()


def test_packing_holds_all_ids(stages):
    before, after = stages["best_fit_packing"]
    encoder = tokens.encoder(tokens.default_path())
    n = sum(len(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in before.text)
    assert after.length.sum() == n and after.groupby("sequence_id").length.sum().max() <= 2048


def test_run_is_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() == len(stages["best_fit_packing"][1])
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0])


ODD = "doc_id long, text string, lang string, source string, n_chars long, _id int, _texts string, `_copies` int, other_id int, covered_a int, others string, `a b.c` string, _n int, count int"


def odd_documents():
    long_ = " ".join(f"wort{i % 977} ünd{i % 13}" for i in range(20_000))
    rows = [
        (1, "The cat sat on the mat and the dog ran off with it", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, " \t\n", "de", "b"),
        (5, long_, "de", "b/x"), (6, long_, "de", None), (None, "no id here but some words", "en", None), (None, None, None, None),
        (None, "no id here but some words", "en", None), (7, "same row twice", "en", "a"), (7, "same row twice", "en", "a"),
        (8, "one id two texts", "en", "a"), (8, "quite another text", "en", "b"), (9, "é" * 900, "fr", "a"),
    ]
    return [(*r, 0, 1, "t", 2, 3, 4, "o", "x", 5, 6) for r in rows]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_and_clashing_names_go_through_every_stage(spark, empty):
    docs = spark.createDataFrame([] if empty else odd_documents(), ODD)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, SMALL), "odd")
        assert docs.columns == before.columns, name
    kept = docs.toPandas()
    assert len(kept) == 0 if empty else {1, 2, 3, 5} <= set(kept.doc_id.dropna())
    packed = corpus_pipeline.pack(spark, docs, SMALL)
    assert packed.count() >= len(kept)
