"""Token alignment, toxicity and importance resampling against plain versions and on odd tables."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from waymill.llm import alignment, importance, queries, toxicity  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LINE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potent and fizzy drink"
ODD = [
    None, "", " ", "  a", "a  b\n  c", "x ▁ y", "▁", "  a  ", "<|endoftext|> hi <s> </s>", "l'été  d'août\n\n x", "\U0001f600 é́ é", "a\x1c b \x1f c   d", "word " * 5, "\t tab\r\n",
    "ﬁ ½ Ａ 　 ​", "it's they'll don't 'll 12 345 6789 !!! ... #*", LINE, LINE, LINE.upper(), (LINE + " ") * 3, "x" * 300, "é" * 200, "a\x00b c",
]
SCHEMA = "doc_id long, text string, row int, score string, rank string, n_links string, block long, label int, no string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 1, "s", "r", "l", 3, 0, "n") for i, t in enumerate(ODD)]
    rows += [rows[16], (None, LINE, None, None, None, None, None, None, None), (None, None, *[None] * 7), (None, LINE, 1, "", "", "", 0, 0, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.mark.parametrize(("block", "memo", "held"), [(1 << 14, 1 << 17, 1 << 20), (2, 3, 1)])
def test_alignment_equals_plain_version(spark, odd, libraries, monkeypatch, block, memo, held):
    for name, value in (("BLOCK_DOCS", block), ("MEMO", memo), ("HELD_DOCS", held)):
        monkeypatch.setattr(alignment, name, value)
    docs = odd.select("doc_id", "text").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    assert rows_of(alignment.align(docs, A, B)) == sorted(brute.aligned(pairs(docs), *libraries), key=str)


def test_alignment_of_clashing_names_and_empty_tables(odd, none, libraries):
    assert rows_of(alignment.align(odd, A, B)) == sorted(brute.aligned(pairs(odd), *libraries), key=str)
    assert alignment.align(none, A, B).collect() == []


def test_runs_hold_what_went_in():
    random.seed(5)
    keys = np.array([random.choice([1, 7, 50000]) << 32 | random.choice([3, 9, 31999]) for _ in range(500)])
    owners = np.array([random.choice([0, 1, 5, 16383]) for _ in range(500)])
    got = {}
    for _, pairs_, postings in alignment.runs_of(keys, owners, 3):
        own, n = alignment.pairs_of(pairs_)
        docs, links = alignment.postings_of(postings, n)
        for key, doc, many in zip(np.repeat(own, n).tolist(), docs.tolist(), links.tolist(), strict=True):
            got[key, doc] = many
    want: dict = {}
    for key, doc in zip(keys.tolist(), owners.tolist(), strict=True):
        want[key, doc] = want.get((key, doc), 0) + 1
    assert got == want


def test_merge_counts_and_maxima():
    run = lambda *x: (np.array([a << 32 | b for a, b, _ in x]), np.array([n for *_, n in x]))
    keys, counts, best = alignment.merged([run((1, 1, 2), (1, 2, 1), (2, 9, 4)), run((1, 2, 3), (2, 8, 4), (3, 0, 1)), run()])
    assert counts.tolist() == [2, 4, 4, 4, 1] and best.tolist() == [False, True, True, True, True]


@pytest.mark.parametrize(("samples", "segments"), [(1 << 20, 4), (2, 7), (50, 1)])
def test_resampling_equals_one_sort(spark, odd, monkeypatch, samples, segments):
    monkeypatch.setattr(importance, "SAMPLES", samples)
    docs = odd.select("doc_id", "text").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    docs = docs.union(spark.createDataFrame([(77, (LINE + " ") * 2)] * 60, "doc_id long, text string"))  # ties of score and id
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", segments)
    try:
        got = rows_of(importance.resample(docs.repartition(5), target))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == sorted(brute.resampled(pairs(docs), [r["text"] for r in target.collect()]), key=str)


def test_resampling_of_clashing_names_and_empty_tables(spark, odd, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(importance.resample(odd, empty)) == sorted(brute.resampled(pairs(odd), []), key=str)
    assert importance.resample(none, odd.select("text")).collect() == []


def test_resampling_of_longer_features(spark):
    counts = importance.bucket_counts(spark.createDataFrame([("A b-c",), (None,)], "text string"), 2)
    want = [importance.zlib.crc32(w) % importance.BUCKETS for w in (b"a", b"b", b"c", b"a b", b"b c")]
    assert counts.sum() == 5 and all(counts[w] for w in want)


def test_toxicity_on_held_out_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    got = queries.op12_toxicity(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.count() == docs.count() and got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    met = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").selectExpr("toxic", "predicted").collect()
    toxic, clean = [r[1] for r in met if r[0]], [r[1] for r in met if not r[0]]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.06 * len(clean)  # one in twenty labels of toxic documents is noise there


def toxic_rows(n=240):
    random.seed(8)
    syllables = ["lo", "ra", "ti", "men", "sto", "ve", "qua", "den", "fi", "gor"]
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randint(1, 3)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(80)]
        bad = i % 4 == 0
        for _ in range(5 * bad):
            words.insert(random.randrange(80), random.choice(["blockhead", "nitwit", "Nitwits,", "dimwitted"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_finds_words_of_toxic_texts(spark, odd):
    rows, labels = toxic_rows()
    extra = [(900, None), (901, ""), (None, "you nitwit, a blockhead and dimwitted nitwits"), (902, "men lo ra dimwitted blockhead nitwit men ti sto"), (903, "men lo ra tiqua men ti sto " * 9)]
    docs = spark.createDataFrame(rows + extra + rows[:3], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (1, 0), (5, None), (None, 1), (6, 7)], "doc_id long, toxic int")
    got = toxicity.classify(docs, marks).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == docs.count() and all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert by[902]["predicted"] == by[None]["predicted"] == 1 and by[900]["score"] == by[901]["score"] < 0.5 and by[903]["predicted"] == 0
    known = dict(labels)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (brute.zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert held and sum(r["predicted"] == known[r["doc_id"]] for r in held) >= 0.95 * len(held)
    model = toxicity.fit(docs, marks)
    extra = toxicity.scored(odd, model)
    assert extra.columns == [*odd.columns, "predicted"] and extra.count() == odd.count()


def test_toxicity_scores_do_not_depend_on_held_out_labels_or_partitions(spark):
    rows, labels = toxic_rows(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda i: brute.zlib.crc32(str(i).encode()) % 5 == 0
    plain = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, y in labels], "doc_id long, toxic int")
    assert toxicity.fit(docs.repartition(1), plain) == toxicity.fit(docs.repartition(7), turned)


def test_toxicity_without_labels(spark, odd, none):
    for marks in ([], [(1, 1)], [(16, 0)]):
        got = toxicity.classify(odd, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
        assert len(got) == odd.count() and {r["score"] for r in got} == {0.0}
    assert toxicity.classify(none, spark.createDataFrame(toxic_rows(8)[1], "doc_id long, toxic int")).collect() == []


def test_long_texts(spark, libraries):
    random.seed(9)
    words = [f"w{random.randrange(3000)}" for _ in range(150_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "x" * 200_000), (3, " " * 100_000), (4, LINE)], "doc_id long, text string")
    assert rows_of(alignment.align(docs, A, B)) == sorted(brute.aligned(pairs(docs), *libraries), key=str)
    assert rows_of(importance.resample(docs, docs)) == sorted(brute.resampled(pairs(docs), [t for _, t in pairs(docs)]), key=str)
    rows, labels = toxic_rows(120)
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    once = toxicity.Gains(model.base, model.toxic)
    want = {r[0]: once.features(r[1]) for r in pairs(docs)}
    assert want[1][-1] == pytest.approx(np.log1p(150_000)) and toxicity.scored(docs, model).count() == 4
