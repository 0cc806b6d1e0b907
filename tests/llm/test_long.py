"""Very long texts and very many matches in one text: each operator ends in seconds, with plain results."""

from __future__ import annotations

import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import hashlib  # noqa: E402

import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402

from waymill.llm import classifier, exact_dedup, lm_score, mixing, pieces, pii, preferences, rules, secrets, simhash  # noqa: E402

LONG = {
    "labels of a domain": "x@" + "a." * 200_000 + "com", "addresses": "ab.c@d.ee " * 50_000, "digits": "7" * 1_000_000, "pluses": "+1 " * 200_000, "octets": "1.2.3.4 " * 40_000,
    "numbers": "555-123-4567 " * 40_000, "only pluses": "+" * 500_000, "cards": "4111 1111 1111 1111, " * 20_000, "at signs": "a@" * 150_000, "dashes": "1-" * 200_000, "dots": "." * 300_000, "zeros": "0" * 4000 + ".1.1.1",
}


@pytest.mark.parametrize("name", LONG)
def test_personal_data_in_one_long_text(spark, name):
    text = LONG[name]
    began = time.time()
    got = pii.scan(spark.createDataFrame([(1, text), (2, "mail a@b.cd")], "doc_id long, text string")).collect()
    assert time.time() - began < 60
    quick = name in ("digits", "only pluses", "dashes", "dots", "at signs")  # the plain patterns are quadratic there and match nothing
    assert {r["doc_id"]: r["base_sha256"] for r in got}[1] == brute.sha("" if quick else brute.joined(brute.personal_spans(text)))


WORDS = " ".join(f"w{i % 977}x{i % 31}" for i in range(150_000))
TEXTS = {"one word": "a" * 1_000_000, "spaces": " " * 1_000_000, "words": WORDS, "secrets": "secret=abcdef12 tokentokentokentoken " * 15_000, "lines": "one line of it\n" * 60_000}


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS.values())] + [(50, "a short text", "s"), (51, None, None)], "doc_id long, text string, source string")


def timed(frame, seconds=120):
    began = time.time()
    rows = frame.collect()
    assert time.time() - began < seconds
    return rows


def test_long_texts_secrets(long_docs):
    texts = list(TEXTS.values())
    for r in timed(secrets.scan(long_docs)):
        if r["doc_id"] < 50:
            assert r["base_sha256"] == brute.sha(brute.joined(brute.secret_spans(texts[r["doc_id"]])))


def test_long_texts_exact_dedup(long_docs):
    got = {r["doc_id"]: r["digest"] for r in timed(exact_dedup.exact_dedup(long_docs))}
    assert all(got[i] == hashlib.sha256(t.lower().encode()).hexdigest() for i, t in enumerate(TEXTS.values()))


def test_long_texts_rules(long_docs):
    got = {r["doc_id"]: r for r in timed(rules.judged(long_docs))}
    assert got[2]["n_words"] == 150_000 and got[0]["word_chars"] == 1_000_000 and got[1]["n_words"] == 0 and got[4]["n_dup_lines"] == 59_999


def test_long_texts_mixing(long_docs):
    assert all(r["text"] in (*TEXTS.values(), "a short text", None) for r in timed(mixing.mix(long_docs, rows=20)))


def test_long_texts_classifier(long_docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    assert len(timed(classifier.classify(long_docs, labels))) == 7


def test_long_texts_preferences(long_docs, spark):
    turns = spark.createDataFrame([(c, i, ("user", "assistant")[i % 2], "x" * (i % 50)) for c in (0, 1) for i in range(3000 + c)] + [(2, 0, "assistant", TEXTS["words"])], "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in timed(preferences.format_pairs(preferences.adjacent_pairs(turns)))}
    assert got[0]["prompt_turns"] == 3000 and got[1]["chosen_mask"] == f"14:{14 + len(TEXTS['words'])}"


def test_long_texts_cross_entropy(long_docs, spark):
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    assert {r["doc_id"]: r["n_words"] for r in timed(lm_score.score(long_docs, labels))}[2] == 150_000


def test_long_texts_pieces(long_docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    for r in timed(pieces.encode(long_docs, model)):
        assert r["ids"] == sp.encode(r["text"] or "", add_bos=True, add_eos=True) and r["decoded"] == sp.decode(r["ids"])


def test_long_texts_simhash(long_docs):
    assert len(timed(simhash.near_groups(long_docs))) == 7
