"""Secret scan: fixed patterns, and character Markov models compared by likelihood.

Two order-1 character models are trained from labelled samples of the corpus. Random strings:
the values that the fixed patterns match. Ordinary identifiers: of all other runs of token
characters those too short to be judged, and the long ones that read as identifiers, words in
camel, snake and kebab case, paths, and numbers without letters (``IDENTIFIER``), so that a long
card, phone or order number is told by its digits and not by its length. Counting is one pass over every whole text; what is gathered is two
square tables over a fixed alphabet, whatever the corpus. A second pass scores each long
token outside the base spans: the sum of the log-likelihood ratios of its transitions
against ``MIN_RATIO``, the log odds of one secret in a million tokens.

Defined cases: a null text is the empty text, with no span and the digest of the empty
string; a very long text takes time in proportion to its length and its spans; rows repeated
give their rows again; extra columns are ignored; an empty table gives
an empty result; with no sample of a class its model is
uniform by smoothing.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # shorter runs fail anyway
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Words, capitalised words or short runs of capitals, up to four digits behind them, or digits alone; parts joined by separators.
_PART = "(?:(?:[a-z]{2,}+|[A-Z][a-z]{2,}+|[A-Z]{2,12}(?![a-z]))++[0-9]{0,4}+|[0-9]++)"
IDENTIFIER = re.compile(f"[+/_=-]*{_PART}(?:[+/_=-]++{_PART})*+[+/_=-]*")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
SIZE = len(ALPHABET) + 1  # the last symbol separates tokens
MIN_RATIO = math.log(1e6)
SMOOTHING = 0.5
BACKOFF = 8.0  # weight, in counts, of the single-character model behind each context

_SYMBOLS = np.full(256, SIZE - 1, np.int32)
for _i, _c in enumerate(ALPHABET):
    _SYMBOLS[ord(_c)] = _i


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, where the value starts), by start and then kind."""
    found = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def _transitions(data: bytes) -> np.ndarray:
    at = _SYMBOLS[np.frombuffer(data, np.uint8)]
    return np.bincount(at[:-1] * SIZE + at[1:], minlength=SIZE * SIZE)


def _identifier(token: re.Match) -> str:
    """A long token that is a sample of the ordinary class; else a space."""
    return token[0] if IDENTIFIER.fullmatch(token[0]) else " "


def sample_counts(texts: Iterator[str | None]) -> np.ndarray:
    """[label, from, to]: label 1 for values of base spans, 0 for the short tokens and the long identifiers left."""
    out = np.zeros((2, SIZE * SIZE), np.int64)
    for text in texts:
        text = text if isinstance(text, str) else ""
        spans, rest, at = base_spans(text), [], 0
        for start, _, end, value in spans:
            out[1] += _transitions(b" " + text[value:end].encode("utf-8", "replace") + b" ")
            rest.append(text[at : max(at, start)])
            at = max(at, end)
        rest.append(text[at:])
        out[0] += _transitions(b" " + TOKEN.sub(_identifier, " ".join(rest)).encode("utf-8", "replace") + b" ")
    return out


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition, random strings over ordinary identifiers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            total += sample_counts(batch.column(0).to_pylist())
        label, step = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"label": pa.array(label, pa.int32()), "step": pa.array(step, pa.int32()), "n": pa.array(total[label, step], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "label int, step int, n long").groupBy("label", "step").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, SIZE * SIZE))
    for r in rows:  # at most 2 * SIZE * SIZE
        counts[r["label"], r["step"]] = r["n"]
    counts = counts.reshape(2, SIZE, SIZE)
    single = counts.sum(axis=1) + SMOOTHING
    single /= single.sum(axis=1, keepdims=True)
    logs = np.log((counts + BACKOFF * single[:, None, :]) / (counts.sum(axis=2, keepdims=True) + BACKOFF))
    return logs[1] - logs[0]


def ratio(model: np.ndarray, token: str) -> float:
    """Of a whole token, with the steps from and to a separator."""
    at = _SYMBOLS[np.frombuffer(f" {token} ".encode("ascii"), np.uint8)]
    return float(model[at[:-1], at[1:]].sum())


def all_spans(model: np.ndarray, text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of base spans and of likely secrets that touch none of them."""
    text = text if isinstance(text, str) else ""
    base = [x[:3] for x in base_spans(text)]
    more, at, reach = [], 0, 0
    for m in TOKEN.finditer(text):  # both lists go by start: one sweep
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= m.start() and ratio(model, m[0]) >= MIN_RATIO:
            more.append((m.start(), 3, m.end()))
    return sorted(base + more)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of each kind, base_sha256 and spans for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    kind = "n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = all_spans(shared.value, text)
                base = _joined([x for x in spans if x[1] < 3])
                rows.append((*[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(base.encode()).hexdigest(), _joined(spans)))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in kind.split(", ")])

    return docs.select("doc_id", run("text").alias("__s")).select("doc_id", "__s.*")
