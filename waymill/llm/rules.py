"""Quality rules: a bitmask ledger.

Every rule is evaluated once a document; the ledger, a written table, stores its measurements
and one bit a failed rule. A policy is a version and a mask: a document passes when no masked
bit is set. Policies and ablations (what a rule alone removes, what a policy would keep without
it) are bitwise columns and sums over the stored ledger, never another look at the texts.

Defined cases: a null or empty text has no word and measurements 0; a very long text is
measured whole, in time proportional to its length; rows repeated give their rows again; extra
columns are ignored; an empty table gives an empty ledger and ablations of 0 for every rule.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize

SYMBOLS = "#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
WINDOW = 3


def rules() -> dict[str, Column]:
    """Name -> failed; the bit of a rule is its place."""
    words, col = F.col("n_words"), F.col
    return {
        "few_words": words < 50,
        "repeated_windows": 100 * col("n_repeat_words") > 50 * words,
        "symbol_heavy": col("n_symbols") > 2 * words,
        "repeated_lines": 100 * col("n_dup_lines") > 50 * col("n_lines"),
        "long_words": col("word_chars") > 40 * words,
        "short_words": col("word_chars") < 2 * words,
    }


BITS = ("few_words", "repeated_windows", "symbol_heavy", "repeated_lines", "long_words", "short_words")
POLICIES = {1: ("few_words", "repeated_windows"), 2: BITS}
CURRENT = 2


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << BITS.index(n) for n in names)


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words.

    Words are split on 0x20 and 0x09-0x0D, which is what bytes.split() does.
    """
    text = text if isinstance(text, str) else ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen, repeated = Counter(windows), 0
    if len(seen) < len(windows):
        upto = 0  # words before this place are counted
        for at, w in enumerate(windows):
            if seen[w] > 1:
                repeated += at + WINDOW - max(at, upto)
                upto = at + WINDOW
    return len(words), chars, sum(map(data.count, map(str.encode, SYMBOLS))), len(lines), len(lines) - len(set(lines)), repeated


def measured(texts: Column) -> Column:
    @F.pandas_udf(MEASURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([measure(t) for t in batch], columns=[x.split()[0] for x in MEASURES.split(", ")])

    return run(texts)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and failed, a bit for each failed rule; written out."""
    rows = docs.select("doc_id", measured(F.col("text")).alias("__m")).select("doc_id", "__m.*")
    checks = rules()
    bits = sum((F.when(checks[n], F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(BITS)), F.lit(0))
    return materialize(rows.withColumn("failed", bits.cast("int")), "ledger")


def passes(version: int = CURRENT) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """version, rule, n_failed, n_only (removed by this rule alone), n_kept, n_kept_without."""
    table = [(v, n, mask(names), 1 << BITS.index(n)) for v, names in POLICIES.items() for n in names]
    bit = lambda v, m: F.col("failed").bitwiseAND(F.lit(m))
    sums = [
        F.struct(
            F.lit(v).alias("version"), F.lit(n).alias("rule"), F.count_if(bit(v, b) != 0).alias("n_failed"), F.count_if(bit(v, m) == b).alias("n_only"),
            F.count_if(bit(v, m) == 0).alias("n_kept"), F.count_if(bit(v, m & ~b) == 0).alias("n_kept_without"),
        )
        for v, n, m, b in table
    ]
    return rows.agg(F.array(*sums).alias("a")).select(F.inline("a"))


def judged(docs: DataFrame) -> DataFrame:
    """The stored ledger with base_failed (policy 1) and kept (the current policy as well)."""
    base = mask(POLICIES[1])
    rows = ledger(docs).withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(base)) != 0)
    return rows.withColumn("kept", ~F.col("base_failed") & passes())
