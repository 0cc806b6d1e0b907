"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.llm import alignment, classifier, exact_dedup, importance, lm_score, mixing, pieces, pii, preferences, rules, secrets, simhash, toxicity
from waymill.operators.shared import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")
    return rules.judged(table(spark, sf_dir, "documents")).select(*columns)


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy removes, alone and with the others."""
    return rules.ablations(rules.ledger(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a source in the mix: the square root of its rows; as many rows as there are."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_pairs(preferences.adjacent_pairs(table(spark, sf_dir, "conversations")))


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(model))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_pii,
        op3_exact_dedup,
        op4_quality_rules,
        rule_ablations,
        op5_mixing,
        op6_quality_classifier,
        op7_preferences,
        op8_cross_entropy,
        op9_sentencepiece,
        op10_simhash_near_dedup,
        op11_token_alignment,
        op12_toxicity,
        op13_importance_resampling,
    )
}

LEDGER_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
windows AS (SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM t JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (n_symbols > 2 * n_words)::INT
        + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars > 40 * n_words)::INT + 32 * (word_chars < 2 * n_words)::INT AS failed FROM m)
"""

ORACLES = {
    "op3_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t""",
    "op5_mixing": """
WITH counts AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
means AS (SELECT s, sqrt(n::DOUBLE) / sum(sqrt(n::DOUBLE)) OVER () * sum(n) OVER () / n AS mean FROM counts),
parts AS (SELECT s, greatest(1, ceil(mean / 16.0))::INT AS parts, mean / greatest(1, ceil(mean / 16.0)) AS m FROM means),
steps AS (SELECT s, parts, k, sum(exp(k * ln(m) - m - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS c
          FROM parts, LATERAL (SELECT unnest(range(0, ceil(m + 12 * sqrt(m) + 40)::INT + 1)) AS k)),
tables AS (SELECT s, parts, list(c ORDER BY k) AS t FROM steps GROUP BY s, parts),
drawn AS (SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda part: len(list_filter(t, lambda c: c <=
            ('0x' || substr(md5('42:' || doc_id::VARCHAR || ':' || md5(coalesce(text, '')) || ':' || part::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0))))::INT AS copies
          FROM documents d JOIN tables ON coalesce(source, '') = s)
SELECT doc_id, text, lang, source, n_chars, copy_no::INT AS copy_no, md5('42:order:' || doc_id::VARCHAR || ':' || md5(coalesce(text, '')) || ':' || copy_no::VARCHAR) AS mix_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy_no FROM drawn WHERE copies > 0)""",
    "op4_quality_rules": LEDGER_SQL
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f""",
    "rule_ablations": LEDGER_SQL
    + """SELECT version, rule, count(*) FILTER (failed & bit <> 0) AS n_failed, count(*) FILTER (failed & mask = bit) AS n_only,
  count(*) FILTER (failed & mask = 0) AS n_kept, count(*) FILTER (failed & (mask - bit) = 0) AS n_kept_without
FROM f, (VALUES (1, 'few_words', 3, 1), (1, 'repeated_windows', 3, 2), (2, 'few_words', 63, 1), (2, 'repeated_windows', 63, 2), (2, 'symbol_heavy', 63, 4),
  (2, 'repeated_lines', 63, 8), (2, 'long_words', 63, 16), (2, 'short_words', 63, 32)) AS p(version, rule, mask, bit)
GROUP BY version, rule""",
    "op7_preferences": r"""
WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT pair_id, coalesce(list({'role': role, 'text': text} ORDER BY turn, role, text) FILTER (side = 0), []) AS c,
        coalesce(list({'role': role, 'text': text} ORDER BY turn, role, text) FILTER (side = 1), []) AS r FROM t GROUP BY pair_id),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1), lambda i: c[i] IS DISTINCT FROM r[i])) - 1, len(c)) AS n FROM p),
parts AS (SELECT pair_id, n, 'prompt' AS part, c[1:n] AS l FROM n UNION ALL SELECT pair_id, n, 'chosen', c[n + 1:] FROM n UNION ALL SELECT pair_id, n, 'rejected', r[n + 1:] FROM n),
turns AS (SELECT pair_id, part, i, l[i].role AS role, l[i].text AS text, length(l[i].role) + 5 AS head FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM parts)),
placed AS (SELECT *, sum(head + length(text) + 1) OVER (PARTITION BY pair_id, part ORDER BY i) - length(text) - 1 AS pos FROM turns),
done AS (SELECT pair_id, part, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY i) AS s,
           string_agg(pos::BIGINT || ':' || (pos + length(text))::BIGINT, ',' ORDER BY i) FILTER (role = 'assistant') AS mask FROM placed GROUP BY ALL)
SELECT n.pair_id, n::INT AS prompt_turns, coalesce(a.s, '') AS prompt, coalesce(b.s, '') AS chosen, coalesce(b.mask, '') AS chosen_mask,
  coalesce(d.s, '') AS rejected, coalesce(d.mask, '') AS rejected_mask
FROM n LEFT JOIN done a ON a.pair_id = n.pair_id AND a.part = 'prompt' LEFT JOIN done b ON b.pair_id = n.pair_id AND b.part = 'chosen'
LEFT JOIN done d ON d.pair_id = n.pair_id AND d.part = 'rejected'""",
    "op13_importance_resampling": r"""
WITH low AS (SELECT doc_id, 0 AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT NULL, 1, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
numbered AS (SELECT *, row_number() OVER () AS row FROM low),
occurrences AS (SELECT row, doc_id, side, unnest(w) AS word FROM numbered),
words AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM occurrences),
steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) AS r(i))),
buckets AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket FROM words, steps),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM occurrences JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
sums AS (SELECT row, count(*) AS n, sum(gain)::BIGINT AS weight FROM occurrences JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM numbered LEFT JOIN sums USING (row) WHERE side = 0),
ordered AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM ordered""",
}
