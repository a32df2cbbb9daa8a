"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)``, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regioncast.llm import decontaminate, langid, line_dedup, packing, periodic, pii, prefix_trie, quality, rules, simhash, suffix_dedup, toxicity, wavelet
from regioncast.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of the benchmark's 13-word windows in all documents, through FM-indexes."""
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=13)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(names.cast("binary"), 256).alias("items_sha256"),
                      decontaminate.is_contaminated().alias("contaminated"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents' tokens, packed into sequences of 2048."""
    got = packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=0)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents by the learned lexicon, its misspellings and their context."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held_fold=1, threshold=0.7)


def op4_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by the byte convolutional network."""
    return langid.languages(table(spark, sf_dir, "documents"), folds=5, held_fold=0)


def op5_qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents by the quadratic discriminant."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_fold=0, threshold=0.3)


def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to wavelet-matrix files and read back."""
    files = wavelet.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)
    got = wavelet.read_token_files(files)
    return got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outlier verdict per language and source for all documents."""
    got = rules.quality_rules(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their globally repeated multi-line chunks."""
    got = line_dedup.without_repeated_chunks(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_radix_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents covered by 50-byte strings that also start in an earlier document."""
    got = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"), width=50)
    spans = F.floor(F.size("removed") / 2).cast("long")
    gone = F.col("n_bytes") - F.length("kept").cast("long")
    return got.select("doc_id", "n_bytes", gone.alias("n_removed"), spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint (4-word shingles) and near-duplicate component (4 bits) of all documents."""
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the patterns' matches, and all spans, those of the field among them."""
    got = pii.personal_data(table(spark, sf_dir, "documents"))

    def joined(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def matches(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return got.select("doc_id", *map(matches, pii.KINDS), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of at least 12 words in all documents (a tenth of them rearranged), and what is left without the repeats."""
    got = periodic.periodic_runs(table(spark, sf_dir, "documents"), least=12, plant=True)
    lengthy = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    best = F.get(lengthy, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return got.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations, with its subtree totals."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), family=100, shares=6)


QUERIES = {f.__name__: f for f in (
    op1_fm_decontamination, op2_best_fit_packing, op3_lexicon_toxicity, op4_byte_cnn_language, op5_qda_quality, op6_wavelet_tokens,
    op7_mcd_rules, op8_line_chunks, op9_radix_suffix_dedup, op10_simhash_pivots, op11_skip_chain_pii, op12_periodic_runs, op13_prefix_trie)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: crc32 of a table's decimal ids: the byte table, and the sum over the digits of ``{id}``.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS crc)"""
_CRC = """xor(4294967295, list_reduce(list_transform(string_split({id}::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))"""

#: DuckDB SQL where SQL can express the operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_fm_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
      FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p))),
h AS (SELECT doc_id, i, n, item_id FROM g JOIN p USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op12_periodic_runs": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC.format(id="doc_id")} AS h
      FROM documents, {_CRC_TABLE}),
e AS (SELECT *, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM d WHERE len(w) > 0),
t AS (SELECT r, CASE WHEN h % 10 = 0 THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w
      FROM e),
g AS (SELECT r, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT r, w, unnest(range(len(w) - 5)) AS i FROM t)),
eq AS (SELECT x.r, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.r = y.r AND x.s = y.s AND x.i < y.i),
st AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 6 + q AS length
       FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM eq) GROUP BY r, q, island),
run AS (SELECT r, start, length, min(q) AS period FROM st WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
per AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
               arg_min(struct_pack(s := start, l := length, p := period), (-length, start, period)) AS best FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS rest
         FROM (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM t) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period,
       (1000 * best.l // best.p)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)""",
    "op13_prefix_trie": f"""
WITH c AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS ts
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
h AS (SELECT conv_id, ts, {_CRC.format(id="conv_id")} % 6 AS h FROM c, {_CRC_TABLE}),
b AS (SELECT h.conv_id, list_concat(list_slice(coalesce(c.ts, []), 1, h), list_slice(h.ts, h + 1, len(h.ts))) AS ts
      FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, d, list_slice(ts, 1, d) AS k, len(ts) = d AS whole, coalesce(length(ts[d].t), 0) AS chars
      FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM b)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '') AS ends FROM p GROUP BY k, d),
kid AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kid USING (k)),
sub AS (SELECT list_slice(k, 1, e) AS k, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
        FROM (SELECT k, saved, n_children, unnest(range(d + 1)) AS e FROM f) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN sub USING (k) LEFT JOIN n up ON f.d > 0 AND up.k = list_slice(f.k, 1, f.d - 1)""",
}
