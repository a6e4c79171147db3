"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata.llm import (
    alignment,
    licences,
    neighbours,
    packing,
    pieces,
    quality_trees,
    secrets,
    simhash,
    substrings,
    superminhash,
    token_files,
    weak_rules,
    whitening,
)
from eventstrata.llm.common import table
from eventstrata.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_OF_TEXT = 50256
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "quality_probability",
        "kept",
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat token files, then each document's place and length in them."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, BYTE_BPE, END_OF_TEXT)
    counted = token_files.count_tokens(token_files.token_blocks(spark, path), END_OF_TEXT)
    # part-00012 and the file's number in that task's part, without the write's own id.
    name = F.concat(F.regexp_extract("file", r"^part-\d+", 0), F.regexp_extract("file", r"-c\d+", 0))
    return counted.withColumn("file", name)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("code")).alias("fingerprint"), "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    counts = [
        F.size(secrets.of_kinds(F.col("spans"), [kind])).cast("long").alias(f"n_{kind}")
        for kind in secrets.BASE_KINDS
    ]
    base = secrets.spans_text(F.col("spans"), secrets.BASE_KINDS)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op10_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignments(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_MODEL)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _secrets_sql() -> str:
    """All rules by cutting each text at its matches and adding up the lengths before them."""
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.plain.replace("'", "''")
        parts.append(
            f"SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least, "
            f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g, "
            f"regexp_split_to_array(t, '{pattern}') AS p FROM texts WHERE regexp_matches(t, '{pattern}')"
        )
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    matched AS ({' UNION ALL '.join(parts)}),
    numbered AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM matched),
    placed AS (
        SELECT doc_id, kind, place, length(m[i]) AS long,
            list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS stop
        FROM numbered WHERE length(g[i]) >= least
    ),
    named AS (
        SELECT doc_id, kind, place, stop - long AS start,
            kind || ':' || CAST(stop - long AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
        FROM placed
    ),
    per_doc AS (
        SELECT doc_id,
            count(*) FILTER (kind = 'assign') AS n_assign,
            count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
            string_agg(span, ',' ORDER BY start, place) AS spans
        FROM named GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN per_doc USING (doc_id)
    """


def _minhash_sql() -> str:
    """All similarities from shared shingles, components by following the links."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE split AS (
        SELECT row_number() OVER () AS r, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT r, doc_id, CASE
            WHEN len(w) < 4 THEN list_filter([array_to_string(w, ' ')], lambda x: len(w) > 0)
            ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
        FROM split
    ),
    members AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
    shared AS (
        SELECT a.r AS p, b.r AS q, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS common
        FROM members a JOIN members b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2
    ),
    linked AS (SELECT p, q FROM shared WHERE 100 * common >= 80 * (m + n - common)),
    links AS (FROM linked UNION ALL SELECT q, p FROM linked),
    reached AS (
        SELECT r, r AS t FROM sets
        UNION
        SELECT reached.r, links.q FROM reached JOIN links ON reached.t = links.p
    ),
    named AS (SELECT reached.r, min(sets.doc_id) AS component_id FROM reached JOIN sets ON sets.r = t GROUP BY 1)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
    FROM sets JOIN named USING (r)
    """


REGISTRY: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_nearest_neighbours,
        op2_packing,
        op3_quality_rules,
        op4_token_counts,
        op5_quality_classifier,
        op6_substring_dedup,
        op7_pieces,
        op8_simhash_near_dedup,
        op9_secret_scans,
        op10_licence_scans,
        op11_cross_tokenizer,
        op12_minhash_near_dedup,
        op13_embedding_whitening,
    )
}
EXPECTED: dict[str, str] = {"op9_secret_scans": _secrets_sql(), "op12_minhash_near_dedup": _minhash_sql()}
