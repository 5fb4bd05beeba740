"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, exact_dedup, filter_audit, host_paths, language_id, lm_trie, mixing, pseudonyms, quality, secret_scan, sentencepiece_codec, simhash, token_shards


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_paths.extract_pages(_table(spark, sf_dir, "pages"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_shards.write_shards(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return token_shards.read_documents(spark, path)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign_groups(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign_components(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonyms.TEST_KEY)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of sources, one after the other, into one ledger; then the findings of all documents."""
    versions = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ledger = secret_scan.open_ledger(spark)
    first = F.col("source").eqNullSafe(F.lit("src0"))
    for batch in (versions.where(first), versions.where(~first)):
        secret_scan.scan_into(ledger, batch, content_col="text")
    findings = secret_scan.findings_of(versions, secret_scan.read_ledger(spark, ledger), path_cols=("doc_id",), content_col="text")
    return secret_scan.digest_rows(findings, "doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.trusted_sample(_table(spark, sf_dir, "labels"))).drop("text")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), ids=False)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_trie.score_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_host_paths": op1_host_paths,
    "op2_token_shards": op2_token_shards,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_secret_scan": op8_secret_scan,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality": op10_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_alignment": op12_alignment,
    "op13_lm_trie": op13_lm_trie,
}

def _matches(kind: str, nth: int, pattern: str, group: int, least: int) -> str:
    """SQL for the spans of one rule: what stands between the matches gives their places."""
    return f"""
        SELECT rid, '{kind}' AS kind, {nth} AS nth, gaps + alls - length(a) AS start, gaps + alls AS stop
        FROM (SELECT *, sum(length(g)) OVER w AS gaps, sum(length(a)) OVER w AS alls
              FROM (SELECT rid, generate_subscripts(a, 1) AS i, unnest(a) AS a, unnest(p) AS p, unnest(g[1:len(a)]) AS g
                    FROM (SELECT rid, regexp_extract_all(t, {pattern}, 0) AS a, regexp_extract_all(t, {pattern}, {group}) AS p, string_split_regex(t, {pattern}) AS g FROM d))
              WINDOW w AS (PARTITION BY rid ORDER BY i))
        WHERE length(p) >= {least}"""


_EITHER = {k: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token")}
_ASSIGN = "(" + "|".join(_EITHER.values()) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"

SQL: dict[str, str] = {
    "op8_secret_scan": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
        m AS ({" UNION ALL ".join((
            _matches("assign", 0, "'" + _ASSIGN + """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'""", 2, 12),
            _matches("access", 1, "'AKIA[A-Z0-9]+'", 0, 18),
            _matches("hex", 2, "'[0-9a-f]+'", 0, 16),
        ))}),
        s AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                     string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, nth) AS spans FROM m GROUP BY rid)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN s USING (rid)
    """,
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)
    """,
    "op11_filter_audit": r"""
        WITH w AS (SELECT *, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        f AS (SELECT part, doc_id, [
                len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'), min(doc_id) OVER (PARTITION BY t) < doc_id] AS fails FROM w),
        l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        a AS (SELECT unnest(range(1, 6)) AS i),
        o AS (SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM a p, a q, a r, a s, a t WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
        k AS (SELECT part, o, i AS step,
                fails[o[i]] AS fail, len(list_filter(o[1:i - 1], lambda x: fails[x])) > 0 AS gone,
                len(list_filter(fails, lambda x: x)) AS many, n, good, toxic FROM c, o, a),
        z AS (SELECT part, o, step,
                sum(n) FILTER (NOT fail AND NOT gone) AS kept, sum(n) FILTER (fail AND NOT gone) AS removed, sum(n) FILTER (fail AND gone) AS redundant,
                sum(n) FILTER (fail AND many = 1) AS unique_fails, sum(good) FILTER (fail AND NOT gone) AS good_lost, sum(toxic) FILTER (fail AND NOT gone) AS toxic_lost FROM k GROUP BY ALL),
        s AS (SELECT part, o[step] AS filter, sum(removed) AS shapley FROM z GROUP BY ALL)
        SELECT part, array_to_string(list_transform(o, lambda x: chr(CAST(64 + x AS INT))), '') AS filter_order, CAST(step AS INT) AS step,
               CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
               CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
        FROM z JOIN s USING (part) WHERE s.filter = o[step]
    """,
}
