"""The registered queries of this package: thin callers of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.llm import bpe, decontamination, html_text, licenses, periodic, pii, quality, sharding, simhash, substrings, token_counts, url_rules, whitening
from regiocast.llm.common import split_words, table
from regiocast.session import scratch_path


TOKEN_LIMIT = 4096
SHARDS = 24
#: Key of the registered query and the pipeline; a deployment passes its own secret to the operator.
PSEUDONYM_KEY = b"key of the registered query"


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = quality.fit(docs, quality.trusted_sample(table(spark, sf_dir, "labels")), group_col="lang")
    return quality.judge(docs, model, group_col="lang").drop("text", "lang")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.encode(docs, path, decoded_col="decoded")
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.protect(docs, PSEUDONYM_KEY).select(
        "doc_id",
        "text",
        F.size("pii").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct(F.col("pii.kind"))), ",").alias("kinds"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so each run encodes every different text."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")  # before the join, which then carries no text
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", size.alias("n_bytes"))
    counted = token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"), scratch_path(spark, "token-counts"))
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.known_digests(spark))
    return found.select("doc_id", "whole_license", F.array_join("licenses", ",").alias("licenses"), "n_notices")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), k=20, m=substrings.MINIMISER)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: Explicit rules of the registered query (host, path, verdict); what they decide are the labels that rules are mined from.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined")


def planted_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text), for one id in ten the words from place a on replaced by their first p over and over (a, p: by the id's CRC)."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    split = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when(F.pmod(crc, F.lit(10)) == 0, split_words(F.col("text"))).alias("w"))
    n = F.size("w")
    placed = split.withColumn("a", F.when(n > 0, F.pmod("g", n)).cast("int"))
    placed = placed.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.pmod("g", F.lit(8))))).cast("int"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), n - F.col("a")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted_cycles(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.select("doc_id", "runs", "collapsed", periodic.greatest_run(F.col("runs")).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", components=16, scale=64.0, offset=1_000_000)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_simhash_components": op3_simhash_components,
    "op4_pii_pseudonyms": op4_pii_pseudonyms,
    "op5_sharding": op5_sharding,
    "op6_token_counts": op6_token_counts,
    "op7_license_scan": op7_license_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_html_text": op10_html_text,
    "op11_url_filter": op11_url_filter,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_whitening": op13_embedding_whitening,
}
def _license_sql() -> str:
    """Canonical forms by the same fixed values, matched by the text itself; long licences by its digest."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    form = "' ' || lower(unit) || ' '"
    for pattern, new in [(licenses.COPYRIGHT_LINE, " "), (licenses.SIGNS, "  "), *licenses.spellings()]:
        form = f"regexp_replace({form}, {quoted(pattern)}, {quoted(new)}, 'g')"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN)
    long_texts = ", ".join(f"({quoted(name)}, {quoted(digest)})" for name, _, digest in licenses.LONG_TEXTS)
    return f"""
        WITH known AS (
            SELECT min(license) AS license, form FROM (SELECT license, {form} AS form FROM (VALUES {values}) AS v(license, unit))
            GROUP BY form
        ), units AS (
            SELECT doc_id, false AS whole, unnest(string_split(text, chr(10))) AS unit FROM documents
            UNION ALL SELECT doc_id, true, text FROM documents
        ), forms AS (
            SELECT doc_id, whole, {form} AS form FROM units
        ), found AS (
            SELECT doc_id, whole, license FROM forms JOIN known USING (form)
            UNION ALL SELECT doc_id, whole, license FROM forms JOIN (VALUES {long_texts}) AS l(license, digest) ON sha256(form) = digest
        ), gathered AS (
            SELECT doc_id, min(license) FILTER (whole) AS whole_license, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                   count(*) FILTER (NOT whole) AS n_notices
            FROM found GROUP BY doc_id
        )
        SELECT d.doc_id, g.whole_license, coalesce(g.licenses, '') AS licenses, CAST(coalesce(g.n_notices, 0) AS BIGINT) AS n_notices
        FROM documents d LEFT JOIN gathered g USING (doc_id)
    """


#: Independent DuckDB SQL for the queries that SQL can express.
ORACLE_SQL = {
    "op7_license_scan": _license_sql(),
    "op8_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), places AS (
            SELECT doc_id, unnest(range(len(w) - 19)) AS pos, w FROM words WHERE len(w) >= 20
        ), windows AS (
            SELECT doc_id, pos, array_to_string(list_slice(w, pos + 1, pos + 20), ' ') AS win FROM places
        ), repeated AS (
            SELECT doc_id, pos FROM windows
            QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1
        ), covered AS (
            SELECT DISTINCT doc_id, pos + j AS word FROM repeated, range(20) AS r(j)
        ), single AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS word_at FROM words
        ), kept AS (
            SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.word_at) FILTER (c.word IS NULL) AS kept_text,
                   count(c.word) AS n_removed
            FROM single s LEFT JOIN covered c ON c.doc_id = s.doc_id AND c.word = s.word_at
            GROUP BY s.doc_id
        )
        SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k.kept_text, '')) AS kept_sha256
        FROM words w LEFT JOIN kept k USING (doc_id)
    """,
}
