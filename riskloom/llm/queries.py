"""The queries of the corpus operators over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import exact, fingerprints, jaccard, lm, manifest, mixing, packing, pii, quality, registers, sharding, suffix, whitening
from riskloom.llm.common import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@query(
    "op9_exact_dedup",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS txt, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha FROM documents),
    g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size, row_number() OVER w AS place
      FROM t WINDOW w AS (PARTITION BY sha ORDER BY length(txt) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha AS text_sha256 FROM g
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.find_copies(documents(spark, folder))


def vocabulary_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), *vocabulary_files())


@query("op7_histogram_shards")
def histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.text_digest(documents(spark, folder))
    placed = sharding.shard_by_bytes(rows, F.col("size"), F.col("hash"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Wanted shares of the domains' tokens.
MIX = {"plain": 0.90, "junk": 0.04, "toxic": 0.06}


def domains(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled table: junk where quality is 0, else toxic where so marked, else plain."""
    name = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "plain")
    return labels(spark, folder).select("doc_id", name.alias("domain"))


@query("op3_soft_mixing")
def soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    classifier = mixing.fit_domains(docs, domains(spark, folder))
    rows = mixing.fit_rates(docs, classifier, MIX)
    return rows.select("doc_id", "n_tokens", *[F.element_at("posteriors", i + 1).alias(f"p_{d}") for i, d in enumerate(classifier.domains)], "rate")


@query("op8_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    held_out = quality.in_fold(F.col("doc_id"), 4, 2)
    model = quality.train(docs.where(~held_out), labels(spark, folder))
    return quality.with_scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op4_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_similar(documents(spark, folder), width=4, percent=85)


@query("op6_merkle_fingerprints")
def merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edits(documents(spark, folder))


#: A key for the query alone; a real one comes from a secret store.
QUERY_KEY = "corpus-query"


@query("op1_feistel_pseudonyms")
def feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, folder).select("doc_id", "text"), QUERY_KEY, count="n_values")


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, folder)).drop("kept")


@query("op2_log_bilinear")
def log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    language, counts = lm.fit(docs.where(~quality.in_fold(F.col("doc_id"), 5, 1)))
    scored = lm.score_texts(docs, language, counts)
    return scored.select("doc_id", quality.in_fold(F.col("doc_id"), 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _manifest_sql(levels: int = 16, top_levels: int = 8) -> str:
    """The manifest with one step of SQL for each level: enough for 3^levels rows of a source, 3^top_levels sources."""
    h = lambda text: f"sha256({text})"
    size = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen({0}) AS VARCHAR) || ':' || {0} END"
    leaf = lambda text: h(" || ".join(size.format(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)))
    # crc32 bit by bit over the digits of the id
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"
    steps = [
        f"leaves AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN ({crc}) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS claimed FROM documents)",
        "d0 AS MATERIALIZED (SELECT *, coalesce('=' || source, '-') AS key, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos FROM leaves)",
        "n0 AS MATERIALIZED (SELECT key, pos, leaf AS node FROM d0)",
    ]

    def climb(prefix: str, last: int) -> None:
        for i in range(last):
            run = "(PARTITION BY key, pos // 3 ORDER BY pos)"
            steps.append(
                f"{prefix}s{i} AS MATERIALIZED (SELECT key, pos, node, count(*) OVER (PARTITION BY key) AS total, "
                f"coalesce(lag(node, 2) OVER {run}, '') || coalesce(lag(node) OVER {run}, '') AS before, coalesce(lead(node) OVER {run}, '') || coalesce(lead(node, 2) OVER {run}, '') AS after FROM {prefix}n{i})"
            )
            steps.append(f"{prefix}n{i + 1} AS MATERIALIZED (SELECT key, pos // 3 AS pos, CASE WHEN max(total) = 1 THEN max(node) ELSE {h("string_agg(node, '' ORDER BY pos)")} END AS node FROM {prefix}s{i} GROUP BY key, pos // 3)")

    def descend(prefix: str, last: int) -> None:
        for i in range(last):
            steps.append(
                f"{prefix}d{i + 1} AS MATERIALIZED (SELECT d.* REPLACE (d.pos // 3 AS pos, "
                f"CASE WHEN s.total = 1 THEN d.folded ELSE {h('s.before || d.folded || s.after')} END AS folded, CASE WHEN s.total = 1 THEN d.proof ELSE d.proof || s.before || s.after END AS proof) FROM {prefix}d{i} d JOIN {prefix}s{i} s USING (key, pos))"
            )

    climb("", levels)
    steps.append(f"tn0 AS MATERIALIZED (SELECT 'top' AS key, row_number() OVER (ORDER BY encode(key)) - 1 AS pos, node, key AS source_key FROM n{levels})")
    climb("t", top_levels)
    steps[1] = steps[1].replace("SELECT *,", "SELECT *, claimed AS folded, '' AS proof,")
    descend("", levels)
    steps.append(f"td0 AS MATERIALIZED (SELECT d.doc_id, d.leaf, t.node AS subroot, 'top' AS key, t.pos, d.folded, d.proof FROM d{levels} d JOIN tn0 t ON d.key = t.source_key)")
    descend("t", top_levels)
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, r.node AS root, {h('proof')} AS proof_sha256, folded AS folded_root, folded = r.node AS verified "
        f"FROM td{top_levels}, (SELECT node FROM tn{top_levels}) r"
    )


@query("op11_merkle_manifest", _manifest_sql())
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest.build(documents(spark, folder), even)


@query("op13_qd_whitening")
def qd_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))


@query(
    "op12_hyperminhash",
    """
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
    r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
    m AS (SELECT node, min(seen) AS least FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.least AS component_id, d.doc_id = m.least AS kept
    FROM documents d JOIN m ON m.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
    """,
)
def hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return registers.near_copies(documents(spark, folder), width=2, percent=80)
