"""The registered queries of this subpackage: each over its whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster_vectors
from .common import if_small, materialise, read_table, spread
from .decontaminate import find_contained
from .fingerprint import fingerprint_edits
from .html_extract import extract
from .langid import identify
from .licenses import scan_licenses
from .packing import pack_documents
from .quality import classify
from .simhash import near_duplicates
from .token_count import count_tokens
from .toxicity import score_documents
from .vector_codes import compress_vectors
from .vectors import as_long
from .warc import page_archives


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, by the vocabulary of 49,000 words."""
    return count_tokens(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain, of all documents."""
    return find_contained(spread(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"), words=5, containment=0.8)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(spread(read_table(spark, sf_dir, "documents")))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that documents hold, of all documents."""
    return scan_licenses(spread(read_table(spark, sf_dir, "documents")), coverage=0.8)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under a model of the trusted ones, and who is kept."""
    return classify(spread(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(spread(read_table(spark, sf_dir, "pages")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, linked at 2 bits or fewer."""
    return near_duplicates(spread(read_table(spark, sf_dir, "documents")), words=3, radius=2)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; nothing is learned from the held-out ones."""
    return score_documents(spread(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "labels"), threshold=0.3)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed to sequences of 2,048 tokens."""
    return pack_documents(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; nothing is learned from the held-out ones."""
    return identify(spread(read_table(spark, sf_dir, "documents")))


#: Most labels or clusters whose sums are sent to all tasks.
FEW = 1_000_000


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: 16 parts, 64 entries, 2 rounds."""
    made = compress_vectors(spread(read_table(spark, sf_dir, "embeddings")), parts=16, entries=64, rounds=2)
    rows = materialise(made.rows, "codes")
    errors = rows.groupBy("label").agg(as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error")).withColumnRenamed("label", "_label")
    out = rows.join(if_small(errors, FEW), F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to compressed archives and read back."""
    return page_archives(spread(read_table(spark, sf_dir, "pages")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings: 40 centroids, 5 rounds."""
    made = cluster_vectors(spread(read_table(spark, sf_dir, "embeddings")), clusters=40, rounds=5, dimensions=64, seed=2)
    rows = materialise(made.rows, "clusters")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # a row for each cluster
    whole = sum(int(r["total"]) for r in sums)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    told = [(r["cluster"], r["total"], digest(made.centroids[r["cluster"]])) for r in sums]
    told = spark.createDataFrame(told, "cluster int, total decimal(38,0), centroid_sha256 string")
    out = rows.join(F.broadcast(told), "cluster")
    return out.select("vec_id", "cluster", "distance", as_long(F.col("total")).alias("cluster_inertia"), as_long(F.lit(whole).cast("decimal(38,0)")).alias("inertia"), "centroid_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontamination": op2_decontamination,
        "op3_fingerprints": op3_fingerprints,
        "op4_license_scans": op4_license_scans,
        "op5_quality": op5_quality,
        "op6_html_extraction": op6_html_extraction,
        "op7_simhash": op7_simhash,
        "op8_toxicity": op8_toxicity,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_language_id": op10_language_id,
        "op11_vector_codes": op11_vector_codes,
        "op12_warc": op12_warc,
        "op13_centroids": op13_centroids,
    }


_WHOLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_SCALED = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
_FAR = "CAST(list_sum(list_transform(list_zip({0}, {1}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
#: The floor of a mean, for sums below zero too.
_MEAN = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def _op11_sql() -> str:
    steps = [
        f"k AS (SELECT vec_id, label, {_SCALED} AS v FROM embeddings WHERE {_WHOLE})",
        "w AS (SELECT len(v) // 16 AS n FROM k LIMIT 1)",
        "cut AS (SELECT vec_id, label, p, v[p * n + 1 : p * n + n] AS part FROM k, w, range(16) AS r(p))",
        "c0 AS (SELECT p, e, part FROM (SELECT p, part, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < 64)",
    ]
    for i in range(3):
        steps.append(f"a{i} AS (SELECT vec_id, cut.label, cut.p, any_value(cut.part) AS part, min({{'d': {_FAR.format('cut.part', f'c{i}.part')}, 'e': e}}) AS best FROM cut JOIN c{i} ON cut.p = c{i}.p GROUP BY vec_id, cut.label, cut.p)")
        if i < 2:
            steps.append(f"m{i} AS (SELECT p, e, list(x ORDER BY j) AS part FROM (SELECT p, e, j, {_MEAN} AS x FROM (SELECT p, best.e AS e, unnest(part) AS x, generate_subscripts(part, 1) AS j FROM a{i}) GROUP BY p, e, j) GROUP BY p, e)")
            steps.append(f"c{i + 1} AS (SELECT c{i}.p, c{i}.e, coalesce(m{i}.part, c{i}.part) AS part FROM c{i} LEFT JOIN m{i} ON c{i}.p = m{i}.p AND c{i}.e = m{i}.e)")
    steps.append("o AS (SELECT vec_id, label, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 GROUP BY vec_id, label)")
    steps.append("s AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o, s"


_OP12_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM f
"""


def _op13_sql() -> str:
    steps = [
        f"k AS (SELECT vec_id, {_SCALED} AS v FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64)",
        "c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM k ORDER BY h LIMIT 40))",
    ]
    for i in range(6):
        steps.append(f"a{i} AS (SELECT vec_id, any_value(k.v) AS v, min({{'d': {_FAR.format('k.v', f'c{i}.v')}, 'c': c}}) AS best FROM k, c{i} GROUP BY vec_id)")
        if i < 5:
            steps.append(f"m{i} AS (SELECT c, list(x ORDER BY j) AS v FROM (SELECT c, j, {_MEAN} AS x FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j) GROUP BY c)")
            steps.append(f"c{i + 1} AS (SELECT c{i}.c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256 FROM a5 JOIN c5 ON best.c = c5.c"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express; the vectors' ids are unique in the tables."""
    return {"op11_vector_codes": _op11_sql(), "op12_warc": _OP12_SQL, "op13_centroids": _op13_sql()}
