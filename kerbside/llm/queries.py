"""Registered queries of the training-data operators, and their SQL where SQL can say it.

A held-out row is one whose crc32 of the doc_id as text leaves the stated remainder; labels of those rows are never learned from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode
from .chaining import repeated_passages
from .collocations import collocations
from .decontaminate import contaminated
from .langid import identify_languages
from .line_dedup import without_repeated_lines
from .lm_score import score_pseudo_likelihood
from .ngram_join import ngram_jaccard_components
from .pfair import pfair_mix
from .quality_mil import score_quality
from .tables import prepare
from .topk_search import top_k_inner_products
from .toxicity import score_toxicity
from .vafile import cluster_vectors

QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.3, 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(folds: int) -> Column:
    """Fold of a row: crc32 of its doc_id as text, modulo ``folds``; a null doc_id has none."""
    return F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % folds


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(_table(spark, sf_dir, "documents"), labels, remainder(5) != 0)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix(_table(spark, sf_dir, "documents")).select("doc_id", "source", "mix_position", "mix_epoch")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = score_toxicity(_table(spark, sf_dir, "documents"), labels, remainder(3) != 1)
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_THRESHOLD).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_substring_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(_table(spark, sf_dir, "documents"), remainder(4) != 2)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "bits")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_vafile_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(_table(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: r["s"] for r in found.assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a centroid
    rows = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(found.centroids)]
    digest = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(digest), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_line_dedup, op3_exact_topk, op4_quality_mil, op5_pfair_mix,
        op6_toxicity, op7_decontaminate, op8_substring_chains, op9_language_id, op10_lm_score,
        op11_phrase_collocations, op12_vafile_clusters, op13_bpe_round_trip,
    )
}


def _clusters_sql(k: int, rounds: int) -> str:
    """Op 12 in SQL: every vector measured against every centroid, round by round."""
    distance = "CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [f"""
        WITH points AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v FROM points
            QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), v) <= {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT p.row, min(struct_pack(d := {distance}, c := c.cluster)) AS best FROM points p CROSS JOIN c{i} c GROUP BY p.row)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
                    SELECT a.best.c AS cluster, d, CAST(sum(p.v[d]) AS BIGINT) AS s, count(*) AS n
                    FROM a{i} a JOIN points p USING (row), range(1, 65) AS t(d) GROUP BY ALL) GROUP BY cluster) m USING (cluster))""")
    return ", ".join(steps) + f"""
        SELECT p.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance,
               CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN points p USING (row) JOIN c{rounds} c ON c.cluster = a.best.c"""


ORACLE: dict[str, str] = {
    "op3_exact_topk": """
        WITH good AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), cut AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), f AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (VALUES (1), (2), (3)) AS v(k)) GROUP BY ALL
        ), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
        ), cuts AS (
            SELECT c.lang, c.phrase, c.k, c.f AS a, cut_at, array_to_string(string_split(c.phrase, ' ')[1 : cut_at], ' ') AS head,
                   array_to_string(string_split(c.phrase, ' ')[cut_at + 1 :], ' ') AS tail
            FROM f c, (VALUES (1), (2)) AS v(cut_at) WHERE c.k >= 2 AND c.f >= 10 AND cut_at < c.k
        ), scored AS (
            SELECT c.lang, c.phrase, c.k, c.a, c.cut_at, h.f AS l, t.f AS r,
                   CAST((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
            FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
        ), inside AS (
            SELECT lang, part, max(f) AS longer FROM (
                SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS part
                FROM f WHERE k = 3 AND f >= 10) GROUP BY ALL
        ), ranked AS (
            SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.part = w.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * w.a
        )
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
    """,
    "op12_vafile_clusters": _clusters_sql(40, 5),
}
