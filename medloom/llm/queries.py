"""The thin query of each operator: its whole table, production parameters, digest columns of its results."""

from __future__ import annotations

import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import ann, byte_bpe, embedding_dedup, hard_negatives, license_scan, line_dedup, mixing, quality, simhash, spelling, token_counts, token_files, toxicity

#: Ids of the word tokenizer.
WORD_IDS = 49_408
#: A text is predicted toxic from this score on.
TOXIC_FROM = 0.3
#: A text is predicted good from this score on.
GOOD_FROM = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("bigint").alias("n_chars_left"), F.sha2("text", 256).alias("left_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(_table(spark, sf_dir, "documents"))
    names = lambda c: F.transform(c, lambda x: x["label"])
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    starts = F.transform("places", lambda x: x["word"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(names("places")).alias("base_labels"), listed(F.concat(names("places"), names("found"))).alias("labels"), "score",
    )


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id, as text, leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_model(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), token_files.files_folder(docs), WORD_IDS, end_id=1)

    def crc(ids: np.ndarray) -> tuple[int]:
        return (zlib.crc32(ids.astype("<u4").tobytes()),)

    return token_files.read_token_files(files, crc, "ids_crc32 bigint")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def quality_of(labels: DataFrame) -> DataFrame:
    """quality by doc_id: 2 for a document labelled good, 0.5 for one labelled bad."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    return known.select("doc_id", F.when(F.col("good") == 1, 2.0).when(F.col("good") == 0, 0.5).alias("quality"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), quality=quality_of(_table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = _table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("bigint"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", whole.alias("vec"), label.alias("label")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_model(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), shortest=7, fewest=2, times=10, every=31).select("word", "form", "root", "n", "n_near", "form_n")


def license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op4 that SQL can say: words and base places."""
    return op4_license_scan(spark, sf_dir).drop("labels", "score")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op10 that SQL can say: sizes and targets, and that none is taken more than three times."""
    return op10_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("taken") <= 3 * F.col("size")).alias("within"))


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_token_counts, op3_line_dedup, op4_license_scan, op5_nearest_neighbours, op6_simhash_dedup, op7_toxicity, op8_token_files, op9_byte_bpe, op10_mixing, op11_hard_negatives, op12_quality, op13_spelling_variants, license_places, mixing_targets)}

ORACLE_SQL = {
    "op1_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM v),
        links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.9),
        reach AS (SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
        least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
        degree AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
        SELECT least.u AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, least.u = component_id AS kept
        FROM least LEFT JOIN degree USING (u)
    """,
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
    "op13_spelling_variants": r"""
        WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
        r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
        b AS (SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes FROM d),
        h AS (SELECT run, n, xor(list_reduce([4294967295] || bytes, lambda a, x: xor(a >> 8, t.t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM b, t),
        c AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
        w AS (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
        v AS (SELECT word, n, k, substring(word, 1, k - 1) || substring(word, k + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM w)),
        e AS (SELECT DISTINCT v.word AS a, w.word AS b, w.n FROM v JOIN w ON v.less = w.word UNION SELECT DISTINCT w.word, v.word, v.n FROM v JOIN w ON v.less = w.word
            UNION SELECT DISTINCT x.word, y.word, y.n FROM v x JOIN v y ON x.k = y.k AND x.less = y.less AND x.word <> y.word),
        g AS (SELECT a, count(*) AS n_near, max(n) AS most, arg_min(b, (-n, encode(b))) AS best FROM e GROUP BY a),
        f AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 10 * n THEN best END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN g ON word = a),
        u AS (SELECT word, word AS root, form AS further FROM f UNION ALL SELECT u.word, f.word, f.form FROM u JOIN f ON u.further = f.word)
        SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, root FROM u WHERE further IS NULL) USING (word)
    """,
    "license_places": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p AS (SELECT doc_id, len(w) AS n_words, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS a,
            list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS b,
            list_filter(range(1, len(w) + 1), lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS c FROM w)
        SELECT doc_id, n_words::BIGINT AS n_words, (len(a) + len(b) + len(c))::BIGINT AS n_base, list_min(a || b || c) - 1 AS first_word, list_max(a || b || c) - 1 AS last_word,
            concat_ws(',', CASE WHEN len(a) > 0 THEN 'cc-by' END, CASE WHEN len(b) > 0 THEN 'gpl' END, CASE WHEN len(c) > 0 THEN 'reserved' END) AS base_labels FROM p
    """,
    "mixing_targets": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY 1), w AS (SELECT source, n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
        o AS (SELECT *, 3.0 * n / w AS reach, row_number() OVER (ORDER BY 3.0 * n / w, source NULLS LAST) AS k FROM w),
        r AS (SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate FROM o),
        t AS (SELECT source, n, least(3.0 * n, w * (SELECT min_by(rate, k) FROM r WHERE reach >= rate)) AS target FROM r)
        SELECT doc_id, size, n AS source_size, round(target, 6) AS target, true AS within FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    """,
}
