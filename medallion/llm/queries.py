"""One query per operator, over the whole of its table with production
parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import read_table
from medallion.session import staging_path


def tokenizer(name: str) -> str:
    """The path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.tokens import token_counts

    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenizers import Tokenizer

    from medallion.llm.idfiles import read_ids, write_ids
    from medallion.llm.tokens import id_type

    path, folder = tokenizer("word_bpe_49k.json"), staging_path(spark, "llm-ids")
    write_ids(read_table(spark, sf_dir, "documents"), path, folder, end_id=2)
    return read_ids(spark, folder, id_type(Tokenizer.from_file(path)))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.topk import top_k

    return top_k(read_table(spark, sf_dir, "embeddings"))


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.ann import nearest

    return nearest(read_table(spark, sf_dir, "embeddings"))


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.substring import remove_repeated

    got = remove_repeated(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.htmltree import main_text

    return main_text(read_table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.langid import identify

    return identify(read_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.mixing import mix, sized

    return mix(sized(read_table(spark, sf_dir, "documents"))).drop("sources")


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.ngrams import score_texts

    return score_texts(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.infill import fill_in_middle, restored

    got = fill_in_middle(read_table(spark, sf_dir, "documents"))
    shas = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shas)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from medallion.llm.shallot import clusters

    return clusters(read_table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds as a chain of tables: ``cN`` the centroids after N rounds,
    ``aN`` the nearest centroid of every vector by them."""
    parts = []
    for r in range(rounds + 1):
        if r:
            parts.append(f"""s{r} AS (
  SELECT c, i, sum(q[i]) AS s, count(*) AS n FROM (SELECT c, q, unnest(range(1, 65)) AS i FROM a{r - 1}) GROUP BY c, i),
c{r} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r - 1} o
  LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY c) m USING (c))""")
        parts.append(f"""d{r} AS (
  SELECT rid, vec_id, q, c, list_sum(list_transform(list_zip(q, v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept, c{r}),
a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(q) AS q, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM d{r} GROUP BY rid)""")
    return ",\n".join(parts)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_token_files,
        op3_exact_top_k,
        op4_projection_forest,
        op5_simhash_components,
        op6_best_fit_packing,
        op7_substring_dedup,
        op8_page_text,
        op9_language_id,
        op10_source_mix,
        op11_lm_scores,
        op12_fill_in_middle,
        op13_centroid_clusters,
    )
}
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op3_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op7_substring_dedup": f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
places AS (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
win AS (SELECT rid, i, array_to_string(ws[i:i + 34], ' ') AS k FROM places),
dup AS (SELECT rid, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM dup),
word AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM word ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)""",
    "op10_source_mix": f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0'), 1, 16) AS key FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
r AS (SELECT *, 3 * CAST(s AS DOUBLE) / w AS ratio FROM s),
c AS (
  SELECT *, (sum(s) OVER ()) - 3 * coalesce(sum(s) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM r),
f AS (SELECT arg_min(CAST(rest AS DOUBLE) / CAST(weight AS DOUBLE), ratio) AS share FROM c WHERE CAST(rest AS DOUBLE) / CAST(weight AS DOUBLE) <= ratio),
t AS (SELECT source, s, least(3 * CAST(s AS DOUBLE), w * share) AS target FROM r, f),
u AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE least(3, CAST(floor(target) AS BIGINT) // s) END AS whole FROM t),
o AS (
  SELECT d.*, u.s, u.target, u.whole, CAST(floor(target) AS BIGINT) - whole * s AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, s AS source_size, target,
  CAST(size * (whole + CASE WHEN 2 * (rest - before) > size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM o""",
    "op12_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, CAST(len(t) AS BIGINT) AS n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, n, form, text, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p""",
    "op13_centroid_clusters": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v
  FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, vec_id, q AS v FROM kept ORDER BY h, vec_id, v LIMIT 8)),
{_rounds_sql()}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM a10 a JOIN c10 f ON a.c = f.c""",
}
