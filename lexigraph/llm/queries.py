"""The thin queries op1 .. op13 and the pipeline, over the tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .common import table


TEST_KEY = "a key for tests"  # of these queries alone: who has personal data names a key of their own


def _held_out(modulus: int, remainder: int):
    """Whether crc32 of doc_id as text leaves the remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score

    return score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"), _held_out(5, 0))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), _held_out(5, 0))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import store_and_read

    return store_and_read(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_search import top_k

    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import matches

    return matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score

    return score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"), _held_out(4, 2))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), TEST_KEY, found="n_replaced")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample

    return resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .context_tree import score

    return score(table(spark, sf_dir, "documents", "doc_id", "text"), _held_out(7, 2))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .variants import group

    return group(table(spark, sf_dir, "documents", "doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir, TEST_KEY)


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_toxicity, op3_best_fit_packing, op4_language, op5_token_store, op6_top_k, op7_decontamination, op8_licenses, op9_quality, op10_pii, op11_resampling, op12_context_tree, op13_variants, pipeline)}
#: the others need a classifier, a tokenizer, edit distances, alignments or keyed hashes
ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS d, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.d),
c AS (SELECT d, min(root) AS component_id FROM r GROUP BY d)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.d = w.doc_id""",
    "op6_top_k": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score FROM e q JOIN e ON q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id AND len(q.v) = len(e.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_resampling": r"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS g FROM benchmark),
s AS (SELECT r, unnest(w) AS g FROM w),
v AS (SELECT DISTINCT g, hex(encode(g)) AS x FROM (SELECT g FROM s UNION ALL SELECT g FROM b)),
k AS (SELECT g, xor(list_reduce(list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS k FROM v, t),
ds AS (SELECT k, count(*) AS s FROM s JOIN k USING (g) GROUP BY k), bt AS (SELECT k, count(*) AS t FROM b JOIN k USING (g) GROUP BY k),
n AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM ds) AS DOUBLE) AS s_all, CAST((SELECT coalesce(sum(t), 0) FROM bt) AS DOUBLE) AS t_all),
gain AS (SELECT k.g, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((coalesce(s, 0) + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM k LEFT JOIN ds USING (k) LEFT JOIN bt USING (k), n),
d AS (SELECT r, sum(gain) AS weight FROM s JOIN gain USING (g) GROUP BY r),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN d USING (r)),
z AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM f),
o AS (SELECT *, n_features >= 20 AND score IS NOT NULL AS may, row_number() OVER (PARTITION BY n_features >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id) AS p FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND p <= (SELECT count(*) FILTER (may) * 10 // 100 FROM o) THEN p END AS rank FROM o""",
    "op13_variants": r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
a AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents),
b AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM a GROUP BY ALL HAVING length(w) >= 6),
h AS (SELECT w, n, hex(encode(doc_id || ':' || w)) AS x FROM b),
c AS (SELECT w, n, xor(list_reduce(list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h FROM h, t),
d AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM c),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS MATERIALIZED (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
pat AS MATERIALIZED (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS p FROM e),
del AS MATERIALIZED (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS p FROM e),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM pat a JOIN pat b ON a.p = b.p AND a.word <> b.word
  UNION ALL SELECT d.word, w.word, w.n FROM del d JOIN words w ON w.word = d.p UNION ALL SELECT w.word, d.word, d.n FROM del d JOIN words w ON w.word = d.p),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS m FROM near GROUP BY word),
first AS (SELECT near.word, min(other) AS other FROM near JOIN best ON near.word = best.word AND other_n = m GROUP BY near.word),
forms AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * words.n THEN other END AS form, CASE WHEN m >= 5 * words.n THEN m END AS form_n FROM words LEFT JOIN best ON best.word = words.word LEFT JOIN first ON first.word = words.word),
r AS (SELECT word, word AS root, form AS ahead FROM forms UNION ALL SELECT r.word, f.word, f.form FROM r JOIN forms f ON f.word = r.ahead)
SELECT forms.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN r ON r.word = forms.word AND r.ahead IS NULL""",
}
