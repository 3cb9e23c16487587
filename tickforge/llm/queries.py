"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.langid import identify

    return identify(_table(spark, sf_dir, "documents"))


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.hilbert import shards

    return shards(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tickforge.llm.bpe import bpe_digest

    return bpe_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.mixing import mix

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, size=None).select("doc_id", "size", "source_size", "target", "taken")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.jaccard import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))[0].select("doc_id", "n_shingles", "component_id", "class_id")


#: (verdict, host, path)
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op6_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tickforge.llm.urlrules import judge

    pages = _table(spark, sf_dir, "pages")
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return judge(pages, URL_RULES, pages.select("page_id", "url").join(labels, "page_id"))


def op7_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.covertree import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tickforge.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.htmltext import extract

    return extract(_table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickforge.llm.quality import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_jaccard": op2_jaccard,
    "op3_langid": op3_langid,
    "op4_hilbert": op4_hilbert,
    "op5_bpe": op5_bpe,
    "op6_urlrules": op6_urlrules,
    "op7_covertree": op7_covertree,
    "op8_topk": op8_topk,
    "op9_htmltext": op9_htmltext,
    "op10_quality": op10_quality,
}

#: Words of a text, as the shingle and mixing operators count them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, sum(n) OVER ()::BIGINT AS all_n, sum(w) OVER ()::BIGINT AS all_w,
  coalesce(sum(3 * n) OVER e, 0)::BIGINT AS n0, coalesce(sum(w) OVER e, 0)::BIGINT AS w0
  FROM s WINDOW e AS (ORDER BY (3 * n)::DOUBLE / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * n * (all_w - w0) <= (all_n - n0) * w AS capped FROM o),
r AS (SELECT max(CASE WHEN capped THEN n0 + 3 * n ELSE 0 END) AS n1, max(CASE WHEN capped THEN w0 + w ELSE 0 END) AS w1 FROM f),
t AS (SELECT source, n, CASE WHEN capped THEN CAST(3 * n AS DOUBLE) ELSE CAST(all_n - n1 AS DOUBLE) * w / (all_w - w1) END AS target FROM f, r),
g AS (SELECT *, CASE WHEN n > 0 THEN CAST(least(round_even(target, 0), 3 * n) AS BIGINT) // n ELSE 0 END AS passes,
  CASE WHEN n > 0 THEN CAST(least(round_even(target, 0), 3 * n) AS BIGINT) % n ELSE 0 END AS rest FROM t),
k AS (SELECT d.doc_id, d.size, g.*, md5('17:' || coalesce(d.doc_id::VARCHAR, '')) AS h FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(h, 1, 4))::INT % 1024, h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT doc_id, size, n AS source_size, target, CAST(size * passes + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM b
"""

_OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS root, doc_id AS here FROM n UNION SELECT r.root, u.b FROM r JOIN u ON u.a = r.here),
c AS (SELECT here, min(root) AS component_id FROM r GROUP BY here)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id,
  coalesce(min(w.doc_id) OVER (PARTITION BY k.key), w.doc_id) AS class_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.here = w.doc_id
LEFT JOIN (SELECT doc_id, list_sort(list(s)) AS key FROM g GROUP BY doc_id) k ON k.doc_id = w.doc_id
"""

_VECTOR = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"
_SOUND = "e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_OP7 = rf"""
WITH RECURSIVE v AS ({_VECTOR}),
s AS (SELECT * FROM v WHERE label IS NOT NULL AND {_SOUND} AND len(list_filter(e, lambda x: x <> 0)) > 0),
u AS (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT a, count(*) AS n FROM u GROUP BY a),
r AS (SELECT a AS root, a AS here FROM n UNION SELECT r.root, u.b FROM r JOIN u ON u.a = r.here),
c AS (SELECT here, min(root) AS low FROM r GROUP BY here)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.here = vec_id
"""

_OP8 = rf"""
WITH v AS (SELECT vec_id, list_transform(e, lambda x: floor(1024 * x)) AS e FROM ({_VECTOR}) WHERE {_SOUND}),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM p
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_mix": _OP1,
    "op2_jaccard": _OP2,
    "op7_covertree": _OP7,
    "op8_topk": _OP8,
}
