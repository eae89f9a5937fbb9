"""One query per operator over its whole table, and the SQL with the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.llm import (
    align,
    ann,
    chat,
    decontaminate,
    jaccard_join,
    lm_score,
    mixing,
    quality,
    resample,
    simhash,
    subwords,
    substring_dedup,
    token_files,
    toxicity,
)
from wayside.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reach(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    Workers start with the search path of the function they run. On a cluster whose
    machines do not share that folder, ship the package with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path]))


def register(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach(spark)
            return f(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return keep


_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table_name: str, key: str) -> str:
    """(key, s): the distinct five-word shingles of every text."""
    return f"""
SELECT DISTINCT {key}, array_to_string(ws[i:i + 4], ' ') AS s
FROM (SELECT {key}, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i
  FROM (SELECT {key}, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM {table_name}) WHERE len(ws) > 0)"""


@register("op1_quality_classifier")
def op1(spark, sf):
    return quality.classify(table(spark, sf, "documents"))


@register(
    "op2_substring_dedup",
    f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
 win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
 firsts AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
 gone AS (SELECT DISTINCT doc_id, i + j AS p
  FROM (SELECT doc_id, i, unnest(range(50)) AS j FROM win JOIN firsts USING (k) WHERE doc_id > first)),
 words AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
 kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS txt
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
 sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
)
def op2(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept")


_ESCAPED = "replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"


@register(
    "op3_chat_formatting",
    f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length('<s>[INST][/INST]</s>') + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
)
def op3(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat.digests(chat.format_conversations(turns.union(more)))


@register(
    "op4_jaccard_join",
    f"""
WITH RECURSIVE s AS ({_shingles("documents", "doc_id")}),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
 both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
 reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = r),
 low AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id""",
)
def op4(spark, sf):
    return jaccard_join.link_documents(table(spark, sf, "documents"))


def remainder(column: str, by: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


@register("op5_toxicity")
def op5(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@register("op6_token_ids")
def op6(spark, sf):
    path = scratch_path(spark, "token-ids")
    token_files.write_tokens(table(spark, sf, "documents"), path, subwords.default_path())
    return token_files.read_index(spark, path)


@register(
    "op7_decontamination",
    f"""
WITH d AS ({_shingles("documents", "doc_id")}), t AS ({_shingles("benchmark", "item_id")}),
 n AS (SELECT item_id, count(*) AS n_item FROM t GROUP BY item_id),
 c AS (SELECT doc_id, item_id, count(*) AS n_common FROM d JOIN t USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_common FROM c JOIN n USING (item_id) WHERE n_common * 4 >= n_item * 3""",
)
def op7(spark, sf):
    return decontaminate.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op8_nearest_neighbours")
def op8(spark, sf):
    return ann.nearest(table(spark, sf, "embeddings"))


@register(
    "op9_source_mixing",
    f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2 * source_size AS bound FROM s),
 u AS (SELECT *, coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
   sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
   CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS everything
  FROM r WINDOW o AS (ORDER BY CAST(bound AS DOUBLE) / w, source NULLS LAST)),
 l AS (SELECT everything - CAST(full_before AS DOUBLE) AS level_full, CAST(open_w AS DOUBLE) AS open_w FROM u
  WHERE w * (everything - CAST(full_before AS DOUBLE)) / CAST(open_w AS DOUBLE) <= bound
  ORDER BY CAST(bound AS DOUBLE) / w, source NULLS LAST LIMIT 1),
 t AS (SELECT source, source_size,
   coalesce(least(CAST(bound AS DOUBLE), r.w * level_full / open_w), CAST(bound AS DOUBLE)) AS target FROM r LEFT JOIN l ON true),
 x AS (SELECT d.doc_id, d.size, t.source_size, t.target,
   CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
   CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) AS draw, d.source
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
 g AS (SELECT source, draw, CAST(sum(size) AS BIGINT) AS n, any_value(rate - floor(rate)) * any_value(source_size) AS more
  FROM x GROUP BY source, draw),
 c AS (SELECT source, max(draw) AS cut
  FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY source ORDER BY draw) AS DOUBLE) - n / 2.0::DOUBLE AS middle FROM g)
  WHERE more > 0 AND middle <= more GROUP BY source)
SELECT doc_id, size, source_size, target,
 CAST(size * (floor(rate) + CASE WHEN draw <= cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x LEFT JOIN c ON x.source IS NOT DISTINCT FROM c.source""",
)
def op9(spark, sf):
    mixed = mixing.with_copies(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op10_lm_scoring")
def op10(spark, sf):
    docs = table(spark, sf, "documents")
    scored = lm_score.score_texts(docs, remainder("doc_id", 7) != 2, subwords.default_path())
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", (~F.col("in_training")).alias("held_out"), *names)


@register("op11_simhash_near_dedup")
def op11(spark, sf):
    return simhash.link_documents(table(spark, sf, "documents"))


_TERM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@register(
    "op12_importance_resampling",
    f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)),
 d AS (SELECT 0 AS k, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
 w AS (SELECT row_number() OVER () AS r, k, doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS ws FROM d),
 f AS (SELECT r, k, array_to_string(ws[i:i + m - 1], ' ') AS f
  FROM (SELECT r, k, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m)),
 fc AS (SELECT r, k, f, count(*) AS n FROM f GROUP BY r, k, f),
 b AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(f) + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
   lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS b
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM fc)), crc),
 g AS (SELECT b, sum(CASE WHEN k = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN k = 1 THEN n ELSE 0 END) AS t FROM fc JOIN b USING (f) GROUP BY b),
 tot AS (SELECT sum(s) AS ss, sum(t) AS tt FROM g),
 gain AS (SELECT b, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(ss AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST(tt AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM g, tot),
 wt AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM fc JOIN b USING (f) JOIN gain USING (b) WHERE k = 0 GROUP BY r),
 sc AS (SELECT w.r, doc_id, len(ws) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN wt ON w.r = wt.r WHERE k = 0),
 rk AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS p, count(*) FILTER (words >= 20) OVER () AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND p <= 5 * n // 100 THEN p END AS rank FROM rk""",
)
def op12(spark, sf):
    return resample.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op13_tokenizer_alignment")
def op13(spark, sf):
    a, b = subwords.default_path("byte_bpe_50k.json"), subwords.default_path("piece_bpe_32k.model")
    return align.align_documents(table(spark, sf, "documents"), a, b)
