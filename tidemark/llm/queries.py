"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import chat_sql
from .codes import codes_sql
from .common import table
from .licences import licence_sql
from .spelling import SPELLING_SQL


def op1_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pq import embedding_groups

    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed

    return packed(table(spark, sf_dir, "documents"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import interpolated_scores

    return interpolated_scores(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_plan

    return mix_plan(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import compacted

    return compacted(table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import licence_scan

    return licence_scan(table(spark, sf_dir, "documents"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import chat_digests

    return chat_digests(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP8_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, lower(regexp_extract(coalesce(rest, ''), '^[^/]*')) AS host, substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/]*')) + 1) AS path FROM u
), r AS (
  SELECT p.page_id, p.host, p.path, x.rule, x.verdict, row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(x.rule) DESC) AS k
  FROM p LEFT JOIN (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'), ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) AS x(h, pre, rule, verdict)
  ON ends_with('.' || p.host, '.' || x.h) AND starts_with(p.path, x.pre)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM r WHERE k = 1
"""

_ALL = (
    op1_pq, op2_packing, op3_lm, op4_quality, op5_simhash, op6_sharding, op7_rules, op8_urls, op9_mixing, op10_licences,
    op11_codes, op12_chat, op13_spelling, pipeline,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {x.__name__: x for x in _ALL}
ORACLES: dict[str, str] = {"op8_urls": OP8_SQL, "op10_licences": licence_sql(), "op11_codes": codes_sql(), "op12_chat": chat_sql(), "op13_spelling": SPELLING_SQL}
