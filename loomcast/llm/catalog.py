"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomcast.catalog.registry import Query
from loomcast.llm.centroids import SQL as CLUSTER_SQL
from loomcast.llm.common import table

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(run, sql)
        return run

    return register


@query("op3_secret_scans")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.secrets import secret_report

    return secret_report(table(spark, folder, "documents"))


URL_SQL = """
with parts as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), split as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') as path
  from parts
), judged as (
  select *, case
    when host = 'www.example.com' and starts_with(path, '/en/') or host like '%.www.example.com' and starts_with(path, '/en/')
      then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/'
  end as rule
  from split
)
select page_id, host, path, rule,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from judged
"""


@query("op4_url_filter", URL_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.url_filter import rules_table, url_verdicts

    return url_verdicts(table(spark, folder, "pages"), rules_table(spark))


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.quality_rules import compression_rules

    return compression_rules(table(spark, folder, "documents"))


@query("op1_token_files")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.token_files import write_and_read

    return write_and_read(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@query("op7_jaccard_join")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, folder, "documents"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.passages import repeated_passages

    return repeated_passages(table(spark, folder, "documents"))


@query("op8_decontamination")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.tiling import leaked_items

    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.kneser_ney import quality_scores

    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return quality_scores(docs, table(spark, folder, "labels")).drop("text")


@query("op11_centroid_clusters", CLUSTER_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.centroids import cluster_report

    return cluster_report(table(spark, folder, "embeddings"))


@query("op12_best_fit_packing")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.vector_packing import packing_report

    return packing_report(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from loomcast.llm.alignment import aligned_documents

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return aligned_documents(table(spark, folder, "documents"), a, b)
