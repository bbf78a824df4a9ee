"""One query per corpus operator, over its whole table, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pubgrade.llm import collocations, decontaminate, manifest, minhash, mixing, pii, quality, repeats, token_counts, token_files, toxicity, url_rules, warc
from pubgrade.llm.tables import scratch_path, table
from pubgrade.sources.scratch import with_local_scratch

Query = Callable[[SparkSession, str], DataFrame]


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find_repeats(table(spark, sf_dir, "documents"))


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token-ids")
    files = token_files.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(files)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.SITE_RULES + url_rules.WORD_RULES)


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link_near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fit_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("draw")


def template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read_archives(files)


def phrase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.find_collocations(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_spans(table(spark, sf_dir, "documents")))


def manifest_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "op1_sentence_run_dedup": repeated_passages,
        "op2_heap_token_counts": token_count,
        "op3_token_id_files": token_output,
        "op4_url_rules": url_verdicts,
        "op5_adaptive_quality": quality_verdicts,
        "op6_minmax_near_duplicates": near_duplicates,
        "op7_recurrent_toxicity": toxicity_scores,
        "op8_soft_mixing": mixing_rates,
        "op9_template_leaks": template_leaks,
        "op10_warc_revisits": warc_records,
        "op11_tiled_collocations": phrase_scores,
        "op12_deobfuscated_pii": personal_data,
        "op13_merkle_manifest": manifest_proofs,
        "pipeline": corpus_pipeline.run,
    }
    return {name: with_local_scratch(query) for name, query in queries.items()}
