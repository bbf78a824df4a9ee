"""The corpus pipeline stage by stage, and every corpus query."""

import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from checks.compare import compare
from conftest import SF_DIR
from pubgrade.llm import toxicity
from pubgrade.llm.oracles import llm_sql
from pubgrade.llm.queries import llm_queries
from pubgrade.llm.tables import cut_lineage, table
from llm.test_minhash import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the input first."""
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(cut_lineage(stage(spark, found[-1], SF_DIR), name))
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    scores = toxicity.score(stages[0], table(spark, SF_DIR, "labels")).collect()
    assert texts(stages[1]).keys() == {r.doc_id for r in scores if not r.predicted} and any(r.predicted for r in scores)


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    groups = brute(list(before.items()), 5, 80)
    assert texts(stages[2]) == {d: t for d, t in before.items() if groups[d][1] == d}


def test_leaks_go(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    items = [re.sub(r"\s+", " ", r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    assert before.keys() - after.keys() == {d for d, t in before.items() if any(i in re.sub(r"\s+", " ", t) for i in items)}


def test_mixing_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    gone = texts(stages[3]).keys() - texts(stages[4]).keys()
    assert all(labels.get(d, 0) == 0 for d in gone)


def test_token_files(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, rows = 0, {}
    for doc, text in sorted(texts(stages[4]).items()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        rows[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in stages[5].collect()} == rows


def test_registered():
    assert llm_queries().keys() <= __spark_entry__.queries().keys() and llm_sql().keys() <= llm_queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in llm_queries()} - {"pipeline"}


@pytest.mark.parametrize("name", llm_sql())
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, SF_DIR, name)
    assert ok, note
