import os
import sys

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from windlass.llm import exact_dedup, lang_id, quality, simhash
from windlass.llm.common import table
from windlass.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_operators(spark):
    """Brute force of the whole pipeline: each decision taken from the operator's
    report over what is left, applied in plain Python."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    left = {r.doc_id: r for r in docs.collect()}

    def now():
        return spark.createDataFrame([left[i] for i in sorted(left)], docs.schema)

    bad = {r.doc_id for r in quality.classify(now(), labels).collect() if not r.keep}
    left = {i: r for i, r in left.items() if i not in bad}
    bad = {r.doc_id for r in lang_id.identify(now()).collect() if r.rejected}
    left = {i: r for i, r in left.items() if i not in bad}
    top = {}
    for i, r in left.items():
        top[r.text] = max(i, top.get(r.text, i))
    left = {i: r for i, r in left.items() if top[r.text] == i}
    assert {r.doc_id for r in exact_dedup.exact_dedup(now()).collect() if r.kept} == set(left)
    parts = {r.doc_id: r.component_id for r in simhash.near_dedup(now()).collect()}
    left = {i: r for i, r in left.items() if parts[i] == i}

    got = corpus_pipeline.run(spark, SF).collect()
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {i: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in left.items()}
    have = {}
    for p in got:
        have[p.doc_id] = have.get(p.doc_id, 0) + p.length
    assert have == want
    assert 0 < len(left) < docs.count()


def test_stages_keep_columns_and_pass_empty_tables(spark):
    docs = table(spark, SF, "documents").withColumn("row", __import__("pyspark").sql.functions.lit(1)).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "exact_dedup", "simhash_dedup", "packing"]


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_registered(spark):
    sys.path.insert(0, os.path.dirname(os.path.abspath(corpus_pipeline.__file__)))
    import __spark_entry__ as entry
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    assert np.isin(list(ORACLE_SQL), list(entry.oracle_sql())).all()
