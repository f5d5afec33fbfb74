"""The corpus pipeline over the smallest tables, stage by stage, against plain versions."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from skysift.llm import compression_classifier, pii
from skysift.llm.queries import tokenizer_file
from skysift.llm.support import documents, materialize
from tests.llm.test_operators import plain_base, plain_components, plain_shingles, plain_stats

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark):
    docs = documents(spark, FOLDER)
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        model = compression_classifier.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")) if name == "quality_classifier" else None
        scores = {r.doc_id: r.score for r in compression_classifier.scored(docs, model).collect()} if model else {}
        docs = materialize(stage(spark, docs, FOLDER), name)
        kept.append(docs.count())
        after = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_classifier":
            assert set(after) == {n for n in before if scores[n] >= compression_classifier.CUT}
        if name == "quality_rules":
            passing = {n for n, r in before.items() if (s := plain_stats(r.text))[0] >= 50 and 100 * s[4] <= 50 * s[0]}
            assert set(after) <= passing
        if name == "near_duplicates":
            assert set(after) == set(plain_components({n: plain_shingles(r.text) for n, r in before.items()}).values())
        if name == "pii":
            assert set(after) == set(before) and all(not plain_base(r.text) and r.n_chars == len(r.text) for r in after.values())
            assert all(r.text == before[n].text for n, r in after.items() if not pii.base_spans(before[n].text) and not pii.candidates(before[n].text))
        if name == "packing":
            from tokenizers import Tokenizer

            coder = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
            for n, r in before.items():
                ids = np.array(coder.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
                parts = sorted((p for p in docs.where(f"doc_id = {n}").collect()), key=lambda p: p.piece) if n < 30 else []
                assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in parts)
    assert kept[0] > kept[1] > kept[2] == kept[3] > 0
