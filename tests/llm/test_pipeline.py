"""Each stage of the pipeline against a brute-force version on its own input."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from streakline.llm.common import documents, stored
from streakline.llm.quality import verdicts
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import brute_classes, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and result of each stage, as the pipeline passes them on."""
    docs, out = documents(spark, sf_dir), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), name)
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "secret_scan", "packing"]
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.dtypes == before.dtypes
        assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_quality(spark, sf_dir, stages):
    before, after = stages["quality_rules"]
    kept = {r["doc_id"] for r in verdicts(before).where("kept").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i in kept}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    base = {r["doc_id"] for r in verdicts(before).where("base_failed").collect()}
    assert all(i in kept for i, q in labels.items() if q == 1 and i not in base)


def test_lines(stages):
    before, after = (texts(x) for x in stages["line_dedup"])
    ids = sorted(before)
    assert [after[i] for i in ids] == [x[2] for x in brute_lines([before[i] for i in ids], 10)]


def test_near_duplicates(stages):
    before, after = (texts(x) for x in stages["near_duplicates"])
    ids = sorted(before)
    classes = brute_classes(ids, [brute_fingerprint(before[i]) for i in ids])
    assert after == {i: before[i] for i in sorted(set(classes))}


def test_secrets(stages):
    before, after = (texts(x) for x in stages["secret_scan"])
    pattern = re.compile(r'(?i)(token = ")[0-9a-f]{40}(?=")')
    assert after == {i: pattern.sub(r"\1[SECRET]", t) for i, t in before.items()}


def test_packing(stages):
    before, result = stages["packing"]
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for i, text in texts(before).items():
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 0], "<u4")
        expected |= {(i, k // 2048, k, zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)}
    rows = result.collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in rows} == expected and len(rows) == len(expected)


def test_run(spark, sf_dir, stages):
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(pieces).collect()) == sorted(stages["packing"][1].select(pieces).collect())
