"""The pipeline stage by stage against plain versions, on each stage's own input."""

import zlib
from collections import Counter

import __spark_entry__ as entry
import brute
import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from tonegauge.llm import decontamination, pii, quality
from tonegauge.llm.common import table
from tonegauge.llm.tokens import default_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        out.append(docs)
    yield out
    for df in out[1:]:
        df.unpersist()


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_quality_stage(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    failed = {k for k, t in before.items() for n, _, _, _, r in [brute.quality(t)] if n < 50 or 100 * r > 50 * n}
    assert not failed & after.keys()
    judged = quality.judge(stages[0], quality.fit(stages[0])).select("row.doc_id", "kept").collect()
    assert {r["doc_id"] for r in judged if r["kept"]} == after.keys()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    good = {k for k in before if labels.get(k) == 1} - failed
    bad = {k for k in before if labels.get(k) == 0}
    assert len(good & after.keys()) >= 0.97 * len(good) and len(bad & after.keys()) <= 0.1 * len(bad)


def test_duplicates_stage(stages):
    before = sorted(rows(stages[1]).items())
    kept = {low for _, _, low in brute.components(before)}
    assert rows(stages[2]).keys() == kept


def test_decontamination_stage(spark, stages):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {k for k, t in rows(stages[2]).items() if not brute.contamination(t, items)[1]}
    assert rows(stages[3]).keys() == clean
    assert decontamination.contamination(stages[3], table(spark, SF, "benchmark")).where("n_hit > 0").count() == 0


def test_personal_data_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    for key, text in before.items():
        spans = brute.personal(text)
        assert not any(text[s:e] in after[key] for _, s, e in spans)
        if not spans and "<" not in after[key]:
            assert after[key] == text
    assert stages[4].where("n_chars <> length(text)").count() == 0
    assert stages[4].select(pii.find_spans(stages[4]).alias("f")).where("size(f) > 0").count() == 0


def test_packing_stage(stages):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    expected = Counter()
    for key, text in rows(stages[4]).items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        for at in range(0, len(ids), 2048):
            piece = ids[at:at + 2048]
            expected[key, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    got = stages[5].select("doc_id", "start", "length", "ids_crc32").collect()
    assert Counter(map(tuple, got)) == expected
