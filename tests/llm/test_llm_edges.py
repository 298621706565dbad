"""Every operator on nulls, empty and very long texts, ties, repeats, empty tables and clashing columns."""

import gzip
import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import edge_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tonegauge.llm import (
    decontamination, huffman, language_model, ngram_join, packing, passages, pii, quality, toxicity, warc,
)
from tonegauge.llm.common import scratch
from tonegauge.llm.tokens import default_tokenizer


def same(rows, expected):
    assert Counter(map(tuple, rows)) == Counter(expected)


@pytest.fixture(scope="module")
def bench(spark):
    first = edge_rows()[0][1].split()
    items = [(1, " ".join(first[20:34])), (2, "ONE two"), (2, "one TWO"), (3, None), (4, ""), (5, "!!"),
             (None, " ".join(first[20:34])), (6, "absent words only"), (7, " ".join(first[:9]))]
    return spark.createDataFrame(items, "item_id long, text string").withColumn("gram", F.lit(1)), items


@pytest.mark.parametrize("broadcast_words", [0, 10_000])
def test_contamination(edge, empty, bench, broadcast_words):
    items = [(k, t) for k, t in bench[1] if k is not None]
    got = decontamination.contamination(edge, bench[0], broadcast_words=broadcast_words)
    same(got.select("doc_id", "n_words", "n_hit", F.array_join("items", ",")).collect(),
         [(k, n, h, ",".join(i)) for k, t in edge_rows() for n, h, i in [brute.contamination(t, items)]])
    assert decontamination.contamination(empty, bench[0]).count() == 0
    assert decontamination.contamination(edge, bench[0].limit(0)).where("n_hit > 0").count() == 0


def test_removal_of_contamination(edge, empty, bench):
    dirty = [bool(brute.contamination(t, bench[1])[1]) for _, t in edge_rows()]
    kept = decontamination.remove_documents(edge, bench[0])
    assert kept.columns == edge.columns
    same(kept.select("doc_id", "text").collect(), [r for r, d in zip(edge_rows(), dirty) if not d])
    cut = decontamination.remove_spans(edge, bench[0])
    assert cut.columns == edge.columns and cut.count() == len(dirty)
    again = decontamination.contamination(cut, bench[0])
    assert again.where("n_hit > 0").count() == 0
    words = {r["doc_id"]: r["n_words"] for r in again.collect()}
    for key, text in edge_rows():
        n, hit, _ = brute.contamination(text, bench[1])
        if key in (7, 3, 16, 18):
            assert words[key] == n - hit
    assert decontamination.remove_spans(empty, bench[0]).count() == 0


def test_quality(edge, empty):
    model = quality.fit(edge)
    got = quality.judge(edge, model)
    figures = got.select("row.doc_id", "x.n_words", "x.word_chars", "x.n_symbols", "x.n_dup_lines", "x.n_repeat_words")
    same(figures.collect(), [(k, *brute.quality(t)) for k, t in edge_rows()])
    assert got.where("kept and base_failed").count() == 0
    assert quality.keep_good(edge).columns == edge.columns
    assert quality.keep_good(empty).count() == 0
    assert quality.fit(empty).prior == 0.8


def test_language_model(edge, empty):
    expected = Counter((k, h, n, known, total, round(b, 6)) for (k, _), (h, n, known, total, b)
                       in zip(edge_rows(), brute.base_scores(edge_rows())))
    results = []
    for block in (1 << 24, 4000):
        rows = language_model.score(edge, block_bytes=block).collect()
        assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows) == expected
        assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
        results.append(Counter((r["doc_id"], round(r["score"], 6)) for r in rows))
    assert results[0] == results[1]  # blocks are not part of the model
    assert language_model.score(empty).count() == 0


def test_passages(edge, empty):
    rows = passages.repeated_passages(edge).collect()
    pairs = {frozenset((r["doc_id"], r["other_doc_id"])) for r in rows}
    for a, b in ((3, 7), (3, 9), (3, 21), (4, 21), (18, 19)):
        assert frozenset((a, b)) in pairs
    clean = {12, 13, 14, 15, 16, 17, 20, 2**60 + 1, 24}
    assert not clean & {k for p in pairs for k in p}
    assert passages.repeated_passages(empty).count() == 0


@pytest.fixture(scope="module")
def encoded():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [(k, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for k, t in edge_rows()]


def test_token_files(spark, edge, empty, encoded):
    path = scratch(spark, "test-tokens")
    huffman.write_tokens(edge, path)
    rows = huffman.read_tokens(spark, path, with_ids=True).collect()
    rows.sort(key=lambda r: r["start"])
    at = 0
    for r in rows:
        ids = np.array(r["ids"], "<u4")
        assert r["start"] == at and r["n_tokens"] == len(ids) and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        at += len(ids)
    same([(r["doc_id"], tuple(r["ids"])) for r in rows], [(k, tuple(x.tolist())) for k, x in encoded])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    path = scratch(spark, "test-tokens")
    huffman.write_tokens(empty, path)
    assert huffman.read_tokens(spark, path).count() == 0


def test_personal_data(edge, empty):
    rows = edge.select("doc_id", "text", pii.find_spans(edge).alias("found")).collect()
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["found"] if s["base"]] == brute.personal(r["text"])
    more = {s["kind"] for r in rows for s in r["found"] if not s["base"]}
    assert more == {"iban", "ssn", "local_phone"}
    clean = pii.redact(edge)
    assert clean.columns == edge.columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[12] is None and texts[18] == dict(edge_rows())[18]
    assert texts[17].startswith("Mail <EMAIL> or x@y.z<EMAIL>") or texts[17].startswith("Mail <EMAIL> or <EMAIL>")
    assert "+44" not in texts[17] and "DE89" not in texts[17] and "1.2.3.256" in texts[17]
    assert empty.select(pii.find_spans(empty)).count() == 0


def test_packing(edge, empty, encoded):
    rows = packing.pack_documents(edge, group_pieces=8).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == Counter(
        (k, at, len(x[at:at + 2048]), zlib.crc32(x[at:at + 2048].tobytes()), len(x))
        for k, x in encoded for at in range(0, len(x), 2048))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty).count() == 0


def test_toxicity(spark, edge, empty):
    texts = [(i, f"you {w} person of no worth number {i}") for i, w in enumerate(["idiot", "friend"] * 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(70)] + [(3, 0), (None, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert all(r["toxic"] == (r["doc_id"] % 2 == 0) for r in got)  # ten of them held out
    assert all((r["severity"] >= 0.5) == r["toxic"] for r in got)
    assert toxicity.score(edge, model).count() == len(edge_rows())
    nothing = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, nothing).where("toxic").count() == 0
    assert toxicity.score(empty, model).count() == 0


def test_jaccard_join(edge, empty):
    got = ngram_join.link(edge)
    same(got.select("doc_id", "n_shingles", "component_id").collect(), brute.components(edge_rows()))
    kept = ngram_join.keep_one(edge)
    assert kept.columns == edge.columns
    groups = {}
    for (key, text), (_, n, low) in zip(edge_rows(), brute.components(edge_rows())):
        groups.setdefault((low, n > 0), []).append((key, text))
    wordless = [r for r in edge_rows() if not brute.words(r[1])]
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([low for low, worded in groups if worded]) + Counter(k for k, _ in wordless)
    assert ngram_join.link(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_archives(spark):
    body = "<p>" + "é" * 600 + "</p>"
    pages = [(1, "http://a/b c\r\nX: y", body), (5, None, body), (5, None, body), (9, "http://z", body[:-1]), (2, "u", None),
             (3, "u", ""), (4, "u", "short"), (8, "u", "short"), (None, "u", body), (2**60 + 1, "u", "q" * 2000),
             (2**60, "u", "q" * 2000), (11, "u", "line\r\n\r\nContent-Length: 3\r\n\r\n" * 300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = scratch(spark, "test-warc")
    rows = warc.archive_pages(df, path, with_payload=True).collect()
    expected = []
    for key, _, html in pages:
        raw = (html or "").encode()
        same_body = [k for k, _, h in pages if (h or "") == (html or "") and k is not None]
        other = len(raw) >= 1000 and len([1 for _, _, h in pages if h == html]) > 1 and key != max(same_body)
        expected.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response",
                         max(same_body) if other else None, None if other else raw))
    same([(*r[:5], None if r[5] is None else bytes(r[5])) for r in rows], expected)
    files = spark.read.format("binaryFile").load(f"{path}/normal/kind=archives").collect()
    sidecars = spark.read.format("binaryFile").load(f"{path}/normal/kind=index").collect()
    index = [line for f in sidecars for line in gzip.decompress(bytes(f["content"])).splitlines()]
    assert sum(gzip.decompress(bytes(f["content"])).count(b"WARC/1.1\r\n") for f in files) == len(pages) == len(index)
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_long_archives_and_small_chunks():
    raws = [warc.record(i, f"http://x/{i}", b"z" * (i * 977), "d", None, "2020-01-01T00:00:00Z") for i in range(40)]
    stream = b"".join(raws)
    assert list(warc.split_records(stream[i:i + 101] for i in range(0, len(stream), 101))) == raws
    assert b"".join(warc.inflate(gzip.compress(stream) + warc.EMPTY_MEMBER)) == stream
    with pytest.raises(ValueError):
        list(warc.split_records([stream[:-5]]))
    with pytest.raises(ValueError):
        list(warc.inflate(gzip.compress(stream)[:-30]))
