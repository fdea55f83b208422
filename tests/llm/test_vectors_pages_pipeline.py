"""Nearest neighbours, WARC archives, the URL filter and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import forest, urls, warc
from tidemark.llm.common import BATCH_BYTES, stored

# ---- nearest neighbours ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, id string, vector string"


def brute_force(rows, every, top):
    ok = [(k, np.asarray(v, np.float32).astype(float)) for k, v in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ok = [(k, v) for k, v in ok if len(v) == 8]
    out = {}
    for q, v in ok:
        if q % every == 0:
            away = sorted({(float(np.sqrt(((v - w) ** 2).sum())), k) for k, w in ok if k != q})
            out[q] = away[:top]
    return out


def test_small_tables_are_searched_whole_with_odd_vectors_ties_and_copies(spark):
    random = np.random.default_rng(1)
    rows = [(k, random.standard_normal(8).tolist()) for k in range(120)]
    hot = random.standard_normal(8).tolist()
    rows += [(k, hot) for k in range(200, 260)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [float("inf")] + [1.0] * 7), (305, [None] + [1.0] * 7), (306, [1.0] * 3), (None, hot), (7, rows[7][1])]
    frame = spark.createDataFrame([(k, v, "x", "y") for k, v in rows], VECTORS)
    expected = brute_force(rows, 20, 10)
    found = {}
    for r in forest.nearest(frame, query_every=20).orderBy("query_id", "rank").collect():
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.score, r.vec_id))
    assert found.keys() == expected.keys()
    for q, pairs in expected.items():
        assert [k for _, k in found[q]] == [k for _, k in pairs] and np.allclose([s for s, _ in found[q]], [s for s, _ in pairs], atol=1e-12)


def test_recall_on_vectors_without_structure_and_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAST", 100)
    random = np.random.default_rng(2)
    spread = random.standard_normal((3000, 32))
    centres = random.standard_normal((6, 32))
    close = centres[random.integers(0, 6, 3000)] + 0.05 * random.standard_normal((3000, 32))
    for data in (spread, close):
        data = data.astype(np.float32)
        frame = spark.createDataFrame([(k, v, "", "") for k, v in enumerate(data.tolist())], VECTORS)
        hits = total = 0
        found = Counter((r.query_id, r.vec_id) for r in forest.nearest(frame, query_every=50).collect())
        for q in range(0, 3000, 50):
            away = ((data - data[q]).astype(float) ** 2).sum(axis=1)
            away[q] = np.inf
            nearest = np.argsort(away, kind="stable")[:10]
            hits += sum(found[q, int(k)] for k in nearest)
            total += 10
        assert hits >= 0.9 * total


def test_no_vectors_give_no_neighbours(spark):
    assert forest.nearest(spark.createDataFrame([], VECTORS)).collect() == []
    assert forest.nearest(spark.createDataFrame([(0, [1.0, 2.0], "", "")], VECTORS)).collect() == []


# ---- archives ----------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, record_type string, row string"


def odd_pages():
    return [
        (1, "http://a.org/x", "<p>same</p>", "", ""), (5, "http://b.org/", "<p>same</p>", "", ""), (3, None, "<p>same</p>", "", ""),
        (7, "http://c.org/\r\nX: y", "WARC/1.1\r\n\r\nin the payload\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "", ""),
        (8, "http://é.org/😀", None, "", ""), (9, "", "", "", ""), (10, "u", "ü" * 50_000, "", ""), (11, "v", "\r\n\r\n", "", ""),
        (12, "w", "twice", "", ""), (12, "w", "twice", "", ""), (None, "n", "<p>same</p>", "", ""), (2, "u2", "\n", "", ""),
    ]


@pytest.mark.parametrize("least", [0, 8])
def test_archives_give_back_every_page(spark, least):
    pages = odd_pages()
    expected = []
    for page, _, html, *_ in pages:
        data = (html or "").encode()
        stands = max((k for k, _, h, *_ in pages if (h or "") == (html or "") and k is not None), default=None)
        again = page is not None and len(data) >= least and page < stands
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "revisit" if again else "response", stands if again else None))
    found = warc.archived_pages(spark.createDataFrame(pages, PAGES), least).drop("target_uri").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_records_keep_blocks_and_identifiers(spark, tmp_path):
    folder = str(tmp_path / "warc")
    warc.write_archive(spark.createDataFrame(odd_pages(), PAGES), folder)
    records = stored(warc.read_records(spark, folder), "records")
    assert records.count() == 3 * len(odd_pages()) == records.select("record_id").distinct().count()
    captures = warc.transactions(records).collect()
    assert len(captures) == len(odd_pages())
    for c in captures:
        assert c.request.concurrent_to == c.metadata.concurrent_to == c.response.record_id
    texts = {bytes(c.response.block).partition(b"\r\n\r\n")[2].decode() for c in captures if c.response.record_type == "response"}
    assert texts == {h or "" for _, _, h, *_ in odd_pages()}


def test_a_record_without_partner_leaves_its_struct_null(spark):
    rows = [("response", "r1", None), ("request", "q1", "r1"), ("metadata", "m9", "r9")]
    records = spark.createDataFrame(rows, "record_type string, record_id string, concurrent_to string")
    (capture,) = warc.transactions(records).collect()
    assert capture.request.record_id == "q1" and capture.response.record_id == "r1" and capture.metadata is None


def test_broken_archives_are_refused():
    good = warc.record("metadata", "<x>", {}, "a: b") + warc.END
    assert [f["warc-type"] for f, _ in warc.parse(good.encode() * 2)] == ["metadata"] * 2
    for broken in (good[:-2], good.replace("Content-Length: 4", "Content-Length: 3"), "X" + good):
        with pytest.raises((ValueError, KeyError)):
            list(warc.parse(broken.encode()))
    assert gzip.decompress(gzip.compress(good.encode())) == good.encode()


def test_no_pages_give_no_captures(spark):
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).collect() == []


# ---- URL filter --------------------------------------------------------------------------------------


def test_rules_and_vocabulary(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "a.org/x": ("", "", None, "allow"),
        "http://A.ORG/x": ("a.org", "/x", "org/", "allow"), "http://org": ("org", "", None, "allow"),
        "https://x.example.org/es/1?q#f": ("x.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/en/12": ("badexample.org", "/en/12", "org/", "allow"),
        "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"), "http://a.com?/de/": ("a.com", "", None, "allow"),
        "x://y://z/p": ("y:", "//z/p", None, "allow"),
        "http://casino.net/": ("casino.net", "/", None, "block"), "http://casinos.net/": ("casinos.net", "/", None, "allow"),
        "http://CASINO.org/": ("casino.org", "/", "org/", "allow"), "http://b.net/blog/blog/blog": ("b.net", "/blog/blog/blog", None, "allow"),
        "http://blog.net/top?page=1": ("blog.net", "/top", None, "block"), "http://a.net/" + "x" * 100_000 + "/xxx": ("a.net", "/" + "x" * 100_000 + "/xxx", None, "block"),
    }
    frame = spark.createDataFrame([(k, u, "h", "v") for k, u in enumerate(cases)], "page_id long, url string, host string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame).collect()}
    assert [found[k] for k in range(len(cases))] == list(cases.values())
    assert urls.judge(frame.limit(0)).collect() == []


# ---- pipeline ----------------------------------------------------------------------------------------


def test_stages_keep_columns_and_decide(spark, tmp_path):
    def prose(seed, n=60):
        random = np.random.default_rng(seed)
        return ". ".join(" ".join("".join(random.choice(list("abcdefgh"), 5)) for _ in range(10)) for _ in range(n // 10)) + "."

    near = prose(1).split()
    near[30] = "other"
    texts = [(k, prose(k)) for k in range(40)]
    texts += [(100, prose(0)), (101, prose(0).replace(" ", "  ", 1)), (102, " ".join(near)), (103, prose(3).upper().replace(" ", "!! ")), (104, None), (None, prose(70))]
    texts += [(200 + k, prose(200 + k).upper().replace(" ", "!! ")) for k in range(30)]
    rows = [(k, t, "en", f"s{(k or 0) % 3}", 1, "x", "y") for k, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` string, dropped_id string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, str(tmp_path)), name)
        if name != "byte_bpe":
            assert docs.columns == before.columns
        kept.append(sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str))
    good, exact, near_free, mixed, encoded = kept
    assert set(range(40)) | {100, 101, 102, None} == set(good)
    assert set(good) - set(exact) == {0, 100} and set(exact) - set(near_free) == {102}  # the longest copy stays
    assert set(mixed) <= set(near_free) and encoded == mixed
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in result), key=str) == encoded
    assert all(r.n_tokens == len(r.ids) > 0 for r in result)


@pytest.mark.parametrize("stage", ["weak_label_quality", "minhash_dedup", "byte_bpe"])
def test_stages_hand_texts_to_python_in_small_batches(spark, tmp_path, stage):
    """The texts of a task never enter Python, and the buffers before it, as one batch; a session's own limit stays."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 400) AS text", "'en' AS lang", "'s' AS source", "1 AS n_chars")

    @F.arrow_udf("long")
    def size(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([texts.nbytes] * len(texts))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    try:
        spark.conf.unset(limit)
        dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(5), str(tmp_path))
        for found in (docs.select(size("text").alias("size")), docs.select("text").mapInArrow(sizes, "size long")):
            assert 100_000 < max(r["size"] for r in found.distinct().collect()) < 2 * BATCH_BYTES
        spark.conf.set(limit, "3m")
        dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(5), str(tmp_path))
        assert spark.conf.get(limit) == "3m"
    finally:
        spark.conf.unset(limit)
