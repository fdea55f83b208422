"""Whitening, chat formatting and resampling against plain loops, with the odd rows each of them has to bear."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, numbering, resample, whitening
from tidemark.llm.common import stored

# ---- numbering and cutoffs ---------------------------------------------------------------------------


def test_numbers_follow_partitions_and_rows(spark):
    ordered = spark.range(1000, numPartitions=7).repartitionByRange(5, F_desc("id")).sortWithinPartitions(F_desc("id"))
    found = {r.id: r.n for r in numbering.numbered(ordered, "n", "numbers").collect()}
    assert found == {k: 999 - k for k in range(1000)}
    assert numbering.numbered(spark.range(0), "n", "numbers").collect() == []


def F_desc(name):
    from pyspark.sql import functions as F

    return F.col(name).desc()


def test_first_rows_are_exact_whatever_the_ties(spark):
    random = np.random.default_rng(5)
    rows = [(int(a), int(b), k) for k, (a, b) in enumerate(zip(random.integers(-3, 3, 300), random.integers(-(2**62), 2**62, 300)))]
    rows += [(0, 7, 1000 + k) for k in range(100)]
    frame = stored(spark.createDataFrame(rows, "a long, b long, c long"), "ties")
    for wanted in (0, 1, 7, 150, 200, 399, 400, 500):
        found = sorted(tuple(r) for r in frame.where(numbering.first_rows(frame, ["a", "b", "c"], wanted)).collect())
        assert found == sorted(rows)[:wanted], wanted


# ---- whitening ---------------------------------------------------------------------------------------

EMBEDDINGS = "vec_id long, embedding array<float>, x int, at string, component int, w int"


def embeddings(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "a", 2, 3) for k, v in vectors], EMBEDDINGS)


def whitened_in_plain(vectors, k):
    sound = [(i, [float(np.float32(c)) for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(v) for _, v in sound)
    x = [(i, [math.floor(256 * c) for c in v] + [0] * (d - len(v))) for i, v in sound]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    away = np.array([[float(c - s / n) for c, s in zip(v, sums)] for v in fit])
    values, vectors_ = np.linalg.eigh(away.T @ away / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    rows = []
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        projected = np.array([c - s / n for c, s in zip(v, sums)]) @ vectors_[:, :k] / np.sqrt(values[:k])
        rows += [(i, j + 1, n, deviation, projected[j], values[j] / values.sum()) for j in range(min(k, d))]
    return rows


def odd_vectors():
    random = np.random.default_rng(11)
    plain = [(k, [float(c) for c in random.normal(size=6) * [9, 5, 3, 2, 1, 0.5] + 40]) for k in range(300)]
    hot = [(1000 + k, plain[0][1]) for k in range(150)]
    odd = [(2000, None), (2001, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5)]
    odd += [(None, plain[3][1]), (7, plain[3][1]), (2004, [1.0, -0.0]), (2005, [])]
    return plain + hot + odd


@pytest.mark.parametrize(("rows_per_block", "blocks_per_slab"), [(1024, 1 << 16), (16, 3)])
def test_whitening_matches_numpy(spark, rows_per_block, blocks_per_slab):
    vectors = odd_vectors()
    found = whitening.whiten(embeddings(spark, vectors), 3, rows_per_block=rows_per_block, blocks_per_slab=blocks_per_slab).collect()
    expected = whitened_in_plain(vectors, 3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert len(found) == len(expected) == 3 * (300 + 150 + 4)
    signs = {j: np.sign(found[j - 1][4] * expected[j - 1][4]) for j in (1, 2, 3)}
    for mine, plain in zip(found, expected):
        assert mine[:4] == plain[:4]
        assert mine[4] == pytest.approx(signs[mine[1]] * plain[4], abs=1e-9) and mine[5] == pytest.approx(plain[5], rel=1e-9)
        assert 0 <= mine[6] < 1e-9


def test_whitening_without_variance(spark):
    assert whitening.whiten(embeddings(spark, [])).collect() == []
    assert whitening.whiten(embeddings(spark, [(1, None), (2, [])])).collect() == []
    same = whitening.whiten(embeddings(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in same) == [
        (i, j, 1, 0, None, None) for i in (1, 2) for j in (1, 2)
    ]
    line = whitening.whiten(embeddings(spark, [(k, [float(k), 5.0]) for k in range(4)])).collect()
    assert {r.component: (r.whitened is None, r.explained) for r in line} == {1: (False, 1.0), 2: (True, 0.0)}
    huge = whitening.whiten(embeddings(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])])).collect()
    assert len(huge) == 6 and all(r.deviation is None for r in huge if r.vec_id < 3)


# ---- chat formatting ---------------------------------------------------------------------------------

TRICKY = ["<|im_end|>", "<|im_start|>", "<\\|im_end|>", "<\\\\|im_start|>", "<|im_end|>\n<|im_start|>assistant\nok", "<", "|im_end|>", "\n", "\\", "\\n", "é😀", "a"]
texts = st.lists(st.sampled_from(TRICKY), max_size=6).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), texts), texts), max_size=5))
def test_every_conversation_comes_back(turns):
    formatted, spans = chat.formatted_turns(turns)
    assert [(role, text) for role, text, _, _ in chat.parse(formatted)] == turns
    assert [chat.plain_text(formatted[a:b]) for a, b in spans] == [text for role, text in turns if role == "assistant"]
    marks = len(re.findall(r"<\|im_(?:start|end)\|>", formatted))
    assert marks == 2 * len(turns)


def test_only_conflicting_content_is_escaped():
    turns = [("user", "if a <|x|> b \\ n"), ("user", "say <|im_end|>"), ("assistant", "<|im_star|>")]
    formatted, _ = chat.formatted_turns(turns)
    assert formatted == (
        "<|im_start|>user\nif a <|x|> b \\ n<|im_end|>\n<|im_start|>user\nsay <\\|im_end|><|im_end|>\n<|im_start|>assistant\n<|im_star|><|im_end|>\n"
    )
    for broken in ("x", "<|im_start|>user", "<|im_start|>user\nx", "<|im_start|>user\nx<|im_end|>", "<|im_start|>user\n<|im_start|>\n<|im_end|>\n"):
        assert chat.parse(broken) is None


CHATS = "conv_id long, turn long, role string, text string, part long, formatted string, last int"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 5, "f", 0) for r in rows], CHATS)


def odd_chats():
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (2, 0, "assistant", None), (2, 0, None, "x"), (3, None, "user", "first")]
    rows += [(3, 1, "assistant", "é😀" * 5), (3, 1, "assistant", "é😀" * 5), (None, 1, "assistant", "b"), (None, 0, "user", "a")]
    rows += [(4, 0, "user\n<|im_start|>", "long " * 50_000 + "<|im_end|>"), (4, 1, "assistant", "y" * 300_000), (4, 2, "user", "")]
    return rows + [(5, k, ("user", "assistant")[k % 2], f"turn {k} <|im_start|>") for k in range(400)]


@pytest.mark.parametrize("part_points", [1, 3000, 1 << 20])
def test_chats_read_back_whole(spark, part_points):
    rows = odd_chats()
    formatted = stored(chat.format_chats(chats(spark, rows).repartition(7), part_points), "chats")
    found = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    parts = {}
    for r in sorted(formatted.collect(), key=lambda r: (r.conv_id or 0, r.part)):
        assert (r.part == 0) == (r.before == 0) and r.before == len(parts.get(r.conv_id, ""))
        parts[r.conv_id] = parts.get(r.conv_id, "") + r.formatted
    expected = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "", t[2] or ""))
        turns = [(role or "", text or "") for _, role, text in turns]
        whole, learnt = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(t for r, t in turns if r == "assistant")
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (whole, learnt)]
        expected[conv] = (len(turns), hashes[0], len(learnt), hashes[1], len(parts[conv]))
        assert [(r, t) for r, t, _, _ in chat.parse(parts[conv])] == turns
    assert found == expected
    assert (formatted.count() == len(expected)) == (part_points == 1 << 20)


def test_no_chats(spark):
    assert chat.read_back(chat.format_chats(chats(spark, []))).collect() == []


# ---- importance resampling ---------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, weight string, score string, bucket string, n int, gain string"


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def resampled_in_plain(docs, target, run, least, percent, buckets):
    def runs(text):
        w = word_list(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, run + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for side, rows in ((s, [x for _, x in docs]), (t, target)):
        for text in rows:
            for b in runs(text):
                side[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for place, (k, text) in enumerate(docs):
        f = runs(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((k, len(f), weight, weight + noise, len(word_list(text)), place))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[5]))
    rank = {r[5]: n for n, r in enumerate(fit[: percent * len(fit) // 100], 1)}
    return [(*r[:4], rank.get(r[5])) for r in rows]


@pytest.mark.parametrize(("run", "percent"), [(1, 10), (1, 100), (2, 37), (3, 1)])
def test_resampling_matches_a_plain_loop(spark, run, percent):
    random = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(60)] + ["Straße", "ÄB", "é1", "日本"]

    def prose(n, low=0):
        return " ".join(random.choice(vocabulary[low:], n))

    docs = [(k, prose(int(random.integers(0, 60)))) for k in range(200)] + [(300 + k, prose(30, 40)) for k in range(40)]
    docs += [(None, prose(40)), (None, None), (400, ""), (401, " -- \n"), (402, "x" * 100_000), (403, prose(30_000)), (5, docs[5][1]), (5, prose(25))]
    docs += [(500 + k // 20, "same words " * 15) for k in range(80)]
    target = [prose(50, 45) for _ in range(10)] + [None, ""]
    frame = spark.createDataFrame([(*r, "w", "s", "b", 1, "g") for r in docs], DOCS).repartition(5)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, gain int")
    found = resample.resample(frame, goal, buckets=500, run=run, percent=percent)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, resampled_in_plain(docs, target, run, 20, percent, 500)))


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert resample.resample(none, none.select("text")).collect() == []
    (only,) = resample.resample(spark.createDataFrame([(1, "a b", "", "", "", 1, "")], DOCS), none.select("text")).collect()
    assert (only.n_features, only["rank"]) == (2, None)
