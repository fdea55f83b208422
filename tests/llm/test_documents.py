"""Operators on documents against plain loops, with the odd rows every one of them has to bear."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bytebpe, exact, hmm, minhash, mixing, pii, quality
from tidemark.llm import components as components_module
from tidemark.llm.common import marked

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, source string, size int, root string, `class` string, row string, kept string, h string"


def documents(spark, texts, sources=None):
    """Frame of texts by id, with extra columns named like the operators' own ones."""
    rows = [(k, t, (sources or {}).get(k, "s"), 7, "r", "c", "w", "k", "h") for k, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def prose(seed, n):
    random = np.random.default_rng(seed)
    return " ".join("".join(random.choice(list("abcdefgh"), 5)) for _ in range(n))


def odd_texts():
    base = prose(1, 80)
    edited = base.split()
    edited[40] = "other"
    return [
        (1, base), (2, base.upper()), (3, " ".join(edited)), (4, prose(2, 80)), (5, None), (6, ""), (7, " \t\n"),
        (8, "one two"), (9, "One  two"), (10, base.replace(" ", "\n")), (10, base.replace(" ", "\n")), (11, prose(3, 30_000)),
        (12, "x" * 200_000), (13, "ß é 😀   a"), (None, base), (None, None), (14, prose(2, 80) + " tail"),
    ]


# ---- exact dedup -------------------------------------------------------------------------------------


@pytest.mark.parametrize("heads", [1, 1000])
def test_exact_groups_match_a_plain_loop(spark, heads):
    texts = odd_texts() + [(100 + k, "hot text" + " " * (k % 3)) for k in range(40)]
    groups = {}
    for k, t in texts:
        groups.setdefault("".join(c for c in t or "" if c not in SPACES), []).append((k, t or ""))
    expected = []
    for text, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += [(k, keep, len(members), k == keep, sha) for k, _ in members]
    found = exact.exact_groups(documents(spark, texts), heads=heads, tracked=max(heads, 8)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_exact_stage_keeps_columns_and_null_ids(spark):
    docs = documents(spark, [(1, "a b"), (2, "ab "), (3, "ab"), (None, "ab")])
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, None]


# ---- near dedup --------------------------------------------------------------------------------------


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts):
    sets = [(k, shingles(t)) for k, t in texts]
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                group[top(i)] = top(j)
    low = {}
    for i, (k, s) in enumerate(sets):
        if s and k is not None:
            low[top(i)] = min(low.get(top(i), k), k)
    return [(k, len(s), c := (low.get(top(i)) if s else k), k == c) for i, (k, s) in enumerate(sets)]


def near_texts():
    """Chains of edits around the threshold, and a passage that many texts share."""
    random = np.random.default_rng(5)
    texts, at = odd_texts(), 1000
    for chain in range(6):
        now = prose(100 + chain, 120).split()
        for _ in range(8):
            texts.append((at, " ".join(now)))
            at += 1
            for place in random.choice(len(now), chain // 2 + 1):
                now[place] = f"new{at}"
    passage = prose(50, 40)
    for k in range(60):
        texts.append((at + k, f"{prose(500 + k, 30)} {passage} {prose(600 + k, 10)}"))
    return texts


def test_near_groups_match_all_pairs(spark):
    texts = near_texts()
    found = [tuple(r) for r in minhash.near_groups(documents(spark, texts)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, components(texts)))


def test_window_of_an_order_survives_batches(spark):
    """Candidates do not depend on how Arrow cuts a sorted partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        test_near_groups_match_all_pairs(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("parts", [200, 2000])
def test_near_copies_of_small_tables_do_not_depend_on_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for n in (2, 10, 50):
            base = prose(n, 100).split()
            texts = [(k, " ".join([*base[:95], f"end{k}", *base[96:]])) for k in range(n)]
            found = [tuple(r) for r in minhash.near_groups(documents(spark, texts)).collect()]
            assert sorted(found) == sorted(components(texts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_range_borders_lose_no_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "RANGE", 1)
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    try:
        test_near_groups_match_all_pairs(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def crowd(n, planted):
    """Texts at mutual similarity 0.71 by a passage, of which ``planted`` pairs are at 0.8 by some more words of their own."""
    passage, texts = prose(70, 90), []
    for k in range(n):
        own = k // 2 if k < 2 * planted else k
        texts.append((k, f"{passage} {prose(10_000 + own, 6)} {prose(20_000 + k, 11)}"))
    return texts


@pytest.mark.parametrize(("n", "planted", "block"), [(3000, 400, 1024), (300, 40, 32)])
def test_pairs_in_a_crowd_are_all_found(spark, monkeypatch, n, planted, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = crowd(n, planted)
    sets = [shingles(t) for _, t in texts[:2] + texts[-1:]]
    close, far = (len(sets[0] & x) / len(sets[0] | x) for x in sets[1:])
    assert far < 0.72 and 0.76 < close < 0.83
    rows = {r.doc_id: r.component_id for r in minhash.near_groups(documents(spark, texts)).collect()}
    assert rows == {k: k - k % 2 if k < 2 * planted else k for k in range(n)}


def test_only_likely_texts_move_to_the_wanted_ids(spark, capsys):
    frame = documents(spark, [(k, f"t{k}") for k in range(1000)] + [(None, "none"), (7, "again")])
    wanted = spark.createDataFrame([(k,) for k in range(0, 1000, 50)] + [(None,)], "wanted long")
    seen = marked(frame, "doc_id", wanted).collect()
    assert len(seen) == 1002 and seen[0].asDict().keys() - set(frame.columns) == {"_marked"}
    assert all(r._marked for r in seen if r.doc_id is None or r.doc_id % 50 == 0) and sum(r._marked for r in seen) < 150
    assert not any(r._marked for r in marked(frame, "doc_id", wanted.limit(0)).collect())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the wanted ids are too many for Spark
    try:
        minhash._sets_of(frame, spark.createDataFrame([(1, b"x")], "doc_id long, class binary")).explain()
        assert "getbit" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_one_row_of_each_class_goes_on(spark):
    texts = [(k, prose(k, 60)) for k in range(300)]
    edited = texts[7][1].split()
    edited[30] = "other"
    texts += [(300, " ".join(edited)), (301, texts[9][1])]
    rows = minhash.stored(minhash.signed(documents(spark, texts)), "signatures")
    lowest = minhash.stored(rows.groupBy("class").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")), "lowest")
    classes = minhash._classes(rows, lowest)
    assert classes.select("class").distinct().count() == classes.count() == 301
    classes = minhash.stored(classes, "classes")
    close = minhash._crowded(classes)
    assert {r.doc_id for r in close.collect()} >= {7, 300} and close.count() < 10


def test_components_end_with_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components_module, "stored", lambda df, purpose: written.append(purpose) or minhash.stored(df, purpose))
    stars = [(k, k % 3) for k in range(3, 40)]
    found = components_module.components(spark.createDataFrame(stars, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(k, k % 3) for k in range(40)] and written == ["edges"]
    chain = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(7, 7), (None, 3), (60, 61), (61, 60)], "a long, b long")
    assert sorted(map(tuple, components_module.components(chain).collect())) == [(k, 0) for k in range(51)] + [(60, 60), (61, 60)]


def test_only_the_graph_of_components_is_solved_again(spark, monkeypatch):
    sizes = []
    solve = components_module.components
    monkeypatch.setattr(minhash, "components", lambda edges: sizes.append(edges.distinct().count()) or solve(edges))
    labelled = spark.createDataFrame([(bytes([k]), bytes([k // 10 * 10])) for k in range(40)], "class binary, root binary")
    links = spark.createDataFrame([(bytes([3]), bytes([17])), (bytes([5]), bytes([18])), (bytes([12]), bytes([39]))], "a binary, b binary")
    roots = {r.node[0]: r.root[0] for r in minhash._joined(labelled, links).collect()}
    assert roots == {k: 20 if k // 10 == 2 else 0 for k in range(40)} and sizes == [2]
    assert minhash._joined(labelled, links.limit(0)).count() == 40 and sizes == [2]


def test_shared_counts_match_sets():
    random = np.random.default_rng(6)
    make = lambda n: [np.unique(random.integers(0, 60, int(random.integers(1, 40))).astype(np.uint64)) for _ in range(n)]
    for n, m in ((1, 1), (3, 5), (40, 30)):
        left, right = make(n), make(m)
        assert minhash.shared_counts(left, right).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]


def test_class_keys_tell_sets_apart():
    a, b = np.arange(1, 9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)
    assert minhash.class_key(a) == minhash.class_key(a[::-1].copy()) != minhash.class_key(b)


# ---- mixing ------------------------------------------------------------------------------------------


def filled(sizes, weights, most=3):
    """Targets by taking the excess of sources over their cap and sharing it again."""
    left, target, free = float(sum(sizes)), {}, set(range(len(sizes)))
    while free:
        share = {k: left * weights[k] / sum(weights[j] for j in free) for k in free}
        over = [k for k in free if share[k] > most * sizes[k]]
        if not over:
            return target | share
        for k in over:
            target[k] = most * sizes[k]
            left -= target[k]
            free.remove(k)
    return target


def test_mix_meets_its_targets(spark):
    random = np.random.default_rng(3)
    names = ["a", "b", "B", "é", "z", None]
    count = [900, 30, 300, 5, 400, 60]
    texts, sources = [], {}
    for name, n in zip(names, count):
        for _ in range(n):
            sources[len(texts)] = name
            texts.append((len(texts), prose(len(texts), int(random.integers(0, 12)))))
    docs = documents(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(7)).collect())
    order = sorted((n for n in names if n is not None)) + [None]
    size = Counter()
    for r in rows:
        assert r["size"] == len(words(texts[r.doc_id][1]))
        size[sources[r.doc_id]] += r["size"]
    target = filled([size[n] for n in order], [1, 2, 3, 1, 2, 3])
    taken = Counter()
    for r in rows:
        assert r.taken in {k * r["size"] for k in range(4)} and r.source_size == size[sources[r.doc_id]]
        assert r.target == pytest.approx(target[order.index(sources[r.doc_id])])
        taken[sources[r.doc_id]] += r.taken
    for k, name in enumerate(order):
        assert abs(taken[name] - target[k]) <= 12
    again = Counter(r.doc_id for r in mixing.mixed(docs).select("doc_id").collect())
    assert again == Counter({r.doc_id: r.taken // r["size"] for r in rows if r.taken})
    assert mixing.mixed(docs).columns == docs.columns


# ---- byte-level BPE ----------------------------------------------------------------------------------


@pytest.mark.parametrize("leaf", [1, 3, 17, 4096])
def test_tree_encoding_equals_the_plain_one(leaf, monkeypatch):
    monkeypatch.setattr(bytebpe, "LEAF_POINTS", leaf)
    monkeypatch.setattr(bytebpe, "LEAF_IDS", leaf)
    codec = bytebpe.Tokenizer().codec()
    random = np.random.default_rng(leaf)
    signs = list("ab'stre ll \n\t 12.,!é字  ‍😀²ǅ\x1c\x0b")
    texts = ["", "a", "'re", "x" * 3000, " " * 500, "don't we're 123abc  \n\n  end", *(t or "" for _, t in odd_texts()[:10])]
    texts += ["".join(random.choice(signs, int(random.integers(1, 80)))) for _ in range(400)]
    for text in texts:
        ids = codec.encode(text)
        assert ids.tolist() == codec.plain(text).tolist(), repr(text)
        assert codec.decode(ids) == text.encode()


def test_encoded_documents(spark):
    docs = documents(spark, odd_texts())
    codec = bytebpe.Tokenizer().codec()
    expected = []
    for k, t in odd_texts():
        ids = codec.encoding.encode_ordinary(t or "")
        raw = np.asarray(ids, "<u4").tobytes()
        expected.append((k, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, bytebpe.encode_digests(docs).collect()))) == sorted(map(repr, expected))
    decoded = bytebpe.encode_documents(docs).select(bytebpe.Tokenizer().decoded("ids").alias("t")).collect()
    assert sorted(bytes(r.t) for r in decoded) == sorted((t or "").encode() for _, t in odd_texts())


# ---- language model ----------------------------------------------------------------------------------


def test_base_scores_and_counts_match_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 30)
    texts = odd_texts()[:-4] + [(200 + k, prose(k % 7, 40)) for k in range(60)]
    fold = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in texts}
    sequences = [(k, [*words((t or "").translate(LOWER)), None]) for k, t in texts]
    counts = Counter(w for k, s in sequences if not fold[k] for w in s)
    n, v = sum(counts.values()), len(counts)
    found = hmm.score(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    by_id = {r.doc_id: r for r in found}
    for k, s in sequences:
        r = by_id[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[k], len(s), sum(w in counts for w in s), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s), abs=1e-6)
        assert r.score < 0


def test_forward_recursion_equals_all_paths():
    random = np.random.default_rng(1)
    states = 3
    make = lambda *shape: (x := random.random(shape)) / x.sum(axis=-1, keepdims=True)
    chain = hmm.Chain(make(states), make(states, states), make(states, hmm.CLASSES).T)
    seen = np.array([5, 9, 5, 2, 7, 7, 1], np.int32)
    bounds = np.array([0, 4, 4 + 1, 7])
    for k, (a, b) in enumerate(pairwise(bounds)):
        total = 0.0
        for path in np.ndindex(*[states] * (b - a)):
            p = chain.start[path[0]] * chain.emit[seen[a], path[0]]
            for t in range(1, b - a):
                p *= chain.move[path[t - 1], path[t]] * chain.emit[seen[a + t], path[t]]
            total += p
        assert chain.log10(seen, bounds)[k] == pytest.approx(np.log10(total))


def test_training_raises_the_likelihood_of_held_out_texts(spark):
    """Two languages with the same words as neighbours only within each: the chain tells them apart."""
    random = np.random.default_rng(2)
    texts = []
    for k in range(200):
        own = [f"{'ab'[k % 2]}{j}" for j in range(40)]
        texts.append((k, " ".join(random.choice(own, 60))))
    rows = hmm.score(documents(spark, texts)).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 10 * len(rows)


# ---- quality -----------------------------------------------------------------------------------------


def test_weak_labels_find_the_bad_texts(spark):
    good = [(k, ". ".join(prose(1000 * k + j, 9 + k % 5) for j in range(7)) + ".") for k in range(300)]
    bad = [(1000 + k, " ".join(w + "$$$"[: 1 + k % 3] + "#" for w in prose(k, 50).split())) for k in range(40)]
    bad += [(2000 + k, prose(k, 50).upper().replace(" ", "!! ")) for k in range(40)]
    bad += [(3000 + k, " ".join([w for w in prose(k, 5).split() for _ in range(15)])) for k in range(40)]
    rows = quality.classify(documents(spark, good + bad + [(9000, None), (9001, "")])).collect()
    kept = {r.doc_id for r in rows if r.kept}
    assert len(rows) == 422 and not kept & {9000, 9001}
    assert len(kept & {k for k, _ in good}) >= 297 and len(kept & {k for k, _ in bad}) <= 12


def test_expectation_maximisation_recovers_accuracies():
    random = np.random.default_rng(4)
    truth, n = random.random(20_000) < 0.8, quality.N_LABELLERS
    accuracy = np.linspace(0.93, 0.99, n)
    bad = np.arange(n) < quality.N_BAD
    vote = np.zeros((len(truth), n), int)
    for j in range(n):
        says_bad = np.where(random.random(len(truth)) < accuracy[j], ~truth, truth)
        vote[:, j] = (says_bad if bad[j] else ~says_bad) & (random.random(len(truth)) < 0.8)
    patterns, counts = np.unique(quality.pattern(vote), return_counts=True)
    posterior, _ = quality.estimate(dict(zip(patterns.tolist(), counts.tolist())))
    guess = np.array([posterior[p] for p in quality.pattern(vote).tolist()]) > 0.5
    assert (guess == truth).mean() > 0.9


# ---- personal data -----------------------------------------------------------------------------------

FORMS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base_spans(text):
    out = []
    for k, (name, form) in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if name == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if name == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(out)]


def pii_texts():
    random = np.random.default_rng(8)
    signs = list("ab.@-+_% 1234()é😀\n")
    texts = [
        "a@b.c_d@e.f x@y .@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
        "00000000000000 000000000000000000000", "+1 (017) 555-7713 +1234567890123456 +12 3", "😀 a@b.co é 1.1.1.1", "a" * 5_000,
        "1" * 50_000, "+1" + " " * 20_000, "a@" * 5000, None, "",
    ]
    texts += ["".join(random.choice(signs, 60)) for _ in range(300)]
    return list(enumerate(texts))


def test_fixed_forms_match_plain_expressions(spark):
    texts = pii_texts()
    rows = {r.doc_id: r for r in pii.find(documents(spark, texts)).collect()}
    for k, text in texts:
        expected = base_spans(text or "")
        assert rows[k].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), repr(text)[:100]
        assert [rows[k][f"n_{name}"] for name, _ in FORMS] == [sum(s.startswith(name + ":") for s in expected) for name, _ in FORMS]
        assert [s for s in rows[k].spans.split(",") if s and not s.startswith("id:")] == expected


def test_contexts_of_seeds_discover_other_identifiers(spark):
    texts = [(k, f"{prose(k, 8)} reach me user{k}@mail.example.org soon") for k in range(8)]
    texts += [(50, "please reach me ticket-77812 soon"), (51, "no pattern here 99-1234567"), (52, "and ask desk ticket-77812 today")]
    rows = {r.doc_id: r.spans for r in pii.find(documents(spark, texts)).collect()}
    assert rows[50] == "id:16:28" and rows[51] == "" and rows[3].startswith("email:")


def test_all_fixed_hits_are_seeds(spark):
    names = ["jane", "john", "mary", "omar"]
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004"]
    texts = [(k, f"{prose(k, 8)} mail me {n}.doe@example.com soon") for k, n in enumerate(names)]
    texts += [(10 + k, f"{prose(k, 8)} call us +44 20 7946 09{k}8 soon") for k in range(4)]
    texts += [(20 + k, f"{prose(k, 8)} card number {c} soon") for k, c in enumerate(cards)]
    texts += [(50, "mail me ticket-77812"), (51, "call us ext-77812"), (52, "card number no-77812"), (53, "not mine no-77812")]
    rows = {r.doc_id: r for r in pii.find(documents(spark, texts)).collect()}
    assert all(rows[k].n_email == rows[10 + k].n_phone == rows[20 + k].n_card == 1 for k in range(4))
    assert [rows[k].spans for k in range(50, 54)] == ["id:8:20", "id:8:17", "id:12:20", ""]


def test_tokens_without_two_words_before_form_no_pattern(spark):
    texts = [(k, f"user{k}@mail.example.org {prose(k, 8)}") for k in range(8)]
    texts += [(20 + k, f"desk 99-1230 user2{k}@mail.example.org {prose(k, 8)}") for k in range(8)]
    texts += [(50, "covid-19 is over"), (51, "one two 2024-01-02 2024-01-03 three")]
    rows = {r.doc_id: r.spans for r in pii.find(documents(spark, texts)).collect()}
    assert rows[50] == rows[51] == "" and all("id:" not in s for s in rows.values())


# ---- empty tables ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "operator",
    [exact.exact_groups, exact.without_copies, minhash.near_groups, minhash.without_near_copies, mixing.mix, mixing.mixed,
     bytebpe.encode_digests, hmm.score, quality.classify, quality.good_documents, pii.find],
)
def test_empty_tables_give_empty_results(spark, operator):
    assert operator(documents(spark, [])).collect() == []
