import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cases import PROSE, documents, empty
from veleta.llm import near_dedup as nd
from veleta.llm.words import NOT_SPACE, shingle_hashes, slices, word_hashes


def bag(text, size=5):
    w = text.split()
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def similarity(a, b):
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared)


def test_words_and_runs_tell_what_python_tells():
    texts = ["a b  c", "", "b\na", "ab c", "a b c d e f", "a b c d e", " é é ", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    seen, runs = {}, {}
    for small in (1, 7, 1 << 20):
        n = 0
        for part, data, offsets in slices(iter([batch]), at_most=small):
            words, bounds = word_hashes(data, offsets, NOT_SPACE)
            hashes, owner = shingle_hashes(words, bounds)
            for k, text in enumerate(part.column(0).to_pylist()):
                own = (text or "").split()
                assert bounds[k + 1] - bounds[k] == len(own)
                for h, w in zip(words[bounds[k] : bounds[k + 1]].tolist(), own):
                    assert seen.setdefault(w, h) == h
                for h, r in zip(hashes[owner == k].tolist(), bag(text or "")):
                    assert runs.setdefault(r, h) == h
                n += 1
        assert n == len(texts)
    assert len(set(seen.values())) == len(seen) and len(set(runs.values())) == len(runs)


def test_signatures_agree_as_often_as_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(5)
    slots, keys = 4096, rng.integers(1, 2**63, 60).astype(np.uint64)
    wa, wb = rng.integers(0, 40, 60), rng.integers(0, 40, 60)
    text = np.repeat([0, 1], [(wa > 0).sum(), (wb > 0).sum()])
    sig = nd.bag_minhash(np.concatenate([keys[wa > 0], keys[wb > 0]]), text, np.concatenate([wa[wa > 0], wb[wb > 0]]), 2, slots)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert np.isfinite(sig).all() and abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / slots) ** 0.5


def test_classes_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = {}
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, 150))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs[len(docs)] = " ".join(own)
    bags = {k: bag(t) for k, t in docs.items()}
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and similarity(bags[a], bags[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()}
    assert got == {k: find(k) for k in docs}


def test_edges(spark):
    got = nd.near_duplicates(documents(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.class_id)
    assert len(got) == 14 and by[1] == [1] and by[2] == [1, 1] and by[3] == [3] and by[4] == [4] and by[5] == [5]
    assert by[6] == [6] and by[None] == [None, None]
    assert nd.near_duplicates(empty(spark)).count() == 0


def test_one_large_group_of_copies_and_one_of_near_copies(spark):
    words = [f"v{i}" for i in range(200)]
    near = [(i, " ".join(words[:k] + [f"z{i}"] + words[k + 1 :])) for i, k in enumerate(range(20, 120), 1000)]
    rows = [(i, PROSE * 2) for i in range(300)] + near
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0, 1000}
    assert {r.n_copies for r in got if r.class_id == 0} == {300}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 70), (9, 9)]
    got = {r.node: r.root for r in nd.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 70: 50, 100: 50}


@pytest.mark.parametrize("most", [6, 9])
def test_recall_in_a_large_group_of_loose_copies(spark, most):
    """250 copies with up to `most` of 300 words replaced: buckets are far larger than what is compared in full."""
    rng = random.Random(most)
    base, docs = [f"w{i}" for i in range(300)], {}
    for k in range(250):
        own = list(base)
        for at in rng.sample(range(300), rng.randint(0, most)):
            own[at] = f"x{k}_{at}"
        docs[k] = " ".join(own)
    bags = {k: bag(t) for k, t in docs.items()}
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)).collect()}
    near = [(a, b) for a in docs for b in docs if a < b and similarity(bags[a], bags[b]) >= 0.8]
    assert len(near) > 9_000 and sum(got[a] == got[b] for a, b in near) == len(near)


@pytest.mark.parametrize("rows, words", [(1024, 1 << 21), (60, 1 << 21), (1024, 1 << 14)])
def test_every_link_of_a_large_group_counts_once(spark, monkeypatch, rows, words):
    """Buckets of over a hundred rows, whole or in cells of several parts; repeated rows and runs too."""
    monkeypatch.setattr(nd, "CELL_ROWS", rows)
    monkeypatch.setattr(nd, "CELL_WORDS", words)
    rng = random.Random(4)
    base, docs = [f"w{i}" for i in range(240)] + ["again"] * 30, {}
    for k in range(160):
        own = list(base)
        for at in rng.sample(range(240), rng.randint(0, 8)):
            own[at] = f"x{k}_{at}" if k % 4 else f"x{at}"
        docs[k] = " ".join(own) + " again" * (k % 3)
    texts = Counter(docs.values())
    bags = {t: bag(t) for t in texts}
    links = Counter(a for a in texts for b in texts if a != b and similarity(bags[a], bags[b]) >= 0.8)
    df = spark.createDataFrame([*docs.items(), *docs.items()], "doc_id long, text string").repartition(7)
    got = {r.doc_id: r for r in nd.near_duplicates(df).collect()}
    assert max(links.values()) > 100 and {k: r.n_links for k, r in got.items()} == {k: links[t] for k, t in docs.items()}
    assert {k: r.n_copies for k, r in got.items()} == {k: 2 * texts[t] for k, t in docs.items()}


def test_members_that_rows_share_equal_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 60))) for _ in range(90)]
    sets += [np.arange(5)] * 40  # held by more than RARE rows
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    members = np.concatenate(sets)
    for left, right in ((slice(0, 130), slice(0, 130)), (slice(0, 50), slice(50, 130))):
        got = nd._shared(members, owner, left, right)
        for a in range(left.start, left.stop):
            for b in range(right.start, right.stop):
                assert a == b or got[a - left.start, b - right.start] == len(np.intersect1d(sets[a], sets[b]))
