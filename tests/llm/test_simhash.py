"""SimHash against plain formulas, and links against comparing all fingerprints."""

import random
import re

import numpy as np
import xxhash

from cases import documents, empty
from veleta.llm import simhash as sh
from veleta.llm.graph import components, forest


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fingerprints):
    root = {k: k for k in fingerprints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = list(fingerprints)
    values = np.array([fingerprints[k] for k in keys], np.uint64)
    for k, v in zip(keys, values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 2):
            a, b = find(k), find(keys[j])
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_fingerprints_and_components(spark):
    docs = documents(spark)
    got = sorted(map(tuple, sh.near_copies(docs).collect()), key=str)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = {k: plain_fingerprint(t) for k, (_, t) in enumerate(texts)}
    roots = plain_components(prints)
    least = {}
    for k, (doc, _) in enumerate(texts):
        if doc is not None:
            least[roots[k]] = min(doc, least.get(roots[k], doc))
    assert got == sorted([(doc, f"{prints[k]:016x}", least.get(roots[k])) for k, (doc, _) in enumerate(texts)], key=str)
    assert sh.near_copies(empty(spark)).collect() == []


def test_dense_clusters_lose_no_link(spark):
    """Buckets of all levels overflow: fingerprints around a few centres, and such that differ in two segments only."""
    rng = random.Random(5)
    values = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(1500):
            v = centre
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
        values |= {centre ^ (rng.getrandbits(16) << 24) for _ in range(1500)}
        values |= {centre ^ (rng.getrandbits(8) << 56) ^ rng.getrandbits(8) for _ in range(1500)}
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    roots = {r.node: r.root for r in components(sh.links(nodes)).collect()}
    assert {v: roots.get(v, v) for v in signed} == plain_components(signed)


def test_chain_filter_keeps_every_close_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = a.copy()
    for _ in range(2):
        b ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    kept = np.zeros(4000, bool)
    for start in range(sh.SEGMENTS):
        kept |= sh._chains(a, b, np.full(4000, start))
    assert kept.all()


def test_forest():
    a, b = forest(np.array([5, 7, 1, 9, 4]), np.array([3, 5, 7, 8, 4]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(3, 1), (5, 1), (7, 1), (9, 8)]


def test_components_of_long_paths_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 100), (None, 5), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {k: 0 for k in range(61)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
