"""Operators that SQL cannot express, against plain versions of their rules over a small corpus."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cases import labels
from veleta.llm import html_text, quality, span_dedup, toxicity
from veleta.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n=None):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x", "to", "of", "Yes", "é"]) for _ in range(n or rng.randint(1, 9))) + rng.choice([". ", "! ", "?\n", "\n"])


@pytest.fixture(scope="module")
def corpus():
    """Documents that share sentences, passages and whole texts, with ids that repeat and are missing."""
    rng = random.Random(8)
    pool = [sentence(rng) for _ in range(60)]
    passages = ["".join(rng.sample(pool, 4)) for _ in range(6)]
    docs = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.3 else sentence(rng) for _ in range(rng.randint(0, 8))]
        docs.append((i if i % 13 else None, "".join(parts)))
    docs += [docs[3], (3, docs[5][1]), (90, docs[7][1]), (91, None), (92, "")]
    return docs


def plain_spans(docs, least=span_dedup.SENTENCES, words=span_dedup.WORDS):
    """All windows of every text; the first place of each is the least (id, order of the text), NULL first."""
    texts = sorted({(d, t) for d, t in docs if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    cut = {r: span_dedup.sentences(r[1]) for r in texts}
    places = {}
    for r in texts:
        parts = [" ".join(r[1][a:b].split()) for a, b in cut[r]]
        sizes = [len(WORD.findall(p)) for p in parts]
        windows = set()
        for a in range(len(parts)):
            ends = [b for b in range(a, len(parts)) if b - a + 1 >= least and sum(sizes[a : b + 1]) >= words]
            windows |= {(a, ends[0])} if ends else set()
        for b in range(len(parts)):
            starts = [a for a in range(b + 1) if b - a + 1 >= least and sum(sizes[a : b + 1]) >= words]
            windows |= {(starts[-1], b)} if starts else set()
        for a, b in windows:
            places.setdefault(" ".join(parts[a : b + 1]), []).append((r, a, b))
    return cut, places


def test_repeated_sentences(spark, corpus):
    """Every occurrence but one of a repeated run goes, whole, and nothing else does."""
    ids = Counter(d for d, _ in set(corpus))
    single = [(d, t) for d, t in corpus if ids[d] == 1]  # among texts of one id the first is a matter of a hash
    cut, places = plain_spans(single)
    gone = {}
    for found in places.values():
        first = min(found, key=lambda f: (f[0][0] is not None, f[0][0] or 0, f[1], f[2]))
        for r, a, b in found:
            if (r, a, b) != first:
                gone.setdefault(r, set()).update(range(a, b + 1))
    df = spark.createDataFrame(single, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.text, r.n_removed) for r in span_dedup.dedup_spans(df).collect())
    want = Counter()
    for d, t in single:
        own = gone.get((d, t), set())
        left = t and "".join(t[a:b] for k, (a, b) in enumerate(cut[(d, t)]) if k not in own)
        want[(d, left, len(own))] += 1
    assert got == want and sum(n for (_, _, n) in got) > 50


def test_no_run_occurs_twice_in_what_is_left_first(spark, corpus):
    """With ids that repeat: each repeated run keeps exactly one of its places untouched."""
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    found = span_dedup.spans(df).distinct().collect()
    left = {tuple(r) for r in span_dedup.repeated_spans(span_dedup.spans(df)).distinct().collect()}
    by = {}
    for r in found:
        by.setdefault((r.h1, r.h2), set()).add((r.doc_id, r.doc_key, r.start, r.last))
    for own in by.values():
        assert len(own - left) == 1 or len(own) == 1


def plain_ftrl(rows, epochs):
    """Per-coordinate FTRL-proximal with dictionaries, one coordinate at a time."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    bias = 1 << toxicity.BITS
    for _ in range(epochs):
        for ids, label in rows:
            at = [*ids, bias]
            w = {i: weight(i) for i in at}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
            for i in at:
                g = p - label
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_the_plain_recursion():
    rng = random.Random(3)
    bad, good = ["idiot", "fool"], ["river", "hill", "cloud", "tree", "bird", "stone"]
    texts = [(" ".join(rng.choice(good) for _ in range(12)) + (" you " + rng.choice(bad) if k % 3 == 0 else ""), int(k % 3 == 0)) for k in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in texts])], names=["text"])
    rows = []
    for part, data, offsets in slices([batch]):
        ids, text = toxicity.feature_ids(data, offsets)
        rows += [(ids[text == k], texts[len(rows) + k][1]) for k in range(len(part))]
    z, n = toxicity.ftrl([(np.asarray(i, np.int32), y) for i, y in rows], epochs=3)
    w = toxicity.weights_of(z, n)
    want = plain_ftrl([(i.tolist(), y) for i, y in rows], epochs=3)
    assert want and {i: w[i] for i in np.flatnonzero(w)} == pytest.approx(want, abs=1e-9)
    # Features are the distinct words, neighbours and pairs with one word between.
    ids, _ = toxicity.feature_ids(np.frombuffer(b"a b c a b", np.uint8), np.array([0, 9]))
    assert len(ids) == len({"a", "b", "c"}) + len({"ab", "bc", "ca"}) + len({"a_c", "b_a", "c_b"})


def test_ratio_and_verdict(spark):
    """Score and verdict of every text, from counts by the same hashes but with plain loops."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["red", "green", "blue", "one", "two", "ok"] if i % 2 else ["zig", "zag", "zog", "zug", "red"]) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    df = spark.createDataFrame(docs + [(None, None)], "doc_id long, text string")
    marks = labels(spark, [(i, i % 2, 0) for i in range(0, 60, 3)])
    words = sorted({w for _, t in docs for w in t.split()})
    bucket = {}
    for w, b in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", f"pmod(xxhash64(w), {quality.BUCKETS})").collect():
        bucket[(w,)] = b
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for a, b, k in pairs.selectExpr("a", "b", f"pmod(xxhash64(2, xxhash64(a), xxhash64(b)), {quality.BUCKETS})").collect():
        bucket[(a, b)] = k

    def grams(text):
        own = text.split()
        return [bucket[(w,)] for w in own] + [bucket[p] for p in zip(own, own[1:])]

    raw, good = Counter(), Counter()
    for i, t in docs:
        raw.update(grams(t))
        if i % 3 == 0 and i % 2 == 1:
            good.update(grams(t))
    r, g = sum(raw.values()), sum(good.values())
    share = lambda k: (raw[k] + 1) / (r + quality.BUCKETS)
    ratio = lambda k: math.log((good[k] + quality.BUCKETS * share(k)) / ((g + quality.BUCKETS) * share(k)))
    ratios = quality.fit_ratio(df, quality.trusted_texts(df, marks))
    got = {x.doc_id: x for x in quality.measure(df, ratios).select("row.doc_id", "n_words", "score", "base_failed", "kept").collect()}
    for i, t in docs:
        own = grams(t)
        score = sum(map(ratio, own)) / len(own) if own else None
        assert got[i].score == (None if score is None else pytest.approx(score, abs=1e-6))
        if score is None or abs(score - quality.THRESHOLD) > 1e-5:
            assert got[i].kept == (not got[i].base_failed and score is not None and score >= quality.THRESHOLD)
    assert got[None].kept is False and any(x.kept for x in got.values())


def test_visible_text_of_generated_pages():
    """Pages made of blocks whose text is known: every visible word in its order, no hidden one, blocks on lines of their own."""
    rng = random.Random(6)
    for _ in range(60):
        page, seen, lines = [], [], []
        for k in range(rng.randint(1, 12)):
            word, kind = f"w{k}", rng.choice(["p", "div", "h2", "hidden", "script", "li", "span"])
            if kind in ("hidden", "script"):
                page.append({"hidden": f"<div hidden>{word}</div>", "script": f"<script>{word}</script>"}[kind])
                continue
            seen.append(word)
            page.append(f"<ul><li>{word}</ul>" if kind == "li" else f"<{kind}>{word}</{kind}>")
            if kind == "span" and lines and lines[-1][1]:
                lines[-1] = (lines[-1][0] + word, True)
            else:
                lines.append((("- " if kind == "li" else "") + word, kind == "span"))
        got = html_text.render("".join(page))
        assert re.findall(r"w\d+", got) == seen
        assert [x for x in got.split("\n") if x] == [x for x, _ in lines]
