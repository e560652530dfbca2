"""Token alignment against plain loops over both encodings."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from cases import documents, empty
from veleta.llm import alignment as al

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
MORE = [
    (-3, "a ▁ b"), (-4, "<|endoftext|> <s> </s> hi"), (-5, "é 日本語 🙂 \x00\x01\t\n  x"), (-6, "  lead  two   "),
    (-8, "x" * 5000), (-9, "日本語" * 300), (-10, "ﬁ Å ① half"),
]


def plain(rows):
    a, b = tokenizers.Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    _, side_a, _, side_b = al._tokenizers(*(open(p, "rb").read() for p in PATHS))
    token = lambda side, i: side.data[side.starts[i] : side.starts[i] + side.lengths[i]].tobytes()
    held, spread = [], Counter()
    for doc, text in rows:
        groups = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts = [[token(s, i) for i in own] for s, own in zip((side_a, side_b), ids)]
            if all(b"".join(p) == (" " + text).encode() for p in parts):
                ends = []
                for p in parts:
                    at, own = 0, []
                    for t in p:
                        at += len(t)
                        own.append(at)
                    ends.append(own)
                groups = [[[i for i, e in zip(ids[s], ends[s]) if low < e <= high] for s in (0, 1)] for low, high in _between(sorted(set(ends[0]) & set(ends[1])))]
        links = Counter()
        for x, y in groups:
            for (i, m), (j, n) in ((p, q) for p in Counter(x).items() for q in Counter(y).items()):
                links[i, j] += m * n
        spread.update(links.keys())
        held.append((doc, groups, links))
    best = defaultdict(int)
    for (i, _), n in spread.items():
        best[i] = max(best[i], n)
    out = []
    for doc, groups, links in held:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for k, n in links.items() if spread[k] == best[k[0]]), sum(n * spread[k] for k, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def _between(cuts):
    return zip([0, *cuts], cuts)


def small(spark):
    docs = documents(spark).filter("doc_id IS NULL OR doc_id NOT IN (8, 9, 10)").select("doc_id", "text", "row", "words")
    extra = spark.createDataFrame([(i, t, "clash", "clash") for i, t in MORE], docs.schema)
    return docs.union(extra).repartition(3)


@pytest.mark.parametrize("options", [{}, {"span": 300, "head": 20}, {"span": 64, "head": 0}])
def test_alignment(spark, options):
    docs = small(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = al.align(docs, *PATHS, **options)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_empty_table(spark):
    assert al.align(empty(spark), *PATHS).collect() == []


def test_composition_is_associative():
    rng = np.random.default_rng(2)
    ends = [np.cumsum(rng.integers(1, 9, 120)) for _ in range(2)]
    total = min(e[-1] for e in ends)
    ends = [np.append(e[e < total], total) for e in ends]
    parts, closed = [], []
    for k in range(-(-int(total) // 40)):
        (i, j), (p, q) = (np.searchsorted(e, [k * 40 + 1, (k + 1) * 40 + 1]) for e in ends)
        part, groups = al.fragment(0, k, np.arange(i, j), ends[0][i:j], np.arange(p, q), ends[1][p:q])
        parts.append(part)
        if groups:
            closed += list(zip(np.split(groups["a"], groups["to_a"][:-1]), np.split(groups["b"], groups["to_b"][:-1])))
    results = []
    for from_left in (True, False):
        own, found = list(parts), list(closed)
        while len(own) > 1:
            at = 0 if from_left else len(own) - 2
            whole, group = al.compose(own[at], own[at + 1])
            own[at : at + 2] = [whole]
            if group:
                found.append(group)
        assert own[0]["cut"] and not len(own[0]["suf_a"]) and not len(own[0]["suf_b"])
        found.append((own[0]["pre_a"], own[0]["pre_b"]))
        results.append(sorted((x.tolist(), y.tolist()) for x, y in found))
    cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    want = [tuple(np.flatnonzero((e > low) & (e <= high)).tolist() for e in ends) for low, high in _between(cuts)]
    assert results[0] == results[1] == sorted(want)
