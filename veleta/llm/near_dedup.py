"""Near duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its runs of five words. Every distinct run with weight w owns Poisson
processes over [0,1), [1,2), [2,4), [4,8) ..., the rate of each being its length; a point names a
signature slot, a time and a place in the interval, and counts when its place lies below w. The
process of an interval that w covers whole needs no finer split; only the topmost one is thinned.
The earliest point of a slot is its signature value, so two texts agree in a slot with a
probability equal to their weighted Jaccard similarity. Points are drawn in order of time and only
as long as they come before the latest slot of the text, so a text of n runs and m slots costs
about n + m log m points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.graph import components, forest
from veleta.llm.tables import in_arrow, only
from veleta.llm.words import GOLDEN, chain, counted, mix, shingle_hashes, slices, word_hashes
from veleta.session import stabilise

BANDS, ROWS, SHINGLE, SIMILAR = 32, 5, 5, 0.8
# All pairs of a bucket are compared. A bucket of more rows or words is dealt into parts of about
# this size, and each pair of parts is a cell of its own.
CELL_ROWS, CELL_WORDS = 1024, 1 << 21
# Runs that more rows of a cell hold are counted by products of matrices, so many columns at a time.
RARE, COLUMNS = 32, 4096


def bag_minhash(hashes: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, slots: int) -> np.ndarray:
    """Signature of every text as times of points; rows of texts without runs are infinite."""
    out = np.full(n_texts * slots, np.inf)
    rows, seeds, rates, lows = [], [], [], []
    level, low, high = 0, 0, 1
    owner = np.arange(len(hashes))
    while len(owner):
        rows.append(owner)
        seeds.append(mix(hashes[owner] + np.uint64(level * int(GOLDEN) % 2**64)))
        rates.append(np.full(len(owner), float(high - low)))
        lows.append(np.full(len(owner), float(low)))
        level, low, high = level + 1, high, high * 2
        owner = owner[weights[owner] > low]
    if not rows:
        return out.reshape(n_texts, slots)
    row, seed, rate, low = map(np.concatenate, (rows, seeds, rates, lows))
    doc, weight, time = text[row], weights[row], np.zeros(len(row))
    step = 0
    while len(seed):
        step += 1
        a = mix(seed + np.uint64(2 * step * int(GOLDEN) % 2**64))
        b = mix(seed + np.uint64((2 * step + 1) * int(GOLDEN) % 2**64))
        time = time - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        slot = ((b & np.uint64(0xFFFFFFFF)) % np.uint64(slots)).astype(np.int64)
        place = low + np.floor((b >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rate)
        hit = place < weight
        np.minimum.at(out, doc[hit] * slots + slot[hit], time[hit])
        if step > 4 and step % 4:  # short texts take many rounds; the latest slot need not be known in each
            continue
        alive = time < out.reshape(n_texts, slots).max(axis=1)[doc]
        seed, rate, low, doc, weight, time = (x[alive] for x in (seed, rate, low, doc, weight, time))
    return out.reshape(n_texts, slots)


def _digests(words: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of every text's sequence of words."""
    counts = np.diff(bounds)
    place = mix((np.arange(len(words)) - np.repeat(bounds[:-1], counts)).astype(np.uint64) * GOLDEN)
    out = []
    for k in range(2):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words ^ mix(place + np.uint64(k))), out=sums[1:])
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + counts.astype(np.uint64)).view(np.int64))
    return out


def _digested(batches):
    for batch, data, offsets in slices(batches):
        digest = _digests(*word_hashes(data, offsets))
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, digest)], names=["doc_id", "text", "d1", "d2"])


def _signatures(batches):
    for batch, data, offsets in slices(batches):
        words, bounds = word_hashes(data, offsets)
        runs, text = shingle_hashes(words, bounds, SHINGLE)
        own, own_text, weights = counted(runs, text)
        n = len(batch)
        times = bag_minhash(own, own_text, weights, n, BANDS * ROWS).view(np.uint64)
        keys = np.stack([chain([times[:, b * ROWS + r] for r in range(ROWS)]) for b in range(BANDS)], axis=1)
        n_words, digest = np.diff(bounds), _digests(words, bounds)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                *map(pa.array, digest),
                pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_words", "d1", "d2", "keys"],
        )


def _bags(batches):
    """node, keys and the runs of every text as a set: a run that repeats is a new member each time."""
    for batch, data, offsets in slices(batches):
        runs, text, weights = counted(*shingle_hashes(*word_hashes(data, offsets), SHINGLE))
        begin = np.cumsum(weights) - weights
        nth = (np.arange(weights.sum()) - np.repeat(begin, weights)).astype(np.uint64)
        members = mix(np.repeat(runs, weights) + nth * GOLDEN)
        sizes = np.bincount(np.repeat(text, weights), minlength=len(batch))
        bag = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(members.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bag], names=["node", "keys", "bag"])


def _shared(members: np.ndarray, owner: np.ndarray, left: slice, right: slice) -> np.ndarray:
    """Members that each row in `left` has in common with each row in `right`."""
    n, width = left.stop - left.start, right.stop - right.start
    out = np.zeros((n, width), np.float32)
    order = np.argsort(members, kind="stable")
    members, owner = members[order], owner[order]
    begin = np.flatnonzero(np.append(True, members[1:] != members[:-1]))
    held = np.diff(np.append(begin, len(members)))
    for d in np.unique(held[(held > 1) & (held <= RARE)]):
        rows = owner[begin[held == d][:, None] + np.arange(d)]
        for k in range(1, d):  # every row with the one k places on, around
            x, y = rows.ravel(), np.roll(rows, k, axis=1).ravel()
            here = (x >= left.start) & (x < left.stop) & (y >= right.start) & (y < right.stop)
            np.add.at(out, (x[here] - left.start, y[here] - right.start), 1)
    often = np.flatnonzero(held > RARE)
    for first in range(0, len(often), COLUMNS):
        own = often[first : first + COLUMNS]
        size = held[own]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[own], size)
        has = np.zeros((right.stop, len(own)), np.float32)
        has[owner[at], np.repeat(np.arange(len(own)), size)] = 1
        out += has[left] @ has[right].T
    return out


def _linker(threshold: float):
    def linked(band, side, node, keys, members, ends):
        """Rows (node, root, n) of a cell: nodes with links, the least node of their component, and their number."""
        sizes = np.diff(ends)
        half = int(np.searchsorted(side, 1))
        whole = half in (0, len(side))
        left, right = (slice(0, len(side)),) * 2 if whole else (slice(0, half), slice(half, len(side)))
        shared = _shared(members, np.repeat(np.arange(len(side)), sizes), left, right).astype(np.float64)
        near = shared / np.maximum(1, sizes[left][:, None] + sizes[right][None, :] - shared) >= threshold
        a, b = np.nonzero(np.triu(near, 1) if whole else near)
        a, b = a + left.start, b + right.start
        # A pair counts in the first band that it shares.
        own = np.concatenate([np.zeros(0, bool)] + [(keys[a[k : k + 65536]] == keys[b[k : k + 65536]]).argmax(axis=1) == band for k in range(0, len(a), 65536)])
        a, b = a[own], b[own]
        n = np.bincount(a, minlength=len(side)) + np.bincount(b, minlength=len(side))
        root = node.copy()
        child, least = forest(node[a], node[b])
        place = np.argsort(node)
        root[place[np.searchsorted(node, child, sorter=place)]] = least
        return node[n > 0], root[n > 0], n[n > 0]

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            rows = table.to_batches()[0] if len(table) else None
            if rows is None:
                continue
            cell = np.stack([rows.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
            cuts = np.append(0, np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1)
            held = rows.slice(cuts[-1])
            yield from cells(rows, cell, cuts)
        if held is not None:
            yield from cells(held, np.stack([held.column(0).to_numpy(zero_copy_only=False).astype(np.int64)]), np.array([0, len(held)]))

    def cells(rows, cell, cuts):
        side, node = (rows.column(k).to_numpy(zero_copy_only=False) for k in (4, 5))
        keys = rows.column(6).flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        members, sizes = rows.column(7).flatten().to_numpy(zero_copy_only=False), pc.list_value_length(rows.column(7)).to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        found = [
            linked(cell[0, i], side[i:j], node[i:j], keys[i:j], members[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
            for i, j in zip(cuts[:-1], cuts[1:])
        ]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=["node", "root", "n"])

    return run


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, two digests of the words, and the band keys of every text."""
    return in_arrow(docs, _signatures, "doc_id long, n_words long, d1 long, d2 long, keys array<long>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """Rows (band, key, node) of buckets that hold two nodes or more, with the number of parts.

    Of buckets with the same nodes only the one of the first band stays.
    """
    rows = nodes.select("node", "n_words", F.posexplode("keys").alias("at", "key")).withColumn("band", F.col("at").cast("short"))
    sizes = rows.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.sum("n_words").alias("words"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    parts = F.ceil(F.greatest(F.col("size") / CELL_ROWS, F.col("words") / CELL_WORDS)).cast("int")
    single = sizes.filter("size > 1").groupBy("size", "low", "high", "x", "y").agg(F.min(F.struct("band", "key")).alias("b"), F.first(parts).alias("parts"))
    kept = stabilise(single.select("b.band", "b.key", "parts"), "sizes")
    return rows.select("band", "key", "node").join(kept, ["band", "key"])


def _cells(buckets: DataFrame) -> DataFrame:
    """Every row of a bucket once for each cell of its part: the part with itself and with each other one."""
    part = F.pmod(F.xxhash64("node", F.lit(2)), "parts").cast("int")
    dealt = buckets.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select(
        "band", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "node",
    )


def _links(buckets: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """node, root and n: links of the nodes of each cell, as stars, with the number of links of each node."""
    cell = ["band", "key", "i", "j"]
    rows = _cells(buckets).join(bags, "node").select(*cell, "side", "node", "keys", "bag")
    dealt = rows.repartition(*cell).sortWithinPartitions(*cell, "side", "node")
    return stabilise(in_arrow(dealt, _linker(threshold), "node long, root long, n long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILAR) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies and is_first.

    Texts of equal words form one node. Nodes that share a band are candidates, in buckets of any
    size; those whose weighted Jaccard similarity of five-word runs, computed from the texts,
    reaches `threshold` are links. A class is a component of links; its id is the least doc_id in
    it. n_links counts a document's links to other texts, each once.

    Buckets are compared in cells of bounded size, spread over tasks, that give back stars and
    counts instead of pairs. The work in a cell grows with the square of its rows.

    NULL and wordless texts are never near-duplicates: each is a class of its own, named by its
    doc_id. A text of fewer than five words is one run. Rows with a NULL doc_id take part; a class
    of such rows alone has a NULL id. Rows that repeat an id keep one row each. Other columns are
    not read. An empty table gives no rows.
    """
    source = only(docs, id_col, text_col)
    signed = stabilise(signatures(source), "signatures")
    wordy = signed.filter("n_words > 0")
    copies = wordy.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n_copies"), F.first("keys").alias("keys"), F.first("n_words").alias("n_words")
    )
    nodes = stabilise(copies.withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = stabilise(_buckets(nodes), "buckets")
    touched = buckets.select("node").distinct().join(nodes.select("node", "d1", "d2", "first", "keys"), "node")
    bags = stabilise(in_arrow(_node_texts(source, touched), _bags, "node long, keys array<long>, bag array<long>"), "bags")
    links = _links(buckets, bags, threshold)
    roots = components(links, "node", "root")
    ends = links.groupBy("node").agg(F.sum("n").alias("n_links"))
    grouped = nodes.select("node", "d1", "d2", "first", "n_copies").join(roots, "node", "left").join(ends, "node", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("first").alias("class_id"), F.count("*").alias("n_texts"))
    named = grouped.join(least, "root").select("d1", "d2", "class_id", "n_copies", "n_texts", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = signed.select("doc_id", "d1", "d2", (F.col("n_words") > 0).alias("wordy")).join(named, ["d1", "d2"], "left")
    own = lambda c, other: F.when(F.col("wordy"), F.col(c)).otherwise(other)
    return out.select(
        "doc_id",
        own("class_id", F.col("doc_id")).alias("class_id"),
        own("n_links", F.lit(0)).cast("long").alias("n_links"),
        own("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        own("n_texts", F.lit(1)).cast("long").alias("n_texts"),
    )


def _node_texts(source: DataFrame, touched: DataFrame) -> DataFrame:
    """Text of every node that shares a bucket, read from a row of its first document."""
    firsts = touched.select("node", "keys", F.col("first").alias("id"), "d1", "d2")
    named = in_arrow(source, _digested, "doc_id long, text string, d1 long, d2 long").join(firsts, ["d1", "d2"])
    # Rows repeat ids, too; the join has them in order by both digests.
    return named.filter(F.col("doc_id").eqNullSafe(F.col("id"))).dropDuplicates(["d1", "d2"]).select("node", "keys", "text")
