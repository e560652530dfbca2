"""Near duplicates by SimHash, with links found by pigeonring filtering.

A fingerprint is a ring of SEGMENTS segments. When two fingerprints differ in at most `WITHIN`
bits, some place on the ring has this property: for every length l, the l segments from there on
differ in at most l * WITHIN / SEGMENTS bits. With 2 bits and 8 segments that is a chain of three
equal segments, then at most one differing bit up to the seventh segment, then at most two. So the
three equal segments are a key that both have, and the whole chain is a filter before the full
comparison.

Buckets of a key are cut out of one sorted order, which is dealt to tasks by range, so a bucket of
any size spreads over tasks. Buckets up to LEAF are compared in place. Larger ones, and those on
the border of a task, are split by longer chains: of the four segments that may hold one
differing bit, two and then three must be equal as well. What is still large then differs in two
segments only, and each of its members names all values one bit away: members that name one
value are within two bits of each other, so no pairs are compared at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.graph import components, forest
from veleta.llm.tables import in_arrow, only
from veleta.llm.words import LOWER, NOT_SPACE, slices
from veleta.session import stabilise

SHINGLE, SEED, SEGMENTS, WITHIN = 3, 42, 8, 2
LEAF = 64
BLOCK = 1 << 16
# Segments from the start of the chain that a level takes as equal, by level and variant.
EQUAL = [
    [(0, 1, 2)],
    [(0, 1, 2, 3, 4), (0, 1, 2, 5, 6)],
    [(0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 4, 6), (0, 1, 2, 5, 6, 3), (0, 1, 2, 5, 6, 4)],
]


def simhash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of the texts whose bytes lie between the offsets."""
    n_texts, n = len(offsets) - 1, len(data)
    out = np.zeros(n_texts, np.uint64)
    if not n:
        return out
    inside = NOT_SPACE[data]
    head, tail = np.ones(n, bool), np.ones(n, bool)
    head[1:], tail[:-1] = ~inside[:-1], ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    head[edges], tail[edges - 1] = True, True
    starts, ends = np.flatnonzero(inside & head), np.flatnonzero(inside & tail) + 1
    if not len(starts):
        return out
    # All words in lower case, a space behind each.
    room = ends - starts + 1
    at = np.cumsum(room) - room
    line = LOWER[np.append(data, np.uint8(32))[np.arange(room.sum()) + np.repeat(starts - at, room)]]
    line[at + room - 1] = 32
    line = line.tobytes()
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    many = np.maximum(counts - SHINGLE + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(n_texts), many)
    first = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + bounds[:-1][text]
    last = np.minimum(first + SHINGLE, bounds[1:][text]) - 1
    begin, end = at[first], at[last] + room[last] - 1
    ones = np.zeros((n_texts, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(text), BLOCK):
        spans = zip(begin[k : k + BLOCK].tolist(), end[k : k + BLOCK].tolist())
        h = np.fromiter((digest(line[i:j], SEED) for i, j in spans), np.uint64)
        own = text[k : k + BLOCK]
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[own[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > many[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _fingerprints(batches):
    for batch, data, offsets in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(simhash(data, offsets).view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row; texts without words have 0."""
    return in_arrow(only(docs, id_col, text_col), _fingerprints, "doc_id long, fp long")


def _chains(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the differences from segment `start` on stay within their share at every length."""
    differ = np.bitwise_count((a ^ b).astype("<u8").view(np.uint8).reshape(-1, SEGMENTS))
    ring = (start[:, None] + np.arange(SEGMENTS)) % SEGMENTS
    sums = np.cumsum(np.take_along_axis(differ, ring, axis=1), axis=1, dtype=np.int64)
    return (sums * SEGMENTS <= np.arange(1, SEGMENTS + 1) * WITHIN).all(axis=1)


def _links(start: np.ndarray, bucket: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs within buckets, which lie together; reduced to stars."""
    found = [], []
    for d in range(1, LEAF):
        i = np.flatnonzero(bucket[d:] == bucket[:-d])
        if not len(i):
            break
        i = i[_chains(fp[i], fp[i + d], start[i])]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= WITHIN]
        found[0].append(fp[i])
        found[1].append(fp[i + d])
    if not found[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(*(np.concatenate(f).view(np.int64) for f in found))


def _compare(batches):
    """Rows (chain, key, fp) in order: links of small buckets, and the members of others with no partner."""
    names = ["chain", "a", "b"]

    def links(chain, key, fp):
        new = np.append(True, (chain[1:] != chain[:-1]) | (key[1:] != key[:-1]))
        a, b = _links(chain // 4 % SEGMENTS, np.cumsum(new), fp.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), np.int32)), pa.array(a), pa.array(b)], names=names)

    def left(chain, fp):
        return pa.RecordBatch.from_arrays([pa.array(chain), pa.array(fp), pa.nulls(len(fp), pa.int64())], names=names)

    held, first, passing = None, None, None
    for batch in batches:
        own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if not len(own[0]):
            continue
        if first is None:
            first = passing = (own[0][0], own[1][0])  # may have begun in another task
        if held is not None:
            own = [np.concatenate(x) for x in zip(held, own)]
        chain, key, fp = own
        edge = np.append(np.flatnonzero((chain[1:] != chain[:-1]) | (key[1:] != key[:-1])) + 1, len(chain))
        begin = np.append(0, edge[:-1])
        large = edge - begin > LEAF
        large[0] |= (chain[0], key[0]) == passing
        last = begin[-1]
        if large[-1]:
            passing, held = (chain[-1], key[-1]), None
        else:
            held = [x[last:] for x in own]  # may go on in the next batch
        rows = np.repeat(large, edge - begin)
        if rows.any():
            yield left(chain[rows], fp[rows])
        rows = ~rows
        rows[last:] = False
        if rows.any():
            yield links(chain[rows], key[rows], fp[rows])
    if held is not None:
        yield left(held[0], held[2])  # may go on in another task


def _rotated(fp: Column, by: Column) -> Column:
    """The fingerprint turned so that segment `by` comes lowest."""
    bits = by * 8
    return F.when(by == 0, fp).otherwise(
        F.call_function("shiftrightunsigned", fp, bits).bitwiseOR(F.call_function("shiftleft", fp, 64 - bits))
    )


def _mask(segments: tuple[int, ...]) -> int:
    mask = sum(0xFF << 8 * s for s in segments)
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, level: int) -> DataFrame:
    """chain (4 * start + variant), key and fp: the variants of a level that split each row's bucket."""
    variants = EQUAL[level]
    if level == 0:
        chains = F.array(*[F.lit(start * 4) for start in range(SEGMENTS)])
    else:
        each = len(variants) // len(EQUAL[level - 1])
        start, before = F.floor(F.col("chain") / 4) * 4, F.col("chain") % 4
        chains = F.array(*[(start + before * each + k).cast("int") for k in range(each)])
    out = rows.select(F.explode(chains).alias("chain"), "fp")
    masks = F.array(*[F.lit(_mask(v)).cast("long") for v in variants])
    turned = _rotated(F.col("fp"), F.floor(F.col("chain") / 4).cast("int"))
    return out.select("chain", turned.bitwiseAND(F.get(masks, F.col("chain") % 4)).alias("key"), "fp")


def _around(rows: DataFrame) -> DataFrame:
    """Links of fingerprints that differ in the two open segments only, through the values next to them."""
    open_bits = [[8 * s + k for s in range(SEGMENTS) if s not in v for k in range(8)] for v in EQUAL[-1]]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in bits]) for bits in open_bits])
    turned = _rotated(F.col("fp"), F.floor(F.col("chain") / 4).cast("int"))
    near = rows.select("chain", "fp", turned.alias("turned"), F.explode(F.get(flips, F.col("chain") % 4)).alias("flip"))
    # At most 17 fingerprints are within one bit of a value.
    groups = near.groupBy("chain", F.col("turned").bitwiseXOR(F.col("flip")).alias("value")).agg(F.collect_set("fp").alias("fps"))
    return groups.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")


def links(nodes: DataFrame) -> DataFrame:
    """Pairs a, b of the distinct fingerprints `fp` that connect all that differ in two bits or fewer."""
    found, rows = [], nodes.select("fp")
    for level in range(len(EQUAL)):
        keyed = stabilise(_keyed(rows, level), "chains")
        ordered = keyed.repartitionByRange("chain", "key", "fp").sortWithinPartitions("chain", "key", "fp")
        compared = stabilise(in_arrow(ordered, _compare, "chain int, a long, b long"), "compared")
        found.append(compared.filter("b IS NOT NULL").select("a", "b"))
        rows = compared.filter("b IS NULL").select("chain", F.col("a").alias("fp"))
    out = _around(rows)
    for pairs in found:
        out = out.union(pairs)
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    The words of a text are runs of anything but ASCII white space, with A-Z in lower case; a bit
    is 1 when more than half of the hashes of its runs of three words have it, each as often as it
    occurs. Fingerprints that differ in two bits or fewer are linked, and component_id is the least
    doc_id among all that links reach.

    A text of one or two words is one run. NULL, empty and wordless texts have the fingerprint zero
    and are linked like any other. Rows with a NULL doc_id take part; a component of such rows
    alone has a NULL id. Rows that repeat an id keep one row each. Other columns are not read. An
    empty table gives no rows.
    """
    rows = stabilise(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stabilise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = stabilise(components(links(nodes)), "roots")
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stabilise(grouped.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
