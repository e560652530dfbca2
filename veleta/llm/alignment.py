"""Groups of tokens that two tokenizers cut out of the same bytes, and how their ids go together.

Both encodings of a text cover the same bytes. Where a token of each ends, the text is cut; the
tokens between two cuts form a group, and every token of one side is linked to every token of the
other side of its group.

The groups of a byte range are a fragment: tokens before its first cut (the open prefix), closed
groups, tokens after its last cut (the open suffix). Fragments compose: the suffix of the left and
the prefix of the right become one closed group, or stay open where a side has no cut. Composition
is associative, so the ranges of a very long document are cut in any task and only their open
ends are sent up a tree, FAN at a time.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow, only
from veleta.llm.token_files import FileEncoder
from veleta.llm.word_ids import WordIds
from veleta.llm.words import slices
from veleta.session import stabilise

# Bytes of a range; documents of one range need no tree.
RANGE, FAN = 1 << 18, 16
# Bytes of texts encoded together.
AT_ONCE = 1 << 22
# Most frequent pairs that every task gets, 16 bytes each; all others are joined.
HEAD = 1 << 18
# Pairs held by a task before it hands on their counts.
HELD = 1 << 21
NO_IDS = np.zeros(0, np.int64)


class Side:
    """Bytes of every id of a tokenizer, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        room = self.lengths[ids]
        return self.data[np.arange(room.sum()) + np.repeat(self.starts[ids] - (np.cumsum(room) - room), room)]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself where printable, else one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pieces:
    """Encoder of words by a file of pieces, which writes a space before every text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.side = Side([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)])
        # Pieces that hold a space hold it in front, so none reaches over the space before a word.
        self.splits = not any("▁" in n.lstrip("▁") for n in names)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that begin with a space, which the model adds itself."""
        ids = self.model.encode([w[1:] for w in words], num_threads=1) if words else []
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts


@lru_cache(maxsize=1)
def _tokenizers(byte_level: bytes, pieces: bytes) -> tuple[WordIds, Side, WordIds, Side]:
    a, b, letters = FileEncoder(byte_level, specials=False), Pieces(pieces), byte_letters()
    # Entries outside the alphabet of letters are special tokens, which no text is encoded to.
    entries = [a.tokenizer.id_to_token(i) or "" for i in range(a.tokenizer.get_vocab_size())]
    side = Side([bytes(letters.get(c, 0) for c in t) for t in entries])
    return WordIds(a.words, a.splits), side, WordIds(b.words, b.splits), b.side


def encode(tokenizers, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every text, which begins with a space, the ids of both sides and where their tokens end.

    None for a space alone and where a side has other bytes than the text.
    """
    words_a, side_a, words_b, side_b = tokenizers
    (ids_a, to_a), (ids_b, to_b) = words_a.of(data, offsets), words_b.of(data, offsets)
    ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
    whole = all(np.array_equal(side.joined(ids), data) for side, ids in ((side_a, ids_a), (side_b, ids_b)))
    to_a, to_b, out = np.append(0, to_a), np.append(0, to_b), []
    for k in range(len(offsets) - 1):
        x, y, text = ids_a[to_a[k] : to_a[k + 1]], ids_b[to_b[k] : to_b[k + 1]], data[offsets[k] : offsets[k + 1]]
        ends_x, ends_y = np.cumsum(side_a.lengths[x]), np.cumsum(side_b.lengths[y])
        same = len(text) > 1 and len(x) and len(y) and ends_x[-1] == ends_y[-1] == len(text)
        if same and (whole or (np.array_equal(side_a.joined(x), text) and np.array_equal(side_b.joined(y), text))):
            out.append((x, ends_x, y, ends_y))
        else:
            out.append((NO_IDS,) * 4)
    return out


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side there are up to each cut."""
    _, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    return i + 1, j + 1


class Written:
    """Decimal ids with what stands behind them, end to end: `a1,a2|b1;` of all ids."""

    def __init__(self, most: int):
        self.side = Side([b"%d%s" % (i, mark) for i in range(most) for mark in (b",", b"|", b";")])

    def groups(self, a: np.ndarray, to_a: np.ndarray, b: np.ndarray, to_b: np.ndarray) -> bytes:
        """The groups in order, a semicolon behind each."""
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        group_a, group_b = np.repeat(np.arange(len(to_a)), n_a), np.repeat(np.arange(len(to_b)), n_b)
        what = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[to_a - 1], mark_b[to_b - 1] = 1, 2
        before_b = np.append(0, to_b)
        what[np.arange(len(a)) + before_b[group_a]] = a * 3 + mark_a
        what[np.arange(len(b)) + to_a[group_b]] = b * 3 + mark_b
        return self.side.joined(what).tobytes()


@lru_cache(maxsize=1)
def _written(most: int) -> Written:
    return Written(most)


def linked(a: np.ndarray, to_a: np.ndarray, b: np.ndarray, to_b: np.ndarray, at_most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of linked ids, as id of A * 2^32 + id of B in ascending order, and their numbers of links.

    In each group an id counts once with its number of tokens. The products are made in slices of
    about `at_most` pairs, so a long group stays small in memory.
    """
    sides = []
    for ids, ends in ((a, to_a), (b, to_b)):
        group = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        key, n = np.unique(group << 32 | ids, return_counts=True)
        sides.append((key >> 32, key & 0xFFFFFFFF, n))
    (group_a, id_a, n_a), (group_b, id_b, n_b) = sides
    first = np.searchsorted(group_b, group_a)
    many = np.searchsorted(group_b, group_a, "right") - first
    ends, begin = np.cumsum(many), 0
    pairs, links = NO_IDS, NO_IDS
    while begin < len(many):
        before = ends[begin] - many[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + at_most, "right")))
        own = many[begin:end]
        rows = np.repeat(np.arange(begin, end), own)
        partner = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + first[rows]
        pairs, at = np.unique(np.concatenate([pairs, id_a[rows] << 32 | id_b[partner]]), return_inverse=True)
        links = np.bincount(at, np.concatenate([links, n_a[rows] * n_b[partner]]), len(pairs)).astype(np.int64)
        begin = end
    return pairs, links


# Rows of one shape: `kind` 0 a whole document, 1 a byte range, 2 and 3 groups of a part, 4 an open end.
PARTS = (
    "kind int, row long, part long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, links array<long>, a array<int>, to_a array<int>, b array<int>, to_b array<int>"
)
NAMES = [p.split()[0] for p in PARTS.split(", ")]
TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}[p.split()[1]] for p in PARTS.split(", ")]


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(NAMES, TYPES)], names=NAMES)


def _sums(a, to_a, b, to_b) -> dict:
    pairs, links = linked(a, to_a, b, to_b)
    return {"n_a": len(a), "n_b": len(b), "n_groups": len(to_a), "n_links": int(links.sum()), "pairs": pairs, "links": links}


def _encoded(shared_a, shared_b, span: int):
    def parts(batches):
        tokenizers = _tokenizers(shared_a.value, shared_b.value)
        most = max(len(tokenizers[1].lengths), len(tokenizers[3].lengths))
        for batch in batches:
            rows, held = [], 0
            spaced = pc.binary_join_element_wise(pa.scalar(""), batch.column(2).fill_null(""), pa.scalar(" "))
            texts = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spaced], names=["row", "doc_id", "text"])
            for part, data, offsets in slices([texts], at_most=AT_ONCE):
                both = encode(tokenizers, data, offsets)
                for row, doc, (a, ends_a, b, ends_b) in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), both):
                    head = {"row": row, "doc_id": doc, "part": 0}
                    if not len(a):
                        rows.append(head | {"kind": 0, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "pairs": [], "links": []})
                    elif ends_a[-1] <= span:
                        to_a, to_b = group_ends(ends_a, ends_b)
                        digest = sha256(_written(most).groups(a, to_a, b, to_b)[:-1]).hexdigest()
                        rows.append(head | {"kind": 0, "groups_sha256": digest} | _sums(a, to_a, b, to_b))
                    else:
                        for k in range(-(-int(ends_a[-1]) // span)):
                            (i, j), (p, q) = (np.searchsorted(e, [k * span + 1, (k + 1) * span + 1]) for e in (ends_a, ends_b))
                            rows.append(head | {"kind": 1, "part": k, "a": a[i:j], "to_a": ends_a[i:j] - k * span, "b": b[p:q], "to_b": ends_b[p:q] - k * span})
                            if len(rows) > 16:
                                yield _rows(rows)
                                rows = []
                    held += len(a) + len(b)
                    if held > 1 << 19:
                        yield _rows(rows)
                        rows, held = [], 0
            if rows:
                yield _rows(rows)

    return parts


ENDS = "row long, part long, cut boolean, pre_a array<int>, pre_b array<int>, suf_a array<int>, suf_b array<int>"
ENDS_TYPES = [pa.int64(), pa.int64(), pa.bool_()] + [pa.list_(pa.int32())] * 4
ENDS_NAMES = [p.split()[0] for p in ENDS.split(", ")]


def fragment(row: int, part: int, a, ends_a, b, ends_b) -> tuple[dict, dict | None]:
    """Open ends of a byte range, and its closed groups."""
    to_a, to_b = group_ends(ends_a, ends_b)
    if not len(to_a):
        return {"row": row, "part": part, "cut": False, "pre_a": a, "pre_b": b, "suf_a": NO_IDS, "suf_b": NO_IDS}, None
    ends = {"pre_a": a[: to_a[0]], "pre_b": b[: to_b[0]], "suf_a": a[to_a[-1] :], "suf_b": b[to_b[-1] :]}
    closed = {"a": a[to_a[0] : to_a[-1]], "to_a": to_a[1:] - to_a[0], "b": b[to_b[0] : to_b[-1]], "to_b": to_b[1:] - to_b[0]}
    return {"row": row, "part": part, "cut": True} | ends, closed if len(to_a) > 1 else None


def compose(left: dict, right: dict) -> tuple[dict, tuple | None]:
    """Open ends of two neighbours as one, and the group (a, b) that they close. Associative."""
    both = lambda x, y: np.concatenate([x, y])
    head = {"row": left["row"], "part": left["part"], "cut": left["cut"] or right["cut"]}
    if not left["cut"]:
        pre = {"pre_a": both(left["pre_a"], right["pre_a"]), "pre_b": both(left["pre_b"], right["pre_b"])}
        return head | pre | {"suf_a": right["suf_a"], "suf_b": right["suf_b"]}, None
    pre = {"pre_a": left["pre_a"], "pre_b": left["pre_b"]}
    if not right["cut"]:
        return head | pre | {"suf_a": both(left["suf_a"], right["pre_a"]), "suf_b": both(left["suf_b"], right["pre_b"])}, None
    closed = both(left["suf_a"], right["pre_a"]), both(left["suf_b"], right["pre_b"])
    return head | pre | {"suf_a": right["suf_a"], "suf_b": right["suf_b"]}, closed


def _fragments(batches):
    for batch in batches:
        for r in batch.to_pylist():
            own, closed = fragment(r["row"], r["part"], *(np.array(r[n], np.int64) for n in ("a", "to_a", "b", "to_b")))
            rows = [{"kind": 4, "row": r["row"], "part": r["part"], "n_a": int(own["cut"])} | {n: own[m] for n, m in _AS}]
            if closed:
                # A range's groups come behind the one that its left end closes: parts count by two.
                rows.append({"kind": 2, "row": r["row"], "part": 2 * r["part"] + 1} | closed)
            yield _rows(rows)


# Columns that carry open ends in rows of PARTS.
_AS = [("a", "pre_a"), ("b", "pre_b"), ("to_a", "suf_a"), ("to_b", "suf_b")]


def _composed(batches):
    """Rows of neighbours in order: what they close, and their open ends as one."""
    for batch in batches:
        for r in batch.to_pylist():
            ends = [{"row": r["row"], "part": e["part"], "cut": bool(e["n_a"])} | {m: np.array(e[n], np.int64) for n, m in _AS} for e in sorted(r["ends"], key=lambda e: e["part"])]
            whole, rows = ends[0], []
            for right in ends[1:]:
                whole, closed = compose(whole, right)
                if closed:
                    # The part is that of the range in which the group ends.
                    rows.append(_group(r["row"], 2 * right["part"], *closed))
            rows.append({"kind": 4, "row": r["row"], "part": whole["part"], "n_a": int(whole["cut"])} | {n: whole[m] for n, m in _AS})
            yield _rows(rows)


def _group(row: int, part: int, a: np.ndarray, b: np.ndarray) -> dict:
    return {"kind": 3, "row": row, "part": part, "a": a, "to_a": [len(a)], "b": b, "to_b": [len(b)]}


def _finished(batches):
    """The open prefix of a whole document is its first group; it has no open suffix."""
    for batch in batches:
        yield _rows([_group(r["row"], 0, np.array(r["a"]), np.array(r["b"])) for r in batch.to_pylist()])


def _summed(batches):
    for batch in batches:
        for r in batch.to_pylist():
            yield _rows([r | _sums(*(np.array(r[n], np.int64) for n in ("a", "to_a", "b", "to_b")))])


def _digested(most: int):
    """Rows of groups in order of documents and parts; digests one document after the other."""

    def digests(batches):
        row, state, tail = None, None, b""
        out = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["row"] != row:
                    if row is not None:
                        out.append((row, state.hexdigest()))
                    row, state, tail = r["row"], sha256(), b""
                text = tail + _written(most).groups(*(np.array(r[n], np.int64) for n in ("a", "to_a", "b", "to_b")))
                state.update(text[:-1])
                tail = text[-1:]
        if row is not None:
            out.append((row, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["row", "groups_sha256"])

    return digests


def _long_documents(spark, ranges: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Sums and digest of every document of several ranges; and its distinct pairs with their links."""
    ranges = ranges.repartition("row", "part")
    cut = stabilise(in_arrow(ranges, _fragments, PARTS), "fragments")
    groups, ends, width = cut.filter("kind = 2"), cut.filter("kind = 4"), 1
    last = ranges.agg(F.max("part")).first()[0]
    while last is not None and width <= last:
        width *= FAN
        near = ends.groupBy("row", F.floor(F.col("part") / width).alias("near")).agg(
            F.collect_list(F.struct("part", "n_a", "a", "b", "to_a", "to_b")).alias("ends")
        )
        step = stabilise(in_arrow(near, _composed, PARTS), "fragments")
        groups, ends = groups.union(step.filter("kind = 3")), step.filter("kind = 4")
    groups = groups.union(in_arrow(ends, _finished, PARTS))
    summed = stabilise(in_arrow(groups, _summed, PARTS), "groups")
    ordered = summed.select("row", "part", "a", "to_a", "b", "to_b").repartition("row").sortWithinPartitions("row", "part")
    digests = in_arrow(ordered, _digested(most), "row long, groups_sha256 string")
    totals = summed.groupBy("row").agg(*[F.sum(n).alias(n) for n in ("n_a", "n_b", "n_groups", "n_links")])
    pairs = summed.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", "p.pairs", "p.links")
    return totals.join(digests, "row"), pairs.groupBy("row", F.col("pairs").alias("pair")).agg(F.sum("links").alias("links"))


def _merged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(pairs, return_inverse=True)
    return own, np.bincount(at, counts, len(own)).astype(np.int64)


def _counted(batches):
    """Documents of each pair, as far as a task has seen."""
    pairs, counts, waiting, n = NO_IDS, NO_IDS, [], 0
    names = ["pair", "n"]
    for batch in batches:
        waiting.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
        n += len(waiting[-1])
        if n > HELD:
            new, many = np.unique(np.concatenate(waiting), return_counts=True)
            pairs, counts = _merged(np.concatenate([pairs, new]), np.concatenate([counts, many]))
            waiting, n = [], 0
            if len(pairs) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=names)
                pairs, counts = NO_IDS, NO_IDS
    if n:
        new, many = np.unique(np.concatenate(waiting), return_counts=True)
        pairs, counts = _merged(np.concatenate([pairs, new]), np.concatenate([counts, many]))
    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=names)


def _looked_up(shared):
    """Links of every document to frequent pairs summed; its other pairs are handed on."""

    def rows(batches):
        pairs, counts, best = shared.value
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                own, links = (part.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
                ends = np.cumsum(part.column(1).value_lengths().to_numpy(zero_copy_only=False))
                at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
                hit = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
                share = np.where(hit, links, 0)
                n_best, total = share * best[at] if len(pairs) else share, share * counts[at] if len(pairs) else share
                miss = ~hit
                missed = np.append(0, np.cumsum(miss))[np.append(0, ends)]
                upto = lambda x: np.diff(np.append(0, np.cumsum(x))[np.append(0, ends)])
                offsets = pa.array(missed.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(upto(n_best)), pa.array(upto(total)),
                        pa.ListArray.from_arrays(offsets, pa.array(own[miss])), pa.ListArray.from_arrays(offsets, pa.array(links[miss])),
                    ],
                    names=["row", "n_best", "count_sum", "pairs", "links"],
                )

    return rows


def _frequent(ranked: DataFrame, most: int) -> tuple[np.ndarray, ...]:
    """Pairs in ascending order, counts and best of the highest classes of counts that hold `most` pairs at most."""
    size = F.floor(F.log2("n") * 16).alias("size")  # some hundreds of classes
    left, least = most, None
    for r in sorted(ranked.groupBy(size).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["size"]
    chosen = ranked.filter(F.lit(False) if least is None else size >= least).toArrow()
    pairs, *rest = (chosen.column(k).to_numpy() for k in range(3))
    order = np.argsort(pairs)
    return pairs[order], *(x[order] for x in rest)


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", span: int = RANGE, head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A is a space and the text by the byte-level vocabulary at `byte_level`, side B the text by
    the pieces at `pieces`, which adds the space itself; special tokens are plain text. An id
    pair's count is the number of documents that hold it linked; n_best are the links whose pair
    has the highest count of its A id, ties included, and count_sum is the sum of counts over all
    links. groups_sha256 is of `a1,a2|b1;a3|b2,b3`.

    NULL and empty texts, and those whose bytes a side changes, have no tokens: zeros, and an empty
    digest. Every row counts as a document of its own, also where ids repeat or are NULL. Other
    columns are not read. An empty table gives no rows. Both files are of a fixed size and are
    broadcast; so are the `head` most frequent pairs, all others are joined.
    Documents of more than `span` bytes are cut into ranges of that size.
    """
    spark = docs.sparkSession
    shared, sizes = [], []
    for path in (byte_level, pieces):
        with open(path, "rb") as file:
            shared.append(spark.sparkContext.broadcast(file.read()))
    tokenizers = _tokenizers(*(s.value for s in shared))
    most = max(len(tokenizers[1].lengths), len(tokenizers[3].lengths))
    numbered = only(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = stabilise(in_arrow(numbered, _encoded(*shared, span), PARTS), "alignment")
    whole, ranges = parts.filter("kind = 0"), parts.filter("kind = 1")
    heads = whole.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    bags = whole.select("row", "pairs", "links")
    if not ranges.isEmpty():
        sums, long_pairs = _long_documents(spark, ranges, most)
        names = ranges.filter("part = 0").select("row", "doc_id")
        sums = names.join(sums, "row").select(*heads.columns)
        long_pairs = stabilise(long_pairs, "pairs")
        heads = heads.union(sums)
        # A document's pairs number no more than its links; slices of them keep rows small.
        slices_ = long_pairs.groupBy("row", F.pmod(F.xxhash64("pair"), F.lit(64)).alias("slice"))
        bags = bags.union(slices_.agg(F.collect_list(F.struct("pair", "links")).alias("p")).select("row", F.col("p.pair").alias("pairs"), F.col("p.links").alias("links")))
        bags = stabilise(bags, "bags")
    counts = in_arrow(bags.select("pairs"), _counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    ranked = stabilise(counts.withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("int")), "counts")
    top = spark.sparkContext.broadcast(_frequent(ranked, head))
    found = stabilise(in_arrow(bags, _looked_up(top), "row long, n_best long, count_sum long, pairs array<long>, links array<long>"), "links")
    tail = found.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p"))
    tail = tail.select("row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")).join(ranked, "pair")
    tail = tail.select("row", (F.col("links") * F.col("best")).alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum"))
    total = found.select("row", "n_best", "count_sum").union(tail).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return heads.join(total, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
