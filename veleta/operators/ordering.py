"""Positions, ordered splits and forward fill over raw rows (WIN1-4, LIM1-2, TOP1).

A window over a whole key would put a busy key into one task. These operators cut each key
into chunks that are consecutive in the order, work inside (key, chunk), and carry what a chunk
needs from earlier chunks through a small per-chunk summary: counts for positions, the last
value for a fill.

`chunk` None sorts the table over the cluster by keys and order and takes its sorted partitions
for chunks: bounds come from a sample, equal order values are spread by a hash of the row, and
what a chunk needs is summed up over partitions. That works for any type that has an order, and
no key, day or value makes a chunk large. The sorted rows are stored once.

A caller that knows its data can save that sort: `chunk` may be a time unit for the first order
column, a column that never decreases along the order, or several such columns, coarse to fine.
Results do not depend on the choice. With several columns the summaries are summed up level by
level, so that neither rows nor summaries of a key meet in one task: for a table ordered by (day,
id), chunk by day and then by id range. `time_unit_for` measures which time unit is fine enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.operators.joins import tag_nulls
from veleta.session import stabilise

Chunk = str | Column | Sequence[Column] | None

UNITS = ("year", "month", "day", "hour", "minute", "second")
ROWS_PER_CHUNK = 2_000_000


@dataclass(frozen=True)
class _Cut:
    """Rows with their chunks. All names are technical columns that are never NULL."""

    rows: DataFrame
    keys: list[str]
    levels: list[list[str]]
    # What orders the rows of a chunk; of a sorted table the number of the row, without gaps in a partition.
    inside: list[str]
    numbered: bool = False

    def group(self, depth: int | None = None) -> list[str]:
        """Keys and the chunk columns of the first `depth` levels (all by default)."""
        return [*self.keys, *[name for level in self.levels[:depth] for name in level]]

    def order(self, depth: int) -> list[Column]:
        """Ascending order of one level, NULL first."""
        value, flag = self.levels[depth]
        return [~F.col(flag), F.col(value)]

    def before(self, depth: int):
        """Earlier chunks of one level within the same coarser chunk; runs over summaries only."""
        w = Window.partitionBy(*self.group(depth)).orderBy(*self.order(depth))
        return w.rowsBetween(Window.unboundedPreceding, -1)


def _largest(df: DataFrame, keys: Sequence[str], ts: str, units: Sequence[str]) -> dict[str, int]:
    """Rows of the largest (key, chunk) for each unit, all from one count by the finest unit."""
    finest = F.date_trunc(units[-1], F.col(ts)).alias("__at")
    counts = df.groupBy(*keys, finest).agg(F.count("*").alias("__rows"))
    at_units = F.explode(
        F.array(*[F.struct(F.lit(u).alias("unit"), F.date_trunc(u, "__at").alias("at")) for u in units])
    )
    sizes = counts.select(*keys, "__rows", at_units.alias("__unit")).groupBy(*keys, "__unit").agg(
        F.sum("__rows").alias("__rows")
    )
    largest = sizes.groupBy("__unit.unit").agg(F.max("__rows").alias("largest"))
    return {u: 0 for u in units} | {r["unit"]: r["largest"] for r in largest.toLocalIterator()}


def time_unit_for(df: DataFrame, keys: Sequence[str], ts: str, rows: int = ROWS_PER_CHUNK) -> str:
    """Coarsest time unit that leaves at most `rows` rows in any chunk of any key.

    One aggregate over the key and time columns, and one row per unit to the driver. Days are
    the finest unit of a DATE; a table with more rows on one of them needs a second chunk column.
    """
    is_date = isinstance(df.schema[ts].dataType, T.DateType)
    for units in (UNITS[:3],) if is_date else (UNITS[:4], UNITS[4:]):
        sizes = _largest(df, keys, ts, units)
        for unit in units:
            if sizes[unit] <= rows:
                return unit
    return units[-1]


_ROW, _PART = "__row", "__part"
# Rows of a partition are numbered in the lower bits, as Spark's own row numbers are.
_PART_BITS = 33


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def _sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in partitions that are consecutive in keys and order, with number and partition."""
    spread = [F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)]
    by = [*[F.col(f"`{c}`").asc_nulls_first() for c in (*keys, *order)], F.xxhash64(*spread)]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    row = F.monotonically_increasing_id()
    return stabilise(dealt.withColumns({_ROW: row}), "sorted").withColumn(_PART, F.shiftright(_ROW, _PART_BITS))


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Chunk) -> _Cut:
    if chunk is None:
        rows = _sorted(df, keys, order)
        tagged, pairs = tag_nulls(rows, [*keys, _PART], "__c")
        return _Cut(tagged, [name for pair in pairs[:-1] for name in pair], pairs[-1:], [_ROW], True)
    if isinstance(chunk, str):
        chunk = [F.date_trunc(chunk, F.col(order[0]))]
    elif isinstance(chunk, Column):
        chunk = [chunk]
    names = [f"__chunk{i}" for i in range(len(chunk))]
    tagged, pairs = tag_nulls(df.withColumns(dict(zip(names, chunk))), [*keys, *names], "__c")
    return _Cut(tagged, [name for pair in pairs[: len(keys)] for name in pair], pairs[len(keys) :], list(order))


def _offsets(counts: DataFrame, cut: _Cut, depth: int) -> DataFrame:
    """Append to chunk counts the rows before the chunk (`__offset`) and in the key (`__n`)."""
    here = counts.withColumn("__offset", F.coalesce(F.sum("__rows").over(cut.before(depth)), F.lit(0)))
    if depth == 0:
        return here.withColumn("__n", F.sum("__rows").over(Window.partitionBy(*cut.keys)))
    coarse = cut.group(depth)
    upper = _offsets(counts.groupBy(*coarse).agg(F.sum("__rows").alias("__rows")), cut, depth - 1)
    upper = upper.select(*coarse, F.col("__offset").alias("__upper"), "__n")
    return here.join(upper, coarse).withColumn("__offset", F.col("__offset") + F.col("__upper")).drop("__upper")


def _chunk_offsets(cut: _Cut) -> DataFrame:
    first = [F.min(_ROW).alias("__first")] if cut.numbered else []
    counts = cut.rows.groupBy(*cut.group()).agg(F.count("*").alias("__rows"), *first)
    return _offsets(counts, cut, len(cut.levels) - 1)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Chunk = None) -> DataFrame:
    """Append `pos` (from 1) and `n`, the rows of the key (WIN1); columns of these names are replaced.

    `order` must tell rows of a key apart; NULL comes first.
    """
    cut = _cut(df, keys, order, chunk)
    if cut.numbered:
        placed = cut.rows.join(_chunk_offsets(cut).drop("__rows"), cut.group())
        ranked = placed.withColumn("__rank", F.col(_ROW) - F.col("__first") + 1)
        return _positioned(ranked, df)
    inside = Window.partitionBy(*cut.group()).orderBy(*order)
    ranked = cut.rows.withColumn("__rank", F.row_number().over(inside))
    return _positioned(ranked.join(_chunk_offsets(cut).drop("__rows"), cut.group()), df)


def _positioned(ranked: DataFrame, df: DataFrame) -> DataFrame:
    return ranked.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in ("pos", "n")],
        (F.col("__offset") + F.col("__rank")).alias("pos"),
        F.col("__n").alias("n"),
    )


def ordered_split(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], train_share: float = 0.8, **kw
) -> DataFrame:
    """Mark the first int(share * N) rows of each key as train (WIN2)."""
    at = positions(df, keys, order, **kw)
    return at.withColumn("is_train", F.col("pos") <= F.floor(F.lit(train_share) * F.col("n")))


def ordered_holdout(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], test_share: float = 0.2, **kw
) -> DataFrame:
    """Mark all but the last int(share * N) rows of each key as train (WIN3).

    Differs from `ordered_split` in what is rounded: 101 rows give 81 train rows here, 80 there.
    """
    at = positions(df, keys, order, **kw)
    return at.withColumn("is_train", F.col("pos") <= F.col("n") - F.floor(F.lit(test_share) * F.col("n")))


def _carried(closing: DataFrame, cut: _Cut, cols: Sequence[str], depth: int) -> DataFrame:
    """Append to closing values of chunks the last value before the chunk (`__carry_*`)."""
    here = closing.withColumns({f"__carry_{c}": F.last(f"__close_{c}", True).over(cut.before(depth)) for c in cols})
    if depth == 0:
        return here
    coarse, rank = cut.group(depth), F.struct(*cut.order(depth))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in (f"__close_{c}" for c in cols)]
    upper = _carried(closing.groupBy(*coarse).agg(*last), cut, cols, depth - 1)
    upper = upper.select(*coarse, *[F.col(f"__carry_{c}").alias(f"__upper_{c}") for c in cols])
    carry = {f"__carry_{c}": F.coalesce(f"__carry_{c}", f"__upper_{c}") for c in cols}
    return here.join(upper, coarse).withColumns(carry).drop(*[f"__upper_{c}" for c in cols])


def forward_fill(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], chunk: Chunk = None
) -> DataFrame:
    """Replace NULL by the last value before it in the key's order (WIN4)."""
    cut = _cut(df, keys, order, chunk)
    moment = F.struct(*cut.inside) if len(cut.inside) > 1 else F.col(cut.inside[0])
    # Last value of each column inside the chunk; NULL when the chunk has none.
    closing = cut.rows.groupBy(*cut.group()).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), moment)).alias(f"__close_{c}") for c in cols]
    )
    carried = _carried(closing, cut, cols, len(cut.levels) - 1).drop(*[f"__close_{c}" for c in cols])
    inside = Window.partitionBy(*cut.group()).orderBy(*cut.inside)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.rows.withColumns({f"__local_{c}": F.last(c, True).over(upto) for c in cols})
    joined = local.join(carried, cut.group())
    filled = {c: F.coalesce(f"__local_{c}", f"__carry_{c}") for c in cols}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def first_rows(df: DataFrame, n: int, order: Sequence[str], chunk: Chunk = None) -> DataFrame:
    """The first `n` rows in `order`, for caps too large for one task to rank (LIM1).

    Chunk counts locate the chunk in which the cap falls. Earlier chunks are kept whole and
    unsorted; only the boundary chunk is ranked, and of a sorted table none.
    """
    cut = _cut(df, [], order, chunk)
    # The chunk that holds row n, or the last one when there are fewer rows.
    edge = _chunk_offsets(cut).where(F.col("__offset") < n).orderBy(F.desc("__offset")).first()
    if edge is None:
        return df.limit(0)
    here, earlier = F.lit(True), F.lit(False)
    for value, flag in cut.levels:
        less = (F.col(flag) & F.lit(not edge[flag])) | (
            (F.col(flag) == edge[flag]) & (F.col(value) < F.lit(edge[value]))
        )
        earlier = earlier | (here & less)
        here = here & (F.col(flag) == edge[flag]) & (F.col(value) == F.lit(edge[value]))
    boundary = cut.rows.where(here)
    if edge["__offset"] + edge["__rows"] > n:
        left = n - edge["__offset"]
        boundary = boundary.where(F.col(_ROW) < edge["__first"] + left) if cut.numbered else boundary.orderBy(*order).limit(left)
    return cut.rows.where(earlier).unionByName(boundary).select(*df.columns)


def top_k(df: DataFrame, metric: str, k: int, keys: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """The `k` rows with the least metric, over all rows or per key (TOP1, WIN9).

    Per key this is a rank filter, which Spark applies before and after the shuffle.
    """
    order = [F.col(metric).asc_nulls_last(), *[F.col(c) for c in tiebreak]]
    if not keys:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
