"""Paged JSON documents as record rows (SRC6, WIN7, SET1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.operators.joins import null_safe_join
from veleta.session import stabilise

# Pages that one bitmap of Spark tells apart.
_BITS = 32768


def _first_zero(bitmap: Column) -> Column:
    """Position of the lowest bit that is not set; only for bitmaps that are not full."""
    digits = F.hex(bitmap)
    full = F.length(F.regexp_extract(digits, "^(FF)*", 0))
    byte = F.conv(F.substring(digits, full + 1, F.lit(2)), 16, 10).cast("int")
    # Adding one turns the lowest zero and the ones below it.
    return full * 4 + F.bit_count(byte.bitwiseXOR(byte + 1)) - 1


def _stops(parsed: DataFrame, keys: list[str], page: str, start_page: int) -> DataFrame:
    """First page that is not read, for every sequence.

    One row of 4 KB for 32,768 pages: which of them hold records. The first zero bit is the first
    page that is absent or empty.
    """
    at = F.col(page) - start_page + 1
    found = parsed.groupBy(*keys, F.bitmap_bucket_number(at).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.col("__filled"), at))).alias("__bits"),
        F.min(F.when(~F.col("__filled"), F.col(page))).alias("__empty"),
        F.min(F.when(~F.col("__more"), F.col(page) + 1)).alias("__behind"),
    )
    bucket, following = F.col("__bucket"), F.lead("__bucket").over(Window.partitionBy(*keys).orderBy("__bucket"))
    begin = F.lit(start_page) + (bucket - 1) * _BITS
    gap = F.when(F.bitmap_count("__bits") < _BITS, begin + _first_zero(F.col("__bits"))).when(
        following.isNull() | (following != bucket + 1), begin + _BITS
    )
    stops = found.select(*keys, "__bucket", F.least(gap, "__empty", "__behind").alias("__stop"))
    first = F.when(F.min("__bucket") > 1, F.lit(start_page))
    return stops.groupBy(*keys).agg(F.least(F.min("__stop"), first).alias("__stop"))


def pages_to_records(
    pages: DataFrame,
    record_schema: T.StructType | str,
    start_page: int,
    page: str = "page",
    body: str = "body",
    source: str | None = None,
) -> DataFrame:
    """Records of the pages a sequential reader would have fetched, one row each.

    `pages` holds one landed document per row: a page number and the text
    `{"results": [...], "next": ...}`. Reading starts at `start_page`, stops before the first
    page that is absent, unreadable or empty, and stops after the first page without `next`.
    `source` names a column that tells several page sequences apart.

    The pages are read and parsed once and stored; the stop is found on bitmaps of the pages that
    hold records, so no task sees a whole sequence of pages.
    """
    if isinstance(record_schema, str):
        record_schema = T.StructType.fromDDL(record_schema)
    keys = [source] if source else []
    document = T.StructType([T.StructField("results", T.ArrayType(record_schema)), T.StructField("next", T.StringType())])
    here = pages.where(F.col(page) >= start_page).select(*keys, page, F.from_json(body, document).alias("__doc"))
    parsed = here.select(
        *keys,
        page,
        F.col("__doc.results").alias("__results"),
        (F.coalesce(F.size("__doc.results"), F.lit(0)) > 0).alias("__filled"),
        (F.coalesce(F.length("__doc.next"), F.lit(0)) > 0).alias("__more"),
    )
    parsed = stabilise(parsed, "pages")
    stops = _stops(parsed, keys, page, start_page)
    read = parsed.where("__filled").select(*keys, page, "__results")
    if source:
        kept = null_safe_join(read, stops, keys).where(F.col(page) < F.col("__stop"))
    else:
        kept = read.where(F.col(page) < stops.select("__stop").scalar())
    return kept.select(*keys, page, F.explode("__results").alias("__record")).select(*keys, page, "__record.*")
