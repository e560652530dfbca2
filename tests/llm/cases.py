"""Rows that every operator has to bear: NULLs, empty and very long texts, ties, repeats, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that operators use for what they add.
        *[T.StructField(n, T.StringType()) for n in ("row", "key", "words", "score", "node", "id", "n_removed", "shard", "Slot", "spans", "row_number")],
    ]
)
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank. It never looks back at the dog. "
TEXTS = [
    (1, PROSE * 3), (2, PROSE * 3), (2, PROSE * 3), (3, None), (4, ""), (None, PROSE), (None, None), (5, " \n\t "),
    (6, "one two"), (7, "é ü 日本語 🙂 naïve " * 30), (8, "word " * 20_000), (9, " ".join(f"w{i}" for i in range(5000))),
    (10, "x" * 100_000), (11, "A|B #tag $5 50% & <b>\n" * 4),
]


def documents(spark):
    rows = [(i, t, *["clash"] * (len(SCHEMA) - 2)) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (None, 1, 1), (9, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def items(spark):
    return spark.createDataFrame(
        [(1, "fox jumps over the lazy dog near the old river bank."), (2, "one two"), (3, ""), (4, None), (None, "w7 w8 w9 w10 w11 w12"), (5, "not in any of them at all")],
        "item_id long, text string",
    )
