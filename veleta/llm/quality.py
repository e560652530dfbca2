"""Quality rules: counts of every text, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed single words and word pairs: one of a trusted
target (texts labelled good), one of the raw corpus (all texts). A text's score is its sum of
log-ratios over its number of n-grams, in nats; texts at THRESHOLD or above are kept unless a base
rule fails. All of it is DataFrame operations: arrays within a row for what concerns one text, one
map-side combined aggregate per bucket for the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.session import stabilise

BUCKETS = 1 << 14
# Nats per n-gram below which a text is less like the target than the corpus is.
THRESHOLD = -0.08
# Log-ratios are kept as whole millionths, so sums do not depend on the order of adding.
UNIT = 1_000_000
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"


def _places(n: Column, size: int, then) -> Column:
    """Array of then(i) for the starts of all runs of `size` words; empty where there is none."""
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), then)).otherwise(F.array().cast("array<bigint>"))


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row (all columns of docs), text (NULL as empty) and its words, as `parts`."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    return docs.select(row, text).select("row", "text", F.array_remove(F.split("text", SPACE_RUN), "").alias("parts"))


def _single(word: Column) -> Column:
    """Bucket of a word, given its hash."""
    return F.pmod(word, F.lit(BUCKETS))


def _pair(word: Column, following: Column) -> Column:
    """Bucket of two neighbours, given their hashes."""
    return F.pmod(F.xxhash64(F.lit(2), word, following), F.lit(BUCKETS))


def _bucket_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows of words and of pairs by bucket: one row per word, hashed outside of any lambda."""
    p = F.col("parts")
    words = with_words(docs, text_col).select(F.explode(F.arrays_zip(p.alias("a"), F.slice(p, 2, F.size(p)).alias("b"))).alias("x"))
    hashed = words.select(
        F.xxhash64("x.a").alias("a"), F.when(F.col("x.b").isNotNull(), F.xxhash64("x.b")).alias("b")
    )
    both = F.array(_single(F.col("a")), F.when(F.col("b").isNotNull(), _pair(F.col("a"), F.col("b"))))
    grams = hashed.select(F.explode(both).alias("bucket")).filter(F.col("bucket").isNotNull())
    return grams.groupBy("bucket").agg(F.count("*").alias("n"))


def fit_ratio(docs: DataFrame, trusted: DataFrame, text_col: str = "text") -> DataFrame:
    """One row with `ratios`: the log-ratio of each of BUCKETS buckets, in whole millionths.

    Counts cover all texts of both frames. One is added to every raw bucket, and to the target
    BUCKETS n-grams that are spread like the raw corpus, so that buckets of which little is known
    say little; without trusted texts all ratios are zero. NULL and empty texts count nothing,
    repeated rows count each time; empty tables give ratios of zero.
    """
    raw = _bucket_counts(docs, text_col).withColumnRenamed("n", "raw")
    good = _bucket_counts(trusted, text_col).withColumnRenamed("n", "good")
    counts = stabilise(raw.join(good, "bucket", "full").na.fill(0), "buckets")
    whole = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("r"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")).first()
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").na.fill(0)
    share = (F.col("raw") + 1) / (whole["r"] + BUCKETS)
    ratio = F.log((F.col("good") + BUCKETS * share) / ((whole["g"] + BUCKETS) * share))
    pairs = every.select(F.struct("bucket", F.round(ratio * UNIT).cast("long").alias("ratio")).alias("p"))
    ratios = pairs.agg(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["ratio"]).alias("ratios"))
    return stabilise(ratios, "ratios")


def _repeated_words(n: Column, grams: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        at = lambda k: F.get(s, k)["g"]
        twice = F.filter(
            F.transform(s, lambda x, k: F.when((x["g"] == at(k - 1)) | (x["g"] == at(k + 1)), x["i"])), lambda i: i.isNotNull()
        )
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))

    # The sorted array is bound once, as the only element of an array, not once per use.
    slow = F.transform(F.array(placed), covered)[0]
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(slow)


def measure(docs: DataFrame, ratios: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`row` (the document's own columns) and its counts, score and verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score (NULL without
    words) and kept. NULL and empty texts have no words, fail the base rules and are not kept.
    Every row is judged on its own, so repeated rows and ids come out alike; extra columns are
    carried in `row` whatever their names. An empty table gives no rows.
    """
    w, grams, text, parts, n = F.col("words"), F.col("grams"), F.col("text"), F.col("parts"), F.size("words")
    triples = _places(n, 3, lambda i: F.xxhash64(F.lit(3), w[i], w[i + 1], w[i + 2]))
    hashed = with_words(docs, text_col).select(
        "row",
        "text",
        F.length(F.concat_ws("", parts)).cast("long").alias("word_chars"),
        F.transform(parts, lambda x: F.xxhash64(x)).alias("words"),
    )
    base = hashed.select("row", "text", "word_chars", "words", triples.alias("grams"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(WORD_CHAR)))
    # BUCKETS numbers at most, folded into one literal of the plan.
    known = ratios.first()["ratios"]
    weights = F.split(F.lit(" ".join(map(str, known))), " ").cast("array<bigint>")
    weight = lambda bucket: F.get(weights, bucket.cast("int"))
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(0).cast("long"),
        lambda acc, i: acc
        + weight(_single(w[i]))
        + F.when(i + 1 < n, weight(_pair(w[i], w[i + 1]))).otherwise(F.lit(0).cast("long")),
    )
    measures = F.struct(
        n.cast("long").alias("n_words"),
        "word_chars",
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        _repeated_words(n, grams).cast("long").alias("n_repeat_words"),
        F.when(n > 0, total / (2 * n - 1) / UNIT).alias("score"),
    )
    # Behind a generator, a filter on the verdict does not move below and compute all of it again.
    counted = base.select("row", F.explode(F.array(measures)).alias("m")).select("row", "m.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("score") >= threshold, F.lit(False)))


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that `labels` calls good; an id labelled more than once counts once, NULL ids and labels not at all."""
    good = labels.filter("quality = 1").select(F.col(f"`{id_col}`").alias("id")).distinct()
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # The labels grow with the documents, so they are merged at every size and never broadcast.
    return own.join(good.hint("merge"), "id").select("text")
