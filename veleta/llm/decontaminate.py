"""Benchmark decontamination: test items whose five-word runs lie inside documents.

A short item inside a long document has a tiny Jaccard similarity, so no banding over whole
documents can find it. The search is by containment instead: an item's signature holds, for each
of FUNCTIONS hash functions, its run of least hash. That run is a random one of the item's runs,
so a document that contains a share c of them holds it with probability c, however long it is.
Items are partitioned by size; an item needs that a quarter of its signature is found, and that
the document has enough runs to hold it. Candidates are then verified on the runs themselves.
At a containment of 0.8 a candidate is missed with a probability below 10^-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import only
from veleta.session import stabilise

SHINGLE, CONTAINED = 5, 0.8
FUNCTIONS, FOUND = 24, 6
SPACE_RUN = r"[\x20\x09-\x0D]+"


def _words(text: str = "text") -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE_RUN), "")


def _runs(words: str, size: int, of) -> Column:
    """of(i) for the start of every run of `size` words."""
    n = F.size(words)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), of))


def _run_strings(words: str, size: int = SHINGLE) -> Column:
    w = F.col(words)
    return F.array_distinct(_runs(words, size, lambda i: F.concat_ws(" ", *[w[i + k] for k in range(size)])))


def item_runs(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a number of its own), item_id, size (words in a run), runs (distinct) and n_item, for items that have words."""
    own = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    own = own.select("item_id", _words().alias("words")).filter(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(SHINGLE))
    short = F.array(F.concat_ws(" ", "words"))
    runs = F.when(F.size("words") < SHINGLE, short).otherwise(_run_strings("words"))
    each = own.select("item_id", size.alias("size"), runs.alias("runs")).distinct()
    return each.withColumns({"n_item": F.size("runs"), "item": F.monotonically_increasing_id()})


def signatures(runs: DataFrame, exact: bool = False) -> DataFrame:
    """The runs of least hash of every item, each with the number of its hash function; all of its runs with `exact`."""
    each = runs.select("item", "size", "n_item", F.posexplode("runs").alias("at", "run"))
    if exact:
        chosen = each.withColumnRenamed("at", "k")
    else:
        least = each.select("item", "size", "n_item", "run", F.explode(F.sequence(F.lit(1), F.lit(FUNCTIONS))).alias("k"))
        chosen = least.groupBy("item", "size", "n_item", "k").agg(F.min_by("run", F.xxhash64("k", "run")).alias("run"))
    # Sizes in powers of two: the partition of an item, and the least size of a document for it.
    part = F.floor(F.log2("n_item")).cast("int").alias("part")
    return chosen.select("item", "size", "k", part, "n_item", F.xxhash64(F.split("run", " ")).alias("run_hash"))


def _candidates(docs: DataFrame, anchors: DataFrame, sizes: list[int], threshold: float, found_least: int) -> DataFrame:
    found = None
    w = F.col("words")
    for size in sizes:
        hashes = _runs("words", size, lambda i: F.xxhash64(F.slice(w, i + 1, size)))
        rows = docs.select("doc_id", "key", "words").select("doc_id", "key", (F.size("words") - size + 1).alias("n_runs"), F.explode(hashes).alias("run_hash"))
        own = anchors.filter(F.col("size") == size).drop("size")
        hits = rows.join(own, "run_hash").filter(F.col("n_runs") >= threshold * F.pow(F.lit(2), "part"))
        hits = hits.groupBy("doc_id", "key", "item", "k").agg(F.first("n_item").alias("n_item"))
        found = hits if found is None else found.union(hits)
    counted = found.groupBy("doc_id", "key", "item").agg(F.count_distinct("k").alias("hits"))
    return counted.filter(F.col("hits") >= found_least).select("doc_id", "key", "item")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = CONTAINED, exact: bool = False) -> DataFrame:
    """Pairs doc_id, item_id with n_item, n_shared and containment of at least `threshold`.

    Runs are of five words as they stand between ASCII white space; an item of fewer words is one
    run of all its words. NULL and empty texts contain nothing and are contained in nothing. Rows
    that repeat id and text give one pair per item; rows of one id with other texts are searched
    each, NULL ids too; items with a NULL id are found like any other. Other columns are not read.
    Empty tables give no pairs. With `exact` all runs of an item are looked for in place of its
    signature, so that no pair can be missed, at the cost of more candidates.
    """
    source = only(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    runs = stabilise(item_runs(items), "items")
    anchors = stabilise(signatures(runs, exact), "anchors")
    sizes = sorted(r[0] for r in runs.select("size").distinct().collect()) or [SHINGLE]  # five at most
    pairs = stabilise(_candidates(source.withColumn("words", _words()), anchors, sizes, threshold, 1 if exact else FOUND), "candidates")
    named = source.select("doc_id", "key", "text").join(
        pairs.select(F.col("doc_id").alias("id"), "key", "item"), "key"
    ).filter(F.col("doc_id").eqNullSafe(F.col("id"))).drop("id")
    both = named.withColumn("words", _words()).join(runs, "item")
    whole = F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" "))
    long = F.size(F.array_intersect("runs", F.coalesce(_run_strings("words"), F.array().cast("array<string>"))))
    short = F.contains(whole, F.concat(F.lit(" "), F.element_at("runs", 1), F.lit(" "))).cast("int")
    shared = F.when(F.col("size") < SHINGLE, short).otherwise(long)
    out = both.select("doc_id", "key", "item_id", F.col("n_item").cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
    out = out.withColumn("containment", F.col("n_shared") / F.col("n_item")).filter(F.col("containment") >= threshold)
    return out.distinct()


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = CONTAINED) -> DataFrame:
    """The rows of `docs` that contain no item, with the columns they came with.

    NULL, empty and wordless texts contain none and stay; of repeated rows all stay or go; rows
    with a NULL id are judged by their own text. Without items all rows stay.
    """
    dirty = contained_items(docs, items, id_col, text_col, threshold).select(F.col("doc_id").alias("id"), F.col("key")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    left = docs.select(row, F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("key2"))
    return left.join(dirty, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key2") == F.col("key")), "left_anti").select("row.*")


# Exact containment of every pair, for DuckDB.
SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM benchmark
), d AS (
  SELECT DISTINCT doc_id, array_to_string(words[k:k+4], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS k FROM w WHERE len(words) >= 5)
), r AS (
  SELECT DISTINCT item_id, array_to_string(words[k:k+4], ' ') AS run
  FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS k FROM i WHERE len(words) >= 5)
), n AS (SELECT item_id, count(*) AS n_item FROM r GROUP BY item_id)
SELECT d.doc_id, r.item_id, n.n_item, count(*) AS n_shared, count(*) / n.n_item AS containment
FROM r JOIN d USING (run) JOIN n USING (item_id)
GROUP BY d.doc_id, r.item_id, n.n_item HAVING count(*) / n.n_item >= 0.8
"""
