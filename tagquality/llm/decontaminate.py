"""Benchmark decontamination: short test items found inside documents of any length.

The items are partitioned by size. An item of n shingles is held by a document if at least
ceil(0.8 n) of them are, so that at most n - ceil(0.8 n) are missing: of the n - ceil(0.8 n) + 1
shingles of least hash one must be there. That many MinHash values are the item's
sketch; all that a document shares with an item is found through it, however long the
document. Candidates are verified by counting the shingles themselves. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagquality.llm.common import fresh, sized, written

SHINGLE = 5
CONTAINMENT = 0.8


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and numbers."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _at(words: Column, size: int, join: bool) -> Column:
    """Shingles of `size` words, as hashes or, with `join`, as texts; none if there are fewer words."""
    def shingle(i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(size)]
        return F.concat_ws(" ", *parts) if join else F.xxhash64(*parts)

    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), shingle))


def _items(items: DataFrame) -> DataFrame:
    """(item_id, size, n, shingle, h) for each distinct shingle of an item.

    An item of fewer words than a shingle is one shingle of all its words. Repeated rows
    of an id with the same text are one item; texts that share an id are one item, too,
    and the id is found if any of them is.
    """
    words = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    words = words.select("item_id", F.xxhash64("text").alias("part"), _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(SHINGLE))
    cases = F.lit(None)
    hashed = F.lit(None)
    for k in range(1, SHINGLE + 1):
        cases = F.when(size == k, _at(F.col("w"), k, True)).otherwise(cases)
        hashed = F.when(size == k, _at(F.col("w"), k, False)).otherwise(hashed)
    pairs = F.array_distinct(F.arrays_zip(cases.alias("shingle"), hashed.alias("h")))
    rows = words.select("item_id", "part", size.alias("size"), pairs.alias("s")).withColumn("n", F.size("s"))
    return rows.select("item_id", "part", "size", "n", F.inline("s"))


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, n_shingles, n_found, containment) of the documents that hold an item.

    A document is a pair of doc_id, which may be null, and text (th is the text's hash).
    Repeated rows of it give one row. Null and empty texts hold nothing, and items without
    a word are held by nothing. Where texts share an item_id, the one held best is given.
    """
    parts = written(_items(items), "items")
    need = F.ceil(F.round(F.col("n") * CONTAINMENT, 6))
    by_hash = Window.partitionBy("item_id", "part").orderBy("h", "shingle")
    sketch = parts.withColumn("place", F.row_number().over(by_hash))
    sketch = written(sketch.where(F.col("place") <= F.col("n") - need + 1), "sketch").select("item_id", "part", "size", "n", "h")
    # One row for each number of words from 1 to SHINGLE: no larger value is in a sketch.
    bounds = sketch.groupBy("size").agg(F.max("h").alias("top")).collect()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    words = docs.select("doc_id", "th", _words(F.col("text")).alias("w"))
    found = None
    for size, top in bounds:
        own = sketch.where(F.col("size") == size)
        rows = words.select("doc_id", "th", F.explode(_at(F.col("w"), size, False)).alias("h")).where(F.col("h") <= top)
        hits = rows.join(sized(own), "h").select("doc_id", "th", "item_id", "part", "size", "n")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc_id long, th long, item_id long, part long, size int, n int")
    candidates = written(found.distinct(), "candidates")

    # Verification reads the candidates' documents only, and counts what they share with their items.
    chosen = candidates.select(F.col("doc_id").alias("id"), F.col("th").alias("t"), "size").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (docs["th"] == F.col("t"))
    texts = docs.join(sized(chosen), same).select("doc_id", "th", "size", _words(F.col("text")).alias("w"))
    shingles = F.lit(None)
    for k in range(1, SHINGLE + 1):
        shingles = F.when(F.col("size") == k, _at(F.col("w"), k, True)).otherwise(shingles)
    have = texts.select("doc_id", "th", "size", F.explode(F.array_distinct(shingles)).alias("shingle"))
    wanted = parts.select("item_id", "part", "size", "shingle")
    shared = have.join(sized(wanted), ["size", "shingle"]).distinct()
    counted = shared.groupBy("doc_id", "th", "item_id", "part").agg(F.count("*").alias("n_found"))
    sizes = parts.select(F.col("item_id").alias("i"), F.col("part").alias("p"), "n").distinct()
    counted = counted.join(sized(sizes), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")))
    held = counted.where(F.col("n_found") >= need)
    share = (F.col("n_found") / F.col("n")).alias("containment")
    held = held.select("doc_id", "th", "item_id", F.col("n").cast("long").alias("n_shingles"), "n_found", share)
    best = held.groupBy("doc_id", "th", "item_id").agg(F.max(F.struct("containment", "n_shingles", "n_found")).alias("b"))
    return best.select("doc_id", "th", "item_id", "b.n_shingles", "b.n_found", "b.containment")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the documents that hold an item; other columns pass through."""
    key, hashed = fresh(docs, "_held_id"), fresh(docs, "_held_hash")
    held = contained(docs, items).select(F.col("doc_id").alias(key), F.col("th").alias(hashed)).distinct()
    text = F.col("text").cast("string")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(hashed))
    return docs.join(sized(written(held, "held")), same, "left_anti")
