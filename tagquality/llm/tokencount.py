"""Token counts by a separator scan of flat token files that have no index.

A file is read in blocks, each by any task. In a block a vector comparison finds the
end-of-document ids. What a document holds of earlier blocks follows from the last separator before
the block: a prefix scan over the blocks, which have one small row each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagquality.llm import files
from tagquality.llm.bpe import automaton, load_spec
from tagquality.llm.common import scratch, written

BLOCK_BYTES = 4 * 1024 * 1024
#: Unsigned integers of two bytes, which hold ids below 65,536.
DTYPE = "<u2"
#: Fixed value: the added token whose id ends a document.
END_TOKEN = "<|endoftext|>"
#: A row of the names of a token file: the place of the document in it, whether it has an id, the id, the separator.
NAME = np.dtype([("doc_no", "<i8"), ("held", "u1"), ("doc_id", "<i8"), ("end", DTYPE)])


def end_id(vocabulary: str) -> int:
    """The id that ends a document in the token files of a vocabulary."""
    added = {t["content"]: t["id"] for t in json.loads(load_spec(vocabulary))["added_tokens"]}
    if END_TOKEN not in added:
        raise ValueError(f"the vocabulary has no {END_TOKEN}")
    return added[END_TOKEN]


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end: int) -> None:
    """A flat file of token ids for each partition of `docs`, below `path`/kind=tokens, each document
    followed by `end`, and beside it, below kind=names, a file of the doc_id of each.

    Strings of added tokens in a text are ordinary text, so that `end` only ends documents.
    A task writes both files in one pass and they are committed together, so that they
    agree however often `docs` is planned or a task is repeated.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = automaton(spec.value).encode_all
        done = 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [np.frombuffer(raw, "<u4") for raw in encode(texts, False)]
            if any(len(x) and x.max() > np.iinfo(DTYPE).max for x in ids):
                raise ValueError("an id does not fit the width of the token files")
            n, doc_id = len(ids), batch.column("doc_id")
            names = np.zeros(n, NAME)
            names["doc_no"] = np.arange(done, done + n)
            names["held"] = doc_id.is_valid().to_numpy(zero_copy_only=False)
            names["doc_id"] = doc_id.fill_null(0).to_numpy()
            done += n
            size = NAME.itemsize - NAME["end"].itemsize
            raw = [x.astype(DTYPE).tobytes() for x in ids] + [x.tobytes()[:size] for x in names]
            kinds = ["tokens"] * n + ["names"] * n
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), pa.array(kinds, pa.string())], names=["raw", "kind"])

    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    files.write_flat(held.mapInArrow(run, "raw binary, kind string"), "raw", path, np.array([end], DTYPE).tobytes(), "kind")


def read_names(spark: SparkSession, path: str, block_rows: int = BLOCK_BYTES // NAME.itemsize) -> DataFrame:
    """(path, doc_no, doc_id) of each document in the files of names below `path`."""
    size = block_rows * NAME.itemsize
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    blocks = files.listed(spark, path).where("length > 0 and path like '%/kind=names/%'").select("path", F.explode(starts).alias("start"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.opened(row["path"]) as file:
                    file.seek(row["start"])
                    names = np.frombuffer(file.read(size), NAME)
                n = len(names)
                if not np.array_equal(names["doc_no"], np.arange(n) + row["start"] // NAME.itemsize):
                    raise ValueError("the rows of a file of names are not in the order of the documents")
                doc_id = pa.array(names["doc_id"].copy(), mask=names["held"] == 0)
                columns = [pa.array([row["path"]] * n, pa.string()), pa.array(names["doc_no"].copy()), doc_id]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "doc_no", "doc_id"])

    return files.dealt(blocks).mapInArrow(scan, "path string, doc_no long, doc_id long")


def count_tokens(spark: SparkSession, path: str, end: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, doc_no, first_token, n_tokens) of each document in the files below `path`, but those of names.

    doc_no counts from 0 in a file, first_token is a place in it. Tokens after the last
    separator are a document of their own; an empty file has none.
    """
    width = np.dtype(DTYPE).itemsize
    size = block_bytes // width * width
    held = files.listed(spark, path).where("path not like '%/kind=names/%'")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    blocks = held.where("length > 0").select("path", "length", F.explode(starts).alias("start"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.opened(row["path"]) as file:
                    file.seek(row["start"])
                    ids = np.frombuffer(file.read(size), DTYPE)
                base = row["start"] // width
                places = np.flatnonzero(ids == end) + base
                if row["start"] + size >= row["length"] and (not len(ids) or ids[-1] != end):
                    places = np.append(places, base + len(ids))
                n = len(places)
                before = pa.array(np.concatenate(([0], places))[:n], pa.int64(), mask=np.arange(n) == 0)
                columns = [pa.array([row["path"]] * n, pa.string()), pa.array(np.full(n, row["start"]))]
                columns += [pa.array(np.arange(n)), pa.array(places, pa.int64()), before]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "start", "k", "place", "before"])

    ends = files.dealt(blocks).mapInArrow(scan, "path string, start long, k long, place long, before long")
    ends = written(ends, "separators")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sums = ends.groupBy("path", "start").agg(F.max("place").alias("last"), F.count("*").alias("n"))
    carried = sums.select(
        "path", "start", F.max("last").over(earlier).alias("last"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("docs")
    )
    placed = ends.join(carried, ["path", "start"])
    first = F.coalesce(F.col("before"), F.col("last"), F.lit(-1)) + 1
    return placed.select("path", (F.col("docs") + F.col("k")).alias("doc_no"), first.alias("first_token"), (F.col("place") - first).alias("n_tokens"))


def document_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, file_no, doc_no, first_token, n_tokens) of `docs`, through flat token files.

    Token files carry no ids: the n-th document of a file is the n-th of the file of names
    that the same task wrote, and the result ends in an error where one has no other side.
    Null and empty texts have no tokens; rows come out as often as they occur, null ids stay
    null; other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    end = end_id(vocabulary)
    write_token_files(docs, vocabulary, path, end)
    return _named(read_names(spark, path), written(count_tokens(spark, path, end), "counts"))


def _named(names: DataFrame, counts: DataFrame) -> DataFrame:
    file_no = F.regexp_extract("path", r"/part-(\d+)", 1).cast("int").alias("file_no")
    counts = counts.select(file_no, "doc_no", "first_token", "n_tokens")
    names = names.select(file_no, "doc_no", "doc_id", F.lit(True).alias("named"))
    lost = F.raise_error(F.concat(F.lit("a document without a name or tokens in file "), F.col("file_no")))
    n_tokens = F.when(F.col("named") & F.col("n_tokens").isNotNull(), F.col("n_tokens")).otherwise(lost.cast("long"))
    return names.join(counts, ["file_no", "doc_no"], "full").select(
        "doc_id", "file_no", "doc_no", "first_token", n_tokens.alias("n_tokens")
    )
