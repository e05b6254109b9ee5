"""What the operators share: tables in the shared folder, row keys and connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagquality.plans.joins import payload_bytes
from tagquality.plans.session import shared_folder

#: A side of a join is broadcast only if its measured payload is at most this many bytes.
BROADCAST_BYTES = 32 * 1024 * 1024


#: What goes to a Python worker at once: rows and bytes of text.
BATCH_ROWS = 512
BATCH_BYTES = 4 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Small batches for Python workers, and the place of this package on this machine.

    Workers stay alive between stages and keep what their largest batch took, so that
    batches are bounded by bytes. On a cluster the package is shipped as any other
    (`--py-files`); here workers import it from where the driver did.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


#: Functions of other stages whose results a worker keeps between tasks, and the C library's way to return memory.
_KEPT: list = []
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def kept_by_worker(cached):
    """Marks a cached function whose results `make_room` lets go."""
    _KEPT.append(cached)
    return cached


def give_back() -> None:
    """Returns memory that is free, but still held by Arrow and the C library, to the machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def make_room() -> None:
    """Lets go what earlier stages kept in this worker, such as compiled vocabularies; they make it anew if they come back."""
    if any(cached.cache_info().currsize for cached in _KEPT):
        for cached in _KEPT:
            cached.cache_clear()
        gc.collect()
    give_back()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage and outlives executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name near `name` that `df` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sized(side: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`side` marked for broadcast if its measured payload is within the bound, else as it is."""
    return F.broadcast(side) if payload_bytes(side) <= max_bytes else side


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of training; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Edges that a task takes before it replaces what it holds by stars, and rows of these that it gives at once.
EDGES_HELD = 1 << 18
STAR_ROWS = 1 << 14


def least_connected(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of 0..n-1 is connected to by the edges (u, v)."""
    parent = np.arange(n)
    while len(u):
        pu, pv = parent[u], parent[v]
        apart = pu != pv
        u, v, pu, pv = u[apart], v[apart], pu[apart], pv[apart]
        np.minimum.at(parent, np.maximum(pu, pv), np.minimum(pu, pv))
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
    return parent


def _stars(ends: np.ndarray) -> np.ndarray:
    """Edges (2 x n) from the smallest node of each component of the given ones to its others."""
    nodes, at = np.unique(ends, return_inverse=True)
    root = least_connected(*at.reshape(2, -1), len(nodes))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[root[moved]], nodes[moved]])


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) of a task as stars; it holds about as many edges as it has nodes."""
    held, waiting = [np.zeros((2, 0), np.int64)], 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("a", "b")]))
        waiting += batch.num_rows
        if waiting >= max(EDGES_HELD, held[0].shape[1]):
            held, waiting = [_stars(np.concatenate(held, axis=1))], 0
    a, b = _stars(np.concatenate(held, axis=1))
    for k in range(0, len(a), STAR_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + STAR_ROWS]) for x in (a, b)], names=["a", "b"])


def _contracted(edges: DataFrame) -> tuple[DataFrame, bool]:
    """`edges` with those of each task as stars, and whether any task's may touch another's."""
    stars = _proper(edges).mapInArrow(_starred, "a long, b long").withColumn("part", F.spark_partition_id())
    stars = written(stars, "edges")
    parts = stars.agg(F.min("part").alias("low"), F.max("part").alias("high")).first()
    return stars.drop("part"), parts["low"] != parts["high"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b: long) as rows (node, root); roots are nodes.

    Each task connects what it can of its own edges; where one task has them all, that is all. Else
    in each round every node points to the neighbour, or itself, of least random
    priority, and the graph is rewritten between the nodes pointed to. A constant part
    of the nodes goes in each round, on chains as on stars; no neighbourhood is collected.
    """
    edges, several = _contracted(edges)
    steps: list[DataFrame] = []
    while several:
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("p"), F.col(c).alias("v"))  # noqa: E731, B023
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min(order("b")).alias("best"))
        step = step.select(F.col("a").alias("node"), F.least(order("a"), F.col("best"))["v"].alias("root"))
        steps.append(step := written(step, "step"))
        ends = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        others = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(ends, "a").join(others, "b")
        edges, several = _contracted(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    found = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
    while steps:
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = steps.pop().join(later, "root", "left")
        found = found.select("node", F.coalesce("last", "root").alias("root"))
    return found


def _proper(edges: DataFrame) -> DataFrame:
    pair = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.distinct()
