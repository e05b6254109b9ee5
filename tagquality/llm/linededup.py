"""Line dedup: a suffix array over line ids by prefix doubling; later copies of repeated runs go.

A document is the sequence of its lines that have a word. Suffixes are ranked by their
first line, then by pairs of ranks, so that each round doubles the lines they are sorted
by; only suffixes that still share their interval with another go on. An interval of the
array at depth L holds the places where one run of L lines occurs. A run is repeated if
it has MIN_WORDS words, and its places but the first are later copies. A line of such a
run is in the shortest run with so many words that begins at a line of it or in the
shortest that ends at one: where fewer words than that are left behind the line, they are
in front of it. Both kinds have at most MIN_WORDS lines, so that ranks to that depth
suffice, and maximal runs are the unions of the runs of both kinds. The runs that begin
alone do not reach the last lines of a maximal run, as the run that begins there goes on
past its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tagquality.llm.common import fresh, make_room, scratch, sized, written

MIN_WORDS = 10
#: The n places of one run are dealt to sqrt(n / CHUNK) groups when they are compared with the first of them.
CHUNK = 64

_LINES = "ord long, th long, row long, i int, need int, most int, h1 long, h2 long"


def _line_rows(min_words: int, whole: bool):
    """Lines with `need`, the lines of the shortest run that begins there (0 if there is none), and
    `most`: runs of need to most lines are the shortest that end at their last lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            prints: list[bytes] = []
            counts: list[int] = []
            needs: list[np.ndarray] = []
            mosts: list[np.ndarray] = []
            if not batch.num_rows:
                continue
            for text in batch.column("text"):
                sizes = []
                for line in (text.as_py() or "").split("\n"):
                    if n := len(line.split()):
                        sizes.append(n)
                        prints.append(xxhash.xxh3_128_digest(line.strip().encode()))
                n = len(sizes)
                total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                end = np.searchsorted(total, total[:-1] + min_words)
                need = np.where(end <= n, end - np.arange(n), 0)
                # Runs from a line end in no shorter one as long as the lines after it lack the words.
                most = np.maximum(need, np.append(end[1:], n + 1)[:n] - 1 - np.arange(n)) if whole else need
                needs.append(need)
                mosts.append(np.where(need > 0, most, 0))
                counts.append(n)
            halves = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2)
            keys = [np.repeat(batch.column(c).to_numpy(), counts) for c in ("ord", "th", "row")]
            place = np.concatenate([np.arange(n) for n in counts]).astype(np.int32)
            columns = [*keys, place, *(np.concatenate(x).astype(np.int32) for x in (needs, mosts)), halves[:, 0].copy(), halves[:, 1].copy()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["ord", "th", "row", "i", "need", "most", "h1", "h2"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """(ord, th, row, text): rows in the order of doc_id (null last), then of a hash of the text."""
    last = F.lit((1 << 63) - 1)
    order = F.coalesce(F.col("doc_id").cast("long"), last)
    text = F.col("text").cast("string").alias("text")
    return docs.select(order.alias("ord"), F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("row"), text)


def _refined(keys: DataFrame, by: list[str]) -> DataFrame:
    """Rows of `keys` (rank, `by`, n) with `refined`: the place in the array at which each begins.

    `rank` is where the interval of the row begins so far and n how many suffixes the row
    stands for. Rows are dealt by range, so that an interval of any size is spread over
    many tasks; an interval that crosses ranges goes on from what earlier ranges hold of it.
    """
    spread = keys.repartitionByRange("rank", *by).withColumn("part", F.spark_partition_id())
    spread = written(spread, "ranges")
    inside = Window.partitionBy("part", "rank").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = spread.groupBy("rank", "part").agg(F.sum("n").alias("held"))
    before = held.select("rank", "part", F.coalesce(F.sum("held").over(across), F.lit(0)).alias("before"))
    local = F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = spread.withColumn("local", local).join(before, ["rank", "part"])
    return placed.select("rank", *by, "n", (F.col("rank") + F.col("before") + F.col("local")).alias("refined"))


def suffix_levels(lines: DataFrame, depth: int) -> dict[int, DataFrame]:
    """By power of two up to `depth`: (ord, th, i, need, most, rank, n) of the suffixes that share
    so many first lines with another; n is the size of their interval, rank its begin."""
    first = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).withColumn("rank", F.lit(0).cast("long"))
    ranked = _refined(first, ["h1", "h2"]).where("n > 1").select("h1", "h2", "n", F.col("refined").alias("rank"))
    held = lines.join(ranked, ["h1", "h2"]).select("ord", "th", "i", "need", "most", "rank", "n")
    levels = {1: written(held, "level")}
    k = 1
    while 2 * k <= depth:
        now = levels[k].select("ord", "th", "i", "need", "most", "rank")
        later = now.select("ord", "th", (F.col("i") - k).alias("i"), F.col("rank").alias("next"))
        pairs = written(now.join(later, ["ord", "th", "i"]), "pairs")
        counted = pairs.groupBy("rank", "next").agg(F.count("*").alias("n"))
        # An interval splits only where its suffixes go on in several ways; else it stays as it is.
        ranked = _refined(counted, ["next"]).where("n > 1")
        held = pairs.join(ranked.select("rank", "next", "n", "refined"), ["rank", "next"])
        held = held.select("ord", "th", "i", "need", "most", F.col("refined").alias("rank"), "n")
        k *= 2
        levels[k] = written(held, "level")
    return levels


def _single(lines: DataFrame) -> DataFrame:
    """`lines` of one row of each document; the others that repeat its id and text go."""
    rows = lines.where("i = 0").groupBy("ord", "th").agg(F.min("row").alias("kept"), F.count("*").alias("n"))
    repeated = written(rows.where("n > 1").drop("n"), "repeated")
    if repeated.isEmpty():
        return lines.drop("row")
    return lines.join(sized(repeated), ["ord", "th"], "left").where("kept is null or row = kept").drop("row", "kept")


def _later(runs: DataFrame) -> DataFrame:
    """The rows of `runs` (rank, tail, need, n, place) whose place is not the first of their run.

    n bounds the places of a run. They are dealt to as many groups as a root of n, each with
    the first place beside it, so that neither a group nor the list of groups grows with n itself.
    """
    run = ["rank", "tail", "need"]
    chunks = F.ceil(F.sqrt(F.col("n") / CHUNK))
    least = runs.groupBy(*run).agg(F.min("place").alias("least"), F.max("n").alias("n"))
    dealt = F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk")
    least = least.select(*run, "least", dealt)
    chunk = F.pmod(F.xxhash64("place"), chunks).alias("chunk")
    return runs.select("*", chunk).join(least, [*run, "chunk"]).where("place > least")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = True) -> DataFrame:
    """(ord, th, runs) by document: the runs (i, need) of lines that are later copies."""
    lines = written(_keyed(docs).mapInArrow(_line_rows(min_words, whole), _LINES), "lines")
    levels = suffix_levels(_single(lines), min_words)
    path = scratch(docs.sparkSession, "copies")
    for k, level in levels.items():
        # A run of `need` lines, k <= need < 2k, is the pair of its first and its last k lines.
        begins = level.where((F.col("need") > 0) & (F.col("need") < 2 * k) & (F.col("most") >= k))
        sizes = F.sequence(F.greatest("need", F.lit(k)), F.least("most", F.lit(2 * k - 1)))
        begins = begins.select("ord", "th", "i", "rank", "n", F.explode(sizes).alias("need"))
        exact = begins.where(F.col("need") == k).withColumn("tail", F.col("rank"))
        ends = level.select("ord", "th", F.col("i").alias("at"), F.col("rank").alias("tail"), F.col("n").alias("ending"))
        longer = begins.where(F.col("need") > k).withColumn("at", F.col("i") + F.col("need") - k)
        longer = longer.join(ends, ["ord", "th", "at"]).withColumn("n", F.least("n", "ending")).drop("at", "ending")
        runs = exact.unionByName(longer).withColumn("place", F.struct("ord", "th", "i"))
        _later(runs).select("ord", "th", "i", "need").write.mode("append").parquet(path)
    copies = docs.sparkSession.read.schema("ord long, th long, i int, need int").parquet(path)
    return copies.groupBy("ord", "th").agg(F.collect_list(F.struct("i", "need")).alias("runs"))


def _cut(text: str, runs: list[dict]) -> tuple[str, int, int]:
    """The text without the lines of `runs`, its lines with a word, and how many of them went."""
    lines = (text or "").split("\n")
    places = [k for k, line in enumerate(lines) if line.split()]
    gone = np.zeros(len(places) + 1, np.int64)
    for run in runs:
        gone[run["i"]] += 1
        gone[run["i"] + run["need"]] -= 1
    lost = {places[k] for k in np.flatnonzero(np.cumsum(gone)[:-1])}
    return "\n".join([x for k, x in enumerate(lines) if k not in lost]), len(places), len(lost)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = True) -> DataFrame:
    """`docs` (doc_id, text, others) without later copies, with n_lines and n_removed.

    A run of lines with at least `min_words` words stays where it occurs first, by doc_id
    (null last), then by a hash of the text, then by line; elsewhere its lines go. With
    `whole` these are all such runs, to their last line; without it only the shortest that
    begin at a line, so that the last lines of a longer one stay where fewer words are left.
    Lines are compared without white space at their ends; lines without a word are no part
    of a run and stay. Rows with the same doc_id and text are one document and stay alike.
    A null text stays null and has no lines. Other columns pass through.
    """
    names = {c: fresh(docs, c) for c in ("_ord", "_th", "_runs", "n_lines", "n_removed")}
    runs = repeated_runs(docs.select("doc_id", "text"), min_words, whole)
    runs = runs.withColumnsRenamed({"ord": names["_ord"], "th": names["_th"], "runs": names["_runs"]})
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    same = (key == F.col(names["_ord"])) & (F.xxhash64(F.col("text").cast("string")) == F.col(names["_th"]))
    joined = docs.join(sized(written(runs, "runs")), same, "left").drop(names["_ord"], names["_th"])
    counts = [StructField(names[c], IntegerType()) for c in ("n_lines", "n_removed")]
    schema = StructType([*docs.schema.fields, *counts])

    columns_in, runs_in = docs.columns, names["_runs"]
    columns_out = [*columns_in, names["n_lines"], names["n_removed"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            texts, lines, removed = [], [], []
            for text, cut in zip(batch.column("text"), batch.column(runs_in), strict=True):
                text, cut = text.as_py(), cut.as_py()
                if cut:
                    text, n, gone = _cut(text, cut)
                else:
                    n, gone = sum(1 for x in (text or "").split("\n") if x.split()), 0
                texts.append(text)
                lines.append(n)
                removed.append(gone)
            kept = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns_in]
            columns = [*kept, pa.array(lines, pa.int32()), pa.array(removed, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=columns_out)

    return joined.mapInArrow(run, schema)
