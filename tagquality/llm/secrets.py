"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text. The ledger is a table
in the shared folder with a row for each blob and rule version that was scanned; a run
scans only the pairs that it lacks, each blob once, appends them, and joins the findings back to all
paths that hold the blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagquality.llm.common import sized, written

#: The kinds in their order, each with its pattern, the group that must be
#: long enough, and how long. Letters of the key words of `assign` are in either case.
BASE = (
    ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: What this library adds to the base kinds.
ADDED = (
    ("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 36),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
)
RULES = BASE + ADDED
#: Changes with RULES, so that the ledger holds each version's findings apart.
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

LEDGER = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base string, spans string"

_COMPILED = [(k, kind, re.compile(p), group, least) for k, (kind, p, group, least) in enumerate(RULES)]
# No match of a kind is in a text without these; they are only there to skip work.
_FIRST = {"assign": re.compile("[:=]").search, "hex": re.compile("[0-9a-f]{16}").search}
_FIRST |= {"access": re.compile("AKIA").search, "private": re.compile("-----BEGIN ").search}
_FIRST |= {"github": re.compile("gh[pousr]_").search, "jwt": re.compile("eyJ").search}


def spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of kind, end, kind) of all matches that are long enough, in order.

    The matches of a kind are the leftmost that do not overlap; short ones are dropped after.
    """
    found = []
    for k, kind, pattern, group, least in _COMPILED:
        if _FIRST[kind](text):
            hits = pattern.finditer(text)
            found += [(m.start(), k, m.end(), kind) for m in hits if m.end(group) - m.start(group) >= least]
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [kind for kind, *_ in BASE]
    for batch in batches:
        counts: dict[str, list[int]] = {kind: [] for kind in kinds}
        base, every = [], []
        for text in batch.column("text"):
            found = spans(text.as_py() or "")
            named = [(kind, f"{kind}:{start}:{end}") for start, _, end, kind in found]
            for kind in kinds:
                counts[kind].append(sum(x == kind for x, _ in named))
            base.append(",".join(s for x, s in named if x in counts))
            every.append(",".join(s for _, s in named))
        columns = [batch.column("blob"), pa.array([RULE_VERSION] * batch.num_rows, pa.string())]
        columns += [pa.array(counts[kind], pa.int64()) for kind in kinds]
        columns += [pa.array(base, pa.string()), pa.array(every, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["blob", "rule_version", "n_assign", "n_access", "n_hex", "base", "spans"])


def scan_versions(versions: DataFrame, ledger: str) -> DataFrame:
    """(doc_id, blob, counts, base, spans) for each row of `versions` (doc_id, text).

    `ledger` is the path of the ledger, made where there is none; what it lacks is scanned
    and appended. A null text is the empty blob. Rows come out as often as they occur;
    null ids stay null; other columns are ignored.
    """
    spark = versions.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = versions.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    known = _ledger(spark, ledger).where(F.col("rule_version") == RULE_VERSION).select("blob")
    paths = written(rows.select("doc_id", "blob"), "paths")
    # One path stands for each unseen blob; its text is read again rather than shuffled.
    unseen = paths.join(known.distinct(), "blob", "left_anti")
    unseen = written(unseen.groupBy("blob").agg(F.min("doc_id").alias("first")), "unseen")
    mine = rows.join(sized(unseen), ["blob"]).where(F.col("doc_id").eqNullSafe(F.col("first")))
    scanned = mine.select("blob", "text").mapInArrow(_scan, LEDGER)
    scanned.write.mode("append").parquet(ledger)
    # Rows that repeat a path and its text were scanned alike; the ledger's readers take one.
    found = _ledger(spark, ledger).where(F.col("rule_version") == RULE_VERSION).dropDuplicates(["blob"])
    found = written(found.drop("rule_version"), "findings")
    return paths.join(sized(found), "blob").select("doc_id", *found.columns)


def _ledger(spark, path: str) -> DataFrame:
    """The ledger as it is now; empty where there is none yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def findings(versions: DataFrame, ledger: str) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), with base_sha256 over the base spans."""
    found = scan_versions(versions, ledger)
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "blob")
