"""Joins of large fact tables with lookups.

A lookup is broadcast only after its payload has been measured. Beyond the bound the
join is shuffled, and the keys that hold far more rows than others are found first, by a
sketch over the facts: their rows are dealt to several tasks, and only their lookup rows are
copied to each of these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# The sketch tracks this many keys and reports at most so many; a key is spread where it holds more than
# a task's fair share of all rows, into parts of a quarter of that share.
TRACKED_KEYS, REPORTED_KEYS = 16_384, 1_024
PARTS_PER_SHARE = 4
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _cell_bytes(field: T.StructField) -> Column:
    cell = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(cell), F.lit(0)) + 16
    if isinstance(field.dataType, _NESTED):
        return F.coalesce(F.octet_length(F.to_json(F.struct(cell))), F.lit(0)) + 64
    return F.lit(16)


def payload_bytes(df: DataFrame) -> int:
    """Bytes held by the rows of `df`, from one distributed aggregate."""
    cells = [_cell_bytes(f) for f in df.schema.fields]
    row_bytes = sum(cells[1:], cells[0]).cast("long")
    return df.agg(F.sum(row_bytes).alias("n")).first()["n"] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join `facts` with `lookup` on equal columns; `how` is `inner`, `left` or `left_semi`.

    Every match is kept, whichever of the physical ways is taken. A stream of facts is not
    looked at beforehand.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported lookup join: {how}")
    if payload_bytes(lookup) <= max_bytes:
        return facts.join(F.broadcast(lookup), on, how)
    if facts.isStreaming:
        return facts.join(lookup, on, how)
    return spread_join(facts, lookup, on, how)


def heavy_keys(facts: DataFrame, on: Sequence[str], tasks: int) -> dict[int, int]:
    """Hashes of the keys that hold more than one of `tasks` shares of the rows, and the parts each is to be cut into.

    One pass over the facts with a sketch of bounded size; null keys are not counted.
    """
    hashes = facts.dropna(subset=list(on)).select(F.xxhash64(*on).alias("h"))
    found = hashes.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(h, {REPORTED_KEYS}, {TRACKED_KEYS})").alias("top"),
    ).first()
    share = max(1.0, found["n"] / tasks)
    return {
        r["item"]: min(PARTS_PER_SHARE * tasks, -(-PARTS_PER_SHARE * r["count"] // int(share)))
        for r in found["top"] or []
        if r["count"] > share
    }


def spread_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A shuffled join in which the rows of heavy keys are dealt to several tasks.

    The part of a row follows from its other columns, so that a task that is run again deals
    alike. Null keys match nothing: their rows leave before the shuffle, and a left join adds
    them afterwards.
    """
    on = list(on)
    spark = facts.sparkSession
    known = facts.dropna(subset=on)
    parts = heavy_keys(known, on, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key, part = F.xxhash64(*on), _free_name("_part", facts, lookup)
    right = lookup.dropna(subset=on)
    if parts:
        number = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        count = F.coalesce(F.try_element_at(number, key), F.lit(1))
        row = F.xxhash64(*[F.col(f"`{f.name}`") for f in facts.schema.fields if not _has_map(f.dataType)])
        known = known.withColumn(part, F.pmod(row, count).cast("int"))
        right = right.withColumn(part, F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
        joined = known.join(right, [*on, part], how).drop(part)
    else:
        joined = known.join(right, on, how)
    if how != "left":
        return joined
    unknown = facts.where(" OR ".join(f"`{c}` IS NULL" for c in on))
    return joined.unionByName(unknown, allowMissingColumns=True)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType | T.VariantType)


def _free_name(name: str, *sides: DataFrame) -> str:
    taken = {c.lower() for side in sides for c in side.columns}
    while name.lower() in taken:
        name += "_"
    return name
