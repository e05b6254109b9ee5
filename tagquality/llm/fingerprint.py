"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A cell holds a count, the XOR of the digests that hash to it and the XOR of their checks.
The cells of two versions subtract to a sketch of the digests that differ; cells with one
digest give it away, it is taken out of its other cells, and so on until none is left.
Where cells remain, the digests are parted by hash into more sketches, and sketches that
still fail grow with another hash. Higher-order functions of the DataFrame API only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash functions of a digest, each with cells of its own, and cells of each in a sketch.
HASHES = 3
CELLS = 12
#: Digests in a part of a sketch that is parted, about; rounds of peeling; times that cells double.
PART = 12
ROUNDS = 14
RETRIES = 4
#: Rows in a range of ids, about, and most ranges.
RANGE_ROWS = 2048
MAX_RANGES = 1 << 15

#: A paragraph is a line; long lines part after a mark past 120 characters, or at 300.
PARAGRAPH = r"[^\n]{120,299}?[.!?,;:|](?=\s)|[^\n]{1,300}"

_CELLS = "array<struct<cell:int,n:int,key:bigint,check:bigint>>"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of the paragraphs of a text."""
    parts = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("check")), 32)


def _cell(cell: Column, n: Column, key: Column, check: Column) -> Column:
    return F.struct(cell.cast("int").alias("cell"), n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _entries(key: Column, n: Column, salt: int) -> Column:
    """What a digest adds to the sketch, `n` times: an entry for each hash."""
    size = CELLS << salt
    places = [F.pmod(F.xxhash64(key, F.lit(salt * HASHES + j)), F.lit(size)) + j * size for j in range(HASHES)]
    return F.array(*[_cell(place, n, key, _check(key)) for place in places])


def _merged(entries: Column) -> Column:
    """One entry for each cell, in order; empty cells go."""
    def add(cells: Column, e: Column) -> Column:
        last = F.get(cells, F.size(cells) - 1)
        both = _cell(e["cell"], last["n"] + e["n"], last["key"].bitwiseXOR(e["key"]), last["check"].bitwiseXOR(e["check"]))
        rest = F.slice(cells, F.lit(1), F.size(cells) - 1)
        return F.when(last["cell"] == e["cell"], F.array_append(rest, both)).otherwise(F.array_append(cells, e))

    found = F.aggregate(F.array_sort(entries), F.array().cast(_CELLS), add)
    return F.filter(found, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))


def sketch(keys: Column, salt: int = 0) -> Column:
    """The cells of a set of digests."""
    return _merged(F.flatten(F.transform(keys, lambda k: _entries(k, F.lit(1), salt))))


def subtract(a: Column, b: Column) -> Column:
    """The cells of what is in one of two sketches only."""
    return _merged(F.concat(a, F.transform(b, lambda c: _cell(c["cell"], -c["n"], c["key"], c["check"]))))


def peel(cells: Column, salt: int = 0) -> Column:
    """(left, found): the digests that a difference of sketches gives away, and the cells that are left."""
    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["left"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))
        once = F.array_distinct(F.transform(pure, lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))

        def take(keys: Column) -> Column:
            taken = F.flatten(F.transform(keys, lambda k: _entries(k["key"], -k["n"], salt)))
            found = F.concat(state["found"], F.transform(keys, lambda k: k["key"]))
            grown = F.struct(_merged(F.concat(state["left"], taken)).alias("left"), found.alias("found"))
            return F.when(F.size(keys) == 0, state).otherwise(grown)

        return F.when(F.size(state["left"]) == 0, state).otherwise(_bound(once, take))

    start = F.struct(cells.alias("left"), F.array().cast("array<bigint>").alias("found"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step)


def _count(cells: Column, salt: int) -> Column:
    """How many digests the cells give away; null if cells remain."""
    return _bound(peel(cells, salt), lambda s: F.when(F.size(s["left"]) == 0, F.size(s["found"])))


def difference(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """How many digests differ between the sets `a` and `b` with the sketches `cells_a`, `cells_b`."""
    parts = F.ceil((F.size(a) + F.size(b)) / F.lit(PART)).cast("int")

    def of_part(pair: Column) -> Column:
        tries = [_count(subtract(sketch(pair["a"], s), sketch(pair["b"], s)), s) for s in range(1, RETRIES + 1)]
        # Where the largest sketch does not peel either, the digests themselves are compared.
        apart = F.size(F.array_except(pair["a"], pair["b"])) + F.size(F.array_except(pair["b"], pair["a"]))
        return F.coalesce(*tries, apart)

    def parted(n: Column) -> Column:
        def part(r: Column) -> Column:
            own = [F.filter(x, lambda k: F.pmod(k, n) == r).alias(name) for x, name in ((a, "a"), (b, "b"))]
            return _bound(F.struct(*own), of_part)

        return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0), lambda t, x: t + x)

    return F.coalesce(_count(subtract(cells_a, cells_b), 0), _bound(parts, parted))


def likeness(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """Common digests over all digests of both sets; 1 if both are empty."""
    total, d = F.size(a) + F.size(b), difference(a, b, cells_a, cells_b)
    return F.when(total == 0, F.lit(1.0)).otherwise(_bound(d, lambda x: (total - x) / (total + x)))


def shown(cells: Column) -> Column:
    """The cells as text: cell, count, digest and check."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["cell"], c["n"], F.hex(c["key"]), F.hex(c["check"]))), " ")


def with_next(rows: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """`rows` with next_<c> for c in `carried`: the values of the row that follows by `key`, then by
    the carried columns; the first row follows the last.

    Rows go to ranges of `key`; the first row of each range goes to the range before as well,
    where it follows the last row. So each row is shuffled once, and no range is much larger than others.
    """
    total = rows.count()
    count = max(1, min(MAX_RANGES, -(-total // RANGE_ROWS)))
    shares = [k / count for k in range(count)]
    bounds = rows.agg(F.percentile_approx(key, shares, F.lit(max(10_000, 20 * count))).alias("b")).first()["b"]
    bounds = sorted(set(bounds or [0]))
    table = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    place = F.aggregate(
        steps, F.lit(0), lambda at, s: F.when(F.get(table, at + s) <= F.col(key), at + s).otherwise(at)
    )
    rows = rows.withColumn("_range", place)
    own = F.struct(F.col("_range").alias("_at"), F.lit(0).alias("_after"))
    before = F.struct(F.pmod(F.col("_range") - 1, F.lit(len(bounds))).alias("_at"), F.lit(1).alias("_after"))
    copies = F.when(F.get(table, F.col("_range")) == F.col(key), F.array(own, before)).otherwise(F.array(own))
    spread = rows.select("*", F.inline(copies)).drop("_range")
    # One window for all that is carried: each window expression of its own would shuffle the texts again.
    order = Window.partitionBy("_at").orderBy("_after", key, *carried)
    spread = spread.withColumn("_next", F.lead(F.struct(*carried)).over(order)).where("_after = 0")
    return spread.select("*", *[F.col("_next")[c].alias(f"next_{c}") for c in carried]).drop("_at", "_after", "_next")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one that follows by doc_id (null first), then by text; after
    the last comes the first, so that a single document follows itself. A null text is empty. Rows come
    out as often as they occur; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("key"), text.alias("text"))
    pairs = with_next(rows.withColumn("own", digests(F.col("text"))), "key", ["text", "own"])
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.substring("text", F.lit(1), F.length("text") - half)
    pairs = pairs.withColumn("edited", F.concat(head, F.substring("next_text", F.lit(1), half)))
    pairs = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "own",
        digests(F.col("edited")).alias("changed"),
        F.col("next_own").alias("next"),
    )
    pairs = pairs.select("*", *[sketch(F.col(c)).alias(f"{c}_cells") for c in ("own", "changed", "next")])
    near = {c: likeness(*map(F.col, ("own", c, "own_cells", f"{c}_cells"))) for c in ("changed", "next")}
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("own_cells")).alias("fingerprint"),
        shown(F.col("changed_cells")).alias("edited_fingerprint"),
        near["changed"].alias("near_edited"),
        near["next"].alias("near_next"),
    )
