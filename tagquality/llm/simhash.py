"""SimHash near-duplicates: fingerprints of word shingles, linked by meet-in-the-middle ball hashing.

Two fingerprints within 3 bits meet in a variant that is within 1 bit of one and within
2 bits of the other. Bits of difference are odd in number only between fingerprints of
unlike parity, so that it is enough if all emit their variants within 1 bit, and those
of odd parity also the ones at 2 bits. The shuffle is on the leading bits of the variants:
a fingerprint goes once to each bucket that its variants fall into, and the variants
themselves are made there, block by block.

`drop_near_duplicates` goes by sets of five-word shingles that are alike to 0.8 at least, and finds every such pair or
connects its ends through others. First, sets that have 32 bits of a SimHash in common are compared: most near copies are connected
by that, at eight rows a set. Then the rest is found by prefixes: under one order of all shingles, two sets of that likeness share
one of the first fifth of each, and more of somewhat longer prefixes. Shingles that are common in a sample come last in the order, which only decides how many
sets share one. Bounds that hold for every pair (sizes; parities of hashed shingles) part most pairs before their shingles are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagquality.llm.common import components, fresh, least_connected, make_room, sized, written
from tagquality.llm.phrases import Block
from tagquality.plans.joins import lookup_join, payload_bytes, spread_join

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Leading bits tried in turn, until no bucket has more fingerprints of its own than BUCKET.
BUCKET_BITS = (8, 12, 16, 20)
BUCKET = 20_000
#: Sides of a join that are broadcast: the driver builds each, and what it built goes only with its next collection.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Near duplicates: words of a shingle, least likeness of two sets of shingles, bits and number of tables, and
#: the bits of all tables in which a pair may differ to be looked at by its shingles at first.
NEAR_WORDS = 5
LIKENESS = 0.8
TABLE_BITS = 32
TABLES = 8
MOST_APART = 64
#: One row in so many is counted to learn which shingles are common, and so many of these are known to a task.
#: They only order the shingles; any order gives the same pairs.
COUNTED_ROWS = 16
MOST_COMMON = 1 << 17
#: One of so many of a set's shingles more than the fewest go into its prefix, so that as many must be shared.
SHARED_PART = 20
#: Words of 64 bits of a set's parities.
PARITY_WORDS = 4
#: Sets of one shingle that a task compares with as many others at once.
TILE = 256
#: Words of a text that are worked at once.
TEXT_WORDS = 50_000
#: Fingerprints whose outer variants are made at once in a task.
BLOCK = 512

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(raw: bytes) -> int:
    """64 bits, each set in over half the hashes of the shingles; 0 without words.

    Words are runs of bytes other than space and 0x09-0x0D, lower-cased in A-Z. Repeated
    shingles count each time; a text of fewer words than a shingle is one shingle.
    """
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        hash64 = xxhash.xxh64_intdigest
        spans = zip(begins[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        hashes = np.array([hash64(joined[s:e], SEED) for s, e in spans], dtype=np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        block = hashes[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raws = batch.column("text").cast(pa.binary()).to_pylist()
        found = np.array([fingerprint(raw or b"") for raw in raws], dtype=np.uint64).view(np.int64)
        columns = [batch.column("doc_id"), batch.column("th"), pa.array(found, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, th, fp) of each row, th a hash of the text; a text that is null counts as empty."""
    text_hash = F.xxhash64("text").alias("th")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash, "text")
    return rows.mapInArrow(_fingerprints, "doc_id long, th long, fp long")


def _flips(bits: int, most: int) -> list[list[int]]:
    """Masks over `bits` bits, by the number of set bits from 0 to `most`."""
    return [[sum(1 << b for b in c) for c in combinations(range(bits), k)] for k in range(most + 1)]


def _pairs_in(bucket: int, fps: np.ndarray, bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (u, v) in `fps`, distinct and sorted, whose fingerprints are within RADIUS bits.

    Of fingerprints that share a variant each is paired with the least one, so that pairs connect all
    that are near through others and are no more than the variants.
    """
    rest = width - bits
    one, two = (np.array(x, dtype=np.uint64) for x in _flips(rest, 2)[1:])
    low = np.uint64((1 << rest) - 1)
    prefix = np.uint64(bucket)
    value = (prefix << np.uint64(rest)) | (fps & low)
    used = np.bitwise_count((fps >> np.uint64(rest)) ^ prefix)
    own, near = np.flatnonzero(used == 0), np.flatnonzero(used == 1)
    # Variants within one bit, each with the least of its fingerprints.
    inner = np.concatenate([value[own], value[near], (value[own][:, None] ^ one).ravel()])
    whose = np.concatenate([own, near, np.repeat(own, len(one))])
    order = np.lexsort((whose, inner))
    inner, whose = inner[order], whose[order]
    first = np.flatnonzero(np.concatenate(([True], inner[1:] != inner[:-1]))[: len(inner)])
    met, least = inner[first], whose[first]
    links = [(whose, np.repeat(least, np.diff(np.append(first, len(inner)))))]
    # Variants at two bits of those of odd parity, looked up among the former.
    odd = (np.bitwise_count(fps) & 1) == 1
    for step, masks in ((0, two), (1, one), (2, np.zeros(1, np.uint64))):
        rows = np.flatnonzero(odd & (used == step))
        for k in range(0, len(rows) if len(met) else 0, BLOCK):
            part = rows[k : k + BLOCK]
            outer = (value[part][:, None] ^ masks).ravel()
            at = np.minimum(np.searchsorted(met, outer), len(met) - 1)
            hit = np.flatnonzero(met[at] == outer)
            pair = np.unique(part[hit // len(masks)] * len(fps) + least[at[hit]])
            links.append((pair // len(fps), pair % len(fps)))
    u, v = (np.concatenate(x) for x in zip(*links, strict=True))
    kept = (u != v) & (np.bitwise_count(fps[u] ^ fps[v]) <= RADIUS)
    return u[kept], v[kept]


def _linker(bits: int):
    """For one bucket, a spanning forest of its fingerprints as rows (a, b)."""

    def link(table: pa.Table) -> pa.Table:
        fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
        u, v = _pairs_in(table.column("bucket")[0].as_py(), fps, bits, 64)
        root = least_connected(u, v, len(fps))
        moved = np.flatnonzero(root != np.arange(len(fps)))
        ends = [fps[moved].view(np.int64), fps[root[moved]].view(np.int64)]
        return pa.table([pa.array(x, pa.int64()) for x in ends], names=["a", "b"])

    return link


def _spread(fps: DataFrame, own, bits: int):
    """The buckets of the variants of each fingerprint `fp`, whose leading bits are `own`."""
    masks = _flips(bits, 2)
    near, all_masks = masks[0] + masks[1], sum(masks, [])
    spread = F.when(F.bit_count("fp") % 2 == 1, F.array(*map(F.lit, all_masks)))
    spread = spread.otherwise(F.array(*map(F.lit, near)))
    return F.explode(F.transform(spread, lambda m: own.bitwiseXOR(m.cast("long"))))


def _bucket_bits(fps: DataFrame, width: int, keys: list[str], tried: tuple[int, ...], most: int) -> int:
    """The first of `tried` leading bits with which no bucket has more than `most` fingerprints of its own, else the last."""
    for bits in tried:
        own = F.shiftrightunsigned("fp", width - bits)
        largest = fps.groupBy(*keys, own.alias("k")).count().agg(F.max("count")).first()[0] or 0
        if largest <= most:
            break
    return bits


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints `fp` within RADIUS bits of each other."""
    bits = _bucket_bits(fps, 64, [], BUCKET_BITS, BUCKET)
    own = F.shiftrightunsigned("fp", 64 - bits)
    spread = fps.select("fp", _spread(fps, own, bits).alias("bucket"))
    return spread.groupBy("bucket").applyInArrow(_linker(bits), "a long, b long")


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, fp), and their distinct fingerprints as (fp, root)."""
    rows = written(fingerprints(docs), "fingerprints")
    nodes = rows.select("fp").distinct()
    roots = components(links(nodes)).withColumnRenamed("node", "fp")
    return rows, nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs` (doc_id, text).

    A component holds all rows whose fingerprints are linked, directly or through others;
    its id is its smallest doc_id (null if it has none). Null and empty texts have the
    fingerprint zero. Rows are kept as often as they occur; other columns are ignored.
    """
    rows, nodes = _rooted(docs)
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(nodes, "fp")
    least = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = nodes.join(least, "root").select("fp", "component_id")
    found = rows.join(named, "fp", "left")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_WHITE = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_SEEDS = np.array([0x9E3779B97F4A7C15 * k & (1 << 64) - 1 for k in (1, 2, 3, 4)], np.uint64)


def shingle_hashes(raws: list[bytes]) -> list[np.ndarray]:
    """For each text the distinct hashes of its shingles of NEAR_WORDS words, sorted.

    Words are those of `fingerprint`; a text of fewer words is one shingle, one without words has none.
    """
    found: list[list[np.ndarray]] = [[] for _ in raws]
    parts: list[tuple[bytes, int, int]] = []
    size = 0

    def flush() -> None:
        block = Block(parts)
        prints, where = block.prints(NEAR_WORDS, np.zeros(len(raws), np.uint64)), block.whole(NEAR_WORDS)
        rows, prints = block.row[: len(where)][where], prints[where]
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for k, mine in zip(rows[np.r_[0, cuts]].tolist() if len(rows) else [], np.split(prints, cuts), strict=False):
            found[k].append(mine)

    for k, raw in enumerate(raws):
        raw = raw.translate(_WHITE)
        words = raw.split()
        if not words:
            continue
        if len(words) < NEAR_WORDS:
            found[k].append(np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64))
            continue
        for begin in range(0, len(words) - NEAR_WORDS + 1, TEXT_WORDS):
            part = b" ".join(words[begin : begin + TEXT_WORDS + NEAR_WORDS - 1])
            parts.append((part, 0, k))
            size += len(part)
            if size >= 1 << 18:
                flush()
                parts.clear()
                size = 0
    if parts:
        flush()
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in found]


def signature(hashes: np.ndarray) -> np.ndarray:
    """Four words of 64 bits, each set in over half the mixed hashes."""
    counts = np.zeros(256, np.int64)
    for k in range(0, len(hashes), 1 << 13):
        mixed = hashes[k : k + (1 << 13), None] ^ _SEEDS
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        mixed ^= mixed >> np.uint64(32)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(len(mixed), 32), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")


def parities(hashes: np.ndarray) -> np.ndarray:
    """Bits that say which places odd numbers of hashes fall on: two sets differ in at least as many hashes as bits."""
    places = ((hashes * _SEEDS[0]) >> np.uint64(64 - (PARITY_WORDS * 64).bit_length() + 1)).astype(np.int64)
    odd = np.bincount(places, minlength=PARITY_WORDS * 64) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<u8")


def prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first of a set's sorted hashes, by their counts and then themselves.

    Of n hashes at most (1 - LIKENESS) * n are missing in a set that is alike. With n / SHARED_PART and one more than these, two
    sets that are alike have as many in common there as the smaller of them has more.
    """
    if not len(hashes):
        return hashes
    most = math.floor(len(hashes) * (1 - LIKENESS) + 1e-6) + len(hashes) // SHARED_PART + 1
    if not len(common):
        return hashes[:most]
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    return hashes[np.argsort(np.where(common[at] == hashes, counts[at], 0), kind="stable")[:most]]


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make_room()
    for batch in batches:
        sets = shingle_hashes([raw or b"" for raw in batch.column("text").cast(pa.binary()).to_pylist()])
        for found in sets:
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["t"])


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, in order, that more than one of the counted rows have, and their counts; the most frequent of them."""
    counted = docs.where(F.pmod(F.xxhash64("row"), F.lit(COUNTED_ROWS)) == 0).select("text")
    counts = counted.mapInArrow(_shingles, "t long").groupBy("t").agg(F.count("*").alias("n")).where("n > 1")
    found = counts.orderBy(F.desc("n"), "t").limit(MOST_COMMON).toArrow()
    hashes = found.column("t").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


_SIGNS = [f"s{k}" for k in range(4)]
_PARITIES = [f"p{k}" for k in range(PARITY_WORDS)]


def _signer(common):
    """The class of a row, a hash of its set of shingles, with size, signature, parities and prefix of the set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            sets = shingle_hashes([raw or b"" for raw in batch.column("text").cast(pa.binary()).to_pylist()])
            classes = np.array([np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), "<i8") for x in sets]).reshape(-1, 2)
            signed = np.array([np.concatenate([signature(x), parities(x)]) for x in sets], np.uint64)
            signed = signed.reshape(-1, 4 + PARITY_WORDS).view(np.int64)
            first = pa.array([prefix(x, *common.value).view(np.int64) for x in sets], pa.list_(pa.int64()))
            columns = [batch.column("row"), batch.column("id"), *(pa.array(classes[:, k].copy()) for k in (0, 1))]
            columns += [pa.array([len(x) for x in sets], pa.int32()), first]
            columns += [pa.array(signed[:, k].copy()) for k in range(signed.shape[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "c1", "c2", "n", "first", *_SIGNS, *_PARITIES])

    return sign


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make_room()
    for batch in batches:
        sets = shingle_hashes([raw or b"" for raw in batch.column("text").cast(pa.binary()).to_pylist()])
        lists = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), lists], names=["node", "set"])


def near_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of `classes` (node, s0 to s3) that are neighbours in a table and differ in at most MOST_APART bits.

    Nodes of one fingerprint are a chain, so that pairs grow with the nodes.
    """
    words = [F.col(f"s{t // 2}") for t in range(TABLES)]
    halves = [F.shiftrightunsigned(w, TABLE_BITS) if t % 2 else w.bitwiseAND(F.lit((1 << TABLE_BITS) - 1)) for t, w in enumerate(words)]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), h.alias("fp")) for t, h in enumerate(halves)])
    held = classes.select("node", *_SIGNS, F.inline(tables))
    chain = Window.partitionBy("t", "fp").orderBy(*_SIGNS, "node")
    met = held.select(F.col("node").alias("a"), *_SIGNS, F.lead(F.struct("node", *_SIGNS)).over(chain).alias("next"))
    apart = sum(F.bit_count(F.col(s).bitwiseXOR(F.col(f"next.{s}"))) for s in _SIGNS)
    met = met.where(F.col("next").isNotNull() & (apart <= MOST_APART)).select("a", F.col("next.node").alias("b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible(a: Column, b: Column) -> Column:
    """Whether sets of these sizes and parities may be alike: false for no pair that is."""
    most = F.least(a["n"], b["n"]) + 1e-6 >= LIKENESS * F.greatest(a["n"], b["n"])
    apart = sum(F.bit_count(a[p].bitwiseXOR(b[p])) for p in _PARITIES)
    return most & (apart <= (a["n"] + b["n"]) * ((1 - LIKENESS) / (1 + LIKENESS)) + 1e-6)


def buckets(classes: DataFrame) -> DataFrame:
    """(t, node, set) of each shingle t that begins several of `classes` (node, first, n, parities); set holds size and parities."""
    begun = classes.select(F.explode("first").alias("t"), "node")
    shared = begun.withColumn("c", F.count("*").over(Window.partitionBy("t"))).where("c > 1").select("t", "node")
    held = classes.select("node", F.struct("n", *_PARITIES).alias("set"))
    return lookup_join(written(shared, "shared"), held, ["node"], max_bytes=BROADCAST_BYTES).select("t", "node", "set")


def _pairs_of(met: DataFrame, part: int) -> DataFrame:
    """Pairs (a, b) of `met` (x, y: node and set) that may be alike and meet in one of `part` of the buckets they must share."""
    x, y = F.col("x"), F.col("y")
    met = met.where(_possible(x["set"], y["set"])).select(
        F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b"),
        F.least(x["set"]["n"], y["set"]["n"]).alias("n"),
    )
    met = met.groupBy("a", "b", "n").agg(F.count("*").alias("c"))
    return met.where(F.col("c") * part >= F.floor(F.col("n") / SHARED_PART) + 1).select("a", "b")


def neighbours(held: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that are next to each other in many buckets, in order of size, and may be alike."""
    chain = Window.partitionBy("t").orderBy("set.n", "node")
    row = F.struct("node", "set")
    return _pairs_of(held.select(row.alias("x"), F.lead(row).over(chain).alias("y")).where("y IS NOT NULL"), 2)


def crossing(held: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs (a, b) of nodes of a bucket that have different roots and may be alike.

    The nodes of a bucket are ordered by root and cut into tiles; each goes to the tiles before and behind
    its root's, so that a task holds two tiles of a bucket however large that is.
    """
    named = lookup_join(held, roots.select("node", "root"), ["node"], "left", max_bytes=BROADCAST_BYTES)
    named = named.withColumn("root", F.coalesce("root", "node"))
    several = named.groupBy("t").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("c")).where("low < high")
    placed = lookup_join(named, several.select("t", "c"), ["t"], max_bytes=BROADCAST_BYTES)
    place = F.row_number().over(Window.partitionBy("t").orderBy("root", "node")) - 1
    group = Window.partitionBy("t", "root")
    placed = placed.withColumn("k", place).withColumns({"low": F.min("k").over(group), "high": F.max("k").over(group)})
    tile = lambda x: F.floor(x / TILE).cast("int")
    here, row = tile(F.col("k")), F.struct("node", "root", "set")
    behind = F.explode(F.sequence(tile(F.col("high") + 1), tile(F.col("c") - 1)))
    before = F.explode(F.sequence(F.lit(0), tile(F.col("low") - 1)))
    left = placed.where("high + 1 < c").select("t", here.alias("i"), behind.alias("j"), row.alias("x"))
    right = placed.where("low > 0").select("t", before.alias("i"), here.alias("j"), row.alias("y"))
    return _pairs_of(left.join(right, ["t", "i", "j"]).where(F.col("x.root") < F.col("y.root")), 1)


def _both_ends(pairs: DataFrame, values: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """`pairs` (a, b) with the column `name` of `values` (node, name) for both; its size is measured once."""
    small = payload_bytes(values) <= BROADCAST_BYTES
    for end in ("a", "b"):
        side = values.select(F.col("node").alias(end), F.col(name).alias(f"{name}_{end}"))
        pairs = pairs.join(F.broadcast(side), end, how) if small else spread_join(pairs, side, [end], how)
    return pairs


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose sets (node, set) have at least LIKENESS of their union in common."""
    pairs = _both_ends(pairs, sets, "set")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.where(common >= LIKENESS * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of `pairs` whose ends have different roots; a node without one is its own."""
    pairs = _both_ends(pairs, roots, "root", "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _settled(docs: DataFrame, pairs: DataFrame, edges: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """`edges` with those of `pairs` that are alike, but for pairs that others connect, and the roots of their nodes."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = written(docs.select("row", "text").join(sized(ends, BROADCAST_BYTES), "row").mapInArrow(_sets, "node long, set array<long>"), "sets")
    edges = pairs.limit(0) if edges is None else edges
    roots, left, most = None, pairs, 1
    while roots is None or not left.isEmpty():
        # Each node's first pairs are compared; where they connect, no other pairs between the same two
        # groups need be. The number taken grows, so that rounds are few and every pair is settled.
        ranked = left.withColumn("k", F.row_number().over(Window.partitionBy("a").orderBy("b")))
        found = alike(ranked.where(F.col("k") <= most).drop("k"), sets)
        edges = edges.unionByName(written(found, "alike"))
        roots = written(components(edges), "roots")
        left = written(_apart(ranked.where(F.col("k") > most).drop("k"), roots), "left")
        most *= 8
    return edges, roots


def near_groups(docs: DataFrame) -> DataFrame:
    """(row, id, root) of each row of `docs` (row, id, text): rows of one root are connected by near pairs.

    Two texts are near if their sets of shingles have at least LIKENESS of their union in common; all that are
    have one root. Texts of equal sets are one class, and only one row of each is compared with others.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))
    signs = ", ".join(f"{c} long" for c in [*_SIGNS, *_PARITIES])
    rows = docs.mapInArrow(_signer(common), f"row long, id long, c1 long, c2 long, n int, first array<long>, {signs}")
    rows = written(rows, "signed")
    named = written(rows.groupBy("c1", "c2").agg(F.min("row").alias("node")), "classes")
    nodes = rows.withColumnRenamed("row", "node").join(sized(named.select("node"), BROADCAST_BYTES), "node", "left_semi")
    held = written(buckets(nodes), "buckets")
    edges, roots = _settled(docs, near_pairs(nodes).unionByName(neighbours(held)).distinct(), None)
    edges, roots = _settled(docs, crossing(held, roots), edges)
    named = named.join(sized(roots, BROADCAST_BYTES), "node", "left")
    named = named.select("c1", "c2", F.coalesce("root", "node").alias("root"))
    return lookup_join(rows.select("row", "id", "c1", "c2"), named, ["c1", "c2"], max_bytes=BROADCAST_BYTES).drop("c1", "c2")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of near copies: that with the smallest doc_id, null last.

    See `near_groups`. Texts without a word, null ones too, are one group; of rows that repeat an id any one stays. All columns
    pass through.
    """
    number = fresh(docs, "_row")
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(
        F.col(number).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    )
    groups = near_groups(rows).groupBy("root").agg(F.min(F.struct(F.isnull("id"), "id", "row"))["row"].alias(number))
    return numbered.join(sized(written(groups.select(number), "kept"), BROADCAST_BYTES), number, "left_semi").drop(number)
