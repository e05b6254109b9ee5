"""Phrase collocation mining by Rabin-Karp fingerprints.

A word's fingerprint is cut out of the prefix polynomial of its text's bytes, a phrase's out
of the prefix polynomial of its words' fingerprints. Fingerprints are counted level by
level: words; pairs of frequent words; phrases of three and more words whose pairs are all frequent,
since a phrase is no more frequent than what it holds. What a level finds frequent goes to the next as
a bit field of bounded size, which lets some others through but loses none. A last scan compares
with the text: occurrences that the bit fields let through are grouped by their words, and only these phrases
are written out, each with its exact count and the first document that it occurs in. Fingerprints that
collide thus never decide a result.

Null texts are empty, a null language is `und`. Words are split by bytes, whatever their alphabet. Rows
that repeat count each time. A text of any length is worked in slices that overlap by the
words of a phrase. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagquality.llm.common import BROADCAST_BYTES, fresh, sized, written
from tagquality.plans.joins import lookup_join

MIN_COUNT = 30
MOST_WORDS = 4
TOP = 2000
#: A candidate goes if a longer one that holds it occurs in at least this percentage of its places.
INSIDE_PERCENT = 80
SCALE = 2_000_000
#: Bytes of text worked at once.
SLICE = 1 << 18
#: Bits of a field, as a power of two: at least, at most, and bits for each fingerprint.
LEAST_BITS, MOST_BITS, BITS_EACH = 13, 27, 16
#: Fingerprints that a task holds before it hands them on.
KEPT_PRINTS = 1 << 19
#: Phrases that a task holds, by the numbers of their words, before it writes out their text.
KEPT_PHRASES = 1 << 19

_MAP = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9
)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: str, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0, 1, ... of a base modulo 2^64, and their inverses; kept between calls."""
    known = _POWERS.get(kind)
    if known is None or len(known[0]) < count:
        size = max(count, 2 * SLICE)
        base = _BASES[kind]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        known = (both[0], both[1])
        if size == 2 * SLICE:
            _POWERS[kind] = known
    return known[0][:count], known[1][:count]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(values: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The prefix polynomial of `values`, and the inverse powers that shift a range of it to its begin."""
    powers, inverse = _powers(kind, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    return sums, inverse


def slices(raw: bytes, size: int = SLICE) -> Iterator[tuple[bytes, int]]:
    """Slices of a text that is already mapped, cut between words, and how many words each shares with the last."""
    at = done = lead = 0
    while len(raw) - at > size:
        cut = max(raw.rfind(b" ", done + 1, at + size), raw.rfind(b"\n", done + 1, at + size))
        if cut < 0:
            ends = [e for e in (raw.find(b" ", max(done + 1, at + size)), raw.find(b"\n", max(done + 1, at + size))) if e >= 0]
            if not ends:
                break
            cut = min(ends)
        yield raw[at:cut], lead
        done, back, lead = cut, cut, 0
        while lead < MOST_WORDS - 1:
            end = back
            while end > at and raw[end - 1] in b" \n":
                end -= 1
            if end == at:
                break
            back = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end)) + 1
            back = max(back, at)
            lead += 1
        at = back
    yield raw[at:], lead


class Block:
    """The words of some slices, with the fingerprints of the phrases that begin at each."""

    def __init__(self, parts: list[tuple[bytes, int, int]]) -> None:
        """`parts`: (mapped text, words shared with the slice before, number of the row)."""
        self.raw = b"\n".join(p[0] for p in parts) + b"\n"
        data = np.frombuffer(self.raw, np.uint8)
        apart = (data == 32) | (data == 10)
        edges = np.flatnonzero(np.diff(apart, prepend=True))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.count = len(self.starts)
        self.piece = np.cumsum(data == 10, dtype=np.int32)[self.starts]
        sizes = np.array([len(p[0]) + 1 for p in parts])
        first = np.cumsum(sizes) - sizes
        part = np.searchsorted(first, self.starts, side="right") - 1
        self.row = np.array([p[2] for p in parts])[part]
        place = np.arange(self.count) - np.searchsorted(self.starts, first)[part]
        # The last word of a phrase must be one that the slice before did not have.
        self.new = place >= np.array([p[1] for p in parts])[part]
        sums, inverse = _prefix(data.astype(np.uint64) + np.uint64(1), "byte")
        length = (self.ends - self.starts).astype(np.uint64)
        self.words = _mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + length * np.uint64(0xC2B2AE3D27D4EB4F))
        self.sums, self.inverse = _prefix(self.words, "word")

    def whole(self, size: int) -> np.ndarray:
        """Where a phrase of `size` words begins that lies in one piece and is not counted before."""
        room = max(0, self.count - size + 1)
        last = slice(size - 1, size - 1 + room)
        return (self.piece[:room] == self.piece[last]) & self.new[last]

    def prints(self, size: int, seeds: np.ndarray) -> np.ndarray:
        """Fingerprints of `size` words from each word on; `seeds` holds a number for the language of each row."""
        room = max(0, self.count - size + 1)
        raw = (self.sums[size : size + room] - self.sums[:room]) * self.inverse[:room]
        return _mix(raw ^ _mix(seeds[self.row[:room]] + np.uint64(size)))


class Field:
    """A bit for each value of the leading bits of a fingerprint; unset bits are sure."""

    def __init__(self, bits: int, cells: np.ndarray) -> None:
        self.bits, self.cells = bits, cells

    def has(self, prints: np.ndarray) -> np.ndarray:
        at = prints >> np.uint64(64 - self.bits)
        return (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def field_of(frequent: DataFrame) -> Field:
    """The field of the fingerprints in `fp`; of at most 2^MOST_BITS bits, so that it can go to all tasks."""
    count = frequent.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * count).bit_length()))
    at = F.shiftrightunsigned("fp", 64 - bits)
    rows = frequent.select(at.alias("at")).selectExpr("shiftright(at, 6) AS cell", "shiftleft(1L, int(at & 63)) AS bit")
    cells = rows.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bit").to_numpy().view(np.uint64)
    return Field(bits, out)


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    """The texts of a batch, in blocks of about SLICE bytes."""
    held, size = [], 0
    for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        for raw, lead in slices((text or b"").translate(_MAP)):
            if size and size + len(raw) > SLICE:
                yield Block(held)
                held, size = [], 0
            held.append((raw, lead, row))
            size += len(raw) + 1
    if size:
        yield Block(held)


def _seeds(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("seed").to_numpy().view(np.uint64)


class Counts:
    """Fingerprints and how often each was seen; kept sorted, and merged when many have come in."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, prints: np.ndarray) -> None:
        self.held.append(np.unique(prints, return_counts=True))
        self.size += len(self.held[-1][0])

    def taken(self) -> pa.RecordBatch:
        """All that is held, each fingerprint once; what is held starts anew."""
        prints = np.concatenate([h[0] for h in self.held])
        counts = np.concatenate([h[1] for h in self.held])
        order = np.argsort(prints)
        prints, counts = prints[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1]))[: len(prints)])
        total = np.add.reduceat(counts, first) if len(first) else counts
        self.held, self.size = [], 0
        columns = [pa.array(prints[first].view(np.int64)), pa.array(total.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["fp", "count"])


def _counter(level: int, sent):
    """A task that counts the fingerprints of a level: 1, 2, or 3 for all longer phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, counts = sent.value if sent else {}, Counts()
        for batch in batches:
            seeds = _seeds(batch)
            for block in _blocks(batch):
                if not block.count:
                    continue
                if level == 1:
                    counts.add(block.prints(1, seeds)[block.whole(1)])
                elif level == 2:
                    known = fields[1].has(block.prints(1, seeds))
                    counts.add(block.prints(2, seeds)[block.whole(2) & known[:-1] & known[1:]])
                else:
                    pairs = _pairs(block, seeds, fields)
                    for size in range(3, MOST_WORDS + 1):
                        counts.add(block.prints(size, seeds)[_all_pairs(block, pairs, size)])
            if counts.size >= KEPT_PRINTS:
                yield counts.taken()
        if counts.held:
            yield counts.taken()

    return run


def _pairs(block: Block, seeds: np.ndarray, fields: dict[int, Field]) -> np.ndarray:
    """Where a pair of words begins that may be frequent, whichever slice counts it."""
    if block.count < 2:
        return np.zeros(0, bool)
    known = fields[1].has(block.prints(1, seeds))
    return (block.piece[:-1] == block.piece[1:]) & known[:-1] & known[1:] & fields[2].has(block.prints(2, seeds))


def _all_pairs(block: Block, pairs: np.ndarray, size: int) -> np.ndarray:
    where = block.whole(size)
    for k in range(size - 1):
        where = where & pairs[k : k + len(where)]
    return where


class Phrases:
    """Phrases that a task has seen, by the numbers of their words: exact, and without their text until it is wanted."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {b"": 0}
        self.langs: dict[str, int] = {}
        self.held: list[list[np.ndarray]] = []
        self.size = 0

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Word numbers from 1, with as many zeros after them as a phrase may lack words."""
        table = self.words
        found = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
        return np.concatenate([found, np.zeros(MOST_WORDS, np.int64)])

    def add(self, at: np.ndarray, size: int, ids: np.ndarray, lang: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        """Phrases of `size` words that begin at the places `at`, with the language and document of each."""
        word = [ids[at + k] if k < size else np.zeros(len(at), np.int64) for k in range(MOST_WORDS)]
        one = np.ones(len(at), np.int64)
        self.held.append(_grouped([lang, word[0] << 32 | word[1], word[2] << 32 | word[3], one, doc, known]))
        self.size += len(self.held[-1][0])
        if self.size > 2 * KEPT_PHRASES:
            self.held = [_grouped([np.concatenate(c) for c in zip(*self.held, strict=True)])]
            self.size = len(self.held[0][0])

    def taken(self) -> pa.RecordBatch:
        """All phrases with their text, count and smallest doc_id; what is held starts anew."""
        lang, head, tail, count, doc, known = _grouped([np.concatenate(c) for c in zip(*self.held, strict=True)])
        names, words = list(self.langs), list(self.words)
        numbers = np.stack([head >> 32, head & 0xFFFFFFFF, tail >> 32, tail & 0xFFFFFFFF], axis=1)
        sizes = (numbers > 0).sum(axis=1).astype(np.int32)
        texts = [b" ".join([words[w] for w in row[:n]]) for row, n in zip(numbers.tolist(), sizes.tolist(), strict=True)]
        columns = [
            pa.array([names[k] for k in lang.tolist()], pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array(sizes), pa.array(count), pa.array(doc, mask=~known),
        ]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=PHRASE_COLUMNS)


PHRASE_COLUMNS = ["lang", "phrase", "size", "count", "doc_id"]


def _grouped(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Equal (language, words) once, with the sum of counts and the smallest document that is known."""
    lang, head, tail, count, doc, known = columns
    order = np.lexsort((tail, head, lang))
    lang, head, tail, count, doc, known = (c[order] for c in columns)
    new = (lang[1:] != lang[:-1]) | (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    first = np.flatnonzero(np.concatenate(([True], new))[: len(lang)])
    if not len(first):
        return [lang, head, tail, count, doc, known]
    doc = np.minimum.reduceat(np.where(known, doc, np.iinfo(np.int64).max), first)
    return [lang[first], head[first], tail[first], np.add.reduceat(count, first), doc, np.logical_or.reduceat(known, first)]


def _verifier(sent):
    """A task that groups the occurrences that pass the fields by their words; rows of size 0 count all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, phrases = sent.value, Phrases()
        total: dict[str, int] = {}
        for batch in batches:
            seeds, langs = _seeds(batch), batch.column("lang").to_pylist()
            doc_id = batch.column("doc_id")
            docs, known = doc_id.fill_null(0).to_numpy(), doc_id.is_valid().to_numpy(zero_copy_only=False)
            for block in _blocks(batch):
                code = np.array([phrases.langs.setdefault(lang, len(phrases.langs)) for lang in langs])
                ids = phrases.numbers(block.raw.split())
                for row, count in enumerate(np.bincount(block.row[block.new], minlength=len(langs)).tolist()):
                    total[langs[row]] = total.get(langs[row], 0) + count
                pairs = _pairs(block, seeds, fields)
                for size in range(1, MOST_WORDS + 1):
                    if size == 1:
                        where = block.whole(1) & fields[1].has(block.prints(1, seeds))
                    else:
                        where = _all_pairs(block, pairs, size)
                    if size > 2:
                        where = where & fields[3].has(block.prints(size, seeds))
                    at = np.flatnonzero(where)
                    row = block.row[at]
                    phrases.add(at, size, ids, code[row], docs[row], known[row])
                if phrases.size > KEPT_PHRASES:
                    yield phrases.taken()
        if phrases.held:
            yield phrases.taken()
        rows = [(lang, None, 0, count, None) for lang, count in total.items()]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=PHRASE_COLUMNS)

    return run


def frequent_phrases(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to MOST_WORDS words with at least `least` occurrences, and the words of each language.

    The first has (lang, phrase, size, f, doc_id), with the smallest doc_id of a document that has the phrase
    (null if none of them has an id). The second has (lang, n).
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"))
    rows = rows.withColumn("seed", F.xxhash64("lang"))
    fields: dict[int, Field] = {}
    for level in (1, 2, 3):
        sent = spark.sparkContext.broadcast(fields) if fields else None
        seen = rows.select("seed", "text").mapInArrow(_counter(level, sent), "fp long, count long")
        counted = seen.groupBy("fp").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
        fields = {**fields, level: field_of(written(counted.select("fp"), f"prints{level}"))}
    sent = spark.sparkContext.broadcast(fields)
    schema = "lang string, phrase string, size int, count long, doc_id long"
    found = rows.mapInArrow(_verifier(sent), schema).groupBy("lang", "phrase", "size")
    found = found.agg(F.sum("count").alias("f"), F.min("doc_id").alias("doc_id"))
    found = found.where((F.col("f") >= least) | (F.col("size") == 0))
    found = written(found, "phrases")
    return found.where("size > 0"), found.where("size = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, doc_id): each language's best phrases of two and more words.

    The score of a phrase is that of its worst cut, floor(SCALE * a / (l + r)) with the counts of the
    phrase and of both sides; ties take the earliest cut. Phrases inside a longer candidate that has INSIDE_PERCENT of their
    occurrences are left out. doc_id is the smallest of a document that has the phrase.
    """
    phrases, totals = frequent_phrases(docs, least)
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f"))
    words = F.split("phrase", " ")
    wanted = phrases.where("size > 1").withColumn("w", words)
    cuts = wanted.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("array_join(slice(w, 1, k), ' ')"))
    cuts = cuts.withColumn("rest", F.expr("array_join(slice(w, k + 1, size - k), ' ')"))
    for side, count in (("first", "l"), ("rest", "r")):
        # A common word is a side of very many cuts, so that hot keys are spread where counts are not broadcast.
        looked = counts.select("lang", F.col("part").alias(side), F.col("f").alias(count))
        cuts = lookup_join(cuts, looked, ["lang", side], max_bytes=BROADCAST_BYTES)
    score = F.expr(f"(CAST(f AS DECIMAL(20, 0)) * {SCALE}) div (CAST(l AS DECIMAL(20, 0)) + r)").cast("long")
    best = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).groupBy("lang", "phrase").agg(
        F.min("cut").alias("cut"), F.max("f").alias("a"), F.min("doc_id").alias("doc_id")
    )
    held = wanted.where("size > 2").select(
        "lang", "f", F.explode(F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("phrase")
    )
    held = held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(held, ["lang", "phrase"], "left")
    inside = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * INSIDE_PERCENT
    kept = kept.where(~F.coalesce(inside, F.lit(False))).select("lang", "phrase", "a", "doc_id", "cut.score", "cut.l", "cut.r")
    return _ranked(kept, top).join(sized(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each language by score, ranked.

    Rows are dealt by range of language and order, so that a large language is in many tasks; a
    rank is the place in a range after what the ranges before it hold of the language.
    """
    part, before, place = (fresh(rows, c) for c in ("part", "before", "place"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = rows.repartitionByRange("lang", *order).withColumn(part, F.spark_partition_id())
    spread = written(spread, "ranges")
    inside = Window.partitionBy("lang", part).orderBy(*order)
    earlier = Window.partitionBy("lang").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    held = spread.groupBy("lang", part).agg(F.count("*").alias("held"))
    held = held.select("lang", part, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias(before))
    placed = spread.withColumn(place, F.row_number().over(inside)).where(F.col(place) <= top)
    ranked = placed.join(sized(held), ["lang", part]).withColumn("rank", F.col(before) + F.col(place))
    return ranked.where(F.col("rank") <= top).drop(part, before, place)
