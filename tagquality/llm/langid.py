"""Language ID by a byte convolutional network, trained in numpy.

Bytes are embedded; filters of several widths run over a window of WINDOW bytes; the
maximum of each filter over the window goes through a ReLU and a softmax layer. A text is
cut into windows from end to end, and its class has the highest mean of the windows'
scores, each weighted by its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tagquality.llm.common import fresh, held_out, make_room, sized, written

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: Bounds of the labelled sample: documents of a language and of all languages, windows of a document. Where
#: there are more languages than fit, each gets fewer documents, but every one at least one.
SAMPLE_DOCS = 1600
SAMPLE_ALL = 40_000
SAMPLE_WINDOWS = 4
#: Parts of a language whose sample is cut side by side.
PARTS = 64
EPOCHS = 6
#: Windows that go through the network at once.
BLOCK = 128
NONE = "und"

_ASCII_LETTER = re.compile("[A-Za-z]").search


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text, one after the other; the last is filled up with zeros."""
    count = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


class Network:
    """Embedding, filters of each width, and a softmax layer over `classes`."""

    def __init__(self, classes: list[str], seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.classes = classes
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.parts = {"embed": scale(256, EMBED) * 8, "out": scale(len(WIDTHS) * FILTERS, len(classes))}
        self.parts["bias"] = np.zeros(len(classes), np.float32)
        for w in WIDTHS:
            self.parts[f"filter{w}"] = scale(w * EMBED, FILTERS)
            self.parts[f"shift{w}"] = np.zeros(FILTERS, np.float32)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """By width: for each pair of bytes of a filter's span (and a last odd byte), what it adds."""
        found = {}
        for w in WIDTHS:
            steps = self.parts["embed"] @ self.parts[f"filter{w}"].reshape(w, EMBED, FILTERS)
            pairs = [(steps[k][:, None] + steps[k + 1]).reshape(65536, FILTERS) for k in range(0, w - 1, 2)]
            found[w] = pairs + ([steps[w - 1]] if w % 2 else [])
        return found

    def pooled(self, block: np.ndarray, tables: dict[int, list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's maximum over the windows of `block`, and where it is."""
        pair = block[:, :-1].astype(np.int32) * 256 + block[:, 1:]
        tops, places = [], []
        for w in WIDTHS:
            span = WINDOW - w + 1
            total = None
            for k, table in enumerate(tables[w]):
                index = pair[:, 2 * k : 2 * k + span] if len(table) > 256 else block[:, w - 1 :]
                total = table[index] if total is None else np.add(total, table[index], out=total)
            place = total.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(total, place[:, None], 1)[:, 0] + self.parts[f"shift{w}"])
        return np.concatenate(tops, axis=1), np.concatenate(places, axis=1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.parts["out"] + self.parts["bias"]

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 0, rate: float = 0.01) -> None:
        """Adam over shuffled batches; classes weigh alike. Only the places of the maxima have a gradient."""
        rng = np.random.default_rng(seed)
        weight = len(y) / np.maximum(np.bincount(y, minlength=len(self.classes)), 1) / len(self.classes)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.parts.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            for k in range(0, len(order), 64):
                rows = order[k : k + 64]
                step += 1
                pace = rate * (1 - epoch / EPOCHS)
                for name, slope in self._slopes(x[rows], y[rows], weight[y[rows]].astype(np.float32)).items():
                    m, v = moments[name]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope * slope - v)
                    fixed = m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    self.parts[name] -= (pace * fixed).astype(np.float32)

    def _slopes(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        n, rows = len(y), np.arange(len(y))
        pooled, places = self._pooled_directly(x)
        shown = np.maximum(pooled, 0)
        p = softmax(self.logits(pooled))
        p[rows, y] -= 1
        p *= weight[:, None] / n
        slopes = {"out": shown.T @ p, "bias": p.sum(0), "embed": np.zeros_like(self.parts["embed"])}
        back = (p @ self.parts["out"].T) * (pooled > 0)
        for j, w in enumerate(WIDTHS):
            own = back[:, j * FILTERS : (j + 1) * FILTERS]
            at = places[:, j * FILTERS : (j + 1) * FILTERS]
            span = x[rows[:, None, None], at[:, :, None] + np.arange(w)]
            seen = self.parts["embed"][span].reshape(n, FILTERS, w * EMBED)
            slopes[f"filter{w}"] = np.einsum("nfe,nf->ef", seen, own)
            slopes[f"shift{w}"] = own.sum(0)
            into = (own[:, :, None] * self.parts[f"filter{w}"].T).reshape(-1, EMBED)
            np.add.at(slopes["embed"], span.reshape(-1), into)
        return slopes

    def _pooled_directly(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen, tops, places = self.parts["embed"][x], [], []
        for w in WIDTHS:
            filters = self.parts[f"filter{w}"].reshape(w, EMBED, FILTERS)
            total = sum(seen[:, k : WINDOW - w + 1 + k] @ filters[k] for k in range(w))
            place = total.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(total, place[:, None], 1)[:, 0] + self.parts[f"shift{w}"])
        return np.concatenate(tops, axis=1), np.concatenate(places, axis=1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER(text)) or any(map(str.isalpha, text)))


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document up to SAMPLE_WINDOWS windows, spread evenly from its begin to its end."""
    make_room()
    for batch in batches:
        langs, orders, cut = [], [], []
        for lang, order, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text")), strict=True):
            if has_letter(text):
                every = windows(text.encode())
                for k in np.unique(np.linspace(0, len(every) - 1, SAMPLE_WINDOWS).astype(int)):
                    langs.append(lang)
                    orders.append(order)
                    cut.append(every[k].tobytes())
        columns = [pa.array(langs, pa.string()), pa.array(orders, pa.int64()), pa.array(cut, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "h", "window"])


def learn(docs: DataFrame) -> Network | None:
    """The network learned from a bounded sample of labelled documents that are not held out.

    Of each language the documents with the smallest hash of their id are drawn, SAMPLE_DOCS or an even share of
    SAMPLE_ALL; only text and language are used. None where nothing is labelled.
    """
    known = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = written(known.groupBy("lang").agg(F.count("*").alias("count")), "languages")
    each = max(1, min(SAMPLE_DOCS, SAMPLE_ALL // max(1, counts.count())))
    # Twice as many rows as wanted pass the hash, so that chance leaves enough of each; of a language
    # with few documents all do.
    share = counts.select("lang", (F.lit(2.0 * each) / F.col("count")).alias("share"))
    drawn = known.withColumn("h", F.xxhash64("doc_id", F.lit("sample")))
    drawn = drawn.join(sized(share), "lang").where(
        (F.col("share") >= 0.05) | (F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    )
    rows = drawn.select("lang", "h", "text").mapInArrow(_sample_windows, "lang string, h long, window binary")
    # A hash part of a language is cut to its firsts before the language is, so that none is sorted by one task.
    for part in (["lang", F.pmod(F.xxhash64("h"), F.lit(PARTS))], ["lang"]):
        order = Window.partitionBy(*part).orderBy("h", "window")
        rows = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each * SAMPLE_WINDOWS).drop("k")
    sample = rows.select("lang", "window").orderBy("lang", "window").toArrow()
    if not sample.num_rows:
        return None
    langs = sample.column("lang").to_pylist()
    classes = sorted(set(langs))
    code = {c: k for k, c in enumerate(classes)}
    x = np.frombuffer(b"".join(sample.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    network = Network(classes)
    network.train(x, np.array([code[lang] for lang in langs]))
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """`docs` with two more columns: the language of each row's whole text, and its score.

    They are lang_pred and lang_score, with underscores after these names where `docs` has them; all of its
    columns pass through. The language is `und` with score 0 where the text is null or has no
    letter, or nothing was learned.
    """
    names = [fresh(docs, "lang_pred"), fresh(docs, "lang_score")]
    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(network)
    columns = [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        net = sent.value
        tables = net.tables() if net else {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            chosen, scores = [NONE] * len(texts), np.zeros(len(texts))
            if net:
                totals = np.zeros((len(texts), len(net.classes)))
                for block, owner, size in _blocks(texts):
                    p = net.logits(net.pooled(block, tables)[0])
                    np.add.at(totals, owner, p * size[:, None])
                sizes = np.array([max(1, len(t.encode())) if t else 1 for t in texts])
                mean = softmax(totals / sizes[:, None])
                for k, text in enumerate(texts):
                    if has_letter(text):
                        best = int(mean[k].argmax())
                        chosen[k], scores[k] = net.classes[best], mean[k, best]
            own = [*batch.columns, pa.array(chosen, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(own, names=columns)

    return docs.mapInArrow(run, schema)


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of the texts by BLOCK, with the text that each is of and its bytes."""
    held, owners, sizes, count = [], [], [], 0
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        every = windows(raw)
        size = np.full(len(every), WINDOW)
        size[-1] = len(raw) - WINDOW * (len(every) - 1)
        for j in range(0, len(every), BLOCK):
            part = every[j : j + BLOCK]
            if count and count + len(part) > BLOCK:
                yield np.concatenate(held), np.concatenate(owners), np.concatenate(sizes)
                held, owners, sizes, count = [], [], [], 0
            held.append(part)
            owners.append(np.full(len(part), k))
            sizes.append(size[j : j + BLOCK])
            count += len(part)
    if count:
        yield np.concatenate(held), np.concatenate(owners), np.concatenate(sizes)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row's whole text; see `predict` and `learn`.

    Rows without an id are not held out and not learned from. Other columns are ignored.
    """
    network = learn(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = predict(rows, network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: A document whose best language scores less is rejected, as one in no learned language.
MIN_SCORE = 0.4


def drop_unknown(docs: DataFrame) -> DataFrame:
    """`docs` without those that have no letter or no language of at least MIN_SCORE."""
    found = predict(docs, learn(docs))
    lang, score = found.columns[-2:]
    return found.where((F.col(lang) != NONE) & (F.col(score) >= MIN_SCORE)).drop(lang, score)
