"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, so that misspelt and inflected
forms share most of it. The words of a segment are averaged and go through a linear
softmax of two classes. A text is cut into segments from end to end, and scores as
its highest segment: one insult in a long text is not averaged away. Training follows
that: after first passes over whole documents, each of their words once, the gradient of a document
goes through the segment that decides it. n-grams that few documents have stay at zero, so that a
small sample is not learned by heart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagquality.llm.common import held_out, written

SEGMENT = 5
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 8
EPOCHS = 8
#: A small sample is gone through more often, until it has made so many steps.
STEPS = 600
BATCH = 32
#: Passes over whole documents at first, at most a quarter of all; documents that an n-gram must be in.
FIRST_PASSES = 10
MIN_DOCS = 4
THRESHOLD = 0.3
#: Bounds of the labelled sample: documents of each label, and the length of the texts used for it.
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 40_000
#: Words whose score a worker keeps; it starts anew when full.
KEPT_WORDS = 300_000

# From a letter or digit to the last one before white space or a mark; symbols within belong to the word.
_WORDS = re.compile(r"[^\W_](?:[^\s_.,;:!?]*[^\W_])?").findall


def grams(word: str) -> list[int]:
    """Buckets of the n-grams of a word with its ends marked, and of the whole word."""
    raw = f"<{word}>"
    found = [raw[k : k + n] for n in GRAMS for k in range(len(raw) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in (*found, raw)]


class Scorer:
    """What each n-gram adds to the difference of the two logits, and where it starts."""

    def __init__(self, effect: np.ndarray, bias: float) -> None:
        self.effect, self.bias = effect, bias
        self.known: dict[str, float] = {}

    def _word(self, word: str) -> float:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        value = float(self.effect[grams(word)].mean())
        self.known[word] = value
        return value

    def logit(self, text: str) -> float:
        """The highest logit of the text's segments; that of an empty segment without words."""
        known, word_of = self.known.get, self._word
        values = [word_of(w) if (v := known(w)) is None else v for w in _WORDS(text.lower())]
        if not values:
            return self.bias
        starts = np.arange(0, len(values), SEGMENT)
        sums = np.add.reduceat(np.array(values), starts)
        return float((sums / SEGMENT).max()) + self.bias


def train(texts: list[str], labels: np.ndarray, seed: int = 0) -> Scorer:
    """Embeddings and softmax by Adagrad over batches of documents."""
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in _WORDS(t.lower())], np.int32) for t in texts]
    lists = [np.array(grams(w), np.int32) for w in index]
    sizes = np.array([len(x) for x in lists], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    features = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    del index, lists
    held = np.zeros(BUCKETS, np.int64)
    for doc in docs:
        own = [features[begins[w] : begins[w] + sizes[w]] for w in np.unique(doc)]
        held[np.unique(np.concatenate(own)) if own else []] += 1
    rare = held < MIN_DOCS
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    embed[rare] = 0
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = np.full((BUCKETS, 1), 1e-3, np.float32)
    seen_out = np.full((DIM, 2), 1e-3, np.float32)
    seen_bias = np.full(2, 1e-3, np.float32)

    def of_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of the words, one after the other, and whose each is."""
        n = sizes[words]
        whose = np.repeat(np.arange(len(words)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return features[np.repeat(begins[words], n) + inner], whose

    passes = max(EPOCHS, -(-STEPS * BATCH // max(1, len(docs))))
    for epoch in range(passes):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), BATCH):
            batch = [i for i in order[k : k + BATCH] if len(docs[i])]
            if not batch:
                continue
            segments, whose = [], []
            for i in batch:
                parts = [docs[i][j : j + SEGMENT] for j in range(0, len(docs[i]), SEGMENT)]
                if epoch < min(FIRST_PASSES, passes // 4):
                    chosen = [np.unique(docs[i])]
                else:
                    words, at = np.unique(docs[i], return_inverse=True)
                    grams_of, owner = of_words(words)
                    effect = embed[grams_of] @ (out[:, 1] - out[:, 0])
                    value = np.bincount(owner, effect, len(words)) / sizes[words]
                    sums = np.add.reduceat(value[at], np.arange(0, len(docs[i]), SEGMENT))
                    chosen = [parts[int(sums.argmax())]]
                segments += chosen
                whose += [labels[i]] * len(chosen)
            y = np.array(whose)
            words = np.concatenate(segments)
            segment_of = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
            grams_of, owner = of_words(words)
            many = np.array([max(SEGMENT, len(s)) for s in segments])[segment_of]
            share = (1.0 / (sizes[words] * many)).astype(np.float32)[owner]
            into = segment_of[owner]
            mean = np.zeros((len(segments), DIM), np.float32)
            np.add.at(mean, into, embed[grams_of] * share[:, None])
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            back = p @ out.T
            slope_out, slope_bias = mean.T @ p, p.sum(0)
            seen_out += slope_out**2
            seen_bias += slope_bias**2
            slope = back[into] * share[:, None]
            slope[rare[grams_of]] = 0
            places, inverse = np.unique(grams_of, return_inverse=True)
            total = np.zeros((len(places), DIM), np.float32)
            np.add.at(total, inverse, slope)
            seen[places] += (total**2).mean(1, keepdims=True)
            embed[places] -= 0.3 * total / np.sqrt(seen[places])
            out -= 0.1 * slope_out / np.sqrt(seen_out)
            bias -= 0.1 * slope_bias / np.sqrt(seen_bias)
    return Scorer(embed @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """The scorer learned from a bounded sample of labelled documents that are not held out.

    For each label up to SAMPLE_DOCS ids of least hash are drawn, and of their texts those of
    at most SAMPLE_CHARS are used; a document with several labels has the highest. Labels
    other than 0 and 1, and rows without an id, are not used. None where nothing is labelled.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    drawn = [marked.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(SAMPLE_DOCS) for t in (0, 1)]
    sample = written(drawn[0].unionByName(drawn[1]), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(sample), "doc_id")
    # A repeated id has one text, so that the sample stays within its bound.
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy("doc_id").collect()
    if not rows:
        return None
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row's whole text; see `learn`.

    predicted is 1 from a score of THRESHOLD on. Null and empty texts, and texts without a
    word, have the score of an empty segment; 0 where nothing is labelled. Rows come out as
    often as they occur; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value
        for batch in batches:
            if scorer:
                logits = np.array([scorer.logit(t.as_py() or "") for t in batch.column("text")])
                scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            else:
                scores = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
