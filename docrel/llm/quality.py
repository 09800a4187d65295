"""Document quality by random-indexing word vectors and a two-layer network with calibrated probabilities.

Random indexing (Sahlgren, 2005): every surface feature of a word (the word itself, its byte trigrams with marks
for its ends, its class of characters) has a sparse random index vector that follows from its hash alone. A word's
vector is the sum of its features' vectors; context vectors learned from a sample add to each hashed feature the
index vectors of the words beside it. A document is the mean of its words' vectors, whole text, with a few counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed

#: Hashed features, dimensions of a vector, entries of +1 or -1 in an index vector.
FEATURES, DIMS, NONZERO = 4096, 96, 4
#: Bound on labelled rows that a fit uses: those with the smallest hashes of their keys. A documented sample.
SAMPLE_ROWS = 6000
HIDDEN, EPOCHS, SEED = 24, 60, 5
THRESHOLD = 0.3
FOLDS = 5

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def index_vectors(seed: int = SEED) -> np.ndarray:
    """The index vector of each hashed feature."""
    rng = np.random.default_rng(seed)
    out = np.zeros((FEATURES, DIMS), np.float32)
    for row in out:
        row[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


def _slots(values: np.ndarray) -> np.ndarray:
    mixed = values * _M1
    return ((mixed ^ (mixed >> np.uint64(29))) * _M2 >> np.uint64(52)).astype(np.int64)


#: Texts are handled in packs of so many bytes, and so many documents; longer texts in several packs, whole.
PACK_BYTES, PACK_DOCS = 1 << 18, 64


def _packs(texts) -> Iterator[tuple[np.ndarray, bytes]]:
    """``(which text each byte is of, bytes)``; long texts are cut at blanks where they have any."""
    whose, parts, size = [], [], 0
    for i, text in enumerate(texts):
        data, at = (text or "").encode("utf-8", "surrogatepass"), 0
        while at < len(data):
            stop = min(len(data), at + PACK_BYTES)
            if stop < len(data) and (cut := data.rfind(b" ", at, stop)) > at:
                stop = cut + 1
            if size + stop - at > PACK_BYTES and parts:
                yield np.repeat(whose, [len(x) + 1 for x in parts]), b" ".join([*parts, b""])
                whose, parts, size = [], [], 0
            whose.append(i)
            parts.append(data[at:stop])
            size += stop - at + 1
            at = stop
    if parts:
        yield np.repeat(whose, [len(x) + 1 for x in parts]), b" ".join([*parts, b""])


def word_features(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words of blank-separated UTF-8 start and their slots; where trigrams have their middle and their slots.

    ``data`` ends with a blank. A trigram's middle is no blank, so trigrams at the ends of a word hold one as a mark.
    """
    raw = np.frombuffer(b" " + data, np.uint8)
    byte = np.where((raw >= 9) & (raw <= 13), 32, raw).astype(np.uint64)
    blank = byte == 32
    middle = np.flatnonzero(~blank[1:-1])
    grams = _slots((byte[:-2] << np.uint64(16) | byte[1:-1] << np.uint64(8) | byte[2:])[middle] + _M3)
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not len(starts):
        return starts, np.zeros(0, np.int64), middle, grams
    place = np.zeros(len(byte), np.int64)
    place[starts] = starts
    place = np.minimum(np.arange(len(byte)) - np.maximum.accumulate(place), 63)
    weights = (byte + _M3) * (_M1 * (np.arange(64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))[place]
    weights = np.where(blank, np.uint64(0), weights ^ (weights >> np.uint64(31)))
    return starts - 1, _slots(np.add.reduceat(weights, starts)), middle, grams


def document_vectors(texts, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: mean vectors of words and of trigrams, and counts; null and empty texts have zeros."""
    texts, out = list(texts), np.zeros((len(texts), 2 * DIMS + 4), np.float32)
    for at in range(0, len(texts), PACK_DOCS):
        group = texts[at : at + PACK_DOCS]
        words, grams, repeats = (np.zeros((len(group), n)) for n in (FEATURES, FEATURES, 1))
        for whose, data in _packs(group):
            starts, slots, middle, gram_slots = word_features(data)
            own = whose[starts]
            for counts, ids, found in ((words, own, slots), (grams, whose[middle], gram_slots)):
                lo, n = whose[0], whose[-1] - whose[0] + 1
                counts[lo : lo + n] += np.bincount((ids - lo) * FEATURES + found, minlength=n * FEATURES).reshape(n, FEATURES)
            again = (slots[1:] == slots[:-1]) & (own[1:] == own[:-1])
            repeats[:, 0] += np.bincount(own[1:][again], minlength=len(group))
        n, g = (np.maximum(1, x.sum(1, keepdims=True)) for x in (words, grams))
        kinds = (words > 0).sum(1, keepdims=True)
        out[at : at + len(group)] = np.hstack([
            (words / n).astype(np.float32) @ vectors, (grams / g).astype(np.float32) @ vectors * 4,
            np.log1p(words.sum(1, keepdims=True)), g / n, repeats / n, kinds / np.minimum(n, FEATURES)])
    return out


def context_sums(batches, index: np.ndarray) -> np.ndarray:
    """Per hashed feature the sum of the index vectors of the words one and two places off, in the same text."""
    together = np.zeros(FEATURES * FEATURES, np.float32)
    for texts in batches:
        for whose, data in _packs(texts):
            starts, slots, _, _ = word_features(data)
            own = whose[starts]
            for gap in (1, 2):
                same = own[gap:] == own[:-gap]
                a, b = slots[:-gap][same], slots[gap:][same]
                np.add.at(together, np.concatenate([a * FEATURES + b, b * FEATURES + a]), 1)
    return together.reshape(FEATURES, FEATURES) @ index


def word_vectors(index: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Index vectors plus context vectors of unit length."""
    return (index + sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)


class Model(NamedTuple):
    vectors: np.ndarray  # FEATURES x DIMS
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, texts) -> np.ndarray:
        z = self.logits(document_vectors(texts, self.vectors).astype(np.float64)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, seed: int = SEED) -> Model:
    """Adam on the log loss of four fifths; the temperature is the one with the least log loss on the other fifth."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    hold, use = order[: len(x) // 5], order[len(x) // 5 :]
    mean, scale = x[use].mean(0), x[use].std(0) + 1e-3
    z = (x - mean) / scale
    parts = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(use), max(1, len(use) // 128)):
            h = np.tanh(z[rows] @ parts[0] + parts[1])
            d = (1 / (1 + np.exp(-np.clip(h @ parts[2] + parts[3], -60, 60))) - y[rows]) / len(rows)
            dh = d[:, None] * parts[2] * (1 - h * h)
            grads = [z[rows].T @ dh + 1e-4 * parts[0], dh.sum(0), h.T @ d + 1e-4 * parts[2], d.sum(keepdims=True)]
            step += 1
            for p, g, a, b in zip(parts, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, parts[0], parts[1], parts[2], float(parts[3][0]), 1.0)
    if not len(hold):
        return model
    out = model.logits(x[hold])
    loss = lambda t: np.logaddexp(0, np.where(y[hold] == 1, -out, out) / t).mean()
    return model._replace(temperature=float(min(np.geomspace(0.25, 8, 60), key=loss)))


def fold(key: Column) -> Column:
    """CRC-32 of a key's text modulo FOLDS; null keys count as empty texts."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of ``labels``, learned only from rows whose fold is not 0.

    The driver receives at most ``sample_rows`` keys, their context sums and their document vectors, whatever the
    size of the tables. Null keys and labels are skipped; of a key with several labels the largest counts, of one with
    several texts a single one. Without two labels the model gives every text the share of label 1 (0.5 without labels).
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(F.col(key)) != 0))
    chosen = usable.groupBy(F.col(key).alias("__key")).agg(F.max(label).alias("__y")).orderBy(F.xxhash64("__key"), "__key").limit(sample_rows)
    # chosen is bounded by sample_rows, three numbers a row; of a key that repeats, the text with the smallest hash counts
    own = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.xxhash64(F.col(text)).alias("__hash"))
    one = checkpointed(own.select("__key", "__hash").join(F.broadcast(chosen), "__key").groupBy("__key").agg(F.min("__hash").alias("__hash"), F.first("__y").alias("__y")))
    rows = own.join(F.broadcast(one), ["__key", "__hash"]).groupBy("__key").agg(F.first("__text").alias("__text"), F.first("__y").alias("__y"))
    rows = checkpointed(rows.repartition(8, "__key"))
    index = index_vectors()

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"sums": [context_sums((batch["__text"] for batch in batches), index).ravel()]})

    total = np.zeros(FEATURES * DIMS)
    for row in rows.mapInPandas(sums, "sums array<float>").toLocalIterator():
        total += np.asarray(row.sums)
    vectors = word_vectors(index, total.reshape(FEATURES, DIMS))

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["__key"].astype(str), "y": batch["__y"], "x": list(document_vectors(batch["__text"], vectors))})

    found = rows.mapInPandas(pooled, "key string, y int, x array<float>").toPandas().sort_values(["key", "y"], kind="stable")
    y = found["y"].to_numpy(np.float64)
    if len(set(y)) < 2:
        share = y.mean() if len(y) else 0.5
        none = np.zeros(2 * DIMS + 4)
        logit = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model(vectors, none, none + 1, np.zeros((len(none), 1)), np.zeros(1), np.zeros(1), logit, 1.0)
    return fit_network(np.stack(found["x"].to_numpy()).astype(np.float64), y, vectors)


def score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text, in one pass without an exchange.

    Null and empty texts are scored as texts without words. Only the text is an input of the score.
    """

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return docs.withColumn(name, scores(F.col(text)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, with their columns."""
    model = fit(docs, labels, key, text, **settings)
    return score(docs, model, "__score", text).where(F.col("__score") >= threshold).drop("__score")
