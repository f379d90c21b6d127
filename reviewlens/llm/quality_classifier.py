"""Document quality from random-indexing word vectors and a small neural network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import without
from reviewlens.session import stage

#: Labelled documents that the model is fitted on, at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 8192
#: Hashed vocabulary, and length of a word vector.
ROWS, WIDTH = 8192, 32
#: Nonzero entries of an index vector, half of them +1 and half -1, and words of context on each side.
NONZERO, WINDOW = 4, 2
HIDDEN, STEPS, RATE, DECAY = 16, 400, 0.03, 1e-4
#: Distinct words whose vocabulary rows a task remembers.
REMEMBERED = 100_000


@dataclass(frozen=True)
class Model:
    """Word vectors (``ROWS`` x ``WIDTH``) and the network over pooled vectors; no layers: a constant score."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float
    constant: float

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(pooled), self.constant)
        logits = _forward(self.layers, (pooled - self.mean) / self.scale)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


_SHAPE = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "A" * 26 + "a" * 26 + "9" * 10
)


def _rows_of(word: str) -> tuple[int, int]:
    """Vocabulary rows of the word itself and of its shape: runs of capitals, letters, digits and signs."""
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in word.translate(_SHAPE))
    runs = "".join(c for c, before in zip(shape, " " + shape) if c != before)
    return _hash("w" + word.lower()), _hash("s" + runs)


def _hash(key: str) -> int:
    value = 2166136261
    for byte in key.encode():
        value = ((value ^ byte) * 16777619) & 0xFFFFFFFF
    return (value ^ (value >> 15)) % ROWS


def _index_vectors() -> np.ndarray:
    """A sparse vector of signs for every vocabulary row, the same wherever it is made."""
    random = np.random.default_rng(20)
    out = np.zeros((ROWS, WIDTH), np.int32)
    for row in out:
        places = random.choice(WIDTH, NONZERO, replace=False)
        row[places[: NONZERO // 2]], row[places[NONZERO // 2 :]] = 1, -1
    return out


def _tokens(texts, memory: dict[str, tuple[int, int]]) -> Iterator[np.ndarray]:
    """Of each text, the vocabulary rows of its words: one line for words, one for shapes.

    A word that repeats the one before it has a shape of its own.
    """
    repeated = _hash("r")
    for text in texts:
        words = text.split() if isinstance(text, str) else []
        pairs = []
        for word in words:
            rows = memory.get(word)
            if rows is None:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                rows = memory[word] = _rows_of(word)
            pairs.append(rows)
        lines = np.array(pairs, np.int32).reshape(-1, 2).T
        lines[1, 1:][[word == before for word, before in zip(words[1:], words)]] = repeated
        yield lines


def _add_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The summed index vectors of the words around each vocabulary row, over all texts of a partition."""
    index, memory = _index_vectors(), {}
    total = np.zeros((ROWS, WIDTH), np.int64)
    for batch in batches:
        for words, shapes in _tokens(batch.iloc[:, 0], memory):
            around = index[words] + index[shapes]
            context = np.zeros_like(around)
            for step in range(1, WINDOW + 1):
                context[step:] += around[:-step]
                context[:-step] += around[step:]
            np.add.at(total, words, context)
            np.add.at(total, shapes, context)
    used = np.flatnonzero(total.any(1))
    if len(used):
        yield pd.DataFrame({"row": used, "vector": list(total[used])})


def _pooled(texts, vectors: np.ndarray, memory: dict) -> np.ndarray:
    """Mean word vector beside mean shape vector; zeros for a text without words."""
    out = np.zeros((len(texts), 2 * WIDTH))
    for line, (words, shapes) in zip(out, _tokens(texts, memory)):
        if len(words):
            counts = np.bincount(words, minlength=ROWS), np.bincount(shapes, minlength=ROWS)
            for half, count in zip((line[:WIDTH], line[WIDTH:]), counts):
                used = np.flatnonzero(count)
                half[:] = count[used] @ vectors[used] / len(words)
    return out


def _forward(layers: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inner, bias, outer, last = layers
    hidden = np.tanh(x @ inner + bias)
    return hidden, hidden @ outer + last[0]


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adam on the mean cross entropy of all rows."""
    random = np.random.default_rng(5)
    layers = [random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, STEPS + 1):
        hidden, logits = _forward(tuple(layers), x)
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y) / len(y)
        back = error[:, None] * layers[2] * (1 - hidden**2)
        slopes = [x.T @ back + DECAY * layers[0], back.sum(0), hidden.T @ error + DECAY * layers[2], error.sum(keepdims=True)]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            layers[i] = layers[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits, between 1/4 and 16, with the lowest cross entropy."""
    divisors = 2.0 ** np.linspace(-2, 4, 121)
    signed = np.where(y == 1, -logits, logits)
    return float(divisors[np.argmin([np.logaddexp(0, signed / d).mean() for d in divisors])])


def fold(id_col: str) -> Column:
    """0 to 3, from the CRC of the id as text."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns ``label_col`` (0 or 1) from labelled documents of folds 0, 1 and 3, at most ``sample_rows``.

    Word vectors are sums of the index vectors of neighbouring words over the sample. A document is the mean
    vector of its words and of their shapes. Folds 0 and 3 train the network, fold 1 calibrates it. What the
    driver gets is bounded by ``sample_rows`` and by the size of the vocabulary. Labels that are null or
    neither 0 nor 1 are left out; a document with several labels has the largest. With fewer than two classes
    the score is constant: their share, or 0.5 without labels.
    """
    spark = docs.sparkSession
    chosen = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col) != 2))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = stage(texts.join(F.broadcast(chosen), "id"), "sample")
    parts = sample.select("text").repartition(8).mapInPandas(_add_contexts, "row int, vector array<long>").toPandas()
    vectors = np.zeros((ROWS, WIDTH))
    for row, vector in zip(parts["row"], parts["vector"]):
        vectors[row] += vector
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    shared = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory: dict = {}
        for batch in batches:
            pooled = _pooled(batch["text"], shared.value, memory)
            if len(batch):
                yield pd.DataFrame({"fold": batch["fold"], "label": batch["label"], "pooled": list(pooled)})
        memory.clear()

    rows = (
        sample.withColumn("fold", fold("id").cast("int"))
        .select("fold", "label", "text")
        .mapInPandas(pool, "fold int, label int, pooled array<double>")
        .toPandas()
    )
    shared.unpersist()
    y = rows["label"].to_numpy(float)
    empty = np.zeros(0)
    if len(set(y)) < 2:
        return Model(vectors, empty, empty, (), 1.0, float(y.mean()) if len(y) else 0.5)
    x = np.stack(rows["pooled"].to_numpy())
    order = np.lexsort((*x.T, y, rows["fold"]))  # rows arrive in any order
    x, y, folds = x[order], y[order], rows["fold"].to_numpy()[order]
    learn = folds != 1 if len(set(y[folds != 1])) == 2 else folds >= 0
    check = folds == 1 if (folds == 1).any() else learn
    mean, scale = x[learn].mean(0), x[learn].std(0) + 1e-6
    x = (x - mean) / scale
    layers = _train(x[learn], y[learn])
    return Model(vectors, mean, scale, layers, _temperature(_forward(layers, x[check])[1], y[check]), 0.5)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) from the whole text alone.

    A null or empty text has a score too, that of a document without words. Columns of the same names are
    replaced. An empty table gives an empty result.
    """
    docs = without(docs, "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict = {}
        for texts in batches:
            yield pd.Series(shared.value.scores(_pooled(texts, shared.value.vectors, memory)))
        memory.clear()  # a worker runs many tasks, and may hold on to their frames

    scored = docs.withColumn("score", score(F.col(text_col).cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
