"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed character n-grams (1 to 3 code points, lower case),
normalised to length 1. Document frequencies are counted over all training rows; the
weights are fitted by FTRL-proximal steps with L1 and L2 penalties on a sample bounded by
``max_rows`` and a temperature is then fitted on a further part of that sample. Training and
prediction read whole texts in Arrow batches; what a task keeps is one text's features and
tables of ``buckets`` entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlens.llm.arrow_words import slices
from meterlens.llm.workers import lean

UNDETERMINED = "und"
BUCKET_BITS = 15
ORDERS = (1, 2, 3)
#: Labelled rows the weights are fitted on, at most: shared evenly by the languages.
MAX_ROWS = 2400
#: Bytes of text in a batch of answers.
SLICE_BYTES = 1 << 20
#: Every fifth row of the sample fits the temperature instead of the weights.
CALIBRATION_PART = 5
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 2e-4, 1e-4, 4
#: Odd multipliers of the n-gram hash.
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages, weights (buckets x languages), bias, IDF and temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    orders: tuple[int, ...] = field(default=ORDERS)
    bits: int = BUCKET_BITS


def ngram_counts(text: str, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets with an n-gram, their counts) of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - bits)
    hashed = []
    for order in orders:
        if len(points) < order:
            continue
        h = points[: len(points) - order + 1] * MIX[0] + np.uint32(order)
        for i in range(1, order):
            h = (h ^ (h >> np.uint32(15))) * MIX[1] + points[i : len(points) - order + 1 + i] * MIX[2]
        h = (h ^ (h >> np.uint32(13))) * MIX[0]
        hashed.append(h >> shift)
    if not hashed:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.bincount(np.concatenate(hashed), minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found, counts[found]


def tfidf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt(value @ value)
    return value / norm if norm > 0 else value


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """One text at a time: the batch itself is all of them that is held."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


def document_frequencies(
    texts: DataFrame, text: str, orders: tuple[int, ...] = ORDERS, bits: int = BUCKET_BITS
) -> tuple[np.ndarray, int]:
    """Documents holding each bucket, over all rows, and the number of rows.

    Every task adds up one table of buckets and emits it once, in ``2**bits`` small rows'
    place as one binary; tables are added per part of the table in a second step.
    """
    parts = 8
    width = (1 << bits) // parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for t in _texts(batch, text):
                total[ngram_counts(t, orders, bits)[0]] += 1
                rows += 1
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(range(parts), pa.int32()),
            "counts": pa.array([total[i * width:(i + 1) * width].tobytes() for i in range(parts)]),
            "n_rows": pa.array([rows] * parts, pa.int64()),
        })

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for p, c, n in zip(*(column.to_pylist() for column in batch.columns)):
                have = sums.setdefault(p, [np.zeros(width, np.int64), 0])
                have[0] += np.frombuffer(c, np.int64)
                have[1] += n
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(list(sums), pa.int32()),
            "counts": pa.array([c.tobytes() for c, _ in sums.values()], pa.binary()),
            "n_rows": pa.array([n for _, n in sums.values()], pa.int64()),
        })

    schema = "part int, counts binary, n_rows long"
    found = (
        texts.select(text).mapInArrow(lean(count), schema).repartition(parts, "part")
        .mapInArrow(add, schema).collect()
    )
    table, rows = np.zeros(1 << bits, np.int64), 0
    for row in found:  # `parts` rows
        table[row["part"] * width:(row["part"] + 1) * width] += np.frombuffer(row["counts"], np.int64)
        rows = row["n_rows"]
    return table, rows


def bounded_sample(
    train: DataFrame, text: str, label: str, key: Column, sizes: dict[str, int], max_rows: int
) -> DataFrame:
    """At most ``max_rows`` rows, the same number per label, in the order of a key's hash.

    ``sizes`` are the labels' numbers of rows. Hashes are spread evenly, so the least part of
    them that holds twice the wanted rows is all that is ranked: what moves depends on
    ``max_rows``, not on the table.
    """
    per_label = max(1, max_rows // max(1, len(sizes)))
    order = F.xxhash64(key, F.length(text), F.lit(17))
    ranked = train.select(text, label, order.alias("_order"))
    low = F.lit(None).cast("long")
    for name, n in sizes.items():
        share = 2 * per_label / n
        bound = (1 << 63) - 1 if share >= 1 else int(share * 2.0 ** 64) - (1 << 63)
        low = F.when(F.col(label) == name, F.lit(bound)).otherwise(low)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_order"))
    return ranked.where(F.col("_order") <= low).withColumn("_rank", rank).where(
        F.col("_rank") <= per_label)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], buckets: int, classes: int,
    alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
    epochs: int = EPOCHS, seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for the multinomial logistic loss; L1 is per example.

    A weight is zero while the sum of its gradients stays within the L1 penalty, so rare
    n-grams drop out. The bias has no L1 penalty.
    """
    z = np.zeros((buckets + 1, classes))
    n = np.zeros((buckets + 1, classes))
    penalty = np.full((buckets + 1, 1), l1 * len(rows))
    penalty[buckets] = 0

    def weight(index: np.ndarray) -> np.ndarray:
        zi = z[index]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - penalty[index], 0)
        return -shrunk / ((beta + np.sqrt(n[index])) / alpha + l2 * len(rows))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index = np.append(rows[i][0], buckets)
            x = np.append(rows[i][1], 1.0)
            w = weight(index)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p
            root = np.sqrt(n[index])
            n[index] += g * g
            z[index] += g - (np.sqrt(n[index]) - root) / alpha * w
    w = weight(np.arange(buckets + 1))
    return w[:buckets], w[buckets]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        return float((top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
                      - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train_language_model(
    train: DataFrame, text: str = "text", label: str = "lang", key: Column | None = None,
    max_rows: int = MAX_ROWS, orders: tuple[int, ...] = ORDERS, bits: int = BUCKET_BITS,
) -> LanguageModel:
    """Fit the model; rows with a null text or label are left out.

    Without any such row the model has no language and predicts ``und`` everywhere. The
    number of languages must be at most ``max_rows``.
    """
    train = train.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("_text"), F.col(label).alias("_label"),
        (key if key is not None else F.xxhash64(text)).alias("_key"))
    counted, rows = document_frequencies(train, "_text", orders, bits)
    idf = np.log((1 + rows) / (1 + counted)) + 1
    # Distinct labels, checked against the bound.
    sizes = dict(train.groupBy("_label").count().limit(max_rows + 1).collect())
    languages = sorted(sizes)
    if len(languages) > max_rows:
        raise ValueError(f"more than {max_rows} languages")
    if not languages:
        empty = np.zeros((1 << bits, 0))
        return LanguageModel([], empty, np.zeros(0), idf, 1.0, orders, bits)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(t, orders, bits) for t in _texts(batch, "_text")]
            yield pa.RecordBatch.from_pydict({
                "label": batch.column(1),
                "order": batch.column(2),
                "found": pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()),
                "counts": pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
            })

    sample = bounded_sample(train, "_text", "_label", F.col("_key"), sizes, max_rows)
    chosen = sorted(
        sample.select("_text", "_label", "_order").mapInArrow(
            lean(features), "label string, order long, found binary, counts binary").collect(),
        key=lambda r: (r["order"], r["label"], r["found"]))
    number = {name: i for i, name in enumerate(languages)}
    vectors, labels = [], []
    for row in chosen:
        found = np.frombuffer(row["found"], np.int32)
        vectors.append((found, tfidf(found, np.frombuffer(row["counts"], np.int32), idf)))
        labels.append(number[row["label"]])
    held = [i for i in range(len(chosen)) if i % CALIBRATION_PART == CALIBRATION_PART - 1]
    fit = [i for i in range(len(chosen)) if i % CALIBRATION_PART != CALIBRATION_PART - 1]
    weights, bias = fit_ftrl([vectors[i] for i in fit], [labels[i] for i in fit],
                             1 << bits, len(languages))
    logits = np.array([vectors[i][1] @ weights[vectors[i][0]] + bias for i in held])
    temperature = fit_temperature(logits, np.array([labels[i] for i in held], int))
    return LanguageModel(languages, weights, bias, idf, temperature, orders, bits)


def predict_languages(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` and (lang_pred, score) per row, from the text alone.

    A text that is null or has no letter, and every text of a model without languages, is
    ``und`` with score 0. Very long texts are read whole, one at a time; of languages that tie the
    first in the model's order is taken; repeated rows get equal answers. The model is ``2**bits`` times the number of languages numbers,
    sent to each executor once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    own = text in keep  # a text that is kept travels once
    columns = [*keep] if own else [*keep, "_text"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weights = m.weights.astype(np.float32)
        at = columns.index(text if own else "_text")
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                names, scores = [], []
                for value in part.column(at):
                    t = value.as_py()
                    if not m.languages or not t or not any(map(str.isalpha, t)):
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    found, counts = ngram_counts(t, m.orders, m.bits)
                    logits = (tfidf(found, counts, m.idf) @ weights[found] + m.bias) / m.temperature
                    p = np.exp(logits - logits.max())
                    best = int(p.argmax())
                    names.append(m.languages[best])
                    scores.append(float(p[best] / p.sum()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*keep, "lang_pred", "score"])

    read = docs.select(*keep, *([] if own else [F.col(text).alias("_text")]))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return read.mapInArrow(lean(predict), schema)
