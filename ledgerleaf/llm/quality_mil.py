"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is encoded from its bytes and words, a gated
attention learned from document labels weighs the passages, and the weighted representation is
scored.  Encoding and scoring run in Spark tasks over whole texts; only the fit, on a bounded
sample of labelled documents, runs on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import U64, crc_bucket, joined, staged, text_column, word_hashes, words

PASSAGE_WORDS = 64
#: Labelled documents the fit may see: the documented bound of the training sample.
SAMPLE = 4096
KEEP_AT = 0.3
#: Texts are encoded in stretches of about so many bytes.
STRETCH = 2 << 20

#: Byte classes: each punctuation mark by itself, letters by case, digits, spaces, line ends, other.
CLASS = np.full(256, 36, dtype=np.int64)
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASS[MARKS] = np.arange(len(MARKS))
CLASS[ord("a") : ord("z") + 1] = 32
CLASS[ord("A") : ord("Z") + 1] = 33
CLASS[ord("0") : ord("9") + 1] = 34
CLASS[32] = 35
CLASS[[10, 13]] = 37
CLASS[128:] = 38
N_CLASSES = 39
N_FEATURES = N_CLASSES + 7


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages of each text (1 at least)."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0]
    while cuts[-1] < len(texts):
        base = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, base + STRETCH, side="right"))))
    parts = [_encode(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
    if not parts:
        return np.zeros((0, N_FEATURES), dtype=np.float32), np.zeros(0, dtype=np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buffer, offsets = joined(texts)
    starts, stops, counts = words(buffer, offsets)
    passages = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    first_passage = np.cumsum(passages) - passages
    total = int(passages.sum())
    first_word = np.cumsum(counts) - counts
    rank = np.arange(len(starts)) - np.repeat(first_word, counts)
    of_word = np.repeat(first_passage, counts) + rank // PASSAGE_WORDS
    # a byte belongs to the passage of the last word that began before it, in its own text
    of_byte = np.repeat(first_passage, np.diff(offsets))
    heads = np.flatnonzero((rank % PASSAGE_WORDS == 0) & (rank > 0))
    step = np.zeros(len(buffer) + 1, dtype=np.int64)
    step[starts[heads]] = 1
    passed = np.cumsum(step)[:-1]
    if len(buffer):
        full = np.diff(offsets) > 0
        base = np.zeros(len(offsets) - 1, dtype=np.int64)
        base[full] = passed[offsets[:-1][full]] - step[offsets[:-1][full]]
        of_byte += passed - np.repeat(base, np.diff(offsets))
    histogram = np.bincount(of_byte * N_CLASSES + CLASS[buffer], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
    n_bytes = np.maximum(histogram.sum(1), 1)
    n_words = np.bincount(of_word, minlength=total)
    some = np.maximum(n_words, 1)
    hashes = word_hashes(buffer, starts, stops)
    lengths = stops - starts
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    key = np.sort((of_word.astype(U64) << U64(40)) | (hashes >> U64(24)))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    runs = np.flatnonzero(fresh)
    run_length = np.diff(np.append(runs, len(key)))
    owner = (key[runs] >> U64(40)).astype(np.int64)
    most = np.zeros(total, dtype=np.int64)
    np.maximum.at(most, owner, run_length)
    upper = (buffer >= 65) & (buffer <= 90)
    shouted = (upper[starts] & upper[stops - 1] & (lengths > 2)) if len(starts) else np.zeros(0, dtype=bool)
    per_word = np.stack([
        n_words / PASSAGE_WORDS,
        np.log1p(np.bincount(of_word, lengths, total) / some),
        np.bincount(owner, minlength=total) / some,
        most / some,
        np.bincount(of_word, again, total) / some,
        np.bincount(of_word, shouted, total) / some,
        np.bincount(of_word, lengths == 1, total) / some,
    ], axis=1)
    return np.hstack([np.sqrt(histogram / n_bytes[:, None]), per_word]).astype(np.float32), passages


@dataclass
class Model:
    """Encoder, gated attention and output layer; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, passages: np.ndarray) -> np.ndarray:
        if not len(passages):
            return np.zeros(0)
        return _forward(self.weights, (features - self.mean) / self.scale, passages)[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, passages: np.ndarray):
    """Hidden passages, both gates, attention weights, bag representations, probabilities."""
    at = np.cumsum(passages) - passages
    hidden = np.tanh(x @ w["enc"] + w["enc0"])
    gate_t, gate_s = np.tanh(hidden @ w["att_v"]), _sigmoid(hidden @ w["att_u"])
    energy = (gate_t * gate_s) @ w["att_w"]
    weight = np.exp(energy - np.repeat(np.maximum.reduceat(energy, at), passages))
    weight /= np.repeat(np.add.reduceat(weight, at), passages)
    bag = np.add.reduceat(hidden * weight[:, None], at, axis=0)
    return hidden, gate_t, gate_s, weight, bag, _sigmoid(bag @ w["out"] + w["out0"])


def fit(features: np.ndarray, passages: np.ndarray, labels: np.ndarray, hidden: int = 24, gates: int = 12,
        steps: int = 240, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the logistic loss of the bags, over the whole sample in every step."""
    rng = np.random.default_rng(seed)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    x, y = ((features - mean) / scale).astype(np.float64), labels.astype(np.float64)
    d = x.shape[1]
    w = {
        "enc": rng.normal(0, d**-0.5, (d, hidden)), "enc0": np.zeros(hidden),
        "att_v": rng.normal(0, hidden**-0.5, (hidden, gates)), "att_u": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "att_w": rng.normal(0, gates**-0.5, gates), "out": rng.normal(0, hidden**-0.5, hidden), "out0": np.zeros(1),
    }
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    at = np.cumsum(passages) - passages
    for step in range(1, steps + 1):
        h, t, s, weight, bag, p = _forward(w, x, passages)
        d_logit = (p - y) / len(y)
        d_bag = np.outer(d_logit, w["out"])
        rows = np.repeat(d_bag, passages, axis=0)
        d_weight = (rows * h).sum(1)
        d_energy = weight * (d_weight - np.repeat(np.add.reduceat(weight * d_weight, at), passages))
        d_gates = np.outer(d_energy, w["att_w"])
        d_t, d_s = d_gates * s * (1 - t * t), d_gates * t * s * (1 - s)
        d_h = rows * weight[:, None] + d_t @ w["att_v"].T + d_s @ w["att_u"].T
        d_pre = d_h * (1 - h * h)
        grad = {
            "enc": x.T @ d_pre, "enc0": d_pre.sum(0), "att_v": h.T @ d_t, "att_u": h.T @ d_s,
            "att_w": (t * s).T @ d_energy, "out": bag.T @ d_logit, "out0": d_logit.sum(keepdims=True),
        }
        for k, g in grad.items():
            g = g + decay * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def training_sample(docs: DataFrame, labels: DataFrame, trainable: Column, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Encoded passages, passage counts and labels of at most ``sample`` labelled documents.

    Of the rows that ``trainable`` admits, those with the smallest hash of their id are taken.
    Ids with null or contradicting labels are left out.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high"))
    chosen = known.filter("low = high").filter(trainable).select(F.col("doc_id").alias("chosen_id"), F.col("high").alias("label"))
    chosen = staged(chosen.orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(sample), "quality-sample")

    def encoded(batches):
        for batch in batches:
            features, passages = encode(batch.column("text"))
            ends = np.cumsum(passages)
            rows = [features[e - n : e].tobytes() for e, n in zip(ends, passages)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("doc_id"), pa.array(passages), pa.array(rows, pa.binary())], ["label", "doc_id", "passages", "features"])

    # at most ``sample`` ids: small whatever the input; repeated rows of an id count once
    texts = docs.select("doc_id", text_column().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").cast("double").alias("label"))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    table = texts.mapInArrow(encoded, f"label double, doc_id {id_kind}, passages bigint, features binary").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    features = np.frombuffer(b"".join(table.column("features").to_pylist()), dtype=np.float32).reshape(-1, N_FEATURES)
    return features, table.column("passages").to_numpy(), table.column("label").to_numpy()


def train(docs: DataFrame, labels: DataFrame, trainable: Column, sample: int = SAMPLE) -> Model | None:
    """The fitted model, or None if no document is both labelled and admitted."""
    features, passages, y = training_sample(docs, labels, trainable, sample)
    return fit(features, passages, y) if len(y) else None


#: Digits of a score behind the point.
DIGITS = 9


def scorer(model: Model | None) -> Callable[[Column], Column]:
    """A column function from whole texts to the probability of label 1 (0.5 without a model)."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(texts), 0.5))
        # sums of a batch depend on its rows in their last bits; equal texts must score alike
        return pa.array(np.round(model.score(*encode(texts)).astype(np.float64), DIGITS))

    return score


def scored(docs: DataFrame, model: Model | None, threshold: float = KEEP_AT) -> DataFrame:
    """``doc_id, score, predicted`` of every row.

    A null text is empty; an empty text is one passage without bytes.  Repeated rows and null
    ids give their own rows; no column but ``text`` enters a score.
    """
    out = docs.select("doc_id", scorer(model)(text_column()).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def kept(docs: DataFrame, model: Model | None, threshold: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    return docs.filter(scorer(model)(text_column()) >= threshold)


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return crc_bucket() == 0


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, ~held_out())
    texts = docs.select("doc_id", held_out().alias("held_out"), scorer(model)(text_column()).alias("score"))
    return texts.withColumn("predicted", F.when(F.col("score") >= KEEP_AT, 1).otherwise(0).cast("int"))
