"""Quality classifier by attention-based multiple-instance learning (operator 8).

A document is a bag of passages. Every passage is encoded; gated attention, learned from document labels alone, weighs the passages; the
weighted sum is scored. Fitting takes a bounded sample of labelled documents, scoring takes every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from attestra.llm.common import query, table

WORDS = 64  # of a passage
HASHED = 64
#: Character classes: 0 blank, 1 line end, 2 lower, 3 upper, 4 digit, 5 . and ,  6 ! and ?  7 | < >  8 # * $ % &  9 other signs, 10 letters beyond Latin-1, 11 further signs beyond it
CLASSES = 12


def class_table() -> np.ndarray:
    t = np.full(256, 9, "i8")
    for i in range(256):
        c = chr(i)
        t[i] = 1 if c == "\n" else 0 if c.isspace() else 4 if c.isdigit() else 3 if c.isupper() else 2 if c.isalpha() else t[i]
    for k, signs in ((5, ".,"), (6, "!?"), (7, "|<>"), (8, "#*$%&")):
        for c in signs:
            t[ord(c)] = k
    return t


TABLE = class_table()
N_FEATURES = CLASSES * CLASSES + HASHED + 4


def passages(text: str) -> np.ndarray:
    """One row of features for every passage of ``WORDS`` words; an empty text has one passage of zeros.

    Pairs of neighbouring character classes, hashed runs of three characters, words and their length, share of repeated words and of lines.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("i8")
    n = len(points)
    if n == 0:
        return np.zeros((1, N_FEATURES), "f4")
    kind = np.where(points < 256, TABLE[np.minimum(points, 255)], np.where(points < 0x2000, 10, np.where(points >= 0x2E80, 10, 11)))
    solid = kind > 1
    starts = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]]))
    bounds = starts[::WORDS] if len(starts) else np.zeros(1, "i8")
    k = len(bounds)
    at = np.zeros(n, "i8")
    at[bounds[1:]] = 1
    at = np.cumsum(at)  # the passage of each character
    sizes = np.maximum(np.bincount(at, minlength=k), 1).astype("f4")[:, None]
    pairs = CLASSES * CLASSES
    a = np.bincount(at[1:] * pairs + kind[:-1] * CLASSES + kind[1:], minlength=k * pairs).reshape(k, pairs)
    runs = (points[:-2] * 0x9E3779B1 + points[1:-1] * 0x85EBCA77 + points[2:] * 0xC2B2AE3D) >> 7 & (HASHED - 1)
    b = np.bincount(at[2:] * HASHED + runs, minlength=k * HASHED).reshape(k, HASHED)
    words = np.bincount(at[starts], minlength=k).astype("f4")[:, None]
    # a word's sum of spread code points tells it apart well enough to count repeats
    sums = np.add.reduceat(np.where(solid, (points * 0x9E3779B97F4A7C1 >> 5) & 0xFFFFFFFF, 0), starts) if len(starts) else np.zeros(0, "i8")
    own = at[starts] * (1 << 40) + (sums & ((1 << 40) - 1)) if len(starts) else sums
    distinct = np.bincount(np.unique(own) >> 40, minlength=k).astype("f4")[:, None] if len(starts) else words
    return np.concatenate([np.sqrt(a / sizes), np.sqrt(b / sizes), words / WORDS, sizes / (words + 1) / 10, distinct / (words + 1), np.sqrt(np.bincount(at, kind == 1, k)[:, None] / sizes)], axis=1).astype("f4")


@dataclass
class Model:
    """Encoder, gated attention and the score's weights; ``prior`` alone where the labels have one class."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray] | None
    prior: float

    def forward(self, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of all bags; first: a bag's first passage; bag: the bag of a passage."""
        p = self.p
        h = np.tanh(x @ p["we"] + p["be"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        if self.p is None:
            return np.full(len(bags), self.prior)
        n = np.array([len(x) for x in bags])
        x = (np.concatenate(bags) - self.mean) * self.scale
        return self.forward(x, np.cumsum(n) - n, np.repeat(np.arange(len(bags)), n))["s"].astype("f8")


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Gradient descent (Adam) on the cross-entropy of document labels through the attention; the same bags give the same model."""
    prior = float(labels.mean()) if len(labels) else 0.5
    width = N_FEATURES
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(width, "f4"), np.ones(width, "f4"), None, prior)
    whole = np.concatenate(bags)
    mean, scale = whole.mean(axis=0), 1 / (whole.std(axis=0) + 0.02)
    r = np.random.default_rng(seed)
    p = {"we": r.normal(0, width**-0.5, (width, hidden)), "be": np.zeros(hidden), "v": r.normal(0, hidden**-0.5, (hidden, gate)), "u": r.normal(0, hidden**-0.5, (hidden, gate)),
         "w": r.normal(0, gate**-0.5, gate), "c": r.normal(0, hidden**-0.5, hidden), "b": np.array(np.log(prior / (1 - prior)))}
    model = Model(mean, scale, p, prior)
    bags = [(x - mean) * scale for x in bags]
    m, v2, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for epoch in range(epochs):
        order = r.permutation(len(bags))
        for i in range(0, len(order), batch):
            pick = order[i:i + batch]
            n = np.array([len(bags[j]) for j in pick])
            first, bag = np.cumsum(n) - n, np.repeat(np.arange(len(pick)), n)
            x, y = np.concatenate([bags[j] for j in pick]), labels[pick]
            f = model.forward(x, first, bag)
            ds = (f["s"] - y) / len(pick)
            dz = ds[:, None] * p["c"]
            da = (dz[bag] * f["h"]).sum(axis=1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[bag])
            dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh = (f["a"][:, None] * dz[bag] + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
            grads = {"we": x.T @ dh, "be": dh.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ ds, "b": ds.sum()}
            step += 1
            for k, d in grads.items():
                d = d + decay * p[k]
                m[k], v2[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v2[k] + 0.001 * d * d
                p[k] = p[k] - rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def spread(x: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` rows, evenly spaced from the first to the last."""
    return x if len(x) <= most else x[np.linspace(0, len(x) - 1, most).round().astype(int)]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, text: str, id_col: str, label: str, most: int = 256) -> tuple[list[np.ndarray], np.ndarray]:
    """Passages and labels of at most ``per_class`` documents of each label, those with the least hashed ids.

    A document gives fitting at most ``most`` of its passages, evenly spaced over the whole text, so the bytes that reach the driver are bounded
    by 2 * per_class * most rows of features; scoring reads all passages. Ids are of any type that sorts.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).filter("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    picked = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    sample = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked[0].unionByName(picked[1])), "id")  # at most 2 * per_class ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [spread(passages(t or ""), most).astype("f2").tobytes() for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("id"), b.column("y"), pa.array(x, pa.binary())], ["id", "y", "x"])

    schema = StructType([StructField("id", sample.schema["id"].dataType), StructField("y", IntegerType()), StructField("x", BinaryType())])
    rows = sorted(sample.mapInArrow(run, schema).collect(), key=lambda r: (r.id, r.x))
    return [np.frombuffer(r.x, "f2").astype("f4").reshape(-1, N_FEATURES) for r in rows], np.array([r.y for r in rows], "f8")


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, text: str = "text", id_col: str = "doc_id", label: str = "quality", most: int = 256) -> Model:
    """A model from at most ``per_class`` documents of each label and ``most`` passages of each. Classes are drawn apart, so the score's level is set back to the labels' own share."""
    bags, y = labelled_sample(docs, labels, per_class, text, id_col, label, most)
    counts = {r.y: r.n for r in labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    model = fit(bags, y)
    if model.p is not None:
        odds, drawn = counts[1] / counts[0], y.sum() / (len(y) - y.sum())
        model.p["b"] = model.p["b"] + np.log(odds / drawn)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the score of every document from all its passages; null texts count as empty; a column named as the score is replaced."""
    docs = docs.drop(score)
    at, names = docs.columns.index(text), [*docs.columns, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, got = b.column(at), []
            for i in range(0, len(texts), 256):
                got.append(model.score([passages(t or "") for t in texts.slice(i, 256).to_pylist()]))
            yield pa.record_batch([*b.columns, pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())], names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.7, **options) -> DataFrame:
    """All rows of docs with score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold`` on).

    Only texts are inputs of a score. Ids without a text, labels without a document, null labels and labels other than 0 and 1 are passed
    over; an id with both labels counts as 0; labels of one class give their share as every score, no labels 0.5. No rows give no rows.
    """
    model = train(docs, labels, text=text, id_col=id_col, **options)
    return scored(docs, model, text).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


@query("op8_attention_quality")
def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = classify(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return got.select("doc_id", held_out().alias("held_out"), "score", "predicted")
