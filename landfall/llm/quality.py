"""Quality from document labels: attention-based multiple-instance learning, in numpy.

A document is a bag of passages of ``PASSAGE`` characters. A passage is encoded by what kinds of characters follow each
other in it and by how much of it is new, through a layer of tanh units. Gated attention, tanh(V h) * sigmoid(U h),
weighs the passages of a document; the weighted mean of their encodings is scored by a logistic unit. Labels exist for
documents only; which passages matter is learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, slices, values

PASSAGE = 1024
HIDDEN = 24
ATTENTION = 12
MOST_DOCUMENTS = 3_000
EPOCHS = 40
BATCH = 64
RATE = 0.004
DECAY = 1e-4
SEED = 7
GRAMS = 2048            # buckets that tell how many distinct four-character groups a passage has
TEXTS_CHARS = 1 << 21

# Kinds of characters: these by themselves, the rest by class (fixed values).
ALONE = "\n .,;:!?'\"-#*$%&|<>()[]{}/\\@_=+~^"
LOWER, UPPER, DIGIT, SPACE, OTHER, HIGH = (len(ALONE) + k for k in range(6))
KINDS = len(ALONE) + 6
WIDTH = KINDS * KINDS + 4


def kind_table() -> np.ndarray:
    table = np.full(1 << 16, HIGH, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c in ALONE:
            table[code] = ALONE.index(c)
        elif c.isupper():
            table[code] = UPPER
        elif c.isalpha():
            table[code] = LOWER
        elif c.isdigit():
            table[code] = DIGIT
        elif c.isspace():
            table[code] = SPACE
        elif code < 256:
            table[code] = OTHER
    return table


class Passages:
    """Encodes whole texts as passages; an empty text is one passage of zeros."""

    def __init__(self):
        self.table = kind_table()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The passages' figures, a row each, and the number of passages per text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        number = np.maximum(1, -(-sizes // PASSAGE))
        first = np.cumsum(number) - number
        points = np.minimum(np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4"), (1 << 16) - 1)
        at = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        passage = np.repeat(first, sizes) + at // PASSAGE
        kind = self.table[points].astype(np.int64)
        n = int(number.sum())
        length = np.maximum(np.bincount(passage, minlength=n), 1)
        inside = passage[1:] == passage[:-1]
        cells = (passage[1:] * (KINDS * KINDS) + kind[:-1] * KINDS + kind[1:])[inside]
        follow = np.bincount(cells, minlength=n * KINDS * KINDS).reshape(n, -1)
        # Four characters that follow each other, hashed to buckets: few full ones mean that a passage repeats itself.
        group = points.astype(np.uint64)
        group = (group[3:] + group[2:-1] * 31 + group[1:-2] * 961 + group[:-3] * 29791) * np.uint64(0x9E3779B97F4A7C15)
        whole = passage[3:] == passage[:-3] if len(points) > 3 else np.zeros(0, bool)
        full = np.zeros(n * GRAMS, bool)
        full[(passage[3:] * GRAMS + (group >> np.uint64(53)).astype(np.int64))[whole]] = True
        distinct = full.reshape(n, GRAMS).sum(axis=1)
        groups = np.maximum(np.bincount(passage[3:][whole], minlength=n), 1) if len(points) > 3 else np.ones(n)
        expected = GRAMS * (1 - np.exp(-groups / GRAMS))
        newness = distinct / expected
        rows = np.empty((n, WIDTH), np.float32)
        rows[:, :-4] = np.sqrt(follow / length[:, None])
        rows[:, -4] = newness
        rows[:, -3] = newness < 0.3
        rows[:, -2] = np.log1p(length) / 7
        rows[:, -1] = np.log1p(np.repeat(number, number)) / 4
        return rows, number


@dataclass
class Model:
    """Parameters by name: encoder W, b; attention V, U, w; output c, d; and the mean and scale of the figures."""

    p: dict[str, np.ndarray]

    def forward(self, rows: np.ndarray, number: np.ndarray) -> dict[str, np.ndarray]:
        p, starts = self.p, np.cumsum(number) - number
        x = (rows - p["mean"]) / p["scale"]
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -50, 50)))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), number))
        a = e / np.repeat(np.add.reduceat(e, starts), number)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -50, 50)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "s": s}

    def gradients(self, rows: np.ndarray, number: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss."""
        p, f = self.p, self.forward(rows, number)
        bag = np.repeat(np.arange(len(number)), number)
        ds = (f["s"] - label) / len(label)
        dz = ds[:, None] * p["c"]
        dh = f["a"][:, None] * dz[bag]
        da = (dz[bag] * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * da, np.cumsum(number) - number)
        de = f["a"] * (da - mean[bag])
        dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dh + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ ds, "d": np.array(ds.sum())}

    def score(self, rows: np.ndarray, number: np.ndarray) -> np.ndarray:
        return self.forward(rows, number)["s"].astype(np.float64)


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Gradient descent (Adam) over shuffled batches of bags; deterministic."""
    rng = np.random.default_rng(SEED)
    number = np.array([len(b) for b in bags])
    rows = np.concatenate(bags)
    first = np.cumsum(number) - number

    def layer(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {"mean": rows.mean(axis=0), "scale": rows.std(axis=0) + 0.05, "W": layer(WIDTH, HIDDEN),
         "b": np.zeros(HIDDEN, np.float32), "V": layer(HIDDEN, ATTENTION), "U": layer(HIDDEN, ATTENTION),
         "w": layer(ATTENTION), "c": layer(HIDDEN), "d": np.zeros((), np.float32)}
    model, step = Model(p), 0
    m = {k: np.zeros_like(p[k]) for k in p}
    v = {k: np.zeros_like(p[k]) for k in p}
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            own = order[at:at + BATCH]
            pick = np.concatenate([np.arange(first[i], first[i] + number[i]) for i in own])
            step += 1
            for k, grad in model.gradients(rows[pick], number[own], labels[own]).items():
                grad = (grad + DECAY * p[k] * (k in "WVU")).astype(np.float32)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    model.p = p
    return model


def learn(df: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS, epochs: int = EPOCHS) -> Model | None:
    """A model from ``df`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    Fits on at most ``most`` labelled documents, those first in the order of their ids' hashes; that bound is the only
    sampling, and the passages of those documents are all that reaches the driver. Labels that are null, or ids that
    are, do not count; of several labels of an id the largest does. None without a labelled document.
    """
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
           .agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = df.select("doc_id", "text").join(F.broadcast(one), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages()
        for batch in batches:
            for part in slices(batch, "text"):
                figures, number = passages(values(part, "text", ""))
                # Sent as half precision: the model does not need more, and it is half the size.
                ends = 2 * WIDTH * np.cumsum(number)
                data = figures.astype("<f2").tobytes()
                bags = [data[e - 2 * WIDTH * n:e] for e, n in zip(ends, number)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(bags, pa.binary())],
                                                 names=["doc_id", "quality", "bag"])

    kind = df.schema["doc_id"].dataType.simpleString()
    label = labels.schema["quality"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, quality {label}, bag binary").orderBy("doc_id", "bag").collect()
    if not found:
        return None
    bags = [np.frombuffer(r["bag"], "<f2").reshape(-1, WIDTH).astype(np.float32) for r in found]
    return fit(bags, np.array([r["quality"] for r in found], np.float32), epochs)


def score(df: DataFrame, model: Model | None) -> DataFrame:
    """``df`` with ``score``: 0 to 1, higher for text like that labelled 1.

    Whole texts, one by one; a null text counts as empty, which is a bag of one empty passage. Without a model all are
    0.5. A column named score is replaced; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model, passages = shared.value, Passages()

        def work(part: pa.RecordBatch) -> dict:
            texts = values(part, "text", "")
            scores = np.full(len(texts), 0.5)
            held, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size > TEXTS_CHARS or i == len(texts) - 1:
                    if model:
                        scores[held:i + 1] = model.score(*passages(texts[held:i + 1]))
                    held, size = i + 1, 0
            return {"score": scores}
        return work

    return annotate(df, "text", "score double", make)
