"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over overlapping chunks that cover the whole
document, each filter keeps its maximum per chunk, and mean and maximum over the chunks go
through a small hidden layer into one probability. Scoring is a map over the rows: no
shuffle, and a step works on a fixed number of chunks, however long the text is.

The network is fitted on a bounded sample of labels (`rows`, picked by a seeded hash; of a
text of more than `train_bytes` bytes a seeded piece); every row is scored on its whole text.

Null text counts as empty; an empty text has a score too (one chunk of padding). Repeated
rows get equal scores. Labels that are null, or whose document is missing, are not learned
from; without two classes to learn from the score is the share of label 1, or one half
without labels. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import piece, seeded, staged, steps, text_spans

CHUNK, OVERLAP, KERNEL, STRIDE = 512, 64, 8, 2
DEPTH, FILTERS, HIDDEN = 8, 32, 16
BLOCK = 16  # chunks per step
PAD = 256


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    constant: float | None = None


def chunk_index(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of every chunk; neighbours share OVERLAP bytes, the last one reaches
    the end of the text."""
    step = CHUNK - OVERLAP
    counts = np.maximum(1, -(-(lengths - OVERLAP) // step))
    row = np.repeat(np.arange(len(lengths)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return row, (np.arange(len(row)) - first) * step


def chunk_bytes(raw: np.ndarray, offsets: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    at = (offsets[row] + start)[:, None] + np.arange(CHUNK)
    inside = at < offsets[row + 1][:, None]
    if not len(raw):
        return np.full(at.shape, PAD, np.int16)
    return np.where(inside, raw[np.minimum(at, len(raw) - 1)].astype(np.int16), np.int16(PAD))


def convolve(w: dict[str, np.ndarray], chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of each filter per chunk, and where it is."""
    embedded = w["embed"][chunks]
    n = len(chunks)
    at = (CHUNK - KERNEL) // STRIDE + 1
    s = embedded.strides
    windows = np.lib.stride_tricks.as_strided(
        embedded, (n, at, KERNEL * DEPTH), (s[0], s[1] * STRIDE, s[2])
    ).reshape(n * at, KERNEL * DEPTH)
    z = (windows @ w["filters"]).reshape(n, at, FILTERS)
    best = z.argmax(axis=1)
    top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0, :] + w["bias"]
    return np.maximum(top, 0), best


def pooled(w: dict[str, np.ndarray], raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean and maximum over its chunks, for each text."""
    n = len(offsets) - 1
    row, start = chunk_index(np.diff(offsets))
    total, most = np.zeros((n, FILTERS)), np.zeros((n, FILTERS))
    for lo in range(0, len(row), BLOCK):
        r = row[lo : lo + BLOCK]
        top, _ = convolve(w, chunk_bytes(raw, offsets, r, start[lo : lo + BLOCK]))
        first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        total[r[first]] += np.add.reduceat(top, first, axis=0)
        most[r[first]] = np.maximum(most[r[first]], np.maximum.reduceat(top, first, axis=0))
    return np.hstack([total / np.bincount(row, minlength=n)[:, None], most])


def probability(w: dict[str, np.ndarray], features: np.ndarray) -> np.ndarray:
    hidden = np.tanh(features @ w["inner"] + w["inner_bias"])
    z = hidden @ w["outer"] + w["outer_bias"]
    return 1 / (1 + np.exp(-np.clip(z[:, 0], -40, 40)))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 32, seed: int = 7) -> Network:
    if len(texts) == 0 or len(set(labels.tolist())) < 2:
        return Network({}, float(labels.mean()) if len(texts) else 0.5)
    rng = np.random.default_rng(seed)
    w = {
        "embed": rng.normal(0, 0.3, (PAD + 1, DEPTH)),
        "filters": rng.normal(0, 0.15, (KERNEL * DEPTH, FILTERS)),
        "bias": np.zeros(FILTERS),
        "inner": rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)),
        "inner_bias": np.zeros(HIDDEN),
        "outer": rng.normal(0, 0.3, (HIDDEN, 1)),
        "outer_bias": np.zeros(1),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    w["embed"][PAD] = 0
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    share = labels.mean()
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    step = 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs) + 0.0004
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            step += 1
            grads = gradients(w, [texts[i] for i in pick], labels[pick], balance[pick])
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            w["embed"][PAD] = 0
    return Network(w)


def gradients(w: dict[str, np.ndarray], texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss. The maximum passes a gradient to one window per chunk and
    filter, so only those windows are gathered."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    row, start = chunk_index(np.diff(offsets))
    n = len(texts)
    chunks = chunk_bytes(raw, offsets, row, start)
    parts = [convolve(w, chunks[lo : lo + BLOCK]) for lo in range(0, len(chunks), BLOCK)]
    top, best = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    counts = np.bincount(row, minlength=n)[:, None]
    mean, most = np.add.reduceat(top, first, axis=0) / counts, np.maximum.reduceat(top, first, axis=0)
    f = np.hstack([mean, most])
    hidden = np.tanh(f @ w["inner"] + w["inner_bias"])
    p = 1 / (1 + np.exp(-np.clip((hidden @ w["outer"] + w["outer_bias"])[:, 0], -40, 40)))
    dz = ((p - labels) * weight / n)[:, None].astype(np.float32)
    dh = dz @ w["outer"].T * (1 - hidden**2)
    df = dh @ w["inner"].T
    dmean, dmost = df[:, :FILTERS] / counts, df[:, FILTERS:]
    is_most = top == most[row]
    ties = np.add.reduceat(is_most.astype(np.int64), first, axis=0)[row]
    dtop = (dmean[row] + np.where(is_most, dmost[row] / np.maximum(ties, 1), 0)) * (top > 0)
    at = best[:, :, None] * STRIDE + np.arange(KERNEL)
    seen = chunks[np.arange(len(chunks))[:, None, None], at]
    windows = w["embed"][seen].reshape(len(chunks), FILTERS, KERNEL * DEPTH)
    dembed = np.zeros_like(w["embed"])
    back = dtop[:, :, None] * w["filters"].T[None]
    np.add.at(dembed, seen.reshape(-1), back.reshape(-1, DEPTH).astype(np.float32))
    return {
        "embed": dembed,
        "filters": np.einsum("cfk,cf->kf", windows, dtop, optimize=True),
        "bias": dtop.sum(axis=0),
        "inner": f.T @ dh,
        "inner_bias": dh.sum(axis=0),
        "outer": hidden.T @ dz,
        "outer_bias": dz.sum(axis=0),
    }


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = 2400,
    train_bytes: int = 1 << 16,
    seed: int = 7,
) -> Network:
    """Fit on at most `rows` labels, picked by a seeded hash of their id among those that
    have a document; of a text of more than `train_bytes` bytes on a seeded piece. Labels of
    one id and kind count once, and so do their documents. Only the texts of these few
    documents are moved."""
    given = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    given = given.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).distinct()
    there = docs.select(F.col(id_col).alias("_id")).distinct()
    picked = given.join(there, "_id", "left_semi").withColumn("_h", seeded(seed, F.col("_id")))
    picked = staged(picked.orderBy("_h", "label").limit(rows), "cnn-labels")
    # at most `rows` rows, so they can go to every task
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(picked), "_id").withColumn("text", piece(F.col("text"), seed, train_bytes))
    sample = staged(sample.groupBy("_id", "label", "_h").agg(F.min("text").alias("text")), "cnn-sample")
    got = sample.orderBy("_h", "label").collect()
    return train([r["text"].encode() for r in got], np.array([r["label"] for r in got], np.float32), seed=seed)


def score(df: DataFrame, network: Network, keep: list[str], text_col: str = "text", out_col: str = "score") -> DataFrame:
    """The columns `keep` and `out_col`, the probability of label 1, for every row."""
    schema = df.select(*keep).schema.add(out_col, "double")
    text_at = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(text_at))
            if network.constant is not None:
                out = np.full(batch.num_rows, network.constant)
            else:
                parts = [
                    probability(network.weights, pooled(network.weights, raw, offsets[lo : hi + 1]))
                    for lo, hi in steps(offsets)
                ]
                out = np.concatenate([*parts, np.zeros(0)])
            columns = [*batch.columns[: len(keep)], pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, out_col])

    chosen = df.select(*(df[c] for c in keep), *([] if text_col in keep else [df[text_col]]))
    return chosen.mapInArrow(run, schema)
