"""Language identification by error-correcting output codes.

Each language has a codeword of bits; one binary logistic classifier on byte n-grams
predicts each bit. A text gets the language whose codeword is nearest when every bit is
weighted by its logistic loss (loss-weighted decoding), so an unsure bit counts little. A
small margin over the second nearest flags the text as ambiguous.

Up to five languages have the exhaustive code (every split into two sides once); for more,
seeded random columns are drawn, ten per binary digit of the language count.

Classifiers are fitted on a bounded sample of labelled texts: `rows` in all, equally many per
language (all, of a language with fewer), each text once however often it occurs, picked by a
seeded hash; of a text of more than `train_bytes` bytes a seeded piece. Prediction is a map
over the rows, on whole texts. A null text or one without a letter is `und` with score 0 and
not ambiguous; so is every text if nothing could be learned. With one language learned it is
always predicted, with score 1. Repeated rows get equal results; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import piece, seeded, staged, steps, text_spans

DIM = 4096
AMBIGUOUS = 0.2  # of the score's distance between the first and the second language
UNKNOWN = "und"


@dataclass
class Codes:
    languages: list[str]
    words: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # features x bits
    bias: np.ndarray


def codewords(n: int, seed: int = 11) -> np.ndarray:
    if n <= 5:
        columns = [[1 if i == 0 or not (c >> (i - 1)) & 1 else -1 for i in range(n)] for c in range(1, 1 << max(n - 1, 0))]
        return np.array(columns, np.float64).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    bits = 10 * (n - 1).bit_length()
    best = None
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code[:, np.abs(code.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        apart = (bits - code @ code.T) / 2 + np.eye(n) * bits
        if best is None or apart.min() > best[0]:
            best = (apart.min(), code)
    return best[1]


# Letters of ASCII stay, other ASCII is space, bytes of other scripts stay.
FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of hashed counts of byte 1-, 2- and 3-grams, scaled to length 1."""
    n = len(offsets) - 1
    b = FOLD[raw]
    row = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros(n * DIM)
    value = np.zeros(len(b), np.uint32)
    for size in (1, 2, 3):
        m = len(b) - size + 1
        if m <= 0:
            break
        value = value[:m] * np.uint32(0x01000193) + b[size - 1 :] + np.uint32(size)
        slot = (value * np.uint32(0x9E3779B1)) >> np.uint32(20)
        whole = row[:m] == row[size - 1 :]
        out += np.bincount(row[:m][whole] * DIM + slot[whole], minlength=n * DIM)
    out = np.sqrt(out.reshape(n, DIM)).astype(np.float32)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def blocks(raw: np.ndarray, offsets: np.ndarray, rows: int = 64) -> Iterator[np.ndarray]:
    for lo, hi in steps(offsets):
        for at in range(lo, hi, rows):
            o = offsets[at : min(at + rows, hi) + 1]
            yield features(raw[o[0] : o[-1]], o - o[0])


def train(x: np.ndarray, labels: list[str], rounds: int = 150) -> Codes:
    languages = sorted(set(labels))
    code = codewords(len(languages))
    index = np.array([languages.index(v) for v in labels])
    share = np.bincount(index, minlength=len(languages)) / max(len(index), 1)
    weight = (1 / (len(languages) * share))[index][:, None] / max(len(index), 1)
    target = code[index]
    w, bias = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = x @ w + bias
        slope = -target * weight / (1 + np.exp(np.clip(target * z, -40, 40)))
        g = x.T @ slope + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        bias -= slope.sum(axis=0)
    return Codes(languages, code, w.astype(np.float32), bias)


def decode(codes: Codes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest language, its score, and whether it is ambiguous."""
    z = x @ codes.weights + codes.bias
    # weighted by its loss, each bit costs log(1 + exp(-bit * z))
    cost = np.stack([np.logaddexp(0, -z * word).sum(axis=1) for word in codes.words], axis=1)
    scale = max(1.0, codes.words.shape[1] / 2)
    p = np.exp(-(cost - cost.min(axis=1, keepdims=True)) / scale)
    p /= p.sum(axis=1, keepdims=True)
    best = cost.argmin(axis=1)
    ranked = np.sort(p, axis=1)
    margin = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0)
    return best, p.max(axis=1), margin < AMBIGUOUS


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = 1600, train_bytes: int = 1 << 16, seed: int = 11) -> Codes:
    """Fit on at most `rows` texts with a language, `rows` / languages of each."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.lower(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    usable = usable.withColumn("_h", seeded(seed, F.col("text")))
    # equal texts are one key, however many they are
    keys = staged(usable.groupBy("lang", "_h").agg(F.count("*").alias("copies")), "lang-keys")
    counts = staged(keys.groupBy("lang").count(), "lang-counts")
    share = max(rows // max(counts.count(), 1), 1)
    # the hash, spread over [0, 1), is below a language's rate for some 2 * `share` of its keys
    spread = F.col("_h").cast("double") / F.lit(2.0**64) + 0.5
    thinned = keys.join(counts, "lang").where(spread < (2 * share + 20) / F.col("count"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    picked = thinned.select("lang", "_h", turn.alias("turn")).where(F.col("turn") <= share).orderBy("turn", "_h", "lang").limit(rows)
    picked = staged(picked.select("lang", "_h"), "lang-picked")
    # at most `rows` keys, so they can go to every task
    texts = usable.join(F.broadcast(picked), ["lang", "_h"]).select(piece(F.col("text"), seed, train_bytes).alias("text"), "lang", "_h")
    sample = staged(texts.groupBy("lang", "_h").agg(F.first("text").alias("text")).select("text", "lang", "_h"), "lang-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(0))
            x = [v.astype(np.float32).tobytes() for part in blocks(raw, offsets) for v in part]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1), batch.column(2)], names=["x", "lang", "h"])

    got = sample.mapInArrow(vectors, "x binary, lang string, h long").collect()
    got.sort(key=lambda r: (r["h"], r["lang"]))
    if not got:
        return Codes([], np.zeros((0, 0)), np.zeros((DIM, 0), np.float32), np.zeros(0))
    return train(np.stack([np.frombuffer(r["x"], np.float32) for r in got]), [r["lang"] for r in got])


def predict(df: DataFrame, codes: Codes, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, `lang_pred`, `score` and `ambiguous` for every row."""
    schema = df.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_spans(batch.column(batch.num_columns - 2))
            known = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            if codes.languages:
                parts = [decode(codes, x) for x in blocks(raw, offsets)]
                best, p, unsure = (np.concatenate([np.zeros(0, t), *(r[i] for r in parts)]) for i, t in enumerate((int, float, bool)))
            else:
                best, p, unsure = np.zeros(len(known), int), np.zeros(len(known)), np.zeros(len(known), bool)
                known[:] = False
            names = [codes.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            columns = [pa.array(names, pa.string()), pa.array(np.where(known, p, 0.0)), pa.array(unsure & known)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=[*keep, "lang_pred", "score", "ambiguous"])

    text = df[text_col]
    chosen = df.select(
        *(df[c] for c in keep),
        F.lower(text).alias("_text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_known"),
    )
    return chosen.mapInArrow(run, schema)
