"""Toxicity of texts by a factorization machine over hashed terms.

Terms of a text: its lower-case words, and the first 4 and 5 characters' bytes of each, hashed to
2**18 buckets, each counted once per text. The model keeps the VOCAB buckets that tell the labels
apart best (chi square) and learns

    score = sigmoid(w0 + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2))

so a pair of terms, such as an insult and the mention of a group, has a weight of its own (the
product of two vectors) beside those of the terms. Training runs in one executor task, and one for each
fold, on at most SAMPLE labelled rows, the first in hash order (a documented bound); scoring covers every whole text. The
bias is then moved so that the cut with the best F1, over learning rows scored by models that have not
seen them, is at a score of 0.7.

Null and empty texts have no term and get the score of the bias. Labels of ids that are null or not
in the table are ignored; repeated labels count as often as they are there. A table without labels
of both kinds gives the bias of what there is. Extra columns do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import by_value, table, tidy, trim
from .words import buffers, hashes, loads, mixed, words

by_value(__name__)

BITS, VOCAB, FACTORS = 18, 2048, 8
SAMPLE, STEPS, RATE, DECAY = 16000, 1200, 0.02, 2e-4
PREFIXES = (4, 5)
#: Chi square that chance exceeds for one term in a thousand; on few labels it keeps terms of noise out.
SURE = 10.83
#: Parts of the learning rows, each scored by a model of the others, from which the cut is chosen.
FOLDS = 3
TOXIC_FROM = 0.7

#: Letters, digits and all bytes beyond ASCII make words.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, sorted: buckets and offsets (n + 1)."""
    data, offsets = buffers(pc.utf8_lower(column.cast(pa.large_string())))
    n = len(offsets) - 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    start, length, doc = words(data, offsets, IS_TERM)
    first = loads(padded)[start]
    kinds = [hashes(padded, start, length)]
    for k in PREFIXES:
        kinds.append(mixed((first & np.uint64((1 << (8 * k)) - 1)) * np.uint64(2 * k + 1) + np.uint64(k))[length >= k])
    owner = np.concatenate([doc, *(doc[length >= k] for k in PREFIXES)])
    key = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(kinds) >> np.uint64(64 - BITS)))
    return (key & np.uint64((1 << BITS) - 1)).astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=n))])


def chosen(rows: list[np.ndarray], y: np.ndarray, vocab: int) -> np.ndarray:
    """The buckets that tell the labels apart best, by chi square with a half added to every cell."""
    on, off = (np.bincount(np.concatenate([r for r, t in zip(rows, y) if t == k] or [np.zeros(0, np.int64)]), minlength=1 << BITS).astype(float) for k in (1, 0))
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    a, b, c, d = on + 0.5, off + 0.5, n1 - on + 0.5, n0 - off + 0.5
    chi = (a * d - b * c) ** 2 * (a + b + c + d) / ((a + b) * (c + d) * (a + c) * (b + d))
    chi[on + off < 3] = 0
    best = np.argsort(-chi, kind="stable")[:vocab]
    return np.sort(best[chi[best] > SURE])


def fitted(rows: list[np.ndarray], y: np.ndarray, vocab: int = VOCAB, factors: int = FACTORS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> dict[str, np.ndarray]:
    """The factorization machine by Adam on the logistic loss, in `steps` batches of 256, with a fixed seed."""
    prior = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    ids = chosen(rows, y, vocab) if len(y) else np.zeros(0, np.int64)
    place = np.full(1 << BITS, -1, np.int64)
    place[ids] = np.arange(len(ids))
    k = len(ids)
    r = np.random.default_rng(7)
    model = {"b": np.array([prior]), "w": np.zeros(k), "v": r.normal(0, 0.01, (k, factors))}
    if not k or not 0 < y.sum() < len(y):
        return model | {"ids": ids}
    own = [p[p >= 0] for p in (place[x] for x in rows)]
    first, second = ({n: np.zeros_like(p) for n, p in model.items()} for _ in range(2))
    t = 0
    while t < steps:
        order = r.permutation(len(y))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            x = np.zeros((len(some), k), np.float32)
            for i, j in enumerate(some):
                x[i, own[j]] = 1
            s = x @ model["v"]
            z = model["b"] + x @ model["w"] + 0.5 * ((s * s).sum(1) - x @ (model["v"] ** 2).sum(1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            gx = x.T @ g
            grad = {"b": g.sum(keepdims=True), "w": gx + decay * model["w"], "v": x.T @ (g[:, None] * s) - gx[:, None] * model["v"] + decay * model["v"]}
            t += 1
            for n in model:
                first[n] = 0.9 * first[n] + 0.1 * grad[n]
                second[n] = 0.999 * second[n] + 0.001 * grad[n] ** 2
                model[n] = model[n] - rate * (first[n] / (1 - 0.9**t)) / (np.sqrt(second[n] / (1 - 0.999**t)) + 1e-8)
    return model | {"ids": ids}


def scores(model: dict[str, np.ndarray], buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    place = np.full(1 << BITS, -1, np.int64)
    place[model["ids"]] = np.arange(len(model["ids"]))
    at, doc = place[buckets], np.repeat(np.arange(n), np.diff(offsets))
    at, doc = at[at >= 0], doc[at >= 0]
    v = model["v"]
    z = model["b"] + np.bincount(doc, model["w"][at] - 0.5 * (v[at] ** 2).sum(1), minlength=n)
    for f in range(v.shape[1]):
        z = z + 0.5 * np.bincount(doc, v[at, f], minlength=n) ** 2
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The log-odds from which on calling a row toxic gives the best F1; of equals, the highest, half way to the next row below."""
    order = np.argsort(-z, kind="stable")
    z, hits = z[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][z[1:] == z[:-1]] = -1  # rows of one score stand or fall together
    at = int(np.argmax(f1))
    return float(z[at] if at + 1 == len(z) else (z[at] + z[at + 1]) / 2)


def joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def train(labelled: DataFrame, folds: int = FOLDS, limit: float = TOXIC_FROM, **more) -> dict[str, np.ndarray]:
    """labelled: text, toxic; a bounded sample. One executor task learns from all of it, and for each fold one from the rest, to score the fold.

    Equal texts are in one fold. The bias is moved so that the best cut of the folds' scores comes to be at `limit`.
    """

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, offsets = terms(batch.column(0))
            mark = [zlib.crc32(buckets[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets)), batch.column(1), pa.array(mark, pa.int64())], ["terms", "toxic", "mark"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mark", "toxic"], kind="stable")
        part, own, y, rows = pdf["part"].iloc[0], (pdf["mark"] % folds == pdf["part"]).to_numpy(), pdf["toxic"].to_numpy(float), list(pdf["terms"])
        del pdf
        m = fitted([r for r, o in zip(rows, own) if not o], y[~own], **more)
        if part < folds:
            m = {"z": logit(scores(m, *joined([r for r, o in zip(rows, own) if o]))), "y": y[own]}
        out = pd.DataFrame({"name": list(m), "value": [np.asarray(m[x], float).tobytes() for x in m], "width": [m[x].shape[-1] for x in m]})
        del rows, m
        trim()
        return out

    x = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(tidy(featured), "terms array<int>, toxic int, mark long")
    # the last part, of no fold, learns from all
    x = x.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(folds))))
    got = x.groupBy("part").applyInPandas(fit, "name string, value binary, width int").collect()
    held = {r["name"]: np.frombuffer(r["value"]) for r in got if r["name"] not in "zy"} or {x: np.asarray(y, float) for x, y in fitted([], np.zeros(0)).items()}
    factors = next((r["width"] for r in got if r["name"] == "v"), FACTORS)
    model = {"b": held["b"], "w": held["w"], "v": held["v"].reshape(-1, factors), "ids": held["ids"].astype(np.int64)}
    if not len(model["ids"]):
        return model
    # as many numbers as the sample has rows
    z, y = (np.concatenate([np.frombuffer(r["value"]) for r in got if r["name"] == c]) for c in "zy")
    return model | {"b": model["b"] + logit(np.array(limit)) - best_cut(z, y)}


def scored(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score. The model is VOCAB rows of FACTORS + 2 numbers and goes with the code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(model, *terms(part.column(1))), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), "doc_id long, score double")


def clean(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", limit: float = TOXIC_FROM) -> DataFrame:
    """The rows whose score is under the limit, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield part.filter(pa.array(scores(model, *terms(part.column(at))) < limit))

    return docs.mapInArrow(tidy(run), docs.schema)


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def learned(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The model from `sample` labelled rows that are not held out, the first by hash of their id."""
    own = labels.where(F.col("toxic").isin(0, 1)).where(~held_out()).select("doc_id", "toxic")
    own = own.orderBy(F.xxhash64("doc_id", "toxic"), "doc_id").limit(sample)
    # at most `sample` rows of two numbers are broadcast
    return train(docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "toxic"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(spark, docs, table(spark, sf_dir, "labels"))
    x = scored(docs, model)
    return x.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
