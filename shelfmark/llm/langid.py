"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers of `HIDDEN` units read the bytes of a text, one from each side; every
position is labelled by a softmax over both states, and the probabilities of all positions are
averaged into the document's. Texts are read whole, in segments of `SEGMENT` bytes that start
from an empty state, so many segments of many texts are advanced by one matrix product.

Training is numpy on the driver: backpropagation through time and Adam, on windows of a bounded
sample of labelled rows (`SAMPLE` rows a language, chosen by a hash of the id, `SAMPLE_CHARS`
characters of each from a hashed position). The weights, a few thousand numbers, are sent to the
tasks. Language, source and id are never inputs of a prediction.

Defined results: a null text, or one without a letter, is `und` with score 0; so is every text
where no row could be learned from; ties go to the first language in alphabetical order; a null
id is not held out; repeated rows are rows each; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.frames import slices

HIDDEN = 12
SEGMENT = 128
LANES = 2048
SAMPLE = 300
SAMPLE_CHARS = 600
STEPS = 400
PAD = 256

Weights = dict[str, np.ndarray]


def held_out():
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def training_rows(documents: DataFrame) -> list[tuple[str, str]]:
    """(lang, text window): at most SAMPLE rows a language, those with the least hashes. Rows are
    counted first, and only hashes so low that about four times as many are expected go further, so
    what is ranked does not grow with the table."""
    order = F.xxhash64("doc_id", F.lit(1))
    known = documents.where(~held_out()).where("lang is not null and text is not null and text <> ''")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each label
    if not sizes:
        return []
    highest = {lang: min(2**64 * 4 * SAMPLE // n, 2**64 - 1) - 2**63 for lang, n in sizes.items()}
    bound = F.create_map(*[F.lit(x) for pair in sorted(highest.items()) for x in pair])
    known = known.where(order <= bound[F.col("lang")])
    window = F.substring("text", F.pmod(order, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1, F.lit(SAMPLE_CHARS))
    rows = known.select("lang", order.alias("_o"), window.alias("window"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_o", "window"))
    found = rows.withColumn("_n", nth).where(F.col("_n") <= SAMPLE).select("lang", "_o", "window").collect()
    return [(r["lang"], r["window"]) for r in sorted(found, key=lambda r: (r["lang"], r["_o"], r["window"]))]


# --- the network --------------------------------------------------------------------------
# Rows of the gates: update, reset, candidate. States are (HIDDEN, lanes).


def _start(rng: np.random.Generator, labels: int) -> Weights:
    weights: Weights = {}
    for side in "fb":
        weights[f"x{side}"] = rng.normal(0, 0.3, (3 * HIDDEN, PAD + 1))
        weights[f"u{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (3 * HIDDEN, HIDDEN))
        weights[f"c{side}"] = rng.normal(0, 0.3, (labels, HIDDEN))
        weights[f"x{side}"][:HIDDEN] += 1.0
    weights["c"] = np.zeros((labels, 1))
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _unroll(data: np.ndarray, x: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """States at every step of `data` (steps, lanes) and what the way back needs."""
    steps, lanes = data.shape
    h = np.zeros((HIDDEN, lanes))
    states, saved = np.empty((steps, HIDDEN, lanes)), []
    for t in range(steps):
        a, b = x[:, data[t]], u @ h
        z = _sigmoid(a[:HIDDEN] + b[:HIDDEN])
        r = _sigmoid(a[HIDDEN : 2 * HIDDEN] + b[HIDDEN : 2 * HIDDEN])
        n = np.tanh(a[2 * HIDDEN :] + r * b[2 * HIDDEN :])
        saved.append((h, z, r, n, b[2 * HIDDEN :]))
        h = n + z * (h - n)
        states[t] = h
    return states, saved


def _back(data: np.ndarray, u: np.ndarray, saved: list, into: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input table and the recurrent weights, from `into` at every state."""
    steps, lanes = data.shape
    du, dh = np.zeros_like(u), np.zeros((HIDDEN, lanes))
    at_input = np.empty((steps, 3 * HIDDEN, lanes))
    for t in reversed(range(steps)):
        h, z, r, n, c = saved[t]
        dh = dh + into[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * c * r * (1 - r)
        at_input[t] = np.concatenate((dz, dr, dn))
        inner = np.concatenate((dz, dr, dn * r))
        du += inner @ h.T
        dh = dh * z + u.T @ inner
    dx = np.zeros((size, 3 * HIDDEN))
    np.add.at(dx, data.ravel(), at_input.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN))
    return dx.T, du


def train(rows: list[tuple[str, str]], steps: int = STEPS, length: int = 64, lanes: int = 96, seed: int = 7) -> tuple[list[str], Weights]:
    """Labels in alphabetical order and the weights."""
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return [], {}
    rng = np.random.default_rng(seed)
    weights = _start(rng, len(labels))
    by_label = [[np.frombuffer(t.encode(), np.uint8) for lang, t in rows if lang == label] for label in labels]
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(labels), lanes)
        data = np.full((length, lanes), PAD, np.int64)
        for lane, label in enumerate(chosen):
            text = by_label[label][rng.integers(len(by_label[label]))]
            start = rng.integers(max(len(text) - length, 0) + 1)
            part = text[start : start + length]
            data[: len(part), lane] = part
        forward, saved_f = _unroll(data, weights["xf"], weights["uf"])
        backward, saved_b = _unroll(data[::-1], weights["xb"], weights["ub"])
        backward = backward[::-1]
        logits = weights["cf"] @ forward + weights["cb"] @ backward + weights["c"]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[:, chosen, np.arange(lanes)] -= 1
        p *= (data != PAD)[:, None, :] / max((data != PAD).sum(), 1)
        gradient: Weights = {
            "cf": np.einsum("tlb,thb->lh", p, forward),
            "cb": np.einsum("tlb,thb->lh", p, backward),
            "c": p.sum(axis=(0, 2))[:, None],
        }
        gradient["xf"], gradient["uf"] = _back(data, weights["uf"], saved_f, weights["cf"].T @ p, PAD + 1)
        gradient["xb"], gradient["ub"] = _back(data[::-1], weights["ub"], saved_b, (weights["cb"].T @ p)[::-1], PAD + 1)
        norm = np.sqrt(sum((g * g).sum() for g in gradient.values()))
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, g in gradient.items():
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return labels, weights


class Reader:
    """The trained network in single precision, with the halves of the sigmoids folded into the weights."""

    def __init__(self, weights: Weights) -> None:
        self.sides = []
        for side in "fb":
            x, u = weights[f"x{side}"].copy(), weights[f"u{side}"].copy()
            x[:, PAD] = 0
            x[:HIDDEN, PAD] = 60.0  # the update gate stays shut, so padding leaves the state as it is
            x[: 2 * HIDDEN] *= 0.5
            u *= 0.5
            self.sides.append((np.ascontiguousarray(x, np.float32), np.ascontiguousarray(u, np.float32)))
        self.out = [np.ascontiguousarray(weights[c], np.float32) for c in ("cf", "cb", "c")]

    def _step(self, codes: np.ndarray, side: int, h: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Advance `h` in place by one byte in every lane; `a` and `b` are room to work in."""
        x, u = self.sides[side]
        np.take(x, codes, axis=1, out=a, mode="clip")
        np.matmul(u, h, out=b)
        gates, z, r, n = a[: 2 * HIDDEN], a[:HIDDEN], a[HIDDEN : 2 * HIDDEN], a[2 * HIDDEN :]
        gates += b[: 2 * HIDDEN]
        np.tanh(gates, out=gates)
        gates += 1  # twice the sigmoid
        r *= b[2 * HIDDEN :]
        n += r
        np.tanh(n, out=n)
        h -= n
        h *= z
        h *= 0.5
        h += n

    def segments(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Summed label probabilities (labels, lanes) of segments (steps, lanes) padded by PAD."""
        steps, lanes = codes.shape
        states = np.empty((steps, HIDDEN, lanes), np.float32)
        h, a, b = np.zeros((HIDDEN, lanes), np.float32), np.empty((3 * HIDDEN, lanes), np.float32), np.empty((3 * HIDDEN, lanes), np.float32)
        for t in range(steps):
            self._step(codes[t], 0, h, a, b)
            states[t] = h
        h[:] = 0
        total = np.zeros((len(self.out[2]), lanes), np.float64)
        for t in reversed(range(steps)):
            self._step(codes[t], 1, h, a, b)
            p = self.out[0] @ states[t]
            p += self.out[1] @ h
            p += self.out[2]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p *= (t < sizes) / p.sum(axis=0)
            total += p
        return total

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean label probabilities (texts, labels); empty texts get zeros."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        parts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(np.cumsum(sizes) - sizes, parts) + nth * SEGMENT
        length = np.minimum(sizes[owner] - nth * SEGMENT, SEGMENT)
        result = np.zeros((len(texts), len(self.out[2])))
        step = np.arange(SEGMENT)[:, None]
        for lane in range(0, len(owner), LANES):
            some = slice(lane, lane + LANES)
            inside = step < length[some]
            codes = np.where(inside, data[np.minimum(start[some] + step, len(data) - 1)], PAD).astype(np.int64)
            np.add.at(result, owner[some], self.segments(codes, length[some]).T)
        return result / np.maximum(sizes, 1)[:, None]


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _label_batches(batches: Iterable[pa.RecordBatch], labels: list[str], weights: Weights) -> Iterator[pa.RecordBatch]:
    reader = Reader(weights) if labels else None
    for batch in slices(batches, "text", 4 << 20):
        texts = batch.column("text").to_pylist()
        lettered = [t if t is not None and _has_letter(t) else "" for t in texts]
        if reader:
            p = reader.documents([t.encode() for t in lettered])
            best = p.argmax(axis=1)
            named = [labels[b] if t else "und" for b, t in zip(best.tolist(), lettered)]
            score = [float(min(max(s, 0.0), 1.0)) if t else 0.0 for s, t in zip(p.max(axis=1), lettered)]
        else:
            named, score = ["und"] * len(texts), [0.0] * len(texts)
        columns = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in columns], pa.array(named, pa.string()), pa.array(score, pa.float64())],
            [*columns, "lang_pred", "score"],
        )


def identify(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of `documents` (doc_id, text, lang)."""
    trained = documents.sparkSession.sparkContext.broadcast(train(training_rows(documents.select("doc_id", "text", "lang"))))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(
        lambda b: _label_batches(b, *trained.value), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def _kept(batches: Iterable[pa.RecordBatch], labels: list[str], weights: Weights, least: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        (judged,) = _label_batches([batch.select(["text"])], labels, weights)
        good = pa.compute.and_(
            pa.compute.not_equal(judged.column("lang_pred"), "und"), pa.compute.greater_equal(judged.column("score"), least)
        )
        yield batch.filter(good)


def keep_identified(documents: DataFrame, *, least: float = 0.4) -> DataFrame:
    """Rows of `documents` with a language: labelled, by a pooled probability of `least` or more."""
    trained = documents.sparkSession.sparkContext.broadcast(train(training_rows(documents.select("doc_id", "text", "lang"))))
    return documents.mapInArrow(lambda b: _kept(b, *trained.value, least), documents.schema)
