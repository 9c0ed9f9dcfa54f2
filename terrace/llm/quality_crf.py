"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. The features of a line are shares of character classes,
word statistics and repetition within the document, each also taken from the neighbouring
lines. The field is fitted on a bounded sample of labelled documents whose lines carry the
label of their document. A document's quality is the mean of the forward-backward marginals of
"good", weighted by line length, put on the scale of the labels by a logistic fit on the same
sample.

Sample: at most ``sample_docs`` documents of each label, of each at most ``sample_lines``
consecutive lines. Everything else reads whole texts.

Edge cases: null and empty texts count as one empty line; without labels of both kinds every
score is the share of good labels (0.5 if there are none); duplicated label rows count once per
row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import text_blocks

SYMBOLS = "#*$%&|<>{}[]\\^~_=@"
CLASSES = ("upper", "lower", "digit", "space", "symbol", "bang", "stop", "other")
OWN = 14
FEATURES = 3 * OWN + 1


@dataclass(frozen=True)
class Field:
    weights: np.ndarray      # [2 states, features]
    change: np.ndarray       # [2, 2] transition scores
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float


def _class_table() -> np.ndarray:
    table = np.full(0x3000, 7, dtype=np.uint8)
    for i in range(len(table)):
        c = chr(i)
        if c.isupper():
            table[i] = 0
        elif c.isalpha():
            table[i] = 1
        elif c.isdigit():
            table[i] = 2
        elif c.isspace():
            table[i] = 3
        elif c in SYMBOLS:
            table[i] = 4
        elif c in "!?":
            table[i] = 5
        elif c in ".,;:":
            table[i] = 6
    return table


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, line lengths and the number of lines of each text."""
    table = _class_table()
    lines = [t.split("\n") for t in texts]
    counts = np.array([len(x) for x in lines], dtype=np.int64)
    flat = [x for ls in lines for x in ls]
    size = np.array([len(x) for x in flat], dtype=np.int64)
    codes = np.frombuffer("\n".join(flat).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = table[np.minimum(codes, len(table) - 1)]
    starts = np.cumsum(size + 1) - size - 1
    share = np.zeros((len(flat), len(CLASSES)))
    if len(kinds):
        for k in range(len(CLASSES)):
            upto = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
            share[:, k] = upto[starts + size] - upto[starts]
    own = np.zeros((len(flat), OWN))
    letters = np.maximum(share[:, 0] + share[:, 1], 1)
    length = np.maximum(size, 1)
    own[:, 0] = share[:, 0] / letters
    for k in (2, 4, 5, 6, 7):
        own[:, k - 1 if k < 3 else k - 2] = share[:, k] / length
    own[:, 6] = np.log1p(size)
    i = 0
    for ls in lines:
        seen: set[str] = set()
        for x in ls:
            words = x.split()
            n = len(words)
            if n:
                own[i, 7] = np.log1p(n)
                own[i, 8] = 1 - len(set(words)) / n
                own[i, 9] = sum(map(str.__eq__, words, words[1:])) / n
                own[i, 10] = size[i] / n
                own[i, 11] = x in seen
                own[i, 12] = words[-1][-1] not in ".!?"
                seen.add(x)
            else:
                own[i, 13] = 1
            i += 1
    first = np.cumsum(counts) - counts
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first] = 0
    after[first + counts - 1] = 0
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1), size, counts


def _sequences(x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of documents by falling line count, their first lines, and how many documents have a
    line at each place, so that a step over places handles all documents at once."""
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    places = np.arange(counts.max() if len(counts) else 0)
    return order, first, np.searchsorted(-counts[order], -places, side="left")


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emit: np.ndarray, change: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log marginals [line, state] and expected transitions [2, 2] of all documents."""
    order, first, alive = _sequences(emit, counts)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    alpha[first] = emit[first]
    for i in range(1, len(alive)):
        at = first[:alive[i]] + i
        alpha[at] = emit[at] + _logsum(alpha[at - 1][:, :, None] + change[None], 1)
    for i in range(len(alive) - 2, -1, -1):
        at = first[:alive[i + 1]] + i
        beta[at] = _logsum(change[None] + (emit[at + 1] + beta[at + 1])[:, None, :], 2)
    z = np.repeat(_logsum(alpha[first + counts[order] - 1], 1)[np.argsort(order)], counts)
    marginal = alpha + beta - z[:, None]
    inner = np.ones(len(emit), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    pair = alpha[at - 1][:, :, None] + change[None] + (emit[at] + beta[at])[:, None, :] - z[at][:, None, None]
    return marginal, np.exp(pair).sum(axis=0)


def fit_field(x: np.ndarray, counts: np.ndarray, label: np.ndarray, size: np.ndarray, share_good: float,
              rounds: int = 120, l2: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; ``label`` has 0 or 1 per document."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    mean[-1], scale[-1] = 0, 1
    x = np.clip((x - mean) / scale, -6, 6)
    y = np.repeat(label, counts)
    gold = np.eye(2)[y]
    gold_pairs = np.zeros((2, 2))
    for s in (0, 1):
        gold_pairs[s, s] = (counts[label == s] - 1).sum()
    w, change = np.zeros((2, x.shape[1])), np.zeros((2, 2))
    m = [np.zeros_like(w), np.zeros_like(change)]
    v = [np.zeros_like(w), np.zeros_like(change)]
    n = max(1, len(x))
    for t in range(1, rounds + 1):
        marginal, pairs = forward_backward(x @ w.T, change, counts)
        grads = [(np.exp(marginal) - gold).T @ x / n + l2 * w, (pairs - gold_pairs) / n + 0.05 * change]
        for k, (p, g) in enumerate(zip((w, change), grads)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p -= 0.1 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
    field = Field(w, change, mean, scale, 1.0, 0.0)
    raw = raw_quality(field, None, counts, size, x)
    a, b = 1.0, 0.0
    prior = np.where(label == 1, share_good / max(label.mean(), 1e-9),
                     (1 - share_good) / max(1 - label.mean(), 1e-9))
    for _ in range(400):  # logistic scale, the sample weighted back to the labels' own shares
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = prior * (p - label)
        h = prior * p * (1 - p) + 1e-6
        a -= 0.3 * ((g * raw).mean() + 1e-3 * (a - 1)) / ((h * raw * raw).mean() + 1e-3)
        b -= 0.3 * g.mean() / h.mean()
        a, b = max(a, 0.05), float(np.clip(b, -20, 20))
    return Field(w, change, mean, scale, float(a), float(b))


def raw_quality(field: Field, x: np.ndarray | None, counts: np.ndarray, size: np.ndarray,
                ready: np.ndarray | None = None) -> np.ndarray:
    """Log odds of the length-weighted mean marginal of "good" of each document."""
    if ready is None:
        ready = np.clip((x - field.mean) / field.scale, -6, 6)
    marginal, _ = forward_backward(ready @ field.weights.T, field.change, counts)
    weight = np.maximum(size, 1).astype(float)
    first = np.cumsum(counts) - counts
    good = np.add.reduceat(np.exp(marginal[:, 1]) * weight, first) / np.add.reduceat(weight, first)
    good = np.clip(good, 1e-6, 1 - 1e-6)
    return np.log(good / (1 - good))


def _as_arrow(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*[F.col(c).cast("long").alias(c) for c in columns], F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 1200, sample_lines: int = 64) -> Field | float:
    """``labels`` has doc_id and quality (0 or 1), of the rows to learn from. Returns the share of
    good labels if one kind is missing."""
    labels = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    shares = {r["quality"]: r["n"] for r in labels.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share_good = (shares.get(1, 0)) / max(1, sum(shares.values())) if shares else 0.5
    if len(shares) < 2:
        return float(share_good)
    picked = None
    for q in (0, 1):
        part = labels.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        picked = part if picked is None else picked.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (doc_ids, quality), texts in text_blocks(batches, 4_000_000):
            x, size, counts = line_features(texts)
            at = 0
            for d, q, n in zip(doc_ids, quality, counts):
                begin = at + (d * 2654435761 % max(1, n - sample_lines + 1))
                stop = min(at + n, begin + sample_lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d], pa.int64()), pa.array([q], pa.int64()),
                     pa.array([x[begin:stop].astype("<f8").tobytes()], pa.binary()),
                     pa.array([size[begin:stop].tobytes()], pa.binary())], ["doc_id", "quality", "x", "size"])
                at += n

    joined = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = (_as_arrow(joined, "doc_id", "quality")
            .mapInArrow(run, "doc_id long, quality long, x binary, size binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    label = np.array([r["quality"] for r in rows], dtype=np.int64)
    if len(set(label.tolist())) < 2:
        return float(share_good)
    size = [np.frombuffer(r["size"], dtype=np.int64) for r in rows]
    x = np.concatenate([np.frombuffer(r["x"], dtype="<f8").reshape(-1, FEATURES) for r in rows])
    return fit_field(x, np.array([len(s) for s in size]), label, np.concatenate(size), share_good)


def score(docs: DataFrame, field: Field | float) -> DataFrame:
    """doc_id, score and bad_chars (characters in lines that are more likely bad) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (doc_ids,), texts in text_blocks(batches, 2_000_000):
            x, size, counts = line_features(texts)
            if isinstance(field, Field):
                raw = raw_quality(field, x, counts, size)
                value = 1 / (1 + np.exp(-np.clip(field.slope * raw + field.offset, -30, 30)))
                ready = np.clip((x - field.mean) / field.scale, -6, 6)
                marginal, _ = forward_backward(ready @ field.weights.T, field.change, counts)
                bad = np.add.reduceat(size * (marginal[:, 0] > marginal[:, 1]), np.cumsum(counts) - counts)
            else:
                value, bad = np.full(len(texts), field), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(value), pa.array(bad.astype(np.int64))],
                ["doc_id", "score", "bad_chars"])

    return _as_arrow(docs, "doc_id").mapInArrow(run, "doc_id long, score double, bad_chars long")
