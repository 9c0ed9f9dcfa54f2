"""Language model scores by Brown classes.

Tokens are words between white space, A-Z lower-cased, and one end token per text. All training
texts count. Exchange clustering runs in two steps. The ``seeds`` most frequent words are
exchanged one after another, over the dense table of their bigram counts (all other words
stand in it as one): a word moves to the class that raises the likelihood of the class bigrams
most, until no word moves or ``rounds`` are over. Then every other word that occurs at least
twice is put into the class that makes the classes before and after all its occurrences
likeliest. Words that occur once share class 0 with unknown ones; the end token has class 1.

A token's probability is its smoothed unigram probability times the lift of its class after the
class before: p(w|v) = p(w) * p(C(w)|C(v)) / p(C(w)), with p(w) = (c + 0.1) / (N + 0.1 (V + 1)),
p(C) the sum of p(w) over the class and p(C'|C) = (n(C, C') + m p(C')) / (n(C) + m). Summed over
all words and the unknown word this gives one, whatever stands before; the perplexity of a
text is 10 ** (-score / n_tokens).

The texts are encoded once, in blocks with a dictionary each. The words' counts and contexts
meet in buckets of the word's hash; counts and classes go back to the blocks that have the word.
Only tables bounded by ``seeds`` and the number of classes reach the driver. Words are told
apart by a 64-bit hash.

Edge cases: null and empty texts are the end token alone; without training text all
probabilities come from the smoothing; rows that repeat an id are scored each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terrace.llm.common import stored, stored_alone, text_blocks, text_size

END = b"\n"                # cannot be a word
BLOCK_CHARS = 2_000_000
BUCKET_CHARS = 12_000_000
ADD = 0.1
ENCODED = ("block long, doc_ids array<long>, held array<boolean>, lengths binary, ids binary, keys binary")


def encode(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per block of texts: ids, lengths (tokens with the end), the tokens as numbers of the
    block's dictionary, and the dictionary's word hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, ((ids, held), texts) in enumerate(text_blocks(batches, BLOCK_CHARS)):
            number: defaultdict[bytes, int] = defaultdict(count().__next__)
            get = number.__getitem__
            tokens = [np.fromiter(map(get, [*t.encode("utf-8", "surrogatepass").lower().split(), END]), dtype="<u4")
                      for t in texts]
            words = list(number)
            keys = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
            flat = np.concatenate(tokens)
            kind = "<u2" if len(words) < 1 << 16 else "<u4"
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([held], pa.list_(pa.bool_())),
                 pa.array([np.array([len(t) for t in tokens], dtype="<u4").tobytes()], pa.binary()),
                 pa.array([flat.astype(kind).tobytes()], pa.binary()), pa.array([keys.tobytes()], pa.binary())],
                ["block", "doc_ids", "held", "lengths", "ids", "keys"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held"),
                        F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, ENCODED)


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, tokens and word hashes of a block."""
    keys = np.frombuffer(row["keys"], dtype=np.uint64)
    ids = np.frombuffer(row["ids"], dtype="<u2" if len(keys) < 1 << 16 else "<u4").astype(np.int64)
    return np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64), ids, keys


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _train(row: dict, lengths: np.ndarray) -> np.ndarray:
    return np.repeat(~np.asarray(row["held"], dtype=bool), lengths)


def seed_words(blocks: DataFrame, seeds: int) -> np.ndarray:
    """Sorted hashes of the most frequent training words (the end token excluded), by their counts
    over all blocks."""
    import xxhash

    end = xxhash.xxh64_intdigest(END)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths, ids, keys = _tokens(row)
            train = _train(row, lengths)
            n = np.bincount(ids[train], minlength=len(keys))
            some = np.flatnonzero((n > 0) & (keys != end))
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(n[some].astype(np.int64))], ["key", "n"])

    rows = blocks.select("held", "lengths", "ids", "keys").mapInArrow(run, "key long, n long") \
        .groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(seeds).collect()
    return np.sort(np.array([r["key"] for r in rows], dtype=np.int64).view(np.uint64))


def _places(seeds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each word in the seed table: 0 for other words, 1 for the end token, then the seeds."""
    import xxhash

    out = np.zeros(len(keys), dtype=np.int64)
    if len(seeds):
        at = np.minimum(np.searchsorted(seeds, keys), len(seeds) - 1)
        out = np.where(seeds[at] == keys, at + 2, 0)
    out[keys == np.uint64(xxhash.xxh64_intdigest(END))] = 1
    return out


def _before(of_tokens: np.ndarray, lengths: np.ndarray, end=1) -> np.ndarray:
    """What stands before each token; texts start after an end token."""
    before = np.roll(of_tokens, 1)
    before[np.cumsum(lengths) - lengths] = end
    return before


def seed_bigrams(blocks: DataFrame, seeds: np.ndarray, slices: int = 32) -> np.ndarray:
    """[before, word] training counts over places of the seed table. Each task adds up its blocks,
    Spark adds up the tasks, a slice of the table in one task."""
    n = len(seeds) + 2
    size = -(-n * n // slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * slices, dtype=np.int64)
        for row in _rows(batches):
            lengths, ids, keys = _tokens(row)
            place = _places(shared.value, keys)[ids]
            at, add = np.unique((_before(place, lengths) * n + place)[_train(row, lengths)], return_counts=True)
            sums[at] += add
        for s in range(slices):
            at = np.flatnonzero(sums[s * size:(s + 1) * size])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                     pa.array([sums[s * size:(s + 1) * size][at].tobytes()], pa.binary())], ["slice", "cells", "n"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(size, dtype=np.int64)
        for at, more in zip(pdf["cells"], pdf["n"]):
            sums[np.frombuffer(at, dtype="<u4")] += np.frombuffer(more, dtype="<i8")
        at = np.flatnonzero(sums)
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "cells": [at.astype("<u4").tobytes()], "n": [sums[at].tobytes()]})

    shared = blocks.sparkSession.sparkContext.broadcast(seeds)
    schema = "slice int, cells binary, n binary"
    out = np.zeros(size * slices)
    for r in blocks.select("held", "lengths", "ids", "keys").mapInArrow(run, schema).groupBy("slice").applyInPandas(add, schema).collect():
        out[r["slice"] * size + np.frombuffer(r["cells"], dtype="<u4").astype(np.int64)] = np.frombuffer(r["n"], dtype="<i8")
    return out[:n * n].reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchange(table: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the places of a bigram table and the class bigrams [before, class]. Places 0
    (other words) and 1 (end) keep classes 0 and 1; all others move one after another."""
    n = len(table)
    of = np.arange(n) if n <= k else np.concatenate([[0, 1], 2 + np.arange(n - 2) % (k - 2)])
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    left, right = table.T @ member, table @ member
    pairs = member.T @ right
    for _ in range(rounds):
        moved = False
        for w in range(2, n):
            c, both = of[w], table[w, w]
            l, r = left[w].copy(), right[w].copy()
            l[c] -= both
            r[c] -= both
            pairs[c] -= r
            pairs[:, c] -= l
            pairs[c, c] -= both
            # The sums of the other classes hold the word's neighbours wherever the word goes.
            outs, ins = pairs.sum(axis=1) + l, pairs.sum(axis=0) + r
            cols, rows = np.flatnonzero(r), np.flatnonzero(l)
            gain = (_xlogx(pairs[:, cols] + r[cols]) - _xlogx(pairs[:, cols])).sum(axis=1)
            gain += (_xlogx(pairs[rows] + l[rows, None]) - _xlogx(pairs[rows])).sum(axis=0)
            own = np.diag(pairs)
            gain += _xlogx(own + l + r + both) - _xlogx(own + l) - _xlogx(own + r) + _xlogx(own)
            gain -= _xlogx(outs + r.sum() + both) - _xlogx(outs) + _xlogx(ins + l.sum() + both) - _xlogx(ins)
            gain[:2] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[c] + 1e-9:
                best = c
            pairs[best] += r
            pairs[:, best] += l
            pairs[best, best] += both
            if best != c:
                moved, of[w] = True, best
                right[:, c] -= table[:, w]
                right[:, best] += table[:, w]
                left[:, c] -= table[w]
                left[:, best] += table[w]
        if not moved:
            break
    return of.astype(np.uint8), pairs


def word_classes(blocks: DataFrame, seeds: np.ndarray, of_seeds: np.ndarray, pairs: np.ndarray, buckets: int) -> DataFrame:
    """Rows (block, bucket, counts, classes): for every block the training counts and classes of its
    words in a bucket, in the order of the block's dictionary; with block -1 the sums over the
    bucket's words per class, as (sum of counts, number of words)."""
    k = len(pairs)
    none = 255

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = shared.value[:2]
        for row in _rows(batches):
            lengths, ids, keys = _tokens(row)
            place = _places(known, keys)
            train = _train(row, lengths)
            cls = of[place][ids]
            before, after = _before(cls, lengths), np.roll(cls, -1)
            after[np.cumsum(lengths) - 1] = none
            # The contexts of the words that are not seeds, word by word.
            open_tokens = np.flatnonzero(train & (place == 0)[ids])
            order = open_tokens[np.argsort(ids[open_tokens], kind="stable")]
            context = np.stack([before[order], after[order]], axis=1).astype(np.uint8)
            n = np.bincount(ids[train], minlength=len(keys))
            own = np.where(place == 0, n, 0)
            ends = np.cumsum(own)
            bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[by], prepend=-1))
            parts = np.split(by, cut[1:])
            cells = []
            for p in parts:
                size = own[p]
                at = np.repeat(ends[p] - size - (np.cumsum(size) - size), size) + np.arange(size.sum())
                cells.append(context[at].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(parts), pa.int64()), pa.array([int(bucket[p[0]]) for p in parts], pa.int32()),
                 pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                 pa.array([n[p].astype("<u4").tobytes() for p in parts], pa.binary()), pa.array(cells, pa.binary())],
                ["block", "bucket", "keys", "counts", "contexts"])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        known, of, goes, comes = shared.value
        keys = np.frombuffer(b"".join(pdf["keys"]), dtype=np.uint64)
        n = np.frombuffer(b"".join(pdf["counts"]), dtype="<u4").astype(np.int64)
        words, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(words)).astype(np.int64)
        place = _places(known, words)
        context = np.frombuffer(b"".join(pdf["contexts"]), dtype=np.uint8).reshape(-1, 2).astype(np.int64)
        owner = np.repeat(at, np.where(place[at] == 0, n, 0))
        gain = np.zeros((len(words), k))
        step = max(1, 4_000_000 // k)
        # A word's contexts are counted per class, some words at a time.
        by = np.argsort(owner, kind="stable")
        owner, context = owner[by], context[by]
        for a in range(0, len(words), step):
            lo, hi = np.searchsorted(owner, (a, min(a + step, len(words))))
            m = min(a + step, len(words)) - a
            w = owner[lo:hi] - a
            l = np.bincount(w * k + context[lo:hi, 0], minlength=m * k).reshape(m, k)
            last = context[lo:hi, 1] == none
            r = np.bincount((w * k + context[lo:hi, 1])[~last], minlength=m * k).reshape(m, k)
            gain[a:a + m] = r @ goes.T + l @ comes
        gain[:, 1] = -np.inf
        cls = np.where(place > 0, of[place], np.where(total > 1, gain.argmax(axis=1), 0)).astype(np.uint8)
        ends = np.cumsum([len(x) // 8 for x in pdf["keys"]])
        parts = list(zip(np.append(0, ends[:-1]), ends))
        seen = total > 0
        sums = np.stack([np.bincount(cls[seen], weights=total[seen], minlength=k), np.bincount(cls[seen], minlength=k)])
        return pd.DataFrame({"block": [*pdf["block"], -1], "bucket": pdf["bucket"].iloc[0],
                             "counts": [*[total[at[a:b]].astype("<i8").tobytes() for a, b in parts], sums.astype("<f8").tobytes()],
                             "classes": [*[cls[at[a:b]].tobytes() for a, b in parts], None]})

    smooth = pairs + 0.5
    goes = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    comes = np.log(smooth / smooth.sum(axis=0, keepdims=True))
    shared = blocks.sparkSession.sparkContext.broadcast((seeds, of_seeds, goes, comes))
    return blocks.select("block", "held", "lengths", "ids", "keys") \
        .mapInArrow(send, "block long, bucket int, keys binary, counts binary, contexts binary") \
        .groupBy("bucket").applyInPandas(choose, "block long, bucket int, counts binary, classes binary")


def class_sums(found: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n = np.frombuffer(row["counts"], dtype="<f8").reshape(2, -1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n.shape[1])), pa.array(n[0]), pa.array(n[1])], ["c", "tokens", "words"])

    out = np.zeros((2, k))
    for r in found.where("block = -1").select("counts").mapInArrow(run, "c long, tokens long, words long") \
            .groupBy("c").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect():
        out[:, r["c"]] = r["tokens"], r["words"]
    return out[0], out[1]


def class_bigrams(classed: DataFrame, k: int) -> np.ndarray:
    """[before, class] training counts over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k, dtype=np.int64)
        for row in _rows(batches):
            lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
            cls = np.frombuffer(row["classes"], dtype=np.uint8).astype(np.int64)
            sums += np.bincount((_before(cls, lengths) * k + cls)[_train(row, lengths)], minlength=k * k)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["cell", "n"])

    out = np.zeros(k * k)
    for r in classed.select("held", "lengths", "classes").mapInArrow(run, "cell long, n long") \
            .groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(k, k)


def score_texts(docs: DataFrame, held_out: Column, n_classes: int = 64, seeds: int = 2000, rounds: int = 12,
                prior_weight: float = 20.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    k = n_classes
    buckets = max(32, text_size(docs) // BUCKET_CHARS)
    blocks = stored(encode(docs, held_out), "brown-blocks")
    words = seed_words(blocks, seeds)
    of_seeds, seed_pairs = exchange(seed_bigrams(blocks, words), k, rounds)
    found = stored_alone(word_classes(blocks, words, of_seeds, seed_pairs, buckets), "brown-classes")
    tokens, distinct = class_sums(found, k)
    n_tokens = int(tokens.sum())
    whole = n_tokens + ADD * (distinct.sum() + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths, ids, keys = _tokens(row)
            bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            back = sorted(row["back"], key=lambda x: x["bucket"])
            c, cls = np.zeros(len(keys)), np.zeros(len(keys), dtype=np.uint8)
            c[order] = np.frombuffer(b"".join(x["counts"] for x in back), dtype="<i8")
            cls[order] = np.frombuffer(b"".join(x["classes"] for x in back), dtype=np.uint8)
            starts = np.cumsum(lengths) - lengths
            base = np.add.reduceat(np.log10((c + ADD) / whole)[ids], starts)
            known = np.add.reduceat((c > 0)[ids].astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["doc_ids"]], pa.list_(pa.int64())), pa.array([row["held"]], pa.list_(pa.bool_())),
                 pa.array([row["lengths"]], pa.binary()), pa.array([cls[ids].tobytes()], pa.binary()),
                 pa.array([base.tobytes()], pa.binary()), pa.array([known.tobytes()], pa.binary())],
                ["doc_ids", "held", "lengths", "classes", "base", "known"])

    back = found.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "classes")).alias("back"))
    classed = stored_alone(blocks.join(back, "block").mapInArrow(
        place, "doc_ids array<long>, held array<boolean>, lengths binary, classes binary, base binary, known binary"), "brown-classed")
    pairs = class_bigrams(classed, k)
    mass = (tokens + ADD * distinct) / whole
    mass[0] += ADD / whole
    smooth = (pairs + prior_weight * mass[None]) / (pairs.sum(axis=1, keepdims=True) + prior_weight)
    lift = np.where(mass[None] > 0, np.log10(np.maximum(smooth, 1e-300)) - np.log10(np.maximum(mass, 1e-300))[None], 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
            cls = np.frombuffer(row["classes"], dtype=np.uint8).astype(np.int64)
            base = np.frombuffer(row["base"], dtype=np.float64)
            gain = np.add.reduceat(lift[_before(cls, lengths), cls], np.cumsum(lengths) - lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths),
                 pa.array(np.frombuffer(row["known"], dtype=np.int64)),
                 pa.array(np.full(len(lengths), n_tokens, dtype=np.int64)), pa.array(base), pa.array(base + gain)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return classed.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                     "base_score double, score double")
