"""Removal of passages that an earlier document holds, by difference-cover anchors (op 12).

A window is 13 consecutive words. Position p of a document is a cover position if p modulo 7 is
0, 1 or 3. These three residues are a difference cover: every shift modulo 7 is a difference of
two of them, so for any places i and j of a window that two documents share there is a k below
7 with i + k and j + k both at cover positions. Only the 7 words at cover positions are hashed
(3 of 7 places); as k + 7 <= 13, documents that share a window share such an aligned anchor.

1. Anchors of every block of documents, each once, go to a shuffle by hash; those that several
   documents hold return to their blocks.
2. A shared anchor is extended to the 13-word windows around it. Blocks send each of these once
   (two 64-bit hashes, least and largest id); a window that a document of smaller id holds
   returns to the blocks with that least id.
3. Every block marks the words of such windows and gives the text that is left.

Nothing is compared in pairs: a passage that a third of the documents share is one row per block
in each shuffle. Blocks are rows that follow each other in a file (``common.with_blocks``).

Edge cases: null, empty and blank texts have no words and give an empty text. Texts under 13
words stay whole. A null id is neither smaller nor larger than another: such rows stay whole and
take nothing from others. Rows that repeat an id take nothing from each other, whatever their
texts; each gets a row. Equal windows at two places of one document alone stay. Long texts are
split in slices, but one text and its words' hashes are held in a task. Empty tables give no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from terrace.llm import common as C

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
BLOCK_CHARS = 4_000_000
RESULT = "doc_id long, n_words long, n_removed long, kept_text string"

_AT_COVER = np.isin(np.arange(PERIOD), COVER)
#: Odd multipliers of the window hashes, one for each place.
_MULT = np.random.default_rng(13).integers(0, 1 << 63, (2, WINDOW), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes:
    """Two 64-bit hashes for each word of a text; a bounded number of words is remembered."""

    def __init__(self, size: int = 400_000):
        self.size = size
        self.known: dict[bytes, bytes] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        out = []
        for part in C.word_slices(text):
            words = part.split()
            known = self.known
            if len(known) > self.size:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_128_digest(w)
            out.append(b"".join(map(known.__getitem__, words)))
        return np.frombuffer(b"".join(out), dtype=np.uint64).reshape(-1, 2)


class Block:
    """Word hashes of consecutive documents, one after the other."""

    def __init__(self, texts: list[bytes], hashes: WordHashes):
        each = [hashes(t) for t in texts]
        self.lengths = np.array([len(e) for e in each], dtype=np.int64)
        self.starts = np.concatenate([[0], self.lengths.cumsum()])
        self.words = np.concatenate(each) if each else np.empty((0, 2), np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        place = np.arange(len(self.words))
        self.pos, self.left = place - self.starts[self.doc], self.starts[self.doc + 1] - place

    def hashed(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each place of ``at``."""
        out = np.zeros(len(at), dtype=np.uint64)
        column = np.ascontiguousarray(self.words[:, which])
        for k in range(length):
            out += _MULT[which, k] * column[at + k]
        return out.view(np.int64)

    def anchors(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors of the documents marked in ``wanted``."""
        long_enough = wanted & (self.lengths >= WINDOW)
        at = np.flatnonzero(_AT_COVER[self.pos % PERIOD] & (self.left >= ANCHOR) & long_enough[self.doc])
        return at, self.hashed(at, ANCHOR)

    def windows(self, wanted: np.ndarray) -> np.ndarray:
        """Places of all windows of the documents marked."""
        return np.flatnonzero((self.left >= WINDOW) & wanted[self.doc])


def _runs(batches: Iterator[pa.RecordBatch], max_chars: int | None = None) -> Iterator[tuple[int, list, list[bytes]]]:
    """(blk, ids, texts) of rows (blk, doc_id, text) that follow each other with one blk; with
    ``max_chars`` also cut after about so many bytes."""
    blk, ids, texts, chars = None, [], [], 0
    for b in batches:
        for k, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if texts and (k != blk or (max_chars and chars >= max_chars)):
                yield blk, ids, texts
                ids, texts, chars = [], [], 0
            blk = k
            ids.append(i)
            texts.append(t.as_py())
            chars += len(texts[-1])
    if texts:
        yield blk, ids, texts


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block in one row, their texts compressed: a smaller shuffle."""
    for blk, ids, texts in _runs(batches, BLOCK_CHARS):
        whole = b"".join(texts)
        yield pa.record_batch([[blk], pa.array([ids], pa.list_(pa.int64())),
                               pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                               pa.array([pa.compress(whole, "zstd", asbytes=True)], pa.binary())],
                              ["blk", "ids", "sizes", "texts"])


def _unpacked(docs: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of the rows of a block."""
    ids, texts = [], []
    for i, sizes, data in zip(docs["ids"].to_pylist(), docs["sizes"].to_pylist(), docs["texts"]):
        whole = pa.decompress(data.as_py(), sum(sizes), "zstd", asbytes=True)
        ends = np.cumsum(sizes)
        ids += i
        texts += [whole[e - n:e] for e, n in zip(ends.tolist(), sizes)]
    return ids, texts


def _known(ids: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 for null, and which are given."""
    return (np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids], dtype=bool))


def _grouped(keys: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys with the least and the largest id of each."""
    order = np.lexsort(keys[::-1])
    keys, ids = [k[order] for k in keys], ids[order]
    new = np.zeros(len(ids), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def block_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, blk, n) of the distinct anchors of every run of rows with one blk; n is 2 if
    several of its documents hold the anchor, else 1."""
    hashes = WordHashes()
    for blk, ids, texts in _runs(batches):
        numbers, given = _known(ids)
        block = Block(texts, hashes)
        at, values = block.anchors(given)
        if len(at):
            (keys,), low, high = _grouped([values], numbers[block.doc[at]])
            yield pa.record_batch([pa.array(keys), pa.array(np.full(len(keys), blk, np.int64)),
                                   pa.array(1 + (low < high).astype(np.int32))], ["hash", "blk", "n"])


def _has(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def block_windows(docs: pa.Table, shared: pa.Table) -> pa.Table:
    """(h1, h2, low, high, blk): the windows of a block that hold a shared anchor."""
    names = ["h1", "h2", "low", "high", "blk"]
    empty = pa.table([pa.array([], pa.int64())] * 5, names)
    if not (docs.num_rows and shared.num_rows):
        return empty
    own, texts = _unpacked(docs)
    ids, given = _known(own)
    block = Block(texts, WordHashes())
    at, values = block.anchors(given)
    if not len(at):
        return empty
    marked = np.zeros(len(block.words) + 1, dtype=np.int64)
    marked[at[_has(np.sort(shared["hash"].to_numpy()), values)] + 1] = 1
    before = marked.cumsum()
    at = block.windows(given)
    at = at[before[at + PERIOD] > before[at]]
    if not len(at):
        return empty
    keys, low, high = _grouped([block.hashed(at, WINDOW), block.hashed(at, WINDOW, 1)], ids[block.doc[at]])
    return pa.table([*keys, low, high, np.full(len(low), docs["blk"][0].as_py(), np.int64)], names)


def block_kept(docs: pa.Table, earlier: pa.Table) -> pa.Table:
    """The documents of a block without the words of windows that an earlier document holds."""
    own_ids, texts = _unpacked(docs)
    ids, given = _known(own_ids)
    removed = np.zeros(0, dtype=bool)
    if earlier.num_rows and texts:
        block = Block(texts, WordHashes())
        h1, h2, least = (earlier[c].to_numpy() for c in ("h1", "h2", "least"))
        order = np.argsort(h1, kind="stable")
        h1, h2, least = h1[order], h2[order], least[order]
        at = block.windows(given)
        first = block.hashed(at, WINDOW)
        found = _has(h1, first)
        at, first = at[found], first[found]
        second, own = block.hashed(at, WINDOW, 1), ids[block.doc[at]]
        row, bad = np.searchsorted(h1, first), np.zeros(len(at), dtype=bool)
        while len(at):  # once, but for windows whose first hashes are the same
            same = (row < len(h1)) & (h1[np.minimum(row, len(h1) - 1)] == first)
            if not same.any():
                break
            r = np.minimum(row, len(h1) - 1)
            bad |= same & (h2[r] == second) & (least[r] < own)
            row = row + 1
        step = np.zeros(len(block.words) + WINDOW + 1, dtype=np.int64)
        step[at[bad]] += 1
        step[at[bad] + WINDOW] -= 1
        removed = step.cumsum()[:len(block.words)] > 0
    n_words, n_removed, kept, start = [], [], [], 0
    for text in texts:
        parts, n, cut = [], 0, 0
        for part in C.word_slices(text):
            words = part.split()
            drop = removed[start:start + len(words)]
            if drop.any():
                cut += int(drop.sum())
                parts.append(b" ".join(compress(words, ~drop)))
            else:
                parts.append(b" ".join(words))
            n += len(words)
            start += len(words)
        n_words.append(n)
        n_removed.append(cut)
        kept.append(b" ".join(p for p in parts if p).decode())
    return pa.table([pa.array(own_ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])


def dedup_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row; the kept words are joined by one
    blank."""
    rows = C.with_blocks(docs, [F.col("doc_id").cast("long").alias("doc_id"),
                                F.coalesce("text", F.lit("")).cast("binary").alias("text")], BLOCK_CHARS)
    anchors = rows.select("blk", "doc_id", "text").mapInArrow(block_anchors, "hash long, blk long, n int")
    holders = F.sum("n").over(Window.partitionBy("hash"))
    shared = C.stored_alone(anchors.withColumn("holders", holders).where("holders > 1").select("blk", "hash"),
                            "passage-anchors")
    by_block = (rows.select("blk", "doc_id", "text")
                .mapInArrow(packed, "blk long, ids array<long>, sizes array<long>, texts binary").groupBy("blk"))
    windows = by_block.cogroup(shared.groupBy("blk")).applyInArrow(
        block_windows, "h1 long, h2 long, low long, high long, blk long")
    least = F.min("low").over(Window.partitionBy("h1", "h2"))
    earlier = C.stored_alone(windows.withColumn("least", least).where("least < high").select("blk", "h1", "h2", "least"),
                             "passage-windows")
    return by_block.cogroup(earlier.groupBy("blk")).applyInArrow(block_kept, RESULT)
