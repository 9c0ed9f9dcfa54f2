"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are taken in blocks of bounded size. For a block: its words are the terms; all
texts are stored once as term numbers; document frequencies are counted over all documents; a
randomised SVD of the TF-IDF passages of all documents and items gives term loadings, for blocks of
up to ``GRAM_TERMS`` terms from the terms' products summed in one distributed pass, for others with
a pass each turn; every document is cut into overlapping passages whose vectors are compared by cosine with those of
the items and of the items' own passages; the projection on the item must also reach a share
(``energy``) of the item's length, which passages of common words alone do not. Candidates are checked word by word: the longest
common subsequence of item and surrounding text must cover at least ``overlap`` of the item, and
at least ``answers`` of the item's rarest words (its answer words, the third with the largest
idf) must be found there. So passages that were edited or reformatted are found as well.

Every block is searched against all documents, whole; matches are made inside a task, so no row is
shuffled. Only tables bounded by the block's terms reach the driver.

Edge cases: null and empty texts and items have no match; several items with equal text match
alike; rows that repeat an id give equal rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import WordCodes, stored, text_blocks

HALF = 16                  # words of half a passage; passages overlap by half
BLOCK_CHARS = 1_000_000
CODE_CHARS = 8 * BLOCK_CHARS  # of texts whose words are looked up together
CELLS = 65_536             # of a table of terms that are added up at a time, in some task
GRAM_TERMS = 4096          # terms whose products are summed in memory
OUT_SCHEMA = "doc_id long, item_id long, overlap double, answer_share double, cosine double, first_word long, last_word long"


@dataclass(frozen=True)
class Items:
    ids: list[int]
    words: list[np.ndarray]         # term numbers
    terms: dict[str, int]


def item_blocks(benchmark: DataFrame, block_items: int) -> Iterator[Items]:
    """The items that have words, at most about ``block_items`` at a time."""
    plain = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-plain.count() // block_items))
    for b in range(blocks):
        rows = plain.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        found = [(r["item_id"], [w for run in r["text"].lower().split() for w in WordCodes.WORD.findall(run)]) for r in rows]
        found = [(i, ws) for i, ws in found if ws]
        terms = {w: k for k, w in enumerate(sorted({w for _, ws in found for w in ws}))}
        if found:
            yield Items([i for i, _ in found], [np.array([terms[w] for w in ws]) for _, ws in found], terms)


def _coder(terms: dict[str, int]) -> WordCodes:
    return WordCodes(lambda w: terms.get(w, -1))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _kind(items: Items) -> str:
    return "<i2" if len(items.terms) < 1 << 15 else "<i4"


def code_texts(docs: DataFrame, items: Items) -> DataFrame:
    """Blocks of texts as the term numbers of their words, -1 for other words: ids, words of each
    text, and all numbers."""
    shared, kind = docs.sparkSession.sparkContext.broadcast(items.terms), _kind(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for (ids,), texts in text_blocks(batches, CODE_CHARS):
            words = coder(texts)
            # Block of every text by the characters up to its end.
            block = np.cumsum([len(t) for t in texts]) // BLOCK_CHARS
            cuts = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a:b]], pa.list_(pa.int64())), pa.array([np.array([len(w) for w in words[a:b]], dtype="<u4").tobytes()], pa.binary()),
                     pa.array([np.concatenate(words[a:b]).astype(kind).tobytes()], pa.binary())], ["doc_ids", "lengths", "codes"])

    return _texts(docs).mapInArrow(run, "doc_ids array<long>, lengths binary, codes binary")


def _coded(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Ids, words of each text and term numbers of every block."""
    for batch in batches:
        for ids, lengths, codes in zip(batch.column("doc_ids"), batch.column("lengths"), batch.column("codes")):
            yield ids.as_py(), np.frombuffer(lengths.as_py(), dtype="<u4").astype(np.int64), np.frombuffer(codes.as_py(), dtype=kind).astype(np.int64)


def term_frequencies(coded: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Number of documents that hold each term, and of all documents with words."""
    size, kind = len(items.terms), _kind(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(size, dtype=np.int64), 0
        for _, lengths, codes in _coded(batches, kind):
            hit = codes >= 0
            held = np.unique(np.repeat(np.arange(len(lengths)) * size, lengths)[hit] + codes[hit])
            n += np.bincount(held % size, minlength=size)
            total += int((lengths > 0).sum())
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(n[at], total))], ["term", "n"])

    out, total = np.zeros(size), 0
    for r in coded.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r["term"] >= 0:
            out[r["term"]] = r["n"]
        else:
            total = r["n"]
    return out, total


def passages(words: np.ndarray) -> list[np.ndarray]:
    """Overlapping passages of a word sequence; a short one is one passage."""
    return [words[a:a + 2 * HALF] for a in range(0, max(len(words) - HALF, 1), HALF)]


def halves_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of some lengths, cut into halves of passages: the half of every word, the first half
    of every text (and their number), whether a half is the last of its text, and whether it is all."""
    halves = np.maximum(1, -(-lengths // HALF))
    first = np.cumsum(np.append(0, halves))
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    last = np.zeros(first[-1], dtype=bool)
    last[first[1:] - 1] = True
    return np.repeat(first[:-1], lengths) + place // HALF, first, last, np.repeat(halves, halves) == 1


def passage_rows(lengths: np.ndarray, codes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, weight), ordered, of the TF-IDF rows of all passages, normalised to length one."""
    half, first, last, alone = halves_of(lengths)
    begins = np.zeros(len(last), dtype=bool)
    begins[first[:-1]] = True
    half, term = half[codes >= 0], codes[codes >= 0]
    # A passage has the number of its first half: a half is in its own and in the one before.
    own, before = (~last | alone)[half], ~begins[half]
    keys, n = np.unique(np.concatenate([half[own] * len(idf) + term[own], (half[before] - 1) * len(idf) + term[before]]), return_counts=True)
    passage, term = keys // len(idf), keys % len(idf)
    w = n * idf[term]
    return passage, term, w / np.sqrt(np.bincount(passage, w * w, minlength=len(last)))[passage]


def _own_rows(items: Items, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of all items, whole and in passages."""
    rows = []
    for p in (p for w in items.words for p in [w, *passages(w)]):
        t, n = np.unique(p, return_counts=True)
        w = n * idf[t]
        rows.append((t, w / np.sqrt((w * w).sum())))
    at = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])
    return at, np.concatenate([t for t, _ in rows]), np.concatenate([w for _, w in rows])


def _times(rows: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray, out: np.ndarray) -> None:
    """Adds A'(A x) of some rows A."""
    passage, term, w = rows
    cuts = np.append(np.flatnonzero(np.diff(passage, prepend=-1)), len(passage))
    for a in range(0, len(cuts) - 1, 4096):
        part = slice(cuts[a], cuts[min(a + 4096, len(cuts) - 1)])
        t, v = term[part], w[part, None]
        begin = cuts[a:min(a + 4096, len(cuts) - 1)] - cuts[a]
        product = np.add.reduceat(v * x[t], begin, axis=0)
        np.add.at(out, t, v * np.repeat(product, np.diff(np.append(begin, len(t))), axis=0))


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of tables of ``size`` cells that tasks made, in rows (slice, part)."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, dtype="<f4").astype(np.float64) for p in pdf["part"])
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "part": [total.astype("<f4").tobytes()]})

    out = np.zeros(size, dtype=np.float32)
    for r in parts.groupBy("slice").applyInPandas(add, "slice int, part binary").collect():
        part = np.frombuffer(r["part"], dtype="<f4")
        out[r["slice"] * CELLS:r["slice"] * CELLS + len(part)] = part
    return out


def _sliced(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k, a in enumerate(range(0, len(table), CELLS)):
        part = table[a:a + CELLS].astype("<f4")
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "part"])


def _few(coded: DataFrame) -> DataFrame:
    """As many tasks as run at once: each makes a table of its own, whatever the number of blocks."""
    return coded.coalesce(max(1, coded.sparkSession.sparkContext.defaultParallelism))


def gram(coded: DataFrame, items: Items, idf: np.ndarray) -> np.ndarray:
    """[term, term] A'A of the TF-IDF rows of the passages of all documents.

    Tasks number the terms from the most frequent one on and add a block's products in about the
    order of the cells: the table is larger than caches. The driver holds the upper triangle and the
    table, both of four bytes a cell."""
    size, kind = len(idf), _kind(items)
    order = np.argsort(idf, kind="stable")
    place = np.append(np.argsort(order), -1)  # of a term; the last one stands for other words
    shared = coded.sparkSession.sparkContext.broadcast((place, idf[order]))
    begin = np.arange(size) * size - np.arange(size) * (np.arange(size) + 1) // 2  # of a row of the upper triangle
    cells = size * (size + 1) // 2
    shift = max(0, cells.bit_length() - 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights = shared.value
        out = np.zeros(cells)
        for _, lengths, codes in _coded(batches, kind):
            passage, term, w = passage_rows(lengths, place[codes], weights)
            row, cell, product = begin[term], [], []
            for lag in range(2 * HALF):
                both = np.flatnonzero(passage[lag:] == passage[:len(passage) - lag])
                if not len(both):
                    break
                cell.append(row[both] + term[both + lag])
                product.append(w[both] * w[both + lag])
            if cell:
                at = np.concatenate(cell)
                sort = np.argsort((at >> shift).astype(np.uint16), kind="stable")  # by radix, of 16 bits
                np.add.at(out, at[sort], np.concatenate(product)[sort])
        yield from _sliced(out)

    upper = _added(_few(coded).mapInArrow(run, "slice int, part binary"), cells)
    out = np.zeros((size, size), dtype=np.float32)
    for i, at in enumerate(begin):
        out[order[i], order[i:]] = out[order[i:], order[i]] = upper[at + i:at + size]
    return out


def loadings(coded: DataFrame, items: Items, idf: np.ndarray, rank: int, turns: int = 2, gram_terms: int = GRAM_TERMS) -> np.ndarray:
    """[term, rank] right singular vectors of the TF-IDF passages of all documents and items:
    subspace iteration from a random start."""
    rank = min(rank, len(idf))
    x = np.linalg.qr(np.random.default_rng(7).standard_normal((len(idf), rank)))[0]
    own, kind = _own_rows(items, idf), _kind(items)
    table = gram(coded, items, idf) if len(idf) <= gram_terms else None
    context = coded.sparkSession.sparkContext
    weights = context.broadcast(idf)

    def times(y: np.ndarray) -> np.ndarray:
        total = np.zeros_like(y)
        _times(own, y, total)
        if table is not None:
            for a in range(0, len(table), 512):
                total[a:a + 512] += table[a:a + 512] @ y
            return total
        sent = context.broadcast(y)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros_like(sent.value)
            for _, lengths, codes in _coded(batches, kind):
                _times(passage_rows(lengths, codes, weights.value), sent.value, out)
            yield from _sliced(out.ravel())

        return total + _added(_few(coded).mapInArrow(run, "slice int, part binary"), y.size).reshape(y.shape)

    for _ in range(turns):
        x = np.linalg.qr(times(x))[0]
    small = x.T @ times(x)
    _, u = np.linalg.eigh((small + small.T) / 2)
    return x @ u[:, ::-1]


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, a word of the text at a time on the bits of one
    integer."""
    at: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        at[w] = at.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    v = full
    for w in text.tolist():
        u = v & at.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def search(coded: DataFrame, items: Items, idf: np.ndarray, load: np.ndarray, cosine: float, energy: float,
           overlap: float, answers: float) -> DataFrame:
    """All verified matches of a block of items with all documents."""
    vectors = (load * idf[:, None]).astype(np.float32)
    shapes = [(k, p) for k, w in enumerate(items.words) for p in ([w, *passages(w)] if len(w) > 2 * HALF else [w])]
    owner = np.array([k for k, _ in shapes])
    target = np.stack([vectors[p].sum(axis=0) for _, p in shapes])
    least = energy * np.sqrt((target * target).sum(axis=1))
    target = _unit(target)
    rare = []
    for w in items.words:
        t = np.unique(w)
        rare.append(set(t[np.argsort(-idf[t], kind="stable")][:max(1, len(t) // 3)].tolist()))
    # Term -> items that have it among their answer words.
    pairs = sorted((t, k) for k, r in enumerate(rare) for t in r)
    begin = np.searchsorted([t for t, _ in pairs], np.arange(len(idf) + 1))
    holder = np.array([k for _, k in pairs], dtype=np.int64)
    need = np.array([int(np.ceil(answers * len(r) - 1e-9)) for r in rare])
    reach = -(-max(len(w) for w in items.words) // HALF) + 1
    kind = _kind(items)
    shared = coded.sparkSession.sparkContext.broadcast((items, vectors, target, least, owner, rare, begin, holder, need))

    def answer_places(term: np.ndarray, half: np.ndarray, n_halves: int) -> np.ndarray:
        """[half, item] whether enough answer words of an item may stand around a passage."""
        begin, holder, need = shared.value[6:]
        size = begin[term + 1] - begin[term]
        some = np.flatnonzero(size)
        size = size[some]
        item = holder[np.repeat(begin[term[some]] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        counts = np.zeros((n_halves + 1, len(need)), dtype=np.int32)
        np.add.at(counts, (np.repeat(half[some], size) + 1, item), 1)
        upto = counts.cumsum(axis=0, dtype=np.int32)
        j = np.arange(n_halves)
        return upto[np.minimum(j + 2 + reach, n_halves)] - upto[np.maximum(j - reach, 0)] >= need[None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, vec, to, low, own, answer = shared.value[:6]
        for ids, lengths, flat in _coded(batches, kind):
            half, first, last, alone = halves_of(lengths)
            start = np.cumsum(lengths) - lengths
            hit = np.flatnonzero(flat >= 0)
            # A passage is two halves of one document; a document of one half is a passage. Only
            # passages around which an item's answer words may stand get a vector.
            enough = answer_places(flat[hit], half[hit], int(first[-1]))
            place = np.flatnonzero((~last | alone) & enough.any(axis=1))
            used = np.zeros(first[-1] + 1, dtype=bool)
            used[place] = used[place + 1] = True
            hit = hit[used[half[hit]]]
            sums = np.zeros((first[-1] + 1, vec.shape[1]), dtype=np.float32)
            for a in range(0, len(hit), 65536):
                h = half[hit[a:a + 65536]]
                cut = np.flatnonzero(np.diff(h, prepend=-1))
                sums[h[cut]] += np.add.reduceat(vec[flat[hit[a:a + 65536]]], cut, axis=0)
            whole = sums[place] + np.where(alone[place][:, None], 0, sums[place + 1])
            doc_of = np.repeat(np.arange(len(lengths)), np.diff(first))[place]
            size = np.sqrt((whole * whole).sum(axis=1))
            found: dict[tuple[int, int], tuple] = {}
            for a in range(0, len(place), 4096):
                length = whole[a:a + 4096] @ to.T
                near = length >= low[None]
                near &= length >= cosine * size[a:a + 4096, None]
                near &= enough[place[a:a + 4096]][:, own]
                for p, t in zip(*np.nonzero(near)):
                    d, k = int(doc_of[a + p]), int(own[t])
                    at = int(place[a + p] - first[d]) * HALF
                    key = (d, k)
                    if key in found and found[key][0] >= 1.0:
                        continue
                    item = block.words[k]
                    lo = max(0, at - len(item))
                    region = flat[start[d] + lo:start[d] + min(at + 2 * HALF + len(item), lengths[d])]
                    some = set(region.tolist())
                    share = len(answer[k] & some) / len(answer[k])
                    if share < answers:
                        continue
                    value = common_subsequence(item, region) / len(item)
                    if value >= overlap and (key not in found or value > found[key][0]):
                        found[key] = (value, share, float(length[p, t] / size[a + p]), lo, lo + len(region))
            rows = [(ids[d], block.ids[k], *v) for (d, k), v in sorted(found.items())]
            cols = list(zip(*rows)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "item_id", "overlap", "answer_share", "cosine", "first_word", "last_word"])

    return coded.mapInArrow(run, OUT_SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 96, block_items: int = 1024,
                 cosine: float = 0.45, energy: float = 0.3, overlap: float = 0.6, answers: float = 0.5) -> DataFrame:
    """One row per document and item that it leaks: share of the item found in order, share of its
    answer words, cosine of the best passage, and the words of the text that were looked at."""
    out = None
    for items in item_blocks(benchmark, block_items):
        coded = stored(code_texts(docs, items), "leak-codes", compression="zstd")
        n, total = term_frequencies(coded, items)
        idf = np.log((total + 1) / (n + 1)) + 1e-3
        load = loadings(coded, items, idf, rank)
        part = search(coded, items, idf, load, cosine, energy, overlap, answers)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], OUT_SCHEMA)
