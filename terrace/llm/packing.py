"""Best-fit packing of tokenised documents into sequences under several capacities.

Every document is tokenised, closed by an end id and cut into pieces of at most ``max_tokens``.
A sequence has three capacities: tokens, number of pieces and attention cost (sum of squared
piece lengths). Pieces are dealt to shards of bounded size by a hash; inside a shard they are
placed in order of decreasing length, each into the open sequence that fits it in every
capacity and scores best, either by the weighted dot product of the piece with the residual
capacities or by the smallest norm of the capacities left over. A full piece is a sequence
of its own. Rows without text (null or empty) make one piece that holds the end id only;
repeated rows and ids are packed as often as they occur.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import runs_coded, stored, text_blocks, text_runs

END_ID = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
# The pre-tokens of the tokenizer's own split, as far as Python's classes agree with it.
PRE_TOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "Σ", "İ")
CACHE_WORDS = 600_000


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. The attention cost of a full sequence of one piece is max_tokens**2."""
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def as_array(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def _byte_letters() -> str:
    """What the byte alphabet writes for every byte: itself if it is printed, else a letter above 255."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return "".join(chr(b if b in printed else next(other)) for b in range(256))


class WordCache:
    """Ids of texts by their words between white space: a word is encoded once, by its
    pre-tokens, and then looked up. Both dictionaries are emptied at a fixed size. Texts or
    words that Python cannot split for sure as the tokenizer does are encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = dict(enumerate(_byte_letters()))
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):  # the byte alphabet leaves these as they are
            if not (part.isalpha() and part == part.lower() and unicodedata.is_normalized("NFC", part)):
                return self.whole(part)
            part = part.encode().decode("latin-1").translate(self.letters)
        tokens = self.tokenizer.model.tokenize(part)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def word(self, word: str) -> bytes:
        found = [word] if word.isalpha() else PRE_TOKEN.findall(word)
        if not word.isascii() and any(p[0].isalnum() and not (p.isalpha() or p.isdecimal()) for p in found):
            return self.whole(word)  # letters mixed with other numerals
        parts = self.parts
        for p in found:
            if p not in parts:
                parts[p] = self.part(p)
        return parts[found[0]] if len(found) == 1 else b"".join([parts[p] for p in found])

    def learn(self, runs: list[str]) -> None:
        words = self.words
        if len(words) > CACHE_WORDS:
            words.clear()
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        for run in runs:
            if run not in words:
                words[run] = b"".join(map(self.word, run.lower().split()))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [(t.isascii() or unicodedata.is_normalized("NFC", t)) and not any(map(t.__contains__, ODD)) for t in texts]
        runs, number, sizes = text_runs([t if p else "" for t, p in zip(texts, plain)])
        self.learn(runs)
        ids, ends = runs_coded(self.words, runs, number, sizes, "<u4")
        data, ends = memoryview(ids.tobytes()), (4 * ends).tolist()
        return [bytes(data[a:b]) if p else self.whole(t) for t, p, a, b in zip(texts, plain, [0, *ends], ends)]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, keep_ids: bool = True,
                    end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document (columns doc_id, text; others are ignored): place in
    the document, crc32 of the little-endian 32-bit ids and, unless ``keep_ids`` is false, the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * max_tokens
        for (doc_ids,), texts in text_blocks(batches, 4_000_000):
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids, cache.encode(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            cols = list(zip(*rows))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity(), weights=(1.0, 0.05, 0.05),
             measure: str = "residual_norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one shard.

    Of all open sequences that fit a piece in every capacity the best by ``measure`` is taken
    ("residual_norm": least weighted norm left over; "dot_product": greatest weighted product of
    piece and residual). For a piece of n tokens both are p - n * (q + n * s), up to a term that
    all sequences share, with p, q and s of the sequence alone. A sequence is closed when no piece
    of the shard fits it any more."""
    cap = capacity.as_array()
    w = np.asarray(weights, dtype=np.float64) / cap ** 2
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min(initial=capacity.tokens))
    # Pieces have a token at least, so other capacities may be too wide ever to bind.
    free = capacity.documents >= capacity.tokens and capacity.attention >= capacity.tokens ** 2
    bin_of = np.full(len(lengths), -1, dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    rest = np.zeros((3, len(lengths) + 1))      # residual capacities of the open sequences
    terms = np.zeros((3, len(lengths) + 1))     # p, q and s
    number = np.zeros(len(lengths) + 1, dtype=np.int64)
    opened = m = widest = 0
    for i in order:
        n = int(lengths[i])
        at = m
        if widest >= n:
            fits = rest[0, :m] >= n
            if not free:
                fits &= (rest[1, :m] >= 1) & (rest[2, :m] >= n * n)
            some = np.flatnonzero(fits)
            if len(some):
                p, q, s = terms[:, some]
                at = int(some[(p - n * (q + n * s)).argmin()])
            elif free:
                widest = n - 1
        if at == m:
            rest[:, m], number[m] = cap, opened
            opened, m = opened + 1, m + 1
        bin_of[i], offset[i] = number[at], int(cap[0] - rest[0, at])
        rest[:, at] -= (n, 1, n * n)
        r, d, a = rest[:, at]
        if r < least or d < 1:
            m -= 1
            rest[:, at], terms[:, at], number[at] = rest[:, m], terms[:, m], number[m]
        else:
            widest = max(widest, int(r))
            if measure == "dot_product":
                terms[:, at] = -w[1] * d, w[0] * r, w[2] * a
            else:
                terms[:, at] = w[0] * r * r + w[1] * (d - 1) ** 2 + w[2] * a * a, 2 * w[0] * r, 2 * w[2] * a
    return bin_of, offset


def pack_pieces(pieces: DataFrame, capacity: Capacity = Capacity(), shard_pieces: int = 8192,
                weights=(1.0, 0.05, 0.05), measure: str = "residual_norm") -> DataFrame:
    """Adds sequence_id and offset to stored pieces (doc_id, piece, length, ...). At most one
    sequence a shard is filled badly, so the shards cost well under one sequence in a thousand."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) \
        + ", sequence_id long, offset long"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        seq, offset = best_fit(pdf["length"].to_numpy(), capacity, weights, measure)
        return pdf[names].assign(sequence_id=key[0] * (1 << 32) + seq, offset=offset)

    shard = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shards)).alias("shard")
    return pieces.groupBy(shard).applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(), keep_ids: bool = True,
                   **options) -> DataFrame:
    """Tokenise and pack whole documents: one row per piece with its sequence and offset."""
    pieces = tokenize_pieces(docs, tokenizer_path, capacity.tokens, keep_ids)
    if not keep_ids:
        pieces = pieces.drop("ids")
    return pack_pieces(stored(pieces, "pack-pieces"), capacity, **options)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
