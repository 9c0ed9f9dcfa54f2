"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrace.session import scratch_path

#: Rows of a table that is broadcast at most; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once below the shared scratch folder and read back: later steps neither repeat
    the work nor depend on the executors that did it. ``options`` are those of the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, strongly compressed, after which Spark may drop the shuffle files of this
    write: for plans that share no exchange with a later one."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name, compression="zstd")
    finally:
        conf.set(CLEANUP, before)


def with_blocks(docs: DataFrame, columns: list[Column], max_chars: int) -> DataFrame:
    """``columns`` and ``blk``, the same number for up to some ``max_chars`` characters of rows
    that follow each other in a file. File and place of a row decide, so that the number is the
    same in every job that reads the table; rows that come from no file are stored first."""
    spark = docs.sparkSession
    rows, chars = docs.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, min(max_chars * rows // max(chars or 1, 1), rows // (4 * parts)))
    place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / size)).alias("blk")
    try:
        return docs.select(place, *columns)
    except AnalysisException:
        return stored(docs.select(*columns), "rows").select(place, "*")


def join_measured(big: DataFrame, small: DataFrame, on, how: str = "inner",
                  max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a stored side of narrow rows: its rows are counted, and it is broadcast up to
    ``max_rows`` only; beyond that both sides are shuffled."""
    if small.count() <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def text_blocks(batches: Iterator[pa.RecordBatch], max_chars: int) -> Iterator[tuple[list, list[str]]]:
    """Columns (as lists, text excepted) and texts of consecutive rows, cut so that a block
    holds about ``max_chars`` characters; a longer text makes a block of its own. The text is
    the last column; null counts as empty."""
    rows: list[list] = []
    texts: list[str] = []
    chars = 0
    for batch in batches:
        heads = [c.to_pylist() for c in batch.columns[:-1]]
        for i, t in enumerate(batch.columns[-1]):
            text = t.as_py() or ""
            if texts and chars + len(text) > max_chars:
                yield [list(c) for c in zip(*rows)], texts
                rows, texts, chars = [], [], 0
            rows.append([h[i] for h in heads])
            texts.append(text)
            chars += len(text)
    if texts:
        yield [list(c) for c in zip(*rows)], texts


def text_runs(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct runs between ASCII's white space of some texts, as they are written (one may be
    empty), the number of every run of all texts in order, and how many runs each text has."""
    runs = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    coded = runs.flatten().dictionary_encode()
    return (coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(),
            pc.list_value_length(runs).to_numpy())


def runs_coded(known: dict[str, bytes], runs: list[str], number: np.ndarray, sizes: np.ndarray,
               kind: str) -> tuple[np.ndarray, np.ndarray]:
    """What ``known`` holds of all runs of ``text_runs``, in order, as numbers of some kind, and the
    number of them that each text ends at."""
    parts = list(map(known.__getitem__, runs))
    flat = np.frombuffer(b"".join(parts), dtype=kind)
    count = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // flat.itemsize
    begin = np.cumsum(count) - count
    n = count[number]
    end = np.cumsum(n)
    out = flat[np.repeat(begin[number] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
    return out, np.append(0, end)[np.cumsum(sizes)]


class WordCodes:
    """Integer codes of the words of texts. Words are runs of letters and digits, lower-cased;
    what ``code`` gives for a word is kept in a dictionary of bounded size, by the run between
    white space that it came from."""

    WORD = re.compile(r"[^\W_]+")

    def __init__(self, code: Callable[[str], int], size: int = 500_000):
        self.code, self.size = code, size
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        runs, number, sizes = text_runs(texts)
        known = self.known
        if len(known) > self.size:
            known.clear()
        for run in runs:
            if run not in known:
                word = run.lower()
                # Most runs are a word; all others are searched for words.
                words = [word] if word.isalnum() else self.WORD.findall(word)
                known[run] = struct.pack(f"<{len(words)}q", *map(self.code, words))
        codes, ends = runs_coded(known, runs, number, sizes, "<i8")
        return [codes[a:b] for a, b in zip([0, *ends], ends)]


#: What separates words in the contracts of several operators: blank, tab, line breaks.
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(data: bytes, size: int = 1 << 24) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes that end before white space, so that no word is
    cut; ``bytes.split`` of each gives the words of the whole."""
    start = 0
    while len(data) - start > size:
        end = BLANK.search(data, start + size)
        if end is None:
            break
        yield data[start:end.start()]
        start = end.start()
    yield data[start:] if start else data


def text_size(docs: DataFrame) -> int:
    """Characters of all texts."""
    return docs.agg(F.sum(F.length("text"))).first()[0] or 0
