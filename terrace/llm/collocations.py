"""Phrases whose words keep together, mined by SETM from occurrence relations (op 13).

Texts are lower-cased (A-Z), split at punctuation and line breaks into pieces and those into
words. SETM keeps relations of occurrences, sorted by piece and position, and makes longer
phrases by joining neighbours:

* ``R1``: occurrences of the frequent words of every language. It is stored in units of some
  million characters (pieces of one language, in order); a place is given by its order in the
  unit, and a gap ends a piece or stands for a word that is not frequent. Pieces are never
  split, so joining by piece and adjacent position needs no shuffle: two neighbours in a
  unit's sorted relation are the join partners.
* From ``R(k-1)`` every unit counts the phrases of k words that its neighbours make; counts are
  summed over all units by a shuffle on the phrase (at most one row per unit and phrase), and
  those of at least ``min_count`` return to their units: the semi-join that gives ``R(k)``, from
  which the next length is made. A phrase can be frequent only if its two parts of k - 1 words
  are, so every frequent phrase is found with its exact count.

Scores, cuts and containment are joins over the frequent phrases. Each word of a language has
a number of its own, so phrases are compared exactly, and counts are exact; the score divides decimals.

Edge cases: a null text counts as empty, a null lang as 'und'. Ids are not read: repeated rows
count as often as they occur. Ties in the score of cuts go to the shortest first part, ties in
the order to the larger count and then the phrase's bytes. Very long texts are cut between
pieces; one piece is held whole. Empty tables and languages without a frequent phrase give no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from terrace.llm import common as C

UNIT_CHARS = 8_000_000
#: Tasks rank this many parts of a language before its last ranking.
SALTS = 64
GAP = -1
#: Separators of pieces become line breaks, tabs blanks, capitals small letters.
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t" + bytes(range(65, 91)), b"\n" * 10 + b" " + bytes(range(97, 123)))


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """A text, with separators replaced, in parts that end between pieces."""
    text = text.translate(_TABLE)
    start = 0
    while len(text) - start > size:
        end = text.find(b"\n", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


class Unit:
    """Words of consecutive texts of a language, as numbers of the unit's own."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b"": -2, b"\n": GAP}
        self.codes: list[np.ndarray] = []
        self.chars = 0

    def add(self, part: bytes) -> None:
        words = (part.replace(b"\n", b" \n ") + b" \n").split(b" ")
        numbers = self.numbers
        for w in set(words).difference(numbers):
            numbers[w] = len(numbers) - 2
        got = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
        self.codes.append(got[got != -2])
        self.chars += len(part)

    def row(self, unit: int, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        gap = codes == GAP
        codes = codes[~gap | ~np.concatenate([[True], gap[:-1]])]  # one gap for several
        words = list(self.numbers)[2:]
        return pa.record_batch([[unit], [lang], pa.array([int((codes != GAP).sum())], pa.int64()),
                                pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
                                pa.array([codes.tobytes()], pa.binary())], ["unit", "lang", "n", "words", "codes"])


def occurrences(docs: DataFrame, unit_chars: int = UNIT_CHARS) -> DataFrame:
    """(unit, lang, n, words, codes): all word occurrences, in order, with gaps between pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, units = TaskContext.get().partitionId(), 0, {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                for part in _slices(text.as_py(), min(unit_chars, 1 << 22)):
                    unit = units.setdefault(lang, Unit())
                    unit.add(part)
                    if unit.chars >= unit_chars:
                        yield units.pop(lang).row((task << 32) + made, lang)
                        made += 1
            if sum(u.chars for u in units.values()) >= 4 * unit_chars:
                for lang in list(units):
                    yield units.pop(lang).row((task << 32) + made, lang)
                    made += 1
        for lang, unit in units.items():
            yield unit.row((task << 32) + made, lang)
            made += 1

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "unit long, lang string, n long, words array<string>, codes binary")


def unit_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, unit, code, n) of every distinct word of a unit."""
    for b in batches:
        for unit, lang, words, codes in zip(b["unit"].to_pylist(), b["lang"].to_pylist(), b["words"], b["codes"]):
            codes = np.frombuffer(codes.as_py(), dtype=np.int32)
            n = np.bincount(codes[codes != GAP], minlength=len(words.values) if words.values is not None else 0)
            for at in range(0, len(n), 100_000):
                part = n[at:at + 100_000]
                yield pa.record_batch([pa.array([lang] * len(part), pa.string()), words.values.slice(at, len(part)),
                                       pa.array(np.full(len(part), unit)), pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                                       pa.array(part.astype(np.int64))], ["lang", "word", "unit", "code", "n"])


def _packed(ids: np.ndarray) -> bytes:
    """Bytes of a relation, four for an id if they do; the first byte tells."""
    small = not len(ids) or ids.max() < 1 << 31
    return (b"4" + ids.astype(np.int32).tobytes()) if small else b"8" + ids.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], dtype=np.int32 if data[:1] == b"4" else np.int64).astype(np.int64)


def _one_gap(ids: np.ndarray) -> np.ndarray:
    """Without gaps at the start and after another gap."""
    gap = ids == GAP
    return ids[~gap | ~np.concatenate([[True], gap])[:-1]]


def _relation(unit: int, ids: np.ndarray) -> pa.Table:
    return pa.table({"unit": pa.array([unit], pa.int64()), "ids": pa.array([_packed(ids)], pa.binary())})


_NO_RELATION = pa.table({"unit": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())})


def keep_words(rows: pa.Table, frequent: pa.Table) -> pa.Table:
    """R1 of a unit: its occurrences of frequent words, by their numbers."""
    if not (rows.num_rows and frequent.num_rows):
        return _NO_RELATION
    codes = np.frombuffer(rows["codes"][0].as_py(), dtype=np.int32)
    ids = np.full(int(codes.max(initial=0)) + 2, GAP, dtype=np.int64)
    ids[frequent["code"].to_numpy()] = frequent["id"].to_numpy()
    ids[-1] = GAP  # the code of a gap is -1
    return _relation(rows["unit"][0].as_py(), _one_gap(ids[codes]))


def _places(ids: np.ndarray, k: int) -> np.ndarray:
    """Places from which k occurrences follow each other without a gap."""
    gaps = np.concatenate([[0], (ids == GAP).cumsum()])
    at = np.arange(max(len(ids) - k + 1, 0))
    return at[gaps[at + k] == gaps[at]]


def _numbered(columns: list[np.ndarray]) -> np.ndarray:
    """The same number for equal rows of the columns."""
    out = np.unique(columns[0], return_inverse=True)[1]
    for c in columns[1:]:
        c = np.unique(c, return_inverse=True)[1]
        out = np.unique(out * (int(c.max(initial=0)) + 1) + c, return_inverse=True)[1]
    return out


def unit_phrases(k: int):
    """(w1..wk, unit, n): the phrases of k words that neighbours of R(k-1) make."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*(f"w{j + 1}" for j in range(k)), "unit", "n"]
        for b in batches:
            for unit, data in zip(b["unit"].to_pylist(), b["ids"]):
                ids = _unpacked(data.as_py())
                at = _places(ids, k)
                if not len(at):
                    continue
                number = _numbered([ids[at + j] for j in range(k)])
                _, first, n = np.unique(number, return_index=True, return_counts=True)
                for s in range(0, len(first), 100_000):
                    p = at[first[s:s + 100_000]]
                    yield pa.record_batch([*(pa.array(ids[p + j]) for j in range(k)), pa.array(np.full(len(p), unit)),
                                           pa.array(n[s:s + 100_000].astype(np.int64))], names)
    return run


def keep_phrases(k: int):
    """R(k) of a unit: R(k-1) where the phrases of k words are frequent. Runs of neighbouring
    phrases follow each other without a gap, so that any k + 1 words without one are two
    frequent phrases that overlap."""
    def run(rows: pa.Table, frequent: pa.Table) -> pa.Table:
        if not (rows.num_rows and frequent.num_rows):
            return _NO_RELATION
        ids = _unpacked(rows["ids"][0].as_py())
        at = _places(ids, k)
        number = _numbered([np.concatenate([ids[at + j], frequent[f"w{j + 1}"].to_numpy()]) for j in range(k)])
        good = np.zeros(int(number.max(initial=0)) + 1, dtype=bool)
        good[number[len(at):]] = True
        at = at[good[number[:len(at)]]]
        new = np.concatenate([[True], np.diff(at) != 1])
        first = at[new]
        length = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]])) + k  # its words and a gap
        end = length.cumsum()
        place = np.arange(end[-1]) - np.repeat(end - length - first, length)
        out = ids[np.minimum(place, len(ids) - 1)]
        out[end - 1] = GAP
        return _relation(rows["unit"][0].as_py(), out)
    return run


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored_by_unit(rows: DataFrame, name: str) -> DataFrame:
    """``stored_alone`` of what tasks make of units: a unit takes megabytes, so a task is handed
    one at a time and not all of its files at once."""
    conf = rows.sparkSession.conf
    before = conf.get(BATCH)
    conf.set(BATCH, "1")
    try:
        return C.stored_alone(rows, name)
    finally:
        conf.set(BATCH, before)


def frequent_phrases(docs: DataFrame, max_words: int, min_count: int,
                     unit_chars: int = UNIT_CHARS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (id, lang, word), phrases (words: ids, f) of 1 to ``max_words`` words that occur
    ``min_count`` times, and all occurrences (lang, n)."""
    base = C.stored_alone(occurrences(docs, unit_chars), "phrases-occurrences")
    totals = base.groupBy("lang").agg(F.sum("n").alias("n"))
    words = base.select("unit", "lang", "words", "codes").mapInArrow(unit_words, "lang string, word string, unit long, code int, n long")
    word = Window.partitionBy("lang", "word")
    # The number of a word: the place of its first row among the frequent rows of its partition,
    # which lie sorted by word, times the partitions, plus the partition.
    place = F.monotonically_increasing_id()
    conf = docs.sparkSession.conf
    parts = max(int(conf.get(c, "1")) for c in ("spark.sql.shuffle.partitions",
                                                "spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    spread = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) * parts + F.shiftright("at", 33)
    held = stored_by_unit(words.withColumn("f", F.sum("n").over(word)).where(F.col("f") >= min_count)
                          .withColumn("at", place).withColumn("at", F.min("at").over(word))
                          .select("lang", "word", "unit", "code", "f", spread.alias("id")), "phrases-words")
    names = C.stored_alone(held.groupBy("id").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.max("f").alias("f")),
                           "phrases-names")
    found = names.select(F.array("id").alias("words"), "f")
    back = held.select("unit", "code", "id")
    relation = C.stored_alone(base.select("unit", "codes").groupBy("unit").cogroup(back.groupBy("unit"))
                              .applyInArrow(keep_words, "unit long, ids binary"), "phrases-r1")
    for k in range(2, max_words + 1):
        keys = [f"w{j + 1}" for j in range(k)]
        made = relation.mapInArrow(unit_phrases(k), ", ".join(f"{c} long" for c in [*keys, "unit", "n"]))
        f = F.sum("n").over(Window.partitionBy(*keys))
        held = stored_by_unit(made.withColumn("f", f).where(F.col("f") >= min_count).drop("n"), f"phrases-f{k}")
        found = found.unionByName(held.groupBy(*keys).agg(F.max("f").alias("f")).select(F.array(*keys).alias("words"), "f"))
        if k < max_words:
            relation = C.stored_alone(relation.groupBy("unit").cogroup(held.drop("f").groupBy("unit"))
                                      .applyInArrow(keep_phrases(k), "unit long, ids binary"), f"phrases-r{k}")
    return names.drop("f"), C.stored_alone(found, "phrases-frequent"), totals


def collocations(docs: DataFrame, max_words: int = 4, min_count: int = 30, top: int = 2000,
                 contained: int = 80, unit_chars: int = UNIT_CHARS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    names, found, totals = frequent_phrases(docs, max_words, min_count, unit_chars)
    cands = found.where(F.size("words") > 1)
    size = F.size("words")

    parts = cands.select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = parts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("head"),
                         F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"))
    for name, count in (("head", "l"), ("tail", "r")):
        parts = parts.join(found.select(F.col("words").alias(name), F.col("f").alias(count)), name)
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000BD) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = parts.groupBy("words", "a").agg(cut)

    # Every shorter candidate inside a longer one, with the largest count of those that hold it.
    inside = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> "
                    "transform(sequence(1, size(words) - m + 1), s -> slice(words, s, m))))")
    holders = (cands.where(size > 2).select(F.explode(inside).alias("words"), "f")
               .groupBy("words").agg(F.max("f").alias("longer")))
    covered = (F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * contained)
    left = (scored.join(holders, "words", "left").where(F.col("longer").isNull() | ~covered)
            .select("words", "a", "cut.l", "cut.r", "cut.score"))

    spelled = left.select("*", F.posexplode("words").alias("pos", "id")).join(names, "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    rows = spelled.groupBy("words", "a", "l", "r", "score").agg(F.min("lang").alias("lang"), text.alias("phrase"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
