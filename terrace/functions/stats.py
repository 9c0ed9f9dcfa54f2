"""Distributed order statistics: exact medians, row numbers, ranks and leads.

No column and no key group is pulled into one task. The exact median narrows its search by
histograms until a fixed number of candidates is left. Row numbers, ranks and leads take one
range exchange and one sort; each partition numbers its own rows, and what a partition needs of
the others (how many rows its first key has before it, the row that follows its last one) is
carried over in one border row per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from terrace.functions.aggregates import join_on_keys
from terrace.session import ensure_checkpoint_dir, materialize

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

#: Candidates among which a median is picked by sorting them, at most.
CANDIDATES = 50_000


def exact_median(df: DataFrame, c: str | Column, limit: int = CANDIDATES, buckets: int = 128) -> DataFrame:
    """One-row DataFrame ``median``: the exact median of the non-NULL values of ``c`` (NULL if
    there are none); for an even count the midpoint of the two middle values.

    Rank selection in rounds. A quantile sketch gives ``buckets`` - 1 values; they cut the values
    into cells, the bounds themselves and the gaps between them, whose exact counts tell in
    which cell the middle ranks lie. A value that repeats often is a bound, so a gap holds about
    1/``buckets`` of the values and each round leaves that much; it ends when a cell has one
    value, the two ranks lie in different cells (the largest and the least value of each are
    known), or at most ``limit`` candidates are left, which one task sorts. Each round sends
    one row per cell to the driver.
    """
    x = F.col(c) if isinstance(c, str) else c
    spark = df.sparkSession
    vals = df.where(x.isNotNull()).select(x.alias("v"))
    probs = [i / buckets for i in range(1, buckets)]
    n, cuts = vals.agg(F.count(F.lit(1)), F.percentile_approx("v", probs, 10_000)).first()
    if not n:
        return spark.range(1).select(F.lit(None).cast("double").alias("median"))
    low, high, before, size = (n - 1) // 2, n // 2, 0, n
    while True:
        if size <= limit:
            at = F.sort_array(F.collect_list("v"))
            pick = vals.agg(at.alias("v")).select(F.col("v")[low - before].alias("a"), F.col("v")[high - before].alias("b")).first()
            break
        edges = F.array(*[F.lit(e) for e in sorted(set(cuts))])
        cell = F.size(F.filter(edges, lambda e: e < F.col("v"))) * 2 + F.array_contains(edges, F.col("v")).cast("int")
        cells = (vals.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                 .orderBy("cell").collect())
        held, start = {}, before
        for r in cells:
            for k in {low, high}:
                if start <= k < start + r["n"]:
                    held[k] = (r, start)
            start += r["n"]
        (a, start), (b, _) = held[low], held[high]
        if a is not b or a["lo"] == a["hi"]:
            pick = (a["hi"], b["lo"])
            break
        vals = materialize(vals.where(F.col("v").between(F.lit(a["lo"]), F.lit(a["hi"]))))
        before, size = start, a["n"]
        cuts = vals.agg(F.percentile_approx("v", probs, 10_000)).first()[0]
    a, b = pick
    return spark.range(1).select(((F.lit(a) + F.lit(b)) / F.lit(2.0)).cast("double").alias("median"))


def _ranged(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with ``_pid`` and the place ``_at`` in the
    partition. The reliable checkpoint pins which rows lie where and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # partition number, then 33 bits of place
    return (df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", place)
            .withColumns({"_pid": F.shiftright("_at", 33).cast("int"), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
            .checkpoint(eager=True))


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` without funnelling the table through one task.

    ``order`` must end with a unique tie-breaker so the numbering is deterministic. One range
    exchange; the rows before a partition come from a table of one row per partition.
    """
    ranged = _ranged(df, order, partitions)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (ranged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_at") + F.col("_off") + 1).drop("_pid", "_at", "_off"))


def ranked(df: DataFrame, part_cols: list[str], order: list[Column], tie_cols: list[str],
           row_number: str | None = None, rank: str | None = None, lead: tuple[str, str] | None = None,
           partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER`` / ``RANK`` / ``LEAD`` over ``PARTITION BY part_cols ORDER BY order``
    without sending a whole partition-key group to one task.

    The rows are range-partitioned on (part_cols, order), so a hot key (one state holding a
    third of all customers) is spread over many contiguous range partitions, and sorted once.
    Every partition gives one border row (its first row, its last row, how many rows its last
    key and its last tie have at its end); from these the driver, which so gets one row per
    partition, works out what each partition starts with. Then every partition numbers its rows
    in a stream. There is no second exchange and no join. ``order`` must end with a unique
    tie-breaker; ``tie_cols`` are the columns whose equality defines a rank tie (NULLs tie).
    """
    keys = [F.col(c) for c in part_cols]
    ranged = _ranged(df, [*keys, *order], partitions)
    names = [n for n in (row_number, rank) if n]
    schema = T.StructType(list(df.schema.fields) + [T.StructField(n, T.LongType()) for n in names]
                          + ([T.StructField(lead[1], df.schema[lead[0]].dataType)] if lead else []))
    seen = [*dict.fromkeys([*part_cols, *tie_cols, *([lead[0]] if lead else [])])]
    number = _Numbers(part_cols, tie_cols, row_number, rank, lead, df.columns)
    edge = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in seen)
    borders = (ranged.select("_pid", *seen).mapInArrow(
        number.border, f"pid int, n long, key_run long, tie_run long, first struct<{edge.replace('` ', '`:')}>, last struct<{edge.replace('` ', '`:')}>")
        .orderBy("pid").collect())
    return ranged.drop("_at").mapInArrow(number.rows(_carried(borders, part_cols, tie_cols, lead)), schema)


def _carried(borders: list, part_cols: list[str], tie_cols: list[str], lead) -> dict[int, tuple]:
    """For every partition: rows of its first key before it, the row number at which its first
    tie began before it (0: it did not), and the lead of its last row."""
    def of(row, cols):
        return [row[c] for c in cols]

    out, rows, tie_start, last = {}, 0, 0, None
    for i, b in enumerate(borders):
        same_key = last is not None and of(b.first, part_cols) == of(last, part_cols)
        same_tie = same_key and of(b.first, tie_cols) == of(last, tie_cols)
        following = borders[i + 1].first if i + 1 < len(borders) else None
        after = following[lead[0]] if lead and following and of(following, part_cols) == of(b.last, part_cols) else None
        out[b.pid] = (rows if same_key else 0, tie_start if same_tie else 0, after)
        whole_key, whole_tie = b.key_run == b.n, b.tie_run == b.n
        rows = (rows if same_key and whole_key else 0) + b.key_run
        if not (same_tie and whole_tie):
            tie_start = rows - b.tie_run + 1
        last = b.last
    return out


class _Numbers:
    """Numbers sorted rows of a partition batch by batch."""

    def __init__(self, part_cols, tie_cols, row_number, rank, lead, columns):
        self.part_cols, self.tie_cols, self.columns = list(part_cols), list(tie_cols), list(columns)
        self.row_number, self.rank, self.lead = row_number, rank, lead

    @staticmethod
    def _changes(b: pa.RecordBatch, cols: list[str], last: dict | None) -> np.ndarray:
        """Whether a row differs in ``cols`` from the row before it; the first row of all does."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            v = b.column(b.schema.get_field_index(c))
            prev = pa.concat_arrays([pa.array([last[c] if last else None], v.type), v.slice(0, len(v) - 1)])
            same = pc.fill_null(pc.equal(v, prev), False)
            both = pc.and_(pc.is_null(v), pc.is_null(prev))
            out |= ~pc.or_(same, both).to_numpy(zero_copy_only=False)
        if last is None:
            out[0] = True
        return out

    def _stream(self, batches: Iterator[pa.RecordBatch], rows_before: Callable[[int], tuple]) -> Iterator[tuple]:
        """(batch, row numbers, ranks, last row so far) of the batches of a partition."""
        import numpy as np

        last, number, tie = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            new_key = self._changes(b, self.part_cols, last)
            new_tie = new_key | self._changes(b, self.tie_cols, last)
            if last is None:
                number, tie = rows_before(b["_pid"][0].as_py())
                new_key[0] = number == 0
                new_tie[0] = tie == 0
            at = np.arange(b.num_rows)
            begun = np.maximum.accumulate(np.where(new_key, at, -1))
            numbers = np.where(begun < 0, number + at + 1, at - begun + 1)
            tied = np.maximum.accumulate(np.where(new_tie, at, -1))
            ranks = np.where(tied < 0, tie, numbers[np.maximum(tied, 0)])
            number, tie = int(numbers[-1]), int(ranks[-1])
            last = {c: b.column(b.schema.get_field_index(c))[-1].as_py() for c in {*self.part_cols, *self.tie_cols}}
            yield b, numbers, ranks, last

    def border(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        n, first, end = 0, None, None
        for b, numbers, ranks, _ in self._stream(batches, lambda pid: (0, 0)):
            plain = b.drop_columns(["_pid"])
            if first is None:
                pid, first = b["_pid"][0].as_py(), plain.slice(0, 1).to_struct_array()
            n += b.num_rows
            end = (int(numbers[-1]), int(numbers[-1] - ranks[-1]) + 1, plain.slice(b.num_rows - 1).to_struct_array())
        if n:
            yield pa.record_batch([pa.array([pid], pa.int32()), *(pa.array([v], pa.int64()) for v in (n, *end[:2])), first, end[2]],
                                  ["pid", "n", "key_run", "tie_run", "first", "last"])

    def rows(self, carried: dict[int, tuple]):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def finish(b, numbers, ranks, after: dict | None, value):
            """Columns of a batch; ``after``: key of the row that follows it, ``value`` its lead."""
            cols = [b.column(b.schema.get_field_index(c)) for c in self.columns]
            cols += [pa.array(v, pa.int64()) for c, v in ((self.row_number, numbers), (self.rank, ranks)) if c]
            names = [*self.columns, *[c for c in (self.row_number, self.rank) if c]]
            if self.lead:
                v = b.column(b.schema.get_field_index(self.lead[0]))
                shifted = pa.concat_arrays([v.slice(1), pa.array([value], v.type)])
                ends = np.append(self._changes(b, self.part_cols, None)[1:], False)
                cols.append(pc.if_else(pa.array(ends), pa.scalar(None, v.type), shifted))
                names.append(self.lead[1])
            return pa.record_batch(cols, names)

        def run(batches):
            held, pid = None, None
            for b, numbers, ranks, _ in self._stream(batches, lambda p: carried[p][:2]):
                pid = b["_pid"][0].as_py()
                if held is not None:
                    first = {c: b.column(b.schema.get_field_index(c))[0].as_py() for c in self.part_cols}
                    old = held[0]
                    same = all(first[c] == old.column(old.schema.get_field_index(c))[-1].as_py() for c in self.part_cols)
                    value = b.column(b.schema.get_field_index(self.lead[0]))[0].as_py() if self.lead and same else None
                    yield finish(*held, first, value)
                held = (b, numbers, ranks)
            if held is not None:
                yield finish(*held, None, carried[pid][2])

        return run


def top_distinct_ranked(df: DataFrame, part_cols: list[str], value: str, k: int, name: str) -> DataFrame:
    """Rows whose ``DENSE_RANK() OVER (PARTITION BY part_cols ORDER BY value DESC NULLS FIRST)``
    is at most ``k``, with that rank as ``name``.

    Only the ``k`` greatest distinct values of each key matter: distinct (key, value) pairs are
    formed by a partial-then-final aggregate and cut to ``k`` before and after their shuffle.
    The rows are joined to these lists of at most ``k`` values by key, so rows that tie (all rows
    of a state without a value, say) stay spread over tasks, and a hot key is split by AQE.
    """
    w = Window.partitionBy(*part_cols).orderBy(F.col(value).desc_nulls_first())
    best = df.select(*part_cols, value).distinct().withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    # A struct keeps a NULL value apart from a missing one.
    lists = best.groupBy(*part_cols).agg(F.sort_array(F.collect_list(F.struct("_r", value))).alias("_best"))
    joined = join_on_keys(df, lists, part_cols)
    place = F.filter("_best", lambda e: e[value].eqNullSafe(F.col(value)))
    return joined.withColumn(name, place[0]["_r"].cast("bigint")).where(F.size(place) > 0).drop("_best")
