"""How filters interact when they are applied in every order (op 11).

Every document fails some of the filters A to E: a set, kept as a mask of five bits. Documents
are counted by part, mask and label, so that at most 32 masks times four label pairs stay for a
part, however many documents it has. The rest is matrix work on these counts:

* ``mask matrix`` (masks x filters): 0 where the mask holds the filter, else infinite;
* ``position matrix`` (orders x filters): the step at which an order applies a filter, the
  inverse permutation of the order;
* their product with minimum for the sum and plus for the product gives for every mask and
  order the step that removes it (or that none does);
* counts are scattered, as weights, to the (order, step) cell of their removal; what a filter
  fails but does not remove there is redundant.

Filter E (the text occurs under a smaller doc_id) needs the least id of every text. Texts are
compared by their SHA-256; rows are first counted by text, id and part, so that a text that a
third of the documents share is a few rows before it is joined with its least id.

Edge cases: a null text counts as empty (null and empty texts are copies of each other), a null
source as the part ''. A null id is neither smaller nor larger than another: such rows never
fail E, cause no failure and have no label. Rows that repeat an id do not fail E through each
other; every row counts. An id with several labels is good (toxic) if one of them says so.
Texts of any length are split in slices. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terrace.llm import common as C

FILTERS = "ABCDE"
#: Fixed values of the filters.
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 2
MARKS = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_failures(data: bytes) -> int:
    """The bits of the filters A to D that a text fails."""
    n, distinct = 0, set()
    for part in C.word_slices(data):
        words = part.split()
        n += len(words)
        distinct.update(words)
    upper = len(data) - len(data.translate(None, UPPER))
    points = len(data.translate(None, CONTINUATION))
    marked = len(data.translate(None, MARKS)) < len(data)
    return ((n < MIN_WORDS) | (100 * len(distinct) < MIN_DISTINCT * n) << 1
            | (100 * upper > MAX_UPPER * points) << 2 | marked << 3)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest of the text, bits of A to D) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, bits = [], []
            for t in b.column(2):
                data = t.as_py()
                digests.append(hashlib.sha256(data).digest())
                bits.append(text_failures(data))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(digests, pa.binary()),
                                   pa.array(bits, pa.int32())], ["doc_id", "part", "digest", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, bits int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters and labels."""
    rows = measured(docs).groupBy("digest", "doc_id", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # Rows without an id have no label; their digest spreads them over the tasks of the join.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    rows = (rows.join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
            .fillna(0, ["good", "toxic"]))
    least: Column = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = C.stored(rows.groupBy("digest", "part", "bits", "good", "toxic")
                      .agg(F.sum("n").alias("n"), least.alias("least"),
                           F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null")), "audit-texts")
    first = groups.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    rated = groups.join(first, "digest").withColumn(
        "fresh", F.col("n_null") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0))
    copied = F.lit(1 << FILTERS.index("E"))
    both = F.explode(F.array(F.struct(F.col("bits").alias("mask"), F.col("fresh").alias("n")),
                             F.struct(F.col("bits").bitwiseOR(copied).alias("mask"), (F.col("n") - F.col("fresh")).alias("n"))))
    return (rated.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
            .groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic").agg(F.sum("x.n").alias("n")))


def removal_steps(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All orders, the position matrix (orders x filters, from 1) and the step (masks x orders)
    that removes a mask: the min-plus product of mask and position matrix. A mask that no
    filter holds gets the step n_filters + 1."""
    orders = list(permutations(range(n_filters)))
    position = np.argsort(np.array(orders), axis=1) + 1
    masks = np.arange(1 << n_filters)[:, None] >> np.arange(n_filters) & 1
    never = n_filters + 1
    steps = np.full((len(masks), len(orders)), never)
    for f in range(n_filters):
        cost = np.where(masks[:, f] == 1, 0, never)
        np.minimum(steps, cost[:, None] + position[None, :, f], out=steps)
    return orders, position, steps


def audit_part(weights: np.ndarray, orders, position, steps) -> dict[str, np.ndarray]:
    """The counts of one part for every (order, step), row by row. ``weights``: masks x (all,
    good, toxic)."""
    n_masks, n_filters = len(weights), position.shape[1]
    n_orders = len(orders)
    cells = np.zeros((n_orders, n_filters + 2, 3), dtype=np.int64)
    np.add.at(cells, (np.arange(n_orders)[None, :].repeat(n_masks, 0), steps),
              weights[:, None, :].repeat(n_orders, 1))
    removed = cells[:, 1:n_filters + 1]
    total = weights[:, 0].sum()
    applied = np.array(orders)  # the filter of every (order, step)
    holds = np.arange(n_masks)[:, None] >> np.arange(n_filters) & 1
    fails = (weights[:, :1] * holds).sum(axis=0)
    alone = weights[1 << np.arange(n_filters), 0]
    shapley = np.zeros(n_filters, dtype=np.int64)
    np.add.at(shapley, applied, removed[:, :, 0])
    return {"kept": total - removed[:, :, 0].cumsum(axis=1), "removed": removed[:, :, 0],
            "redundant": fails[applied] - removed[:, :, 0], "unique_fails": alone[applied],
            "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": shapley[applied]}


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every (part, order, step) with its counts; ``counts`` as ``mask_counts`` gives them, bit k
    of a mask for the filter ``names[k]``. A part is one row of at most 4 x 2^filters counts."""
    n_filters = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, position, steps = removal_steps(n_filters)
        text = ["".join(names[f] for f in o) for o in orders]
        order_col = pa.array(np.repeat(text, n_filters))
        step_col = pa.array(np.tile(np.arange(1, n_filters + 1, dtype=np.int32), len(orders)))
        for b in batches:
            for part, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                weights = np.zeros((1 << n_filters, 3), dtype=np.int64)
                for c in cells:
                    weights[c["mask"]] += np.array([1, c["good"], c["toxic"]]) * c["n"]
                got = audit_part(weights, orders, position, steps)
                yield pa.record_batch([pa.array([part] * len(order_col), pa.string()), order_col, step_col,
                                       *[pa.array(got[c].ravel()) for c in COUNTS]],
                                      ["part", "filter_order", "step", *COUNTS])

    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    return parts.mapInArrow(run, AUDIT)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All parts, orders and steps of the five filters over documents."""
    return audit(mask_counts(docs, labels))
