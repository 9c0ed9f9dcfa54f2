"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the multiset of its runs of ``shingle`` consecutive words (letters and digits, lower-
cased; a shorter text is one shingle). A shingle weighs its count in the text times
ln((N + 1) / df), df being the number of texts that hold it among all N. Document frequencies
are counted in buckets of the shingle hash: blocks of documents send their distinct shingles,
packed, to the buckets; what occurs in several documents comes back to these.

Texts with equal word sequences are one class, represented by its least id. Two classes can
only be similar if the shingles that a text shares with any other text carry at least
``threshold`` of its weight, so only such texts are sampled: ``samples`` consistent weighted
samples, in bands of ``rows``. Of the members of a bucket of equal bands the most central one is
the hub. Documents are verified against the best hub of their buckets; then, in buckets that this
did not make one component, against the bucket's hub, and at last against all members of
other components: no link between components is lost, and copies and near copies in large groups
do not make all pairs. A pair is a link if its exact weighted Jaccard similarity is at
least ``threshold``.

Edge cases: texts without words (also null) are groups of their own; rows without id as well;
rows that repeat an id count as one document; an empty table gives an empty result; other
columns are ignored. In a bucket shingles are told apart by 32 bits, which can only raise a
document frequency slightly, and alike for all texts that hold the shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import WordCodes, join_measured, stored, text_blocks, text_size
from terrace.llm.graph import components

BLOCK_CHARS = 3_000_000
BUCKET_CHARS = 12_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def word_hasher() -> WordCodes:
    import xxhash

    return WordCodes(lambda w: xxhash.xxh64_intdigest(w) - (1 << 63))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ordered, and their counts."""
    w = words.view(np.uint64)
    n = len(w) - size + 1
    if not len(w):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if n < 1:
        n, size = 1, len(w)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        h = mixed(h * ODD + w[k:k + n])
    return np.unique(h, return_counts=True)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shared_shingles(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """(doc_id, bucket, keys, df): of every document the shingles that occur in several, as low
    32 bits of the hash, with their document frequencies."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_hasher()
        for (ids,), texts in text_blocks(batches, BLOCK_CHARS):
            owned = [(d, shingles(w, size)[0]) for d, w in zip(ids, coder(texts)) if d is not None and len(w)]
            if not owned:
                continue
            h = np.concatenate([x for _, x in owned])
            owner = np.repeat(np.arange(len(owned)), [len(x) for _, x in owned])
            place = bucket_of(h, buckets).astype(np.int64)
            order = np.argsort(place, kind="stable")
            low, owner, place = h[order].astype(np.uint32), owner[order], place[order]
            cut = np.flatnonzero(np.diff(place, prepend=-1))
            rows = []
            for a, b in zip(cut, [*cut[1:], len(place)]):
                who, n = np.unique(owner[a:b], return_counts=True)
                rows.append((int(place[a]), [owned[k][0] for k in who], n.astype("<u4").tobytes(), low[a:b].tobytes()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.list_(pa.int64())),
                                              pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                             ["bucket", "owners", "counts", "keys"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(pdf["keys"]), dtype="<u4")
        _, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        df = n[place].astype("<u4")
        owners = np.concatenate([np.asarray(o, dtype=np.int64) for o in pdf["owners"]])
        ends = np.cumsum(np.concatenate([np.frombuffer(c, dtype="<u4") for c in pdf["counts"]]).astype(np.int64))
        many = df > 1
        upto = np.concatenate([[0], np.cumsum(many)])
        stops = upto[ends]
        starts = np.concatenate([[0], stops[:-1]])
        kept_keys, kept_df = keys[many], df[many]
        some = np.flatnonzero(stops > starts)
        return pd.DataFrame({
            "doc_id": owners[some], "bucket": pdf["bucket"].iloc[0],
            "keys": [kept_keys[starts[i]:stops[i]].tobytes() for i in some],
            "df": [kept_df[starts[i]:stops[i]].tobytes() for i in some]})

    sent = _plain(docs).mapInArrow(send, "bucket int, owners array<long>, counts binary, keys binary")
    return sent.groupBy("bucket").applyInPandas(count, "doc_id long, bucket int, keys binary, df binary")


def consistent_samples(h: np.ndarray, weight: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """[document, sample] hash of the sampled (shingle, level). ``h`` and ``weight`` hold the
    documents' shingles one after another, from ``starts`` on; no document is empty."""
    out = np.empty((len(starts), samples), dtype=np.uint64)
    sizes = np.diff(np.append(starts, len(h)))
    log_w = np.log(weight).astype(np.float32)
    scale = np.float32(1 / (1 << 21))

    def uniform(x: np.ndarray, shift: int) -> np.ndarray:
        return ((x >> np.uint64(shift)) & np.uint64((1 << 21) - 1)).astype(np.float32) * scale + scale / 2

    for k in range(samples):
        x = mixed(h ^ np.uint64(int(ODD) * (2 * k + 1) % (1 << 64)))
        y = mixed(x * ODD + np.uint64(k))
        r = -np.log(uniform(x, 0) * uniform(x, 21))
        log_c = np.log(-np.log(uniform(x, 42) * uniform(y, 0)))
        beta = uniform(y, 21)
        t = np.floor(log_w / r + beta)
        log_a = log_c - r * (t - beta + 1)
        least = np.minimum.reduceat(log_a, starts)
        hit = np.flatnonzero(log_a == np.repeat(least, sizes))
        first = hit[np.searchsorted(hit, starts)]
        out[:, k] = mixed(h[first] * ODD + t[first].astype(np.int64).view(np.uint64))
    return out


def sampled(docs: DataFrame, shared: DataFrame, n_docs: int, buckets: int, size: int, threshold: float,
            samples: int, rows: int) -> DataFrame:
    """(doc_id, c1, c2, n, bands, keys, weights, total, common) of every row: class hashes of the
    words, number of shingles and, if the document can have near duplicates, its band hashes, its
    weighted shingles, their weight and that of the shingles that other documents hold as well.
    Of equal texts in one block only the first is sampled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        coder = word_hasher()
        top = float(np.log(n_docs + 1))
        for (ids, found), texts in text_blocks(batches, BLOCK_CHARS):
            names, classes, sizes, picked, seen = [], [], [], [], set()
            for i, (d, dfs, words) in enumerate(zip(ids, found, coder(texts))):
                h, tf = shingles(words, size)
                raw = words.tobytes()
                classes.append((xxhash.xxh64_intdigest(raw, 1) - (1 << 63), xxhash.xxh64_intdigest(raw, 2) - (1 << 63)))
                names.append(d)
                sizes.append(len(h))
                if not dfs or not len(h) or classes[-1] in seen:
                    continue
                seen.add(classes[-1])
                key = np.concatenate([(np.frombuffer(x["keys"], dtype="<u4").astype(np.uint64)
                                       | (np.uint64(x["bucket"]) << np.uint64(32))) for x in dfs])
                df = np.concatenate([np.frombuffer(x["df"], dtype="<u4") for x in dfs])
                order = np.argsort(key)
                key, df = key[order], df[order]
                own = (h & np.uint64(0xFFFFFFFF)) | (bucket_of(h, buckets) << np.uint64(32))
                at = np.minimum(np.searchsorted(key, own), len(key) - 1)
                several = key[at] == own
                idf = np.where(several, np.maximum(top - np.log(np.maximum(df[at], 1)), 1e-3), top)
                weight = tf * idf
                total, common = float(weight.sum()), float(weight[several].sum())
                if common >= threshold * total * (1 - 1e-9):
                    picked.append((i, h, weight, total, common))
            bands: list[list[int] | None] = [None] * len(names)
            keys: list[bytes | None] = [None] * len(names)
            weights: list[bytes | None] = [None] * len(names)
            totals: list[float | None] = [None] * len(names)
            commons: list[float | None] = [None] * len(names)
            if picked:
                h, w = (np.concatenate([p[j] for p in picked]) for j in (1, 2))
                starts = np.cumsum([0] + [len(p[1]) for p in picked[:-1]])
                sig = consistent_samples(h, w, starts, samples).reshape(len(picked), samples // rows, rows)
                b = np.zeros(sig.shape[:2], dtype=np.uint64) + np.arange(samples // rows, dtype=np.uint64)
                for j in range(rows):
                    b = mixed(b * ODD + sig[:, :, j])
                for (i, hs, ws, total, common), band in zip(picked, b.view(np.int64)):
                    bands[i], keys[i], weights[i] = band.tolist(), hs.tobytes(), ws.astype("<f4").tobytes()
                    totals[i], commons[i] = total, common
            c1, c2 = zip(*classes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(keys, pa.binary()), pa.array(weights, pa.binary()),
                 pa.array(totals, pa.float64()), pa.array(commons, pa.float64())],
                ["doc_id", "c1", "c2", "n", "bands", "keys", "weights", "total", "common"])

    lists = shared.groupBy("doc_id").agg(F.collect_list(F.struct("bucket", "keys", "df")).alias("found"))
    joined = _plain(docs).join(lists, "doc_id", "left").select("doc_id", "found", "text")
    return joined.mapInArrow(run, "doc_id long, c1 long, c2 long, n long, bands array<long>, keys binary, weights binary, "
                                  "total double, common double")


def weighted_jaccard(ka: np.ndarray, wa: np.ndarray, kb: np.ndarray, wb: np.ndarray) -> float:
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    least = np.minimum(wa[ia], wb[ib]).sum()
    return float(least / max(wa.sum() + wb.sum() - least, 1e-30))


def verified(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold, with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                s = weighted_jaccard(np.frombuffer(r["ka"], np.uint64), np.frombuffer(r["wa"], "<f4").astype(np.float64),
                                     np.frombuffer(r["kb"], np.uint64), np.frombuffer(r["wb"], "<f4").astype(np.float64))
                if s >= threshold - 1e-6:
                    out.append((r["a"], r["b"], s))
            a, b, s = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())],
                                             ["a", "b", "similarity"])

    side = lambda x: reps.select(F.col("doc_id").alias(x), F.col("keys").alias(f"k{x}"), F.col("weights").alias(f"w{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long, similarity double")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, samples: int = 64,
                    rows: int = 4) -> DataFrame:
    """doc_id, class_id (least id with the same words), group_id (least id of the group of near
    duplicates) and n_shingles of every row."""
    docs = docs.select("doc_id", "text")
    n_docs = docs.count()
    buckets = max(32, text_size(docs) // BUCKET_CHARS)
    shared = shared_shingles(docs, buckets, shingle)
    every = stored(sampled(docs, shared, n_docs, buckets, shingle, threshold, samples, rows), "near-sampled")
    ids = every.select("doc_id", "c1", "c2", "n").where("doc_id IS NOT NULL AND n > 0")
    classes = stored(ids.groupBy("c1", "c2").agg(F.min("doc_id").alias("class_id")), "near-classes")
    # Every class that can have near duplicates has been sampled at one of its documents at least.
    reps = every.where("bands IS NOT NULL").drop("doc_id").join(classes, ["c1", "c2"])
    reps = stored(reps.withColumnRenamed("class_id", "doc_id").dropDuplicates(["doc_id"]), "near-reps")
    bands = reps.select("doc_id", "total", "common", F.explode("bands").alias("band"))
    sizes = stored(bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "near-buckets")
    members = join_measured(bands, sizes, "band")
    # The original of many copies shares most buckets with them: the member whose buckets are
    # largest in all is the hub, and every document is tested with the best hub of its buckets.
    weight = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    members = stored(members.drop("size").join(weight, "doc_id"), "near-members")
    rank = F.struct("weight", (-F.col("doc_id")).alias("order"))
    hubs = members.groupBy("band").agg(F.max(rank).alias("hub"))
    tested = (members.join(hubs, "band").where(-F.col("hub.order") != F.col("doc_id"))
              .groupBy(F.col("doc_id").alias("a")).agg(F.max("hub").alias("hub")).select("a", (-F.col("hub.order")).alias("b")))
    tested = stored(tested, "near-pairs")
    links = stored(verified(tested, reps, threshold), "near-links")
    # Then, in buckets that still hold several components, with the bucket's own hub, and at last
    # all pairs that are still apart and can be similar: what two documents share is at most the
    # lesser weight of their common shingles, and in a similar pair at least one document has a
    # total of at most (1 + t) / 2t times its own common weight.
    shared_most = F.least("common_a", "common_b") * (1 + 1e-6)
    possible = shared_most >= threshold * (F.col("total_a") + F.col("total_b") - shared_most)
    light = F.col("total") * (2 * threshold) <= F.col("common") * ((1 + threshold) * (1 + 1e-6))
    for last in (False, True):
        comp = stored(components(links), "near-components").withColumnRenamed("id", "doc_id")
        placed = members.join(comp, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        several = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max(rank).alias("hub"))
        several = several.where("lo != hi").select("band", (-F.col("hub.order")).alias("hub"))
        split = stored(placed.join(several, "band"), "near-open")
        x, y = (split.where(rows).select("band", *[F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "component", "total", "common")])
                for side, rows in (("a", F.lit(True)), ("b", light if last else F.col("doc_id") == F.col("hub"))))
        pairs = x.join(y, (x["band"] == y["band"]) & (F.col("component_a") != F.col("component_b")) & possible)
        pairs = pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        known = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = stored(pairs.join(known, ["a", "b"], "left_anti"), "near-pairs")
        links = stored(links.unionByName(verified(pairs, reps, threshold)), "near-links")
        tested = tested.unionByName(pairs)
    groups = stored(components(links), "near-groups").withColumnRenamed("id", "class_id").withColumnRenamed("component", "group_id")
    whole = every.select("doc_id", "c1", "c2", "n").join(classes, ["c1", "c2"], "left") \
        .withColumn("class_id", F.when(F.col("doc_id").isNull() | (F.col("n") == 0), F.col("doc_id")).otherwise(F.col("class_id")))
    return join_measured(whole, groups, "class_id", "left").select(
        "doc_id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.col("n").alias("n_shingles"))
