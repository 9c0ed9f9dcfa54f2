"""Secrets by format and by a battery of randomness tests.

Format matches (assignments to secret-like names, access key ids, long hex runs) always count.
Besides, every other run of 16 or more token characters that holds a digit, a sign or both cases
is tested: its encoding is inferred (hex, base32, base62 or its parts, base64), and against
uniform symbols of that alphabet four statistics are taken: the chi-squared statistics of symbol
counts and of character classes, the runs test about the alphabet's middle and the lag-1 serial
correlation. Their squared deviates add up to a score; small means random.

The p-value of a score is its place among the scores of ``SAMPLES`` uniform runs of the same
alphabet and length (of the next shorter one in LENGTHS beyond 32 symbols). For every encoding
and length, Benjamini-Hochberg over all tested runs says which are not random; all others are
accepted. A run is refused only if its p-value is at most ``fdr``, so a random token is found with
a chance of at least 1 - ``fdr`` however many others there are, and of the refused runs at most
``fdr`` are random in expectation. How many ordinary runs are accepted is not bounded; it depends
on the power of the tests at their length. Histograms of p-values cover all documents and have a
fixed number of cells. Runs of letters of one case, whatever ``=`` follow, are words, never tested.

Edge cases: null and empty texts have no span; texts are scanned whole; repeated rows get equal
results; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terrace.llm.common import stored, text_blocks

#: The formats that always count, in their order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

ONE_CASE = re.compile(r"(?:[a-z]+|[A-Z]+)\Z")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of runs; a run's encoding is its index.
ALPHABETS = (DIGITS + LOWER[:6], DIGITS + UPPER[:6], UPPER + "234567", UPPER + LOWER, UPPER + DIGITS, LOWER + DIGITS,
             UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "-_", UPPER + LOWER + DIGITS + "+/")
#: Lengths with a null distribution of their own; a run belongs to the largest one not above it.
LENGTHS = (*range(2, 33), 36, 40, 48, 64, 96, 128, 256)
SAMPLES = 10_000    # uniform runs behind a null distribution
PLACES = 8          # cells of p-values for each power of ten
CELLS = 4 * PLACES + 1

SCHEMA = ("doc_id long, base array<struct<start:long,kind:int,end:long>>, "
          "runs array<struct<start:long,kind:int,end:long,stratum:int,cell:int>>")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of format matches, ordered."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6] \
        if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def alphabet_of(run: str) -> str:
    """The smallest alphabet a run fits: letters only are taken as the letters of its cases."""
    chars = set(run)
    for alphabet in ALPHABETS[:2]:
        if chars <= set(alphabet):
            return alphabet
    if chars <= set(ALPHABETS[2]) and chars & set("234567"):
        return ALPHABETS[2]
    out = "".join(part for part in (UPPER, LOWER, DIGITS) if chars & set(part))
    if chars & set("+/_-="):
        out = ALPHABETS[7 if chars & set("-_") else 8]
    return out


def scores(x: np.ndarray, alphabet: str) -> np.ndarray:
    """Sums of squared deviates of the four tests for the rows of a matrix of symbols."""
    (k, n), m = x.shape, len(alphabet)
    rows = np.arange(k)[:, None]
    counts = np.bincount((rows * m + x).ravel(), minlength=k * m).reshape(k, m)
    chi = ((counts - n / m) ** 2).sum(axis=1) / (n / m)
    z_chi = (chi - (m - 1)) / np.sqrt(max(2 * (m - 1) * (1 - 1 / n), 1e-9))
    kinds = np.array([0 if c in LOWER else 1 if c in UPPER else 2 if c in DIGITS else 3 for c in alphabet])
    share = np.bincount(kinds, minlength=4) / m
    there = share > 0
    classes = np.stack([counts[:, kinds == j].sum(axis=1) for j in range(4)], axis=1)[:, there]
    free = max(int(there.sum()) - 1, 1)
    z_class = (((classes - n * share[there]) ** 2 / (n * share[there])).sum(axis=1) - free) / np.sqrt(2 * free)
    high = x >= m / 2
    a = high.sum(axis=1)
    b = n - a
    mean = 2 * a * b / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9)
    z_runs = np.where((a == 0) | (b == 0), np.sqrt(n), (1 + (high[:, 1:] != high[:, :-1]).sum(axis=1) - mean) / np.sqrt(var))
    d = x - x.mean(axis=1, keepdims=True)
    z_serial = np.sqrt(n) * ((d[:, 1:] * d[:, :-1]).sum(axis=1) / np.maximum((d * d).sum(axis=1), 1e-9) + 1 / n)
    return np.maximum(z_chi, 0) ** 2 + np.maximum(z_class, 0) ** 2 + z_runs ** 2 + z_serial ** 2


def randomness(run: str, alphabet: str | None = None) -> float:
    """Sum of squared deviates of the four tests against uniform symbols; small means random."""
    run = run.rstrip("=") or run
    alphabet = alphabet or alphabet_of(run)
    if len(alphabet) < 2:
        return 1e3
    at = {c: i for i, c in enumerate(alphabet)}
    return float(scores(np.array([[at.get(c, 0) for c in run]], dtype=np.int64), alphabet)[0])


@lru_cache(maxsize=None)
def null_scores(encoding: int, length: int) -> np.ndarray:
    """Ordered scores of uniform runs of an encoding and length."""
    m = len(ALPHABETS[encoding])
    return np.sort(scores(np.random.default_rng([encoding, length]).integers(0, m, (SAMPLES, length)), ALPHABETS[encoding]))


def p_value(run: str) -> tuple[int, float]:
    """A run's stratum (encoding and length) and the share of random runs that look as little random."""
    run = run.rstrip("=") or run
    alphabet = alphabet_of(run)
    encoding = ALPHABETS.index(alphabet)
    length = bisect_right(LENGTHS, len(run)) - 1
    null = null_scores(encoding, LENGTHS[length])
    above = SAMPLES - np.searchsorted(null, randomness(run, alphabet) - 1e-9)
    return encoding * len(LENGTHS) + length, float((above + 1) / (SAMPLES + 1))


def _place(run: str) -> tuple[int, int]:
    stratum, p = p_value(run)
    return stratum, min(CELLS - 1, int(-PLACES * np.log10(p)))


def scan(docs: DataFrame) -> DataFrame:
    """Format spans and tested runs of every row of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [docs_schema.field(i).type for i in range(3)]
        for (doc_ids,), texts in text_blocks(batches, 4_000_000):
            base, runs = [], []
            for text in texts:
                spans = base_spans(text)
                tested = []
                for m in RUN.finditer(text):
                    s = m.group()
                    bare = s.rstrip("=")
                    if not ONE_CASE.match(bare) and not bare.isdigit() and len(bare) > 1 and any(map(str.isalnum, s)) \
                            and not any(a < m.end() and m.start() < e for a, _, e in spans):
                        tested.append((m.start(), 3, m.end(), *_place(s)))
                base.append([dict(zip(("start", "kind", "end"), x)) for x in spans])
                runs.append([dict(zip(("start", "kind", "end", "stratum", "cell"), x)) for x in tested])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((doc_ids, base, runs), types)],
                                             ["doc_id", "base", "runs"])

    span = [("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]
    docs_schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(pa.struct(span))),
                             ("runs", pa.list_(pa.struct([*span, ("stratum", pa.int32()), ("cell", pa.int32())])))])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def refused_cells(scanned: DataFrame, fdr: float = 0.01) -> dict[int, int]:
    """For every stratum with refused runs, the first refused cell of p-values."""
    cells = scanned.select(F.explode("runs").alias("r")).groupBy("r.stratum", "r.cell").agg(F.count("*").alias("n")).collect()
    n: dict[int, np.ndarray] = {}
    for r in cells:
        n.setdefault(r["stratum"], np.zeros(CELLS))[r["cell"]] = r["n"]
    out = {}
    for stratum, counts in n.items():
        # Runs from a cell on have p-values up to the cell's upper edge.
        extreme = counts[::-1].cumsum()[::-1]
        edge = 10.0 ** (-np.arange(CELLS) / PLACES)
        ok = np.flatnonzero((extreme > 0) & (edge <= fdr * extreme / counts.sum()))
        if len(ok):
            out[stratum] = int(ok[0])
    return out


def find_secrets(docs: DataFrame, fdr: float = 0.01) -> DataFrame:
    """doc_id, base (format spans) and found (all spans) as arrays of (start, kind, end), ordered
    by start and kind; kind is the index in KINDS."""
    scanned = stored(scan(docs), "secrets")
    first = refused_cells(scanned, fdr)
    first = F.array(*(F.lit(first.get(k, CELLS)) for k in range(len(ALPHABETS) * len(LENGTHS))))
    ok = F.filter("runs", lambda r: r["cell"] < F.element_at(first, r["stratum"] + 1))
    added = F.transform(ok, lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("found"))


def span_text(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
