"""Language identification by cross-parsing entropy.

For every language one suffix automaton is built over a bounded sample of its labelled text.
A text is cut greedily into phrases: the longest match of the remaining text with anything in
the sample is one phrase, an unknown character is one phrase too. The description length of a
text in a language is its number of phrases times the log of the sample's length (what a
pointer into the sample costs). Letters count, and one gap for whatever stands between words. The language with the least one, with its share of the labelled
rows as prior, wins. Automata are bounded by ``sample_chars`` per language.

Texts are parsed in fixed chunks that together cover them whole, many chunks at a time: one
array step advances every chunk of a block in every language by one character.

Edge cases: null texts and texts without a letter get ``und`` with score 0; with no labelled
rows every text gets ``und``; ties go to the language with the larger prior, then to the
smaller name; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from terrace.llm.common import text_blocks

OUT_SCHEMA = "doc_id long, lang_pred string, score double, phrases long, text_chars long"
CHUNK = 256
GAP = 1  # symbol of what stands between words


@dataclass(frozen=True)
class CrossParser:
    languages: list[str]
    log_prior: np.ndarray       # nats
    pointer_cost: np.ndarray    # nats for one phrase, per language
    symbols: np.ndarray         # code point -> symbol, 0 for unknown ones
    step: np.ndarray            # [state of any language, symbol] -> state, 0 for none
    roots: np.ndarray


def symbol_codes(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts and the number of each text: letters, lower-cased, and one GAP for
    every run of other characters."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    codes = table[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    kept = np.ones(len(codes), dtype=bool)
    kept[1:] = (codes[1:] != GAP) | (codes[:-1] != GAP)
    upto = np.concatenate([[0], np.cumsum(kept)])
    ends = np.cumsum(sizes)
    return codes[kept], upto[ends] - upto[ends - sizes]


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton of a symbol sequence: array[state, symbol] with 0 for
    none; the root is state 1."""
    step = np.zeros((2 * len(codes) + 3, width), dtype=np.int32)
    link = [0] * (2 * len(codes) + 3)
    length = [0] * (2 * len(codes) + 3)
    rows: list[dict[int, int]] = [{} for _ in range(2 * len(codes) + 3)]
    last, n = 1, 2
    for c in codes:
        cur, n = n, n + 1
        length[cur] = length[last] + 1
        p = last
        while p and c not in rows[p]:
            rows[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = rows[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone, n = n, n + 1
                length[clone] = length[p] + 1
                rows[clone] = dict(rows[q])
                link[clone] = link[q]
                link[q] = link[cur] = clone
                while p and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
        last = cur
    for s in range(n):
        for c, t in rows[s].items():
            step[s, c] = t
    return step[:n]


def fit(docs: DataFrame, sample_chars: int = 40_000, sample_docs: int = 96, symbols: int = 95) -> CrossParser | None:
    """From columns (doc_id, text, lang), all of them labelled. Per language the ``sample_docs``
    texts of least hash are taken, at most ``sample_chars`` characters in all."""
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return None
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (docs.where(F.length("text") > 0).select("doc_id", "lang").withColumn("k", F.row_number().over(by_hash))
              .where(F.col("k") <= sample_docs).select("doc_id", "k"))
    rows = (docs.select("doc_id", "lang", F.substring("text", 1, sample_chars // 8).alias("text"))
            .join(F.broadcast(picked), "doc_id").orderBy("lang", "k").collect())
    samples: dict[str, str] = {lang: "" for lang in shares}
    for r in rows:
        if len(samples[r["lang"]]) < sample_chars:
            samples[r["lang"]] += " " + r["text"].lower()
    samples = {lang: t[:sample_chars] for lang, t in samples.items()}
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    chars, counts = np.unique(np.frombuffer("".join(samples.values()).encode("utf-32-le", "surrogatepass"),
                                            dtype="<u4"), return_counts=True)
    chars, counts = chars[letter[chars]], counts[letter[chars]]
    kept = chars[np.argsort(-counts, kind="stable")][:symbols]
    table = np.where(letter, 0, GAP).astype(np.uint8)
    table[kept] = np.arange(GAP + 1, GAP + 1 + len(kept))
    width = GAP + 1 + len(kept)
    steps, roots, at = [np.zeros((1, width), dtype=np.int32)], [], 0
    languages = sorted(samples)
    for lang in languages:
        codes, _ = symbol_codes(table, [samples[lang]])
        own = suffix_automaton([int(c) for c in codes if c], width)
        steps.append(np.where(own[1:] > 0, own[1:] + at, 0).astype(np.int32))
        roots.append(at + 1)
        at += len(own) - 1
    total = sum(shares.values())
    return CrossParser(languages, np.log([shares[x] / total for x in languages]),
                       np.log([max(2, len(samples[x])) for x in languages]), table,
                       np.concatenate(steps), np.array(roots, dtype=np.int32))


def phrase_counts(parser: CrossParser, texts: list[str]) -> np.ndarray:
    """[text, language] number of phrases."""
    codes, sizes = symbol_codes(parser.symbols, texts)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    chunks = -(-sizes // CHUNK)
    owner = np.repeat(np.arange(len(texts)), chunks)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = starts[owner] + first * CHUNK
    size = np.minimum(CHUNK, starts[owner + 1] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    k = len(parser.languages)
    roots = parser.roots[:, None]
    state = np.repeat(roots, len(begin), axis=1)
    at_root = parser.step[parser.roots]
    found = np.zeros((k, len(begin)), dtype=np.int64)
    alive = np.searchsorted(-size, -np.arange(CHUNK), side="left")
    flat, width = parser.step.reshape(-1), parser.step.shape[1]
    for i in range(CHUNK):
        n = alive[i]
        if not n:
            break
        c = codes[begin[:n] + i]
        s = state[:, :n]
        t = flat[s.astype(np.int64) * width + c]
        broken = t == 0
        # A phrase ends before the character that does not go on; at the root it is that character.
        ended = broken & (s != roots)
        fresh = np.where(broken, at_root[:, c], t)
        unknown = fresh == 0
        found[:, :n] += ended
        found[:, :n] += unknown
        state[:, :n] = np.where(unknown, roots, fresh)
    found += state != roots
    out = np.zeros((len(texts), k), dtype=np.int64)
    for j in range(k):
        out[:, j] = np.bincount(owner, weights=found[j], minlength=len(texts))
    return out


def predict(docs: DataFrame, parser: CrossParser | None) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the winner), phrases (of the winner) and text_chars
    for every row of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (doc_ids,), texts in text_blocks(batches, 4_000_000):
            letters = [any(map(str.isalpha, t)) for t in texts]
            names: list[str] = ["und"] * len(texts)
            score = np.zeros(len(texts))
            phrases = np.zeros(len(texts), dtype=np.int64)
            if model is not None:
                found = phrase_counts(model.value, texts)
                p = model.value
                cost = found * p.pointer_cost[None, :] - p.log_prior[None, :]
                best = cost.argmin(axis=1)
                rows = np.arange(len(texts))
                posterior = 1 / np.exp(np.maximum(cost[rows, best][:, None] - cost, -700)).sum(axis=1)
                for i, ok in enumerate(letters):
                    if ok:
                        names[i], score[i], phrases[i] = p.languages[best[i]], posterior[i], found[i, best[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(names), pa.array(score), pa.array(phrases),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["doc_id", "lang_pred", "score", "phrases", "text_chars"])

    model = docs.sparkSession.sparkContext.broadcast(parser) if parser is not None else None
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, OUT_SCHEMA)


def identify(docs: DataFrame, learn_from: Column, **options) -> DataFrame:
    """Fit on the rows for which ``learn_from`` holds, predict every row."""
    parser = fit(docs.where(learn_from).select("doc_id", "text", "lang"), **options)
    return predict(docs, parser)
