"""Filter audit, passage removal and collocations against plain Python on hostile tables."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from terrace.llm import collocations, common, filter_audit, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, blk long, h1 long, part string, words string"
WORDS = "the of and river stone window light garden market letter winter summer".split()


def prose(rng, n, ends=("", "", "", ".", ",", " \t", "\n")):
    return " ".join(rng.choice(WORDS) + rng.choice(ends) for _ in range(n))


def rows():
    """Null and empty texts and ids, repeated rows and ids, copies, shared passages, long texts, ties."""
    rng = random.Random(3)
    passage, long = prose(rng, 60), prose(rng, 9000)
    out = [(1, None), (2, ""), (3, " \n\t "), (None, passage), (None, None), (None, passage), (4, "")]
    out += [(10 + i, passage) for i in range(30)] + [(10, passage), (10, prose(rng, 40))]
    out += [(50 + i, prose(rng, i) + " " + passage + " " + prose(rng, 12 - i)) for i in range(12)]
    out += [(70 + i, f"{i} " + " ".join(passage.split()[i:i + 13]) + " x") for i in range(8)]
    out += [(80, long), (79, "é " + long + " #"), (81, "A" * 300 + " " + long), (82, "x" * 50_000), (83, "| " * 400)]
    out += [(90 + i, prose(rng, 230) + (" %" if i % 3 == 0 else "") + " UP" * (i % 4) * 9) for i in range(25)]
    out += [(120, "a b\x1c" * 20), (121, "😀 ß " * 200)]
    return [(d, t, [None, "en", "de"][i % 3], [None, "", "s1", "s1"][i % 4], 7, 8, "p", "w") for i, (d, t) in enumerate(out)]


LABELS = [(d, d % 2, 1 if d % 5 == 0 else 0) for d in range(10, 100)] + [(11, 0, 1), (12, None, None), (None, 1, 1), (999, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_slices_cut_no_word():
    text = ("é😀 ab\tc\n" * 50 + "x" * 300 + " y").encode()
    for size in (1, 7, 64):
        parts = list(common.word_slices(text, size))
        assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


# ------------------------------------------------------------------ 11
def brute_audit(table, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, *_ in table:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))

    def fails(d, text):
        w = split_words(text)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                "D": bool(re.search("[#$%&*|]", text)), "E": d is not None and least[text] < d}

    judged = [(s or "", fails(d, t or ""), d in good, d in toxic) for d, t, _, s, *_ in table]
    out = {}
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(j[1][f] for j in mine) - len(gone),
                                          sum(j[1][f] and sum(j[1].values()) == 1 for j in mine),
                                          sum(j[2] for j in gone), sum(j[3] for j in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit_equals_applying_the_filters(spark, docs, empty):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_filters(docs, labels)
    assert {(r.part, r.filter_order, r.step): [r[c] for c in filter_audit.COUNTS] for r in got.collect()} == brute_audit(rows(), LABELS)
    assert filter_audit.audit_filters(empty, labels).collect() == []
    assert len(filter_audit.audit_filters(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").collect()) == 0


def test_removal_steps_are_a_min_plus_product():
    orders, position, steps = filter_audit.removal_steps(4)
    for k, order in enumerate(orders):
        for mask in range(16):
            first = next((s for s, f in enumerate(order, 1) if mask >> f & 1), 5)
            assert steps[mask, k] == first
        assert all(position[k, f] == order.index(f) + 1 for f in range(4))


# ------------------------------------------------------------------ 12
def brute_passages(table):
    least = {}
    for d, t, *_ in table:
        w = split_words(t)
        for i in range(len(w) - 12):
            if d is not None:
                g = tuple(w[i:i + 13])
                least[g] = min(d, least.get(g, d))
    out = []
    for d, t, *_ in table:
        w = split_words(t)
        cut = {i + k for i in range(len(w) - 12) if d is not None and least[tuple(w[i:i + 13])] < d for k in range(13)}
        out.append((d, len(w), len(cut), " ".join(x for i, x in enumerate(w) if i not in cut)))
    return sorted(out, key=str)


def test_passages_equal_all_windows(docs, empty, monkeypatch):
    got = substring_dedup.dedup_passages(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute_passages(rows())
    assert substring_dedup.dedup_passages(empty).collect() == []


def test_passages_do_not_depend_on_layout(spark, docs):
    one = docs.orderBy("doc_id", "text").coalesce(1)
    assert sorted(map(tuple, substring_dedup.dedup_passages(one).collect()), key=str) == brute_passages(rows())


def test_cover_gives_every_shift():
    cover, period = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert substring_dedup.ANCHOR + period - 1 == substring_dedup.WINDOW


# ------------------------------------------------------------------ 13
def brute_phrases(table, max_words, min_count, top, contained):
    f, n = collections.Counter(), collections.Counter()
    for _, t, lang, *_ in table:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    longest = collections.Counter()
    for (lang, p), a in cands.items():
        for m in range(2, len(p)):
            for s in range(len(p) - m + 1):
                longest[lang, p[s:s + m]] = max(a, longest[lang, p[s:s + m]])
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        if 100 * longest[lang, p] < contained * a:
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for r, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1))


@pytest.mark.parametrize("top,unit", [(2000, 8_000_000), (5, 3000)])
def test_collocations_equal_counting_all_phrases(docs, empty, monkeypatch, top, unit):
    got = collocations.collocations(docs, top=top, unit_chars=unit)
    want = brute_phrases(rows(), 4, 30, top, 80)
    assert len(want) > 10 and sorted(map(tuple, got.collect())) == want
    if top == 5:
        assert collocations.collocations(empty).collect() == []


def test_phrase_rows_do_not_grow_with_copies():
    base = np.append(np.random.default_rng(1).integers(0, 50, 300), collocations.GAP)
    made = []
    for copies in (1, 10, 100):
        unit = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([collocations._packed(np.tile(base, copies))], pa.binary())], ["unit", "ids"])
        made.append(sum(b.num_rows for b in collocations.unit_phrases(4)([unit])))
    assert made[0] == made[1] == made[2] <= 297


def test_units_come_one_at_a_time(spark, monkeypatch):
    """A task holds one unit of a file, however many lie in it."""
    words, phrases = collocations.unit_words, collocations.unit_phrases

    def alone(batches):
        for b in batches:
            assert b.num_rows == 1
            yield b

    monkeypatch.setattr(collocations, "unit_words", lambda batches: words(alone(batches)))
    monkeypatch.setattr(collocations, "unit_phrases", lambda k: lambda batches: phrases(k)(alone(batches)))
    table = spark.createDataFrame([(f"l{i}", "one two three. " * 40) for i in range(6)], "lang string, text string").coalesce(1)
    before = spark.conf.get(collocations.BATCH)
    got = collocations.collocations(table)
    assert got.groupBy("lang").count().count() == 6 and spark.conf.get(collocations.BATCH) == before
