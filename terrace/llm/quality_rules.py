"""Quality rules with a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once for each document; the ledger keeps the measurements and one failure
bit per rule. A policy is a versioned set of rules: its verdict is one bitwise test on the
ledger, and what each rule of it removes on its own (the ablation) comes from an aggregate over
the distinct bit patterns, without another look at the texts.

Words are runs of characters other than space and U+0009 to U+000D. A word repeats if a window
of three consecutive words that holds it occurs twice or more in the text.

Edge cases: null texts count as empty (they fail the length rule); repeated rows get equal
results; other columns are dropped unless asked for; the largest text is limited by Spark's
own string size only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Rules in the order of their bits: (name, failure condition over the measurements).
RULES = (
    ("short", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("shouting", "2 * n_upper > n_letters AND n_letters > 0"),
    ("exclamation", "10 * n_marks > 3 * n_words"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    ("few_letters", "2 * n_letters < word_chars"),
)
#: Versioned policies: names of the rules that reject.
POLICIES = {
    "v1": ("short", "repeats", "symbols", "duplicate_lines"),
    "v2": tuple(name for name, _ in RULES),
}
BASE = ("short", "repeats")
WHITE = "\\x20\\x09-\\x0D"


def mask_of(names) -> int:
    order = [name for name, _ in RULES]
    return sum(1 << order.index(n) for n in names)


def _count(chars: str) -> str:
    """Characters of a class in the text."""
    return f"CAST(length(t) - length(regexp_replace(t, r'{chars}', '')) AS BIGINT)"


def _repeat_words() -> str:
    """From the word hashes: windows of three are packed with their place into one long (as many
    low bits as places need), so that sorting brings equal windows together; their places, in
    order, each cover up to three words."""
    pack = """transform(h, (x, i) -> shiftleft(shiftright(xxhash64(x, get(h, i + 1), get(h, i + 2)), b), b)
              | CAST(i AS BIGINT))"""
    same = "shiftright(get(s, i - 1), b) <=> shiftright(x, b) OR shiftright(get(s, i + 1), b) <=> shiftright(x, b)"
    return f"""CASE WHEN n_words < 4 THEN 0L ELSE
      transform(array(sort_array(slice({pack}, 1, CAST(n_words AS INT) - 2))), s ->
        transform(array(sort_array(transform(filter(s, (x, i) -> {same}), x -> x & (shiftleft(1L, b) - 1)))), p ->
          aggregate(transform(p, (x, i) -> least(3L, coalesce(get(p, i + 1) - x, 3L))), 0L, (a, x) -> a + x))[0])[0] END"""


def measure(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The measurements of every row."""
    white = "' \\t\\n\\u000B\\f\\r'"
    base = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    words = base.selectExpr(
        *keep, "t", f"CASE WHEN btrim(t, {white}) = '' THEN CAST(array() AS ARRAY<STRING>) "
        f"ELSE split(btrim(t, {white}), r'[{WHITE}]+') END AS w",
        f"filter(split(t, '\\n'), x -> btrim(x, {white}) != '') AS lines")
    hashed = words.selectExpr(
        *keep, "t", "CAST(size(w) AS BIGINT) AS n_words", "transform(w, x -> xxhash64(x)) AS h",
        "CAST(ceil(log2(size(w) + 1.0D)) AS INT) AS b",
        "CAST(size(lines) AS BIGINT) AS n_lines",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines")
    return hashed.selectExpr(
        *keep, "n_words", f"{_count(f'[^{WHITE}]')} AS word_chars", f"{_count('[#*$%&|<>]')} AS n_symbols",
        "n_lines", "n_dup_lines", f"{_repeat_words()} AS n_repeat_words",
        f"{_count(chr(92) + 'p{Lu}')} AS n_upper", f"{_count(chr(92) + 'p{L}')} AS n_letters",
        f"{_count('!')} AS n_marks")


def ledger(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Measurements and failure bits of every row."""
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << k}L ELSE 0L END" for k, (_, cond) in enumerate(RULES))
    return measure(docs, text, keep).withColumn("failed", F.expr(bits))


def verdict(policy: str) -> Column:
    """Whether the ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: failed (rows that fail it), only (rows that fail no other rule of
    the policy) and kept_without (rows kept if the rule were dropped). The ledger is reduced to
    its distinct bit patterns, at most two to the number of rules, before rules come in."""
    mask = mask_of(POLICIES[policy])
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("f")).agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(mask_of([name])).cast("long").alias("bit"))
             for name in POLICIES[policy]]
    each = patterns.select("f", "n", F.explode(F.array(*rules)).alias("r")).select("f", "n", "r.rule", "r.bit")
    hit = F.col("f").bitwiseAND(F.col("bit")) != 0
    alone = F.col("f") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("only"),
        F.sum(F.when(alone | (F.col("f") == 0), F.col("n")).otherwise(0)).alias("kept_without"))


def rule_conditions_sql() -> dict[str, str]:
    return dict(RULES)
