"""Queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.llm import common as C

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from terrace.llm import oracle

    return {"op9_quality_rules": oracle.op9(), "op11_filter_audit": oracle.op11(),
            "op12_substring_dedup": oracle.op12(), "op13_phrase_collocations": oracle.op13()}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_crf(spark, sf_dir):
    """Quality of every document, learned from labels whose remainder modulo 4 is not 2."""
    from terrace.llm import quality_crf as Q

    docs = C.documents(spark, sf_dir)
    labels = C.read_table(spark, sf_dir, "labels").where(C.id_remainder(F.col("doc_id"), 4) != 2)
    scored = Q.score(docs, Q.fit(docs, labels))
    return scored.select("doc_id", (C.id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "bad_chars")


@query
def op5_language_id(spark, sf_dir):
    """Language of every document, learned from rows whose remainder modulo 3 is not 1."""
    from terrace.llm import language as L

    docs = C.documents(spark, sf_dir)
    held_out = C.id_remainder(F.col("doc_id"), 3) == 1
    found = L.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "phrases", "text_chars")


@query
def op8_best_fit_packing(spark, sf_dir):
    """Packing of all documents into sequences of at most 2048 tokens."""
    from terrace.llm import packing as P

    packed = P.pack_documents(C.documents(spark, sf_dir), P.default_tokenizer(), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op9_quality_rules(spark, sf_dir):
    """Measurements, rule ledger and verdict of policy v2 for every document."""
    from terrace.llm import quality_rules as R

    rows = R.ledger(C.documents(spark, sf_dir))
    base_failed = F.col("failed").bitwiseAND(F.lit(R.mask_of(R.BASE)).cast("long")) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed.alias("base_failed"), (~base_failed & R.verdict("v2")).alias("kept"), "failed")


@query
def op10_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    from terrace.llm import secrets as S

    found = S.find_secrets(C.documents(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda s, k=k: s["kind"] == k)).cast("long").alias(f"n_{name}")
              for k, name in enumerate(S.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(S.span_text(F.col("base")), 256).alias("base_sha256"),
                        S.span_text(F.col("found")).alias("spans"))


@query
def op6_pii_boosting(spark, sf_dir):
    """Personal data in every document."""
    from terrace.llm import pii as P

    found = P.find_pii(C.documents(spark, sf_dir))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS BIGINT) AS n_{name}")
              for k, name in enumerate(P.KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(P.span_text("base"), 256).alias("base_sha256"),
                        P.span_text("found").alias("spans"))


@query
def op4_line_dedup(spark, sf_dir):
    """Every document with its repeated lines cut out."""
    from terrace.llm import line_dedup as D

    return D.dedup_lines(C.documents(spark, sf_dir).select("doc_id", "text"))


@query
def op2_minhash_near_dedup(spark, sf_dir):
    """Class and group of near duplicates of every document."""
    from terrace.llm import minhash as M

    return M.near_duplicates(C.documents(spark, sf_dir))


@query
def op1_brown_scores(spark, sf_dir):
    """Log probability of every document under the class model and the unigram base."""
    from terrace.llm import brown as B

    return B.score_texts(C.documents(spark, sf_dir), C.id_remainder(F.col("doc_id"), 10) == 0)


@query
def op7_benchmark_leaks(spark, sf_dir):
    """Every pair of a document and a benchmark item that it leaks."""
    from terrace.llm import decontaminate as D

    return D.contaminated(C.documents(spark, sf_dir), C.read_table(spark, sf_dir, "benchmark"))


@query
def op11_filter_audit(spark, sf_dir):
    """Counts of every part, filter order and step."""
    from terrace.llm import filter_audit as A

    return A.audit_filters(C.documents(spark, sf_dir), C.read_table(spark, sf_dir, "labels"))


@query
def op12_substring_dedup(spark, sf_dir):
    """What every document keeps when passages of earlier ones are removed."""
    from terrace.llm import substring_dedup as S

    kept = S.dedup_passages(C.documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query
def op13_phrase_collocations(spark, sf_dir):
    """The 2,000 best phrases of every language."""
    from terrace.llm import collocations as P

    return P.collocations(C.documents(spark, sf_dir))
