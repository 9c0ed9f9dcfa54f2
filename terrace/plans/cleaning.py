"""Cleaning jobs: product JSON cleaning, per-row unit price with quarantine, post
cleaning, and weather shaping. All take DataFrames, so the same code runs on the literal
fixtures in tests and on distributed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrace.functions.exprs import format_amount
from terrace.functions.stats import exact_median

PRODUCT_OUTPUT = ("id_produk", "nama_produk", "harga", "stok", "kategori", "skor_rating")


def _select_products(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("id_produk"), F.upper("title").alias("nama_produk"),
                     F.col("price").alias("harga"), F.col("stock").alias("stok"),
                     F.col("category").alias("kategori"), F.col("rating").alias("skor_rating"))


def products_clean(products: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """Fill, then filter, then select: price -> exact median of *all* rows, stock -> 0,
    category -> 'other', rating -> 0.0; keep rating >= min_rating; rename; title upper-cased.

    The median is a scalar subquery over the unfiltered input, so Catalyst cannot push the
    rating filter below it.
    """
    med = exact_median(products, "price").scalar()
    filled = products.select(
        "id", "title", F.coalesce(F.col("price"), med).alias("price"),
        F.coalesce(F.col("stock"), F.lit(0)).cast("bigint").alias("stock"),
        F.coalesce(F.col("category"), F.lit("other")).alias("category"),
        F.coalesce(F.col("rating"), F.lit(0.0)).alias("rating"))
    return _select_products(filled.where(F.col("rating") >= min_rating))


def products_filter_first(products: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """The exercise variant: the filtered copy is taken before the fills, so kept rows keep
    their NULLs (a NULL rating is dropped by the filter)."""
    return _select_products(products.where(F.col("rating") >= min_rating))


def items_unit_price(items: DataFrame) -> DataFrame:
    """Per row ``harga_total / jumlah`` with a status instead of an exception.

    Checks in the source's order: missing total, missing quantity, zero quantity. A row with
    a missing name gets ``Barang_Tanpa_Nama_{idx}``. Output keeps every row; valid rows carry
    the unit price and its formatted text, the others an error label (the quarantine).
    """
    total, qty = F.col("harga_total"), F.col("jumlah")
    status = (F.when(total.isNull(), "missing_field").when(qty.isNull(), "missing_field")
              .when(qty == 0, "zero_divisor").otherwise("ok"))
    missing = F.when(total.isNull(), "harga_total").when(qty.isNull(), "jumlah")
    unit = F.when(status == "ok", F.try_divide(total, qty))
    return items.select(
        "idx", F.coalesce(F.col("nama"), F.concat(F.lit("Barang_Tanpa_Nama_"), F.col("idx").cast("string"))).alias("nama"),
        status.alias("status"), missing.alias("missing_column"), unit.alias("harga_satuan"),
        format_amount(unit).alias("harga_satuan_text"))


def item_rows_from_order_items(items: DataFrame) -> DataFrame:
    """Part-1 style item rows over the order items: idx, name (missing for some products),
    total price (missing when the price is missing), quantity (zero or missing for some)."""
    k = F.col("order_item_id")
    return items.select(
        (F.col("order_id") * 100 + k).alias("idx"),
        F.when(F.col("product_id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("product_"), F.col("product_id").cast("string"))).alias("nama"),
        (F.col("price") * k).alias("harga_total"),
        F.when(k % 4 == 0, F.lit(0.0)).when(k % 5 == 0, F.lit(None)).otherwise(k.cast("double")).alias("jumlah"))


def posts_clean(posts: DataFrame, min_length: int = 50) -> DataFrame:
    """Drop rows with a NULL title or body, keep bodies longer than ``min_length`` characters,
    rename userId -> author_id."""
    return (posts.dropna(subset=["title", "body"])
            .withColumn("body_length", F.char_length("body").cast("bigint"))
            .where(F.col("body_length") > min_length)
            .withColumnRenamed("userId", "author_id"))


def posts_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").alias("userId"), F.col("source").alias("title"),
                            F.col("text").alias("body"))


def profile_columns(df: DataFrame) -> DataFrame:
    """``(column, type, non_null, rows)`` for every column, from one aggregate pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    stacked = counts.unpivot("_rows", df.columns, "column", "non_null")
    type_map = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return stacked.select("column", type_map[F.col("column")].alias("type"), "non_null",
                          F.col("_rows").alias("rows"))
