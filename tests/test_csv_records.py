"""CSV with line breaks inside quotes, read in parallel; malformed rows end as errors."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators import sinks as K
from terrace.sources import readers as S

SCHEMA = "id long, note string, tag string"


def texts(rng, n):
    pool = ["plain", "a, b", 'say "hi"', "two\nlines", '"', '""', 'x\n\n"y", z\n', "\n", "", None, "é😀", "x" * 900, "l1\nl2\r\nl3"]
    return [(i, rng.choice(pool), rng.choice(["t", "u\nv", None])) for i in range(n)]


def write(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=newline)
        w.writerow(["id", "note", "tag"])
        w.writerows(rows)


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path, **kw):
    return S.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema, multiline=True, **kw)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_equal_the_whole_file_reader(spark, tmp_dir, small_splits, newline):
    rng = random.Random(4)
    folder = os.path.join(tmp_dir, "notes")
    os.makedirs(folder)
    for k in range(3):
        write(os.path.join(folder, f"{k}.csv"), [(k * 1000 + i, *r) for i, *r in texts(rng, 400 * (k + 1))], newline)
    lines = spark.read.option("lineSep", "\n").text(folder)
    assert lines.rdd.getNumPartitions() > 20
    got = read(spark, folder)
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(SCHEMA).csv(folder)
    key = F.col("id")
    a, b = ([tuple(r) for r in d.orderBy(key).collect()] for d in (got, want))
    assert len(a) == 2400
    if newline == "\n":
        assert a == b
    else:  # the whole-file reader makes \\n of line breaks inside quotes; here the text stays
        fold = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in a]
        assert fold == [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in b]
    # The same records however the file is cut.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "317")
    assert [tuple(r) for r in read(spark, folder).orderBy(key).collect()] == a
    monkey = S.MAX_RANGES
    try:
        S.MAX_RANGES = 0  # many ranges: joined by a sort instead of a broadcast
        assert [tuple(r) for r in read(spark, folder).orderBy(key).collect()] == a
    finally:
        S.MAX_RANGES = monkey


def test_record_over_many_ranges_and_unclosed_quote(spark, tmp_dir, small_splits):
    path = os.path.join(tmp_dir, "n.csv")
    long = "\n".join(f"line {i}" for i in range(4000))
    write(path, [(1, "a", "b"), (2, long, "c"), (3, "z", None)])
    assert [(r.id, r.note) for r in read(spark, path).orderBy("id").collect()] == [(1, "a"), (2, long), (3, "z")]
    with open(path, "a") as f:
        f.write('4,"never closed,x\n5,b,c\n')
    bad = read(spark, path, malformed=True).where("_malformed IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0]._malformed.startswith("quote is not closed: 4,")
    cut = S.csv_records(spark, path, max_record=5000).where("broken LIKE 'record is longer%'").collect()
    assert len(cut) == 1 and len(cut[0].record) < 1000


def test_empty_and_header_only_files(spark, tmp_dir):
    for name, text in (("e.csv", ""), ("h.csv", "id,note,tag\n"), ("n.csv", "id,note,tag"), ("m.csv", 'id,"no\nte",tag\n7,a,b')):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
        assert [r.id for r in read(spark, os.path.join(tmp_dir, name)).collect()] == ([7] if name == "m.csv" else [])


def test_malformed_rows_make_an_entry_an_error(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "pq")
    os.makedirs(src)
    head = {t: ",".join(s.names) + "\n" for t, s in schemas.RAW_SCHEMAS.items()}
    files = {"olist_sellers_dataset.csv": head["dim_seller"] + "1,z,c,s\n2,z,c\nx,z,c,s\n3,z,c,s,more\n",
             "olist_order_reviews_dataset.csv": head["fact_order_review"] + '1,2,5,"a\nb",ok,,\nz,2,5,t,m,,\n',
             "product_category_name_translation.csv": head["dim_product_category"] + "a,b\n"}
    for name, text in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    report = K.ingest_catalog(spark, src, dst, S.read_csv_checked)
    got = {r.table_name: r for r in report.collect()}
    assert got["dim_seller"].status.startswith("error: 3 malformed rows") and got["dim_seller"].rows is None
    assert got["fact_order_review"].status.startswith("error: 1 malformed rows, such as 'z,2,5")
    assert got["dim_product_category"].status == "ok" and got["dim_product_category"].rows == 1
    for table in ("dim_seller", "fact_order_review"):  # nothing is committed
        left = os.path.join(dst, table)
        assert not os.path.isdir(left) or not [f for f in os.listdir(left) if f.endswith(".parquet")]
    out = K.ingest_outcome(report).first()
    assert (out.loaded, out.missing, out.failed, out.rows, out.success) == (1, 6, 2, 1, False)
    assert K.ingest_outcome(report.where("status != 'missing' AND status NOT LIKE 'error%'")).first().success
