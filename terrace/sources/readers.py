"""Readers for landed files: JSON envelopes, nested weather documents, parallel forecast
arrays and CSV files, always with an explicit schema (no inference in the core).

All readers are splittable scans: JSON Lines (one envelope or document per line) and CSV are
split by ``spark.sql.files.maxPartitionBytes``, CSV with line breaks inside quotes too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from terrace import schemas
from terrace.functions.exprs import epoch_to_local
from terrace.session import materialize, path_exists

if TYPE_CHECKING:
    import pyarrow as pa


# ---------------------------------------------------------------- S1 / S2
def read_json_envelope(spark: SparkSession, path: str, array_field: str = "products",
                       schema: T.StructType = schemas.PRODUCT_ENVELOPE) -> DataFrame:
    """One row per element of ``array_field`` of every envelope; a missing array gives no rows."""
    env = spark.read.schema(schema).json(path)
    return env.select(F.inline(F.coalesce(F.col(array_field), F.array().cast(schema[array_field].dataType))))


def read_with_fallback(spark: SparkSession, primary: str, fallback: str, reader=read_json_envelope,
                       **kw) -> DataFrame:
    """Read ``primary``; if it is absent, read ``fallback``; if that is absent too, raise."""
    for path in (primary, fallback):
        if path and path_exists(spark, path):
            return reader(spark, path, **kw)
    raise FileNotFoundError(f"neither {primary} nor fallback {fallback} exists")


# ---------------------------------------------------------------- S3-S6, S12 (CSV)
#: Column that holds the text of a malformed row (NULL for a good one).
MALFORMED = "_malformed"
#: Byte ranges (one narrow row each) that are broadcast at most.
MAX_RANGES = 100_000
#: A record of more bytes is malformed (an unbalanced quote swallows what follows it).
MAX_RECORD = 16 * 1024 * 1024


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False,
             max_partition_bytes: int | None = None, malformed: bool = False, keep_empty: bool = False) -> DataFrame:
    """Header CSV with a declared schema. ``multiline``: quoted fields may hold line breaks (see
    ``csv_records``; the file is still split). ``malformed`` adds the column ``_malformed``. A
    quoted empty field is NULL as an unquoted one is, unless ``keep_empty`` (with ``multiline``)."""
    want = T.StructType(schema.fields + [T.StructField(MALFORMED, T.StringType())])
    if multiline:
        return _parsed(csv_records(spark, path), want if malformed else schema, keep_empty)
    r = spark.read.option("header", True).option("escape", '"').schema(want if malformed else schema)
    if malformed:  # a row is judged by all its columns, whatever is selected later
        r = r.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    if max_partition_bytes:
        r = r.option("maxPartitionBytes", str(max_partition_bytes))
    return r.csv(path)


def _parsed(records: DataFrame, schema: T.StructType, keep_empty: bool = False) -> DataFrame:
    options = {"escape": '"', "columnNameOfCorruptRecord": MALFORMED}
    if keep_empty:
        options["nullValue"] = "\u0000"  # what an unquoted empty field stands for
    row = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    out = records.select(row.alias("r"), "broken", "record").select("r.*", "broken", "record")
    if MALFORMED in schema.names:
        out = out.withColumn(MALFORMED, F.when(F.col("broken").isNotNull(), F.concat_ws(": ", "broken", F.left("record", F.lit(200))))
                             .otherwise(F.col(MALFORMED)))
    return out.select(schema.names)


def csv_records(spark: SparkSession, path: str, max_record: int = MAX_RECORD) -> DataFrame:
    """Logical records (record, broken) of header CSV files whose quoted fields may hold line
    breaks, without the headers. Files are read by byte ranges in parallel:

    1. every range counts its quotes; the running parity over the earlier ranges of the file
       (one row per range) tells whether a range begins inside a quoted field;
    2. every range then cuts its lines into records on its own: a line begins a record if the
       number of quotes before it is even (a doubled quote changes nothing);
    3. only records that cross a border, at most two pieces per range, are shuffled and joined.

    A record of more than ``max_record`` bytes, or whose quote never closes, is ``broken`` (the
    reason; the text is cut). A trailing carriage return is not part of a record; blank lines
    between records are skipped, as the CSV source does.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "at").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    ranges = materialize(ranges.select("file", "at", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside")))
    if ranges.count() <= MAX_RANGES:  # lines keep their order
        lines = lines.join(F.broadcast(ranges), ["file", "at"])
    else:
        lines = (lines.withColumn("pos", F.monotonically_increasing_id()).join(ranges.hint("merge"), ["file", "at"])
                 .sortWithinPartitions("file", "at", "pos"))
    pieces = lines.select("file", "at", "inside", "value").mapInArrow(
        _cut_records(max_record), "file string, at long, piece int, record string, closed boolean, first boolean, broken string")
    whole = pieces.where("piece IS NULL").select("record", "broken")
    borders = pieces.where("piece IS NOT NULL")
    order = Window.partitionBy("file").orderBy("at", "piece")
    opened = F.sum(F.when(F.col("piece") == 1, 1).otherwise(0)).over(order)
    size = F.sum(F.length("record")).over(Window.partitionBy("file", "opened"))
    long = F.col("size") > max_record
    borders = (borders.withColumn("opened", opened).withColumn("size", size)
               .where(~long | (F.col("piece") == 1) | F.col("broken").isNotNull()))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece", "record"))), lambda x: x["record"]), "\n")
    joined = (borders.withColumn("record", F.when(long, F.left("record", F.lit(200))).otherwise(F.col("record")))
              .withColumn("broken", F.when(long, F.lit(_too_long(max_record))).otherwise(F.col("broken")))
              .groupBy("file", "opened")
              .agg(text.alias("record"), F.bool_or("closed").alias("closed"), F.bool_or("first").alias("first"),
                   F.min("broken").alias("broken"))
              .where(~F.col("first")))
    joined = joined.select(F.regexp_replace("record", "\r$", "").alias("record"),
                           F.coalesce("broken", F.when(~F.col("closed"), F.lit("quote is not closed"))).alias("broken"))
    return whole.unionByName(joined)


def _too_long(max_record: int) -> str:
    return f"record is longer than {max_record} bytes"


def _cut_records(max_record: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the lines of byte ranges, which come in order, into records. ``piece`` is NULL for a
    record that lies in its range, 0 for the end (or a middle part) of one that an earlier range
    began and 1 for the begin of one that a later range ends; ``closed`` tells if it ends here."""
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["file", "at", "piece", "record", "closed", "first", "broken"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.string()]

    def run(batches):
        key, inside, header = None, False, False
        pending: list[str] = []
        piece, size, broken = None, 0, None

        def border(closed: bool, number: int):
            return (*key, number, "\n".join(pending), closed, header, broken)

        for b in batches:
            out = []
            for s, e in _spans(b):
                now = (b["file"][s].as_py(), b["at"][s].as_py())
                if now != key:
                    if pending:
                        out.append(border(False, 1 if piece is None else 0))
                    key, inside, header = now, b["inside"][s].as_py(), now[1] == 0
                    pending, size, broken, piece = [], 0, None, (0 if inside else None)
                values = b["value"].slice(s, e - s)
                counts = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
                total = counts.cumsum() + int(inside)
                opens = (total - counts) % 2 == 0   # no quote is open before the line
                shuts = total % 2 == 0
                alone = opens & shuts
                plain = values.filter(pa.array(alone))
                if header and alone[0] and not pending:
                    plain, header = plain.slice(1), False
                plain = pc.replace_substring_regex(plain, "\r$", "")
                plain = plain.filter(pc.greater(pc.binary_length(plain), 0))
                if len(plain):
                    n = len(plain)
                    yield pa.record_batch([pa.array([None] * n, t) if c != "record" else plain
                                           for c, t in zip(names, types)], names)
                for i in (~alone).nonzero()[0].tolist():
                    line = values[i].as_py()
                    if not broken and size + len(line) > max_record:
                        broken = _too_long(max_record)
                        pending = ["\n".join(pending)[:200]]
                    if not broken:
                        pending.append(line)
                        size += len(line)
                    if shuts[i]:
                        if piece is not None:
                            out.append(border(True, 0))
                        elif not header:
                            out.append((None, None, None, "\n".join(pending).removesuffix("\r"), None, None, broken))
                        pending, size, broken, piece, header = [], 0, None, None, False
                inside = bool(total[-1] % 2)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        if pending:
            yield pa.record_batch([pa.array([v], t) for v, t in zip(border(False, 1 if piece is None else 0), types)], names)

    return run


def _spans(b: pa.RecordBatch) -> list[tuple[int, int]]:
    """The rows of each byte range in a batch."""
    import pyarrow.compute as pc

    if all(len(pc.unique(b[c])) <= 1 for c in ("file", "at")):
        return [(0, b.num_rows)] if b.num_rows else []
    keys = list(zip(b["file"].to_pylist(), b["at"].to_pylist()))
    starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
    return list(zip(starts, [*starts[1:], len(keys)]))


def read_csv_parse_dates(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Timestamps parsed during the scan (TIMESTAMP_NTZ in the declared schema)."""
    return read_csv(spark, path, schemas.RAW_SCHEMAS[table], multiline=table in schemas.FREE_TEXT_TABLES)


def read_csv_checked(spark: SparkSession, path: str, table: str) -> DataFrame:
    """As ``read_csv_parse_dates`` with the column ``_malformed``: the text of a row that does
    not fit the declared columns, NULL for a good one."""
    return read_csv(spark, path, schemas.RAW_SCHEMAS[table], multiline=table in schemas.FREE_TEXT_TABLES, malformed=True)


def read_csv_raw_strings(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every column read as text; the declared types are applied afterwards with ``try_cast``
    (a malformed value becomes NULL instead of failing the job)."""
    declared = schemas.RAW_SCHEMAS[table]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields])
    raw = read_csv(spark, path, as_text, multiline=table in schemas.FREE_TEXT_TABLES)
    return raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared.fields])


def read_csv_catalog(spark: SparkSession, folder: str,
                     catalog: Sequence[tuple[str, str, str, str]] = schemas.CSV_CATALOG) -> dict[str, DataFrame]:
    """Every catalog entry present in ``folder`` as a DataFrame (missing files are skipped)."""
    out = {}
    for _label, fname, table, _cat in catalog:
        path = f"{folder.rstrip('/')}/{fname}"
        if path_exists(spark, path):
            out[table] = read_csv_parse_dates(spark, path, table)
    return out


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema)


# ---------------------------------------------------------------- S7, S8, S13
def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_sources(tables: dict[str, DataFrame], prefix: str = "raw_") -> list[str]:
    """Declared sources addressed by name: one temp view per entry."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def catalog_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """Tables and views visible in the session catalog, as a DataFrame."""
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'")


# ---------------------------------------------------------------- S10
WEATHER_COLUMNS = ("time", "temp_c", "feelslike_c", "humidity", "pressure_mb", "wind_kph", "wind_degree",
                   "wind_dir", "cloud", "precip_mm", "vis_km", "uv", "is_day", "condition_text",
                   "condition_code", "chance_of_rain", "will_it_rain")


def read_weather_hourly(spark: SparkSession, path: str) -> DataFrame:
    """``forecast.forecastday[0].hour[]`` flattened to 17 columns; ``time`` parsed."""
    docs = spark.read.schema(schemas.WEATHER_DOC).json(path)
    h = docs.select(F.explode(F.col("forecast.forecastday")[0]["hour"]).alias("h"))
    cols = [F.to_timestamp_ntz(F.col("h.time"), F.lit("yyyy-MM-dd HH:mm")).alias("time")]
    for c in WEATHER_COLUMNS[1:]:
        if c == "condition_text":
            cols.append(F.col("h.condition.text").alias(c))
        elif c == "condition_code":
            cols.append(F.col("h.condition.code").alias(c))
        else:
            cols.append(F.col(f"h.{c}").alias(c))
    return h.select(*cols)


# ---------------------------------------------------------------- S11
FORECAST_VARIABLES = ("temperature_2m", "rain", "relative_humidity_2m", "weather_code")


def read_forecast_arrays(spark: SparkSession, path: str, zone: str = "Asia/Bangkok") -> DataFrame:
    """Parallel hourly arrays over ``[time, time_end)`` step ``interval`` -> one row per step,
    with the step time converted from UTC to ``zone`` (a real parameter)."""
    docs = spark.read.schema(schemas.FORECAST_DOC).json(path)
    steps = F.when(F.col("time_end") > F.col("time"),
                   F.sequence(F.col("time"), F.col("time_end") - F.col("interval"), F.col("interval"))) \
        .otherwise(F.array().cast("array<bigint>"))
    zipped = F.arrays_zip(steps.alias("t"), *[F.col(v).alias(v) for v in FORECAST_VARIABLES])
    # arrays_zip pads the shorter arrays with NULLs; steps beyond the time axis are dropped.
    rows = docs.select("station", F.inline(zipped)).where(F.col("t").isNotNull())
    return rows.select("station", epoch_to_local(F.col("t"), zone).alias("date"), *FORECAST_VARIABLES)


# ---------------------------------------------------------------- S9
def literal_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """In-memory rows (dicts); a missing field becomes NULL. For small literal inputs only
    (tests, parameters): anything data-sized is read from storage instead."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
