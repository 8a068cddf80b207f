"""Tables on disk: versioned Parquet, CSV with byte-order mark, bucketed merges, JSON reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine.operators.ordering import ARRIVAL, keep_last, upsert
from corpus_engine.session import scratch_path

FORMATS = ("parquet", "csv")
BOM = "\ufeff"
BUCKET = "_bucket"
COMPLETE = "_complete"
DEFAULT_BUCKETS = 64
CSV_ROWS = 20_000  # in a file
SCRATCH_CODEC = "zstd"  # of tables that only the same job reads


def _fs_path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs_path(spark, path)
    return fs.exists(hadoop)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the job's own with all it holds."""
    fs, folder = _fs_path(spark, path)
    fs.delete(folder, True)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, str, bool]]:
    """Number, label, folder and completeness of every version below ``path``, by number."""
    if not exists(spark, path):
        return []
    fs, hadoop = _fs_path(spark, path)
    found = []
    for status in fs.listStatus(hadoop):
        number, dash, label = status.getPath().getName().removeprefix("version=").partition("-")
        if dash and number.isdigit():
            folder = status.getPath().toString()
            found.append((int(number), label, folder, exists(spark, f"{folder}/{COMPLETE}")))
    return sorted(found)


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The completely written version folder below ``path`` with the highest number."""
    complete = [folder for _, _, folder, done in _versions(spark, path) if done]
    return complete[-1] if complete else None


def _new_version(spark: SparkSession, path: str, label: str) -> str:
    """The folder of the next version; a label that is already complete is refused."""
    versions = _versions(spark, path)
    if label in (known for _, known, _, done in versions if done):
        raise ValueError(f"version {label!r} of {path} is already written")
    number = 1 + max((n for n, *_ in versions), default=0)
    return f"{path}/version={number:09d}-{label}"


def _completed(spark: SparkSession, folder: str) -> None:
    """Marks a version as complete, with a file of our own: not every committer leaves one."""
    fs, mark = _fs_path(spark, f"{folder}/{COMPLETE}")
    fs.create(mark, True).close()


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes all but the newest ``keep`` complete versions, and what was never completed before them."""
    dropped = 0
    for kind in FORMATS:
        versions = _versions(spark, f"{path}.{kind}")
        kept = [n for n, _, _, done in versions if done][-keep:]
        for number, _, folder, _ in versions:
            if kept and number < kept[0]:
                fs, hadoop = _fs_path(spark, folder)
                dropped += bool(fs.delete(hadoop, True))
    return dropped


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, merged: bool = False
) -> DataFrame:
    """The table's newest Parquet version, else its newest CSV version, else an empty table.

    ``merged`` tables are kept by :func:`merge_into_table` in one bucketed folder.
    """
    if merged:
        if exists(spark, f"{path}.merged"):
            return spark.read.parquet(f"{path}.merged").drop(BUCKET)
        return spark.createDataFrame([], schema)
    parquet = newest_version(spark, f"{path}.parquet")
    if parquet:
        return spark.read.parquet(parquet)
    csv = newest_version(spark, f"{path}.csv")
    if csv:
        return read_csv(spark, csv, schema)
    return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame, path: str, version: str, formats: Iterable[str] = ("parquet",)
) -> None:
    """Writes a new version in every format; older versions stay, readers switch when it is complete.

    Versions are numbered in the order of writing; ``version`` is a label, and one that exists is refused. Parquet keeps arrays and maps; further
    formats are written from the finished Parquet version, so the plan runs once.
    """
    wanted = [f.lower() for f in formats]
    unknown = set(wanted) - set(FORMATS)
    if unknown:
        raise ValueError(f"unknown formats: {sorted(unknown)}")
    spark = df.sparkSession
    if "parquet" in wanted:
        target = _new_version(spark, f"{path}.parquet", version)
        df.write.parquet(target)
        _completed(spark, target)
        df = spark.read.schema(df.schema).parquet(target)
    if "csv" in wanted:
        target = _new_version(spark, f"{path}.csv", version)
        write_csv(df, target, with_order="parquet" not in wanted)
        _completed(spark, target)


def merge_into_table(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str] = ARRIVAL,
    buckets: int | None = None,
) -> None:
    """Upserts into a bucketed table and rewrites only the buckets that receive rows.

    The number of buckets is kept with the table; a later call with another number is refused.

    The merged buckets are staged in the shared folder first, so what is overwritten is never what
    is being read. A note names the staged buckets until they are in place: should the driver die in
    between, the next merge first puts them in place again.
    """
    spark = new.sparkSession
    target = f"{path}.merged"
    _finish_merge(spark, path)
    buckets = _bucket_count(spark, path, buckets)
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
    arriving = staged(new.withColumn(BUCKET, bucket), "arriving")
    if exists(spark, target):
        touched = [r[0] for r in arriving.select(BUCKET).distinct().collect()]  # at most `buckets` ints
        current = spark.read.parquet(target).where(F.col(BUCKET).isin(touched))
        merged = upsert(current, arriving, [BUCKET, *keys], order_by)
    else:
        merged = keep_last(arriving, [BUCKET, *keys], order_by)
    aside = scratch_path(spark, "merged")
    merged.write.parquet(aside)
    _note(spark, f"{path}.pending", aside)
    _finish_merge(spark, path)


def _note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written aside, then renamed."""
    fs, aside = _fs_path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.writeUTF(text)
    out.close()
    if not fs.rename(aside, _fs_path(spark, path)[1]):
        raise OSError(f"cannot put {path} in place")


def _noted(spark: SparkSession, path: str) -> str | None:
    fs, note = _fs_path(spark, path)
    if not fs.exists(note):
        return None
    source = fs.open(note)
    text = source.readUTF()
    source.close()
    return text


def _bucket_count(spark: SparkSession, path: str, asked: int | None) -> int:
    stored = _noted(spark, f"{path}.buckets")
    if stored is None:
        _note(spark, f"{path}.buckets", str(asked or DEFAULT_BUCKETS))
        return asked or DEFAULT_BUCKETS
    if asked not in (None, int(stored)):
        raise ValueError(f"{path} has {stored} buckets, not {asked}")
    return int(stored)


def _finish_merge(spark: SparkSession, path: str) -> None:
    """Puts noted buckets in place; doing so twice changes nothing."""
    aside = _noted(spark, f"{path}.pending")
    if aside is None:
        return
    fs, note = _fs_path(spark, f"{path}.pending")
    (
        spark.read.parquet(aside).hint("rebalance", BUCKET)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET).parquet(f"{path}.merged")
    )
    fs.delete(note, False)


def append_batch(df: DataFrame, path: str, batch: int, rows: int | None = None) -> None:
    """One batch of an append-only table; a batch that is repeated takes its own place again. One of other than ``rows`` rows is refused."""
    spark, folder = df.sparkSession, f"{path}/batch={batch:09d}"
    df.write.mode("overwrite").option("compression", SCRATCH_CODEC).parquet(folder)
    if rows is not None and (written := spark.read.schema(df.schema).parquet(folder).count()) != rows:
        raise ValueError(f"{folder} has {written} rows, not {rows}")
    _completed(spark, folder)


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """All complete batches of an append-only table; None before the first one."""
    if not exists(spark, path):
        return None
    fs, hadoop = _fs_path(spark, path)
    folders = [s.getPath().toString() for s in fs.listStatus(hadoop) if s.getPath().getName().startswith("batch=")]
    complete = sorted(f for f in folders if exists(spark, f"{f}/{COMPLETE}"))
    return spark.read.parquet(*complete) if complete else None


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame as a finished table in the shared folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- CSV ------------------------------------------------------------------------------------


def json_cell(value: Column, dtype: T.DataType) -> Column:
    """JSON text with sorted keys, a blank after ``,`` and ``:``, and characters kept as they are."""
    null = F.lit("null")
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda v: json_cell(v, dtype.elementType))
        return F.when(value.isNotNull(), F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]")))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.array_sort(F.map_keys(value)),
            lambda k: F.concat(
                json_cell(k, dtype.keyType), F.lit(": "),
                F.coalesce(json_cell(F.element_at(value, k), dtype.valueType), null)))
        return F.when(value.isNotNull(), F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")))
    if isinstance(dtype, T.StructType):
        members = [
            F.concat(F.lit(f'"{f.name}": '), F.coalesce(json_cell(value[f.name], f.dataType), null))
            for f in sorted(dtype.fields, key=lambda f: f.name)
        ]
        return F.when(
            value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}")))
    quoted = F.to_json(F.array(value))
    return F.coalesce(F.substring(quoted, F.lit(2), F.length(quoted) - 2), null)


def _nested(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))


def write_csv(df: DataFrame, path: str, with_order: bool = False) -> None:
    """CSV with header and byte-order mark; nested cells as JSON text; ``_`` columns left out.

    ``with_order`` keeps those, as the last columns: a table that exists as CSV only must still know its arrival order.
    Cells may hold line ends, so a file is read by one task, and holds ``CSV_ROWS`` rows at most.
    """
    hidden = [f for f in df.schema.fields if f.name.startswith("_")]
    kept = [f for f in df.schema.fields if f not in hidden] + hidden * with_order
    flat = df.select([
        json_cell(F.col(f.name), f.dataType).alias(f.name) if _nested(f) else F.col(f.name)
        for f in kept
    ])
    first = kept[0].name
    flat.withColumnRenamed(first, BOM + first).write.mode("overwrite").option("maxRecordsPerFile", CSV_ROWS).option("header", True).option(
        "escape", '"').option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV as :func:`write_csv` leaves it, back to the declared types.

    Empty cells are nulls, as nothing in the file tells them from empty texts.
    """
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if _nested(f) else f.dataType) for f in schema.fields])
    raw = spark.read.schema(text_schema).csv(
        path, header=True, multiLine=True, escape='"', enforceSchema=True)
    return raw.select([
        F.from_json(F.col(f.name), f.dataType).alias(f.name) if _nested(f) else F.col(f.name)
        for f in schema.fields
    ])


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
