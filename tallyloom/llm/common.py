"""What the text operators share: tables, the shared folder, Arrow access, skew-safe lookups."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: bytes.translate table that lower-cases A-Z and nothing else; safe on UTF-8.
LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset in local mode (tests)."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        got = "file://" + tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


_MADE: list[str] = []  #: folders of intermediate tables, as they are made


def shared_path(spark: SparkSession, label: str) -> str:
    _MADE.append(f"{shared_dir(spark)}/tallyloom/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Removes at its end what was made inside, but for the paths put on the list; for results that are written by then."""
    start, keep = len(_MADE), []
    yield keep
    made = _MADE[start:]
    del _MADE[start:]
    remove(spark, [p for p in made if p not in keep])
    _MADE.extend(keep)


def materialize(df: DataFrame, label: str, keep: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back. Survives the loss of any executor. The path is added to keep."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    if keep is not None:
        keep.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


MEMO = 150_000  #: words whose hashes a worker keeps


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


#: 64-bit hashes of words, one table a worker for all operators.
HASHES = _Hashes()


def tidy(run):
    """A function over batches that gives freed memory back to the system at its end, so that a worker used again stays small."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal read
            for batch in batches:
                read += batch.nbytes
                yield batch

        yield from run(counted())
        if read > 1 << 20:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


def in_chunks(batches: Iterator[pa.RecordBatch], text: str | int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text each, so that work arrays stay small; one long text is a slice of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


HOT_KEYS = 1000  #: keys that a lookup deals to several tasks, at most


def skewed_lookup(left: DataFrame, right: DataFrame, key: str, weight: str, spread: Column, total: int | None = None) -> DataFrame:
    """Left join on `key` that no hot key slows: its rows are dealt to several tasks by `spread`, and copies of what it meets follow.

    `weight` is the number of rows that a key gives, and `total` that of all keys, by default the sum over `right`, which
    then must have one row a key. Keys with a thousandth of all rows or more, HOT_KEYS of them at most, are broadcast with a
    number each, whatever the size of their values. `right` should be a written table: it is read three times.
    """
    if total is None:
        total = right.agg(F.sum(weight)).first()[0] or 0
    cut = max(100, total // HOT_KEYS)
    values = [c for c in right.columns if c != key]
    copies = F.ceil(F.col(weight) / F.lit(cut)).cast("int")
    hot = right.filter(F.col(weight) >= cut).select(F.col(key).alias("_hot"), copies.alias("_copies")).distinct()
    dealt = F.xxhash64(spread, F.spark_partition_id())
    salt = F.when(F.col(key).isNull(), F.pmod(dealt, F.lit(1 << 20))).otherwise(F.coalesce(F.pmod(dealt, F.col("_copies")), F.lit(0)))
    out = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt)
    last = F.when(F.col(weight) >= cut, copies - 1).otherwise(0)
    found = right.select(F.col(key).alias("_key"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("_of"), *values)
    found = found.withColumnsRenamed({c: f"_v_{c}" for c in values})
    out = out.join(found, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_of")), "left")
    return out.select(*[F.col(c) for c in left.columns], *[F.col(f"_v_{c}").alias(c) for c in values])


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of `columns` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def one_row_each(df: DataFrame, key: str) -> DataFrame:
    """Of the rows with the same key, the one whose columns have the least hash; rows are thinned out before they are moved."""
    place = fresh("_place", df.columns)
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    return df.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col(place) == 1).drop(place)


def with_text_key(docs: DataFrame, key: str, of, ident: str, text: str) -> DataFrame:
    """docs and a string column `key`: of(text as bytes, position of the row) and the id; `of` gives None for a row of its own."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in in_chunks(batches, at):
            keys = []
            for ident, t in zip(batch.column(batch.num_columns - 1).to_pylist(), text_bytes(batch.column(at)), strict=True):
                got = of(t)
                keys.append(f"~{part}:{row}" if got is None else got if ident is None else f"{got}:{ident}")
                row += 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(keys, pa.string())], names=batch.schema.names)

    keyed = docs.withColumn(key, F.col(ident).cast("long").cast("string"))
    return keyed.mapInArrow(tidy(run), keyed.schema)
