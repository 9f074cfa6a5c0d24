"""What the operators of this package share: shared scratch tables, bounded row filters, batches."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the fixed-size key filter: 262,144 rows of 64 bits at most, whatever the input's size.
FILTER_BITS = 1 << 24
#: Parts that each key of the small side of a salted join is copied to.
SALT = 16

#: Bytes of text that one vectorised step holds at a time.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session (one machine) gets a folder of our own; a cluster has no folder that
    its machines surely share, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is unset: it names the folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "tarn-scratch")
    return found.rstrip("/")


class Scratch:
    """Tables of one query in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables nothing reads any more, and let Spark delete the shuffle files of finished queries."""
        for name in names:
            self._delete(self.path(name))
        self.release()

    def clear(self) -> None:
        """Delete everything of this query."""
        self._delete(self.root)
        self.release()

    def release(self) -> None:
        """Spark deletes a shuffle's files once the driver's heap no longer holds it, so both heaps are swept."""
        gc.collect()
        self.spark._jvm.System.gc()

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_mark(rows: DataFrame, row_key, keys: DataFrame, key, name: str = "_tarn_may") -> DataFrame:
    """``rows`` with ``name``: whether the key may be among ``keys``.  False is sure, true is likely.

    A bitmap of FILTER_BITS bits is all that is broadcast, so its size has a bound that does not
    depend on the data.  An exact join of the likely rows follows in the caller; this spares the others'
    shuffle.  With very many keys the bitmap fills up and all rows are joined: slower, not wrong.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = (
        keys.select(bit(key).alias("_tarn_bit"))
        .groupBy((F.col("_tarn_bit") / 64).cast("int").alias("_tarn_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_tarn_bit % 64 as int))")).alias("_tarn_bits"))
    )
    marked = rows.withColumn("_tarn_at", bit(row_key)).withColumn("_tarn_word", (F.col("_tarn_at") / 64).cast("int"))
    hit = F.coalesce(F.col("_tarn_bits").bitwiseAND(F.expr("shiftleft(1L, cast(_tarn_at % 64 as int))")) != 0, F.lit(False))
    return marked.join(F.broadcast(words), "_tarn_word", "left").withColumn(name, hit).drop("_tarn_word", "_tarn_at", "_tarn_bits")


def key_filter(rows: DataFrame, row_key, keys: DataFrame, key) -> DataFrame:
    """The rows whose key may be among ``keys``: every true member stays, few others do (see ``key_mark``)."""
    return key_mark(rows, row_key, keys, key).where("_tarn_may").drop("_tarn_may")


def salted(small: DataFrame) -> DataFrame:
    """The small side of a salted join: a copy of each row for each ``_salt``; the other side takes one by
    ``salt_of``, so a hot key's rows are spread over SALT parts whatever their number."""
    return small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def salt_of(column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALT)).cast("int")


class Texts:
    """Texts of a column, converted only where they are asked for; null is empty."""

    def __init__(self, column: pa.Array, kind: pa.DataType) -> None:
        self.column, self.kind, self.empty = column, kind, b"" if kind == pa.binary() else ""
        self.sizes = pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_pylist()

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, at):
        if isinstance(at, slice):
            return [self.empty if x is None else x for x in self.column[at].cast(self.kind).to_pylist()]
        return self[at : at + 1][0]


def slices(batch: pa.RecordBatch, texts: Texts, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes (one row at least): bounded memory however long texts are."""
    at = held = 0
    for i, n in enumerate(texts.sizes):
        if held and held + n > most:
            yield at, i
            at, held = i, 0
        held += n + 1
    if at < len(texts):
        yield at, len(texts)


def as_bytes(column: pa.Array) -> Texts:
    """UTF-8 of each text."""
    return Texts(column, pa.binary())


def as_text(column: pa.Array) -> Texts:
    return Texts(column, pa.string())


def record(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
