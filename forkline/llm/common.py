"""What the training-data operators share: the shared folder, Arrow passes and the word rule."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import own_folder

#: Rows that become Python objects at once; texts can be long, so this stays small.
SLICE_ROWS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a session on one machine names none, as in tests, a temporary folder is set as checkpoint
    folder, so that it is named from then on; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        existing = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = existing.get() if existing.isDefined() else None
    if not found:
        found = own_folder(spark)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Intermediate tables, written to the shared folder so that a lost executor loses none of them.

    Results are lazy and may read them, so they stay until clear() is called, when no result is needed any more.
    """

    roots: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/forkline-{what}-{uuid.uuid4().hex}"
        Scratch.roots.append(self)

    @classmethod
    def clear(cls) -> None:
        """Delete all tables that this process has written."""
        for scratch in cls.roots:
            scratch.drop("")
        cls.roots.clear()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and return what was written, without df's lineage."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no returned DataFrame reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name).rstrip("/"))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def few_parts(spark: SparkSession, least: int = 32) -> int:
    """Partitions that keep every core busy several times over: `least`, or four a core where that is more."""
    return max(least, 4 * spark.sparkContext.defaultParallelism)


def few(df: DataFrame, least: int = 32) -> DataFrame:
    """All rows of df in at most few_parts() partitions, without a shuffle, so that many small ones aren't a file each."""
    return df.coalesce(few_parts(df.sparkSession, least))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own that no column of df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def add_columns(df: DataFrame, text_col: str, fields: list[T.StructField], make: Callable[[], Callable[[list], list[list]]]) -> DataFrame:
    """Append columns computed from one column, in one Arrow pass that keeps all others; one that has the name of a new one is replaced.

    make() runs once per task and returns f(values) -> one list per field. Slices bound the number
    of Python objects alive at once.
    """
    new = {f.name.lower() for f in fields}
    kept = [k for k, c in enumerate(df.columns) if c.lower() not in new]
    out = T.StructType([*(df.schema.fields[k] for k in kept), *fields])
    at, arrow = df.columns.index(text_col), to_arrow_schema(T.StructType(fields))
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                made = f(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), *(pa.array(v, t.type) for v, t in zip(made, arrow, strict=True))], names=names)

    return df.mapInArrow(run, out)


def flat_map(df: DataFrame, schema: T.StructType, make: Callable[[], Callable[[pa.RecordBatch], dict | None]]) -> DataFrame:
    """One Arrow pass from slices of df to any number of rows; make() runs once per task."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                got = f(batch.slice(lo, SLICE_ROWS))
                if got is not None:
                    yield pa.RecordBatch.from_arrays([got[x.name].cast(x.type) if isinstance(got[x.name], pa.Array) else pa.array(got[x.name], x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, as UTF-8; bytes methods know ASCII alone, as the rule does."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def remainder(column: str, mod: int):
    """crc32 of a column's text, mod `mod` (null: the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
