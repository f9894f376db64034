"""Helpers that all operators of the subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import Scratch as Scratch

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is_one(column: str, modulus: int) -> Column:
    """crc32(column as text) mod modulus is 1; false for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == 1, F.lit(False))


def sample_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of the key; ties by the key and all other columns.

    Only about twice as many rows are looked at, by a bound on the hash, so that the last task of the choice gets few from each other task.
    """
    total, at = df.count(), F.xxhash64(key)
    if total > 4 * rows:
        df = df.filter(at < F.lit(-(1 << 63) + (1 << 64) * 2 * rows // total))
    return df.orderBy(at, key, *[c for c in df.columns if c != key]).limit(rows)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of df but for names; Spark compares names without case."""
    gone = {x.lower() for x in names}
    return [c for c in df.columns if c.lower() not in gone]


def join_hot(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, columns: list[str]) -> DataFrame:
    """rows with those columns of facts, which has each key of rows once and in ``weight`` how many rows have it.

    Facts of keys with over 100 and over a thousandth of all rows, fewer than a thousand by this bound, are broadcast, so no task gets
    all rows of a hot key; all others meet their rows in a shuffle."""
    least = max(100, (facts.agg(F.sum(weight)).first()[0] or 0) // 1000)
    hot = facts.filter(F.col(weight) > least).select(*keys, F.struct(*columns).alias("__hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    warm = marked.filter("__hot is null").drop("__hot").join(facts.filter(F.col(weight) <= least).select(*keys, *columns), keys)
    own = [F.col(c) for c in rows.columns]
    return marked.filter("__hot is not null").select(*own, "__hot.*").unionByName(warm.select(*own, *columns))


#: Kernels get slices of Arrow batches of about so many bytes, so that what they hold beside the batch stays small.
SLICE_BYTES = 4_000_000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices that are not empty."""
    for whole in batches:
        rows = max(1, whole.num_rows * SLICE_BYTES // max(1, whole.nbytes))
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


Kernel = Callable[[pa.RecordBatch], list]


def append_columns(df: DataFrame, kernel: Callable[[], Kernel], inputs: list[Column], outputs: str, keep: list[str]) -> DataFrame:
    """Appends columns that a Python kernel computes from Arrow batches.

    ``kernel`` is called once per partition and returns a function that maps a
    batch of the ``inputs`` (in order) to one Arrow array per column of the DDL
    ``outputs``.  ``keep`` names the columns of df that the result carries; one
    that clashes with an output is replaced by it.
    """
    added = T._parse_datatype_string(outputs)
    assert isinstance(added, T.StructType)
    kept = [c for c in keep if c.lower() not in {f.name.lower() for f in added}]
    fields = [f for c in kept for f in df.schema.fields if f.name == c]
    schema = T.StructType([*fields, *added.fields])
    n = len(inputs)
    source = df.select(*[x.alias(f"__in{i}") for i, x in enumerate(inputs)], *[F.col(f"`{c}`") for c in kept])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = kernel()
        for batch in slices(batches):
            new = work(batch)
            columns = [*batch.columns[n:], *new]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) and c.type != f.type else pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def texts(array: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


def as_bytes(column: str) -> Column:
    return F.col(column).cast("string").cast("binary")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; QUILLMATCH_TOKENIZERS overrides the folder."""
    folder = os.environ.get("QUILLMATCH_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))
