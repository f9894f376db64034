"""Tab-separated sources and their lenient and strict readers."""

from __future__ import annotations

import hashlib
import os
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import ids

_DIALECT = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}


def _read(spark: SparkSession, path: str, schema, strict: bool) -> DataFrame:
    """enforceSchema off makes a wrong header an error; strict refuses short and long rows, else they are padded or cut."""
    reader = spark.read.schema(schema).options(**_DIALECT, enforceSchema=False, mode="FAILFAST" if strict else "PERMISSIVE")
    return reader.csv(path)


def check_utf8(spark: SparkSession, path: str) -> None:
    """Raises ValueError on the first invalid line; Spark's readers would replace it silently."""
    bad = spark.read.text(path).filter(~F.is_valid_utf8("value")).limit(1).count()
    if bad:
        raise ValueError(f"not UTF-8: {path}")


def read_source(spark: SparkSession, path: str, prefix: str, strict: bool = False) -> DataFrame:
    """Records in file order; empty cells are empty texts; an id of another source stops the job."""
    raw = _read(spark, path, schemas.SOURCE, strict)
    cells = {c: F.coalesce(c, F.lit("")) for c in raw.columns}
    cells["entity_id"] = ids.require_id(F.coalesce("entity_id", F.lit("")), prefix.strip("S-"))
    return raw.withColumns(cells).withColumn("row_ord", F.monotonically_increasing_id())


def _links(column) -> F.Column:
    return F.filter(F.split(F.coalesce(column, F.lit("")), ","), lambda x: x != "")


def read_truth(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Links of each S1 record; a wrong prefix or a repeated id stops the job."""
    schema = schemas._struct(("source1_entity_id", schemas._S), ("matched_entity_ids", schemas._S))
    rows = _read(spark, path, schema, strict).select(ids.require_id(F.col("source1_entity_id"), "1").alias("source1_entity_id"), _links(F.col("matched_entity_ids")).alias("matched_entity_ids"))
    good = ids.valid_ids(F.col("matched_entity_ids"))
    checked = F.when(good, F.col("matched_entity_ids")).otherwise(F.raise_error(F.concat(F.lit("bad links of "), F.col("source1_entity_id"))))
    return rows.withColumn("matched_entity_ids", checked)


def read_links_lenient(spark: SparkSession, path: str) -> DataFrame:
    """Any two-column file of ids: no check of the header's names, ids trimmed, empty ones dropped, repeats once."""
    lines = _numbered(spark, path).filter("line > 1").filter(F.trim("value") != "")
    parts = F.split("value", "\t", 2)
    listed = F.filter(F.transform(F.split(F.coalesce(F.get(parts, 1), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return lines.select(F.trim(parts[0]).alias("source1_entity_id"), F.array_distinct(listed).alias("matched_entity_ids")).filter("source1_entity_id <> ''")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their numbers from 1, in file order; the byte order mark goes.

    A file is read in its blocks, in parallel.  Within a block ids rise with the lines; the lines before a block are a running sum
    over one row for each block.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    blocks = lines.groupBy("block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.join(blocks.withColumn("before", before), "block").select((F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")
    return numbered.withColumn("value", F.when(F.col("line") == 1, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")))


def parse_output(spark: SparkSession, path: str) -> DataFrame:
    """(line, value, utf8, columns, s1, ids) of each line that is not empty, the header too.

    Empty items of a list are kept, so that ``a,,b`` shows as a bad id.  Lines are malformed, and s1 is null, unless they have two
    columns and an S1 id; the header's s1 is null too.
    """
    lines = _numbered(spark, path).filter((F.col("line") == 1) | (F.col("value") != ""))
    body = lines.withColumn("utf8", F.is_valid_utf8("value")).withColumn("p", F.split("value", "\t")).withColumn("columns", F.size("p"))
    good = (F.col("line") > 1) & (F.col("columns") == 2) & (F.trim(F.col("p")[0]) != "")
    listed = F.when(F.trim(F.col("p")[1]) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(F.col("p")[1], ","), lambda x: F.trim(x)))
    # a good line's text is not needed again
    kept = F.when(~good | ~F.col("utf8"), F.col("value"))
    return body.select("line", kept.alias("value"), "utf8", "columns", F.when(good, F.trim(F.col("p")[0])).alias("s1"), F.when(good, listed).alias("ids"))


def read_output_strict(spark: SparkSession, path: str) -> tuple[list[str], DataFrame, DataFrame]:
    """(header in lower case, rows with ordered ids and line numbers, malformed lines) of parse_output."""
    lines = parse_output(spark, path)
    head = lines.filter("line = 1").first()
    header = [h.strip().lower() for h in head["value"].split("\t")] if head else []
    return header, lines.filter("s1 is not null").select("line", "s1", "ids"), lines.filter("line > 1 and s1 is null").select("line", "value")


def last_rows(rows: DataFrame) -> DataFrame:
    """One row of each S1 id, the last in the file."""
    return rows.groupBy("s1").agg(F.max_by("ids", "line").alias("ids"))


def read_s1_ids(spark: SparkSession, path: str) -> DataFrame:
    first = F.trim(F.substring_index("value", "\t", 1))
    return _numbered(spark, path).filter("line > 1").select("line", first.alias("s1")).filter("s1 <> ''")


def fingerprint(path: str, chunk: int = 1 << 20) -> str:
    """SHA-256 of a file, or of a folder's relative paths and files in order."""
    digest = hashlib.sha256()
    files = [Path(path)] if os.path.isfile(path) else sorted(p for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith((".", "_SUCCESS")))
    for f in files:
        if f != Path(path):
            digest.update(str(f.relative_to(path)).encode())
        with open(f, "rb") as stream:
            while part := stream.read(chunk):
                digest.update(part)
    return digest.hexdigest()


def extract_archive(archive: str, destination: str, allowed: tuple[str, ...], sha256: str | None = None, force: bool = False) -> list[str]:
    """Unpacks the allowed files of a pinned archive; paths that leave the folder and wrong sizes are refused."""
    if sha256 and fingerprint(archive) != sha256:
        raise ValueError("the archive is not the pinned one")
    out, root = [], Path(destination).resolve()
    with zipfile.ZipFile(archive) as z:
        for info in z.infolist():
            if info.is_dir() or os.path.basename(info.filename) not in allowed:
                continue
            target = (root / info.filename).resolve()
            if root not in target.parents:
                raise ValueError(f"{info.filename} leaves the folder")
            if target.exists() and not force:
                raise FileExistsError(target)
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_suffix(target.suffix + ".part")
            with z.open(info) as source, open(part, "wb") as sink:
                while chunk := source.read(1 << 20):
                    sink.write(chunk)
            if part.stat().st_size != info.file_size:
                raise ValueError(f"{info.filename} has the wrong size")
            os.replace(part, target)
            out.append(str(target))
    return out


def find_archive(name: str, start: str = ".", levels: int = 3) -> str | None:
    """The archive in the folder start or in one of the folders above it."""
    folder = Path(start).resolve()
    for where in [folder, *folder.parents[:levels]]:
        if (where / name).is_file():
            return str(where / name)
    return None
