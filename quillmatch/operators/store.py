"""The index on disk: Parquet tables, a manifest, and the checks that guard its use."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..config import RetrievalConfig
from ..functions import ids, text
from ..sources.files import Files
from .retrieval import Index, build

VERSION = "1"


@dataclass
class Manifest:
    folder: str
    sources: dict[str, dict]
    split: str
    config: dict
    total: int
    rows: dict[str, int]
    index_version: str = VERSION
    normalization_version: str = text.VERSION
    engine_version: str = __version__
    made_at: str = field(default_factory=lambda: time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        values = json.loads(Files(spark).read(path))
        known = cls.__dataclass_fields__
        return cls(**{k: v for k, v in values.items() if k in known})


def one_split(*paths: str, wanted: str | None = None) -> str:
    """The split that all paths are of; unspecified ones agree with any.  Raises ValueError if they differ from one another or from wanted."""
    found = {ids.detect_split(p) for p in paths} - {"unspecified"}
    if len(found) > 1:
        raise ValueError(f"sources of different splits: {sorted(found)}")
    split = found.pop() if found else "unspecified"
    if wanted not in (None, "unspecified", split) and split != "unspecified":
        raise ValueError(f"split {split}, not {wanted}")
    return wanted if split == "unspecified" and wanted else split


def require_distinct(records: DataFrame) -> None:
    """Raises ValueError at an entity id that occurs twice."""
    twice = records.groupBy("entity_id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated entity ids: {sorted(r[0] for r in twice)}")


def write(records: DataFrame, folder: str, paths: dict[str, str], config: RetrievalConfig = RetrievalConfig()) -> Manifest:
    """Normalises records and writes the tables to a new folder under ``folder``; the manifest is written last."""
    split = one_split(*paths.values(), wanted=config.split)
    require_distinct(records)
    spark, where = records.sparkSession, f"{folder.rstrip('/')}/index-{uuid.uuid4().hex[:12]}"
    text.normalize(records).write.parquet(f"{where}/records")
    index = build(spark.read.parquet(f"{where}/records"))
    for name in Index.TABLES[1:]:
        getattr(index, name).write.parquet(f"{where}/{name}")
    rows = {name: spark.read.parquet(f"{where}/{name}").count() for name in Index.TABLES}
    files = Files(spark)
    known = {k: {"path": p, "size": files.size(p), "sha256": files.fingerprint(p)} for k, p in paths.items()}
    manifest = Manifest(where, known, split, config.to_dict(), index.size(), rows)
    files.write(f"{folder.rstrip('/')}/manifest.json", json.dumps(asdict(manifest), indent=1, sort_keys=True).encode())
    return manifest


def open_index(spark: SparkSession, manifest: Manifest | str, split: str | None = None) -> Index:
    """The index, if its versions, split, sources and tables are what the manifest says; else ValueError or FileNotFoundError."""
    m = Manifest.read(spark, manifest) if isinstance(manifest, str) else manifest
    if m.index_version != VERSION or m.normalization_version != text.VERSION:
        raise ValueError("the index is of another version")
    if split is not None and split != m.split:
        raise ValueError(f"the index is of split {m.split}, not {split}")
    files = Files(spark)
    for name, s in m.sources.items():
        if not files.exists(s["path"]):
            raise FileNotFoundError(s["path"])
        if files.size(s["path"]) != s["size"] or files.fingerprint(s["path"]) != s["sha256"]:
            raise ValueError(f"{name} changed after the index was built")
    tables = {name: spark.read.parquet(f"{m.folder}/{name}") for name in Index.TABLES}
    for name, df in tables.items():
        if df.count() != m.rows[name]:
            raise ValueError(f"table {name} does not have the manifest's rows")
    return Index(**tables, total=m.total)


def document_frequency(index: Index, tokens: DataFrame) -> DataFrame:
    """tokens(token) with their df, 0 where unknown."""
    return tokens.join(index.frequency, "token", "left").withColumn("df", F.coalesce("df", F.lit(0)))
