"""Entity ids: predicates, guards, and the split by a hash of the id."""

from __future__ import annotations

import hashlib
import re
from pathlib import PurePath

from pyspark.sql import Column
from pyspark.sql import functions as F

ID = r"(?s)^S[123]-.+"
CANDIDATE_ID = r"(?s)^S[23]-.+"
#: The seed of the validation split; the tenth of residue 0 is held out.
SPLIT_SEED, SPLIT_FOLDS = "2026", 10


def is_id(column: Column, sources: str = "123") -> Column:
    return F.coalesce(column.rlike(rf"(?s)^S[{sources}]-.+"), F.lit(False))


def require_id(column: Column, sources: str = "123") -> Column:
    """The id itself; a bad one stops the job."""
    return F.when(is_id(column, sources), column).otherwise(F.raise_error(F.concat(F.lit("invalid entity id: "), F.coalesce(column, F.lit("null")))))


def are_unique(ids: Column) -> Column:
    return F.size(ids) == F.size(F.array_distinct(ids))


def valid_ids(ids: Column, sources: str = "23") -> Column:
    """Ids of the given sources without repetition."""
    return are_unique(ids) & F.forall(ids, lambda x: is_id(x, sources))


def valid_candidate(candidate: Column, routes: Column, scores: Column) -> Column:
    """An S2 or S3 id, routes that are sorted, distinct and not empty, and finite scores of some of these routes."""
    finite = F.forall(F.map_values(scores), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        is_id(candidate, "23") & (F.size(routes) > 0) & (F.array_sort(F.array_distinct(routes)) == routes)
        & (F.size(F.array_except(F.map_keys(scores), routes)) == 0) & finite
    )


def split_residue(column: Column) -> Column:
    """The first eight bytes of SHA-256 of seed and id, as an unsigned number, modulo the folds."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{SPLIT_SEED}|"), column), 256), 1, 16)
    return (F.conv(head, 16, 10).cast("decimal(20,0)") % SPLIT_FOLDS).cast("int")


def is_validation(column: Column) -> Column:
    return split_residue(require_id(column, "1")) == 0


def residue_of(entity_id: str) -> int:
    """split_residue of one id on the driver."""
    if not re.match(r"(?s)^S1-.+", entity_id):
        raise ValueError(f"not an S1 id: {entity_id}")
    return int.from_bytes(hashlib.sha256(f"{SPLIT_SEED}|{entity_id}".encode()).digest()[:8], "big") % SPLIT_FOLDS


def header_key(column: Column) -> Column:
    return F.lower(F.trim(column))


def detect_split(path: str) -> str:
    """train, test, fixture or unspecified, from a path.

    A fixture folder anywhere wins; then the nearest train or test folder; then the file's name.
    """
    parts = [p.lower() for p in PurePath(path).parts]
    folders, name = parts[:-1], PurePath(path).stem.lower()
    if {"fixture", "fixtures"} & set(folders):
        return "fixture"
    for folder in folders[::-1]:
        if folder in ("test", "train", "training"):
            return "test" if folder == "test" else "train"
    for split in ("test", "train"):
        if name == split or name.startswith(f"{split}_") or name.endswith(f"_{split}"):
            return split
    if "fixture" in name or parts[-1:] == ["fixtures"]:
        return "fixture"
    return "unspecified"
