"""Schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SOURCE = _struct(("entity_id", _S), ("business_name", _S), ("business_address", _S), ("country", _S))
RECORD = T.StructType([*SOURCE.fields, T.StructField("row_ord", _L)])
LINKS = _struct(("source1_entity_id", _S), ("matched_entity_ids", T.ArrayType(_S)))
NORMALIZED = _struct(
    ("entity_id", _S), ("name_norm", _S), ("address_norm", _S), ("country_key", _S),
    ("name_tokens", T.ArrayType(_S)), ("address_tokens", T.ArrayType(_S)), ("row_ord", _L),
)
HITS = _struct(("s1", _S), ("cand", _S), ("route", _S), ("score", _D))
FINDING = _struct(("s1_id", _S), ("problem_type", _S), ("invalid_ids", T.ArrayType(_S)), ("context", _S))

#: Headers of the interchange files.
SOURCE_HEADER = tuple(SOURCE.names)
MATCH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
