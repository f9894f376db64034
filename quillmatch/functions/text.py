"""Normalisation and token functions.

Spark has neither NFKC nor case folding, so these run in one Arrow function;
all else is built in.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "1"


@F.pandas_udf(T.StringType())
def fold(values: pd.Series) -> pd.Series:
    """NFKC, then case folding; null stays null."""
    return values.map(lambda x: x if x is None else x.lower() if x.isascii() else unicodedata.normalize("NFKC", x).casefold())


def text_key(column: Column) -> Column:
    """Folded text, & as a word, letters, digits and marks kept, all else one space; null is empty."""
    folded = F.replace(fold(F.coalesce(column, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}\p{M}]+", " "))


def country_key(column: Column) -> Column:
    """Folded text with white space collapsed; punctuation stays."""
    return F.regexp_replace(F.regexp_replace(fold(F.coalesce(column, F.lit(""))), r"(?U)\s+", " "), "^ | $", "")


def tokens(key: Column) -> Column:
    """Words in order, repeats kept; an empty text has none."""
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.split(key, " "))


def normalize(records: DataFrame) -> DataFrame:
    """Raw records -> keys and tokens; row_ord is kept where there is one."""
    order = [F.col("row_ord")] if "row_ord" in records.columns else []
    keyed = records.select(
        "entity_id", text_key(F.col("business_name")).alias("name_norm"), text_key(F.col("business_address")).alias("address_norm"),
        country_key(F.col("country")).alias("country_key"), *order,
    )
    return keyed.withColumns({"name_tokens": tokens(F.col("name_norm")), "address_tokens": tokens(F.col("address_norm"))})


def trigrams(key: Column) -> Column:
    """Distinct windows of three characters of the key with a blank on either side; an empty key has none."""
    padded = F.concat(F.lit(" "), key, F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1))), lambda i: F.substr(padded, i, F.lit(3)))
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))
