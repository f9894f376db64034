"""Features of a pair of records, and the rule score."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "1.1"
# The order in which a model reads the features.
NAMES = (
    "name_exact", "name_token_jaccard", "name_token_containment", "name_char_ratio", "name_length_ratio", "name_prefix_ratio",
    "s1_name_missing", "candidate_name_missing", "address_exact", "address_token_jaccard", "address_token_containment",
    "address_char_ratio", "address_length_ratio", "s1_address_missing", "candidate_address_missing", "both_addresses_missing",
    "number_overlap_count", "number_jaccard", "number_any_agreement", "number_conflict", "is_source2", "is_source3",
    "retrieval_route_count",
)
CHAR_RATIOS = ("name_char_ratio", "address_char_ratio")


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def jaccard(a: Column, b: Column) -> Column:
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(empty, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return _share(F.size(F.array_intersect(a, b)), least)


def exact(a: Column, b: Column) -> Column:
    return _flag((a == b) & (a != ""))


def length_ratio(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b)))


def prefix_ratio(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    differs = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    first = F.array_position(differs, True)
    return F.when(n == 0, 0.0).otherwise(F.when(first == 0, 1.0).otherwise((first - 1) / n))


def numbers(name_tokens: Column, address_tokens: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", name_tokens, address_tokens), F.lit(r"(\p{Nd}+)")))


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for equal texts, 0 where one is empty; of pairs that repeat in a batch each is computed once."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b, strict=True):
        x, y = pair
        if x == y or not x or not y:
            out.append(float(x == y and x != ""))
            continue
        if pair not in known:
            known[pair] = SequenceMatcher(None, x, y, autojunk=False).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def char_ratio(a: Column, b: Column) -> Column:
    """The Ratcliff-Obershelp ratio of a to b, in this order."""
    return _ratio(a, b)


def char_ratios(pairs: DataFrame) -> DataFrame:
    """Appends the ratios of the names and of the addresses, the query's first: one pass, no shuffle."""
    ratio = lambda n: char_ratio(F.col(f"q_{n}_norm"), F.col(f"c_{n}_norm"))
    return pairs.withColumns({"name_char_ratio": ratio("name"), "address_char_ratio": ratio("address")})


def native(pairs: DataFrame) -> DataFrame:
    """Appends all features but the character ratios.

    pairs: s1, cand, n_routes and the normalised columns of both sides with the prefixes q_ and c_.
    """
    q = lambda n: F.col(f"q_{n}")
    c = lambda n: F.col(f"c_{n}")
    with_numbers = pairs.withColumns({"__qn": numbers(q("name_tokens"), q("address_tokens")), "__cn": numbers(c("name_tokens"), c("address_tokens"))})
    left, right = F.col("__qn"), F.col("__cn")
    both = (F.size(left) > 0) & (F.size(right) > 0)
    common = F.size(F.array_intersect(left, right))
    return with_numbers.withColumns(
        {
            "name_exact": exact(q("name_norm"), c("name_norm")),
            "name_token_jaccard": jaccard(q("name_tokens"), c("name_tokens")),
            "name_token_containment": containment(q("name_tokens"), c("name_tokens")),
            "name_length_ratio": length_ratio(q("name_norm"), c("name_norm")),
            "name_prefix_ratio": prefix_ratio(q("name_norm"), c("name_norm")),
            "s1_name_missing": _flag(q("name_norm") == ""),
            "candidate_name_missing": _flag(c("name_norm") == ""),
            "address_exact": exact(q("address_norm"), c("address_norm")),
            "address_token_jaccard": jaccard(q("address_tokens"), c("address_tokens")),
            "address_token_containment": containment(q("address_tokens"), c("address_tokens")),
            "address_length_ratio": length_ratio(q("address_norm"), c("address_norm")),
            "s1_address_missing": _flag(q("address_norm") == ""),
            "candidate_address_missing": _flag(c("address_norm") == ""),
            "both_addresses_missing": _flag((q("address_norm") == "") & (c("address_norm") == "")),
            "number_overlap_count": common.cast("double"),
            "number_jaccard": jaccard(left, right),
            "number_any_agreement": _flag(common > 0),
            "number_conflict": _flag(both & (F.array_sort(left) != F.array_sort(right))),
            "is_source2": _flag(F.col("cand").startswith("S2-")),
            "is_source3": _flag(F.col("cand").startswith("S3-")),
            "retrieval_route_count": F.col("n_routes").cast("double"),
        }
    ).drop("__qn", "__cn")


def rule_score() -> Column:
    """A transparent score in [0, 1]; a conflict of numbers counts against a pair but does not rule it out."""
    name = 0.45 * F.col("name_token_jaccard") + 0.25 * F.col("name_token_containment") + 0.30 * F.col("name_char_ratio")
    address = 0.5 * F.col("address_token_jaccard") + 0.5 * F.col("address_char_ratio")
    known = (F.col("s1_address_missing") == 0) & (F.col("candidate_address_missing") == 0)
    total = 0.75 * name + F.when(known, 0.20 * address).otherwise(0.0) + 0.05 * F.col("number_any_agreement") - 0.08 * F.col("number_conflict")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))
