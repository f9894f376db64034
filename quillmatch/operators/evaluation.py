"""Evaluation of decisions and candidates, error analysis and coverage."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import f_half, precision, ratio_or_nan, recall


def _empty() -> Column:
    return F.array().cast("array<string>")


def require_same_queries(truth: DataFrame, other: DataFrame, what: str) -> None:
    """Both tables have s1; raises ValueError if a query is twice in other, or in one table only."""
    twice = other.groupBy("s1").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated {what}: {sorted(r['s1'] for r in twice)}")
    for left, right, word in ((truth, other, "missing"), (other, truth, "unexpected")):
        odd = left.select("s1").join(right.select("s1"), "s1", "left_anti").orderBy("s1").limit(5).collect()
        if odd:
            raise ValueError(f"{word} {what}: {[r['s1'] for r in odd]}")


def counts(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """truth(s1, ids), predicted(s1, ids) -> s1, true_n, pred_n, common; repeated ids count once."""
    t = truth.select("s1", F.array_distinct("ids").alias("t"))
    p = predicted.select("s1", F.array_distinct("ids").alias("p"))
    both = t.join(p, "s1")
    return both.select("s1", F.size("t").alias("true_n"), F.size("p").alias("pred_n"), F.size(F.array_intersect("t", "p")).alias("common"))


def per_query(counted: DataFrame) -> DataFrame:
    c = (F.col("true_n"), F.col("pred_n"), F.col("common"))
    return counted.withColumns({"f_half": f_half(*c), "precision": precision(*c), "recall": recall(*c)})


def macro(counted: DataFrame) -> DataFrame:
    """Means over all queries and the counts beside them, in one row.  A singleton is a query without links."""
    true_n, pred_n, common = F.col("true_n"), F.col("pred_n"), F.col("common")
    alone = true_n == 0
    return per_query(counted).agg(
        F.avg("f_half").alias("macro_f_half"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.count("*").alias("total_s1"),
        F.count_if(alone).alias("true_empty"), F.count_if(pred_n == 0).alias("pred_empty"), F.sum(pred_n - common).cast("long").alias("false_positives"),
        F.sum(true_n - common).cast("long").alias("false_negatives"), F.count_if(alone & (pred_n == 0)).alias("singletons_correct"),
        ratio_or_nan(F.count_if(alone & (pred_n == 0)), F.count_if(alone)).alias("singleton_accuracy"),
    )


def by_country(counted: DataFrame, countries: DataFrame) -> DataFrame:
    """Macro measures of each nonempty country; countries(s1, country)."""
    named = per_query(counted).join(countries, "s1").filter("country is not null and country <> ''")
    return named.groupBy("country").agg(F.count("*").alias("total_s1"), F.avg("f_half").alias("macro_f_half"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"))


def candidate_measures(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Recall of links by candidates, overall and by source, of whole queries, and the best macro F0.5 that candidates allow.

    truth(s1, ids), candidates(s1, ids); ratios without a denominator are NaN.
    """
    both = truth.select("s1", F.array_distinct("ids").alias("t")).join(candidates.select("s1", F.array_distinct("ids").alias("c")), "s1")
    hit = F.array_intersect("t", "c")
    of = lambda a, k: F.size(F.filter(a, lambda x: x.startswith(f"S{k}-")))
    rows = both.select(
        F.size("t").alias("t"), F.size("c").alias("c"), F.size(hit).alias("h"), of("t", 2).alias("t2"), of("t", 3).alias("t3"), of(hit, 2).alias("h2"), of(hit, 3).alias("h3"),
    )
    return candidate_measures_by_number(rows)


def candidate_measures_by_number(rows: DataFrame) -> DataFrame:
    """candidate_measures() of queries with t links and h found ones, and those of each source (t2, t3, h2, h3)."""
    rows = rows.withColumn("oracle", f_half(F.col("t"), F.col("h"), F.col("h")))
    whole = (F.col("t") > 0) & (F.col("t") == F.col("h"))
    return rows.agg(
        F.sum("t").cast("long").alias("true_edges"), F.sum("h").cast("long").alias("edges_recalled"), ratio_or_nan(F.sum("h"), F.sum("t")).alias("edge_recall"),
        ratio_or_nan(F.sum("h2"), F.sum("t2")).alias("s2_recall"), ratio_or_nan(F.sum("h3"), F.sum("t3")).alias("s3_recall"),
        ratio_or_nan(F.count_if(whole), F.count_if(F.col("t") > 0)).alias("complete_recall"), F.avg("oracle").alias("oracle_macro_f_half"),
    )


def distribution(candidates: DataFrame) -> DataFrame:
    """Sizes of candidate lists: least, mean, most, nearest-rank median, 95th and 99th percentile, and the averaging median."""
    n = candidates.select(F.size(F.array_distinct("ids")).alias("n"))
    rank = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)")
    return n.agg(
        F.min("n").cast("long").alias("min_n"), F.avg("n").alias("mean_n"), F.max("n").cast("long").alias("max_n"), rank(0.5).cast("long").alias("p50"),
        rank(0.95).cast("long").alias("p95"), rank(0.99).cast("long").alias("p99"), F.percentile("n", 0.5).alias("median"),
    )


def reduction(candidates: DataFrame, corpus_size: int) -> DataFrame:
    """pairs / (queries x corpus) as kept_ratio, and one minus that as reduction_ratio; null and 0 without a corpus."""
    total = candidates.agg(F.count("*").alias("q"), F.sum(F.size(F.array_distinct("ids"))).cast("long").alias("pairs"))
    product = F.col("q") * corpus_size
    return total.select(
        F.col("q").alias("s1_count"), "pairs", F.when(product > 0, F.col("pairs") / product).alias("kept_ratio"),
        F.when(product > 0, 1 - F.col("pairs") / product).otherwise(0.0).alias("reduction_ratio"),
    )


def oracle_check(model: float, oracle: float) -> tuple[bool, str]:
    """No decision can beat the oracle; NaN cannot be compared."""
    if math.isnan(model) or math.isnan(oracle):
        return True, "not compared: NaN"
    return model <= oracle + 1e-9, f"model {model:.6f}, oracle {oracle:.6f}"


CATEGORIES = ("retrieval_miss", "scoring_false_negative", "false_positive", "wrong_singleton", "empty_case_false_positive", "multi_match_partial")


def errors(truth: DataFrame, predicted: DataFrame, candidates: DataFrame) -> DataFrame:
    """(category, s1, detail) of every error; predictions and candidates that are absent count as empty."""
    p = predicted.groupBy("s1").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("p"))
    c = candidates.groupBy("s1").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("c"))
    rows = truth.select("s1", F.array_distinct("ids").alias("t")).join(p, "s1", "left").join(c, "s1", "left")
    rows = rows.select("s1", "t", F.coalesce("p", _empty()).alias("p"), F.coalesce("c", _empty()).alias("c"))
    missed, wrong = F.array_sort(F.array_except("t", "p")), F.array_sort(F.array_except("p", "t"))
    ghost = (F.size("t") == 0) & (F.size("p") > 0)

    def each(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("category"), v.alias("detail")))

    def once(name: str, condition: Column, values: Column) -> Column:
        return each(name, F.when(condition, F.array(F.array_join(F.slice(values, 1, 3), ","))).otherwise(_empty()))

    regular = F.flatten(
        F.array(
            each("retrieval_miss", F.array_except(missed, "c")),
            each("scoring_false_negative", F.array_intersect(missed, F.col("c"))),
            each("false_positive", wrong),
            once("wrong_singleton", (F.size("t") == 1) & (F.size("p") == 1) & (F.size(missed) == 1), missed),
            once("multi_match_partial", (F.size("t") > 1) & (F.size(missed) > 0), missed),
        )
    )
    found = F.when(ghost, once("empty_case_false_positive", ghost, F.array_sort("p"))).otherwise(regular)
    return rows.select("s1", F.inline(found)).select("category", "s1", "detail")


def error_sizes(rows: DataFrame) -> DataFrame:
    """(category, s1, errors) of errors(), where there are any, by numbers: t links and h of them among the candidates, p predicted candidates and common links among these."""
    t, p, common, h = (F.col(c) for c in ("t", "p", "common", "h"))
    ghost = (t == 0) & (p > 0)
    sizes = {
        "retrieval_miss": t - h, "scoring_false_negative": h - common, "false_positive": F.when(ghost, 0).otherwise(p - common), "wrong_singleton": (t == 1) & (p == 1) & (common == 0),
        "multi_match_partial": (t > 1) & (common < t), "empty_case_false_positive": ghost,
    }
    each = F.array(*[F.struct(F.lit(c).alias("category"), n.cast("long").alias("errors")) for c, n in sizes.items()])
    return rows.select("s1", F.inline(each)).filter("errors > 0").select("category", "s1", "errors")


def error_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("category").agg(F.count("*").alias("errors"))


def error_examples(found: DataFrame, most: int = 10) -> DataFrame:
    """The first examples of each category by id."""
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("category").orderBy("s1", "detail")).cast("long")
    return found.withColumn("place", place).filter(F.col("place") <= most)


def error_summary(found: DataFrame, total_s1: int, most: int = 3) -> str:
    """The number of errors of each category and the first examples."""
    number = {r["category"]: r["errors"] for r in error_counts(found).collect()}
    first: dict[str, list[str]] = {}
    for r in error_examples(found, most).orderBy("category", "place").collect():
        first.setdefault(r["category"], []).append(f"{r['s1']} ({r['detail']})")
    lines = [f"S1 records: {total_s1}"]
    for c in CATEGORIES:
        lines.append(f"{c.replace('_', ' ')}: {number.get(c, 0)}" + (f", such as {'; '.join(first[c])}" if c in first else ""))
    return "\n".join(lines)


def coverage(queries: DataFrame, output: DataFrame, countries: DataFrame, label: str = "france") -> DataFrame:
    """How far output(s1) covers queries(s1), and those of one country label; countries(s1, country).  Up to ten ids are named."""
    q, o = queries.select("s1").distinct().withColumn("q", F.lit(True)), output.select("s1").distinct().withColumn("o", F.lit(True))
    labelled = countries.filter(F.lower(F.trim("country")) == label).select("s1").distinct().withColumn("l", F.lit(True))
    rows = q.join(o, "s1", "full").join(labelled, "s1", "full")
    has = lambda c: F.col(c).isNotNull()
    counted = rows.agg(
        F.count_if(has("q")).alias("total_s1"), F.count_if(has("o")).alias("output_s1"), F.count_if(has("q") & ~has("o")).alias("missing"), F.count_if(~has("q") & has("o")).alias("extra"),
        F.count_if(has("l")).alias("label_total"), F.count_if(has("l") & has("o")).alias("label_in_output"),
    )
    counted = counted.withColumn("label_missing", F.col("label_total") - F.col("label_in_output"))
    for name, cond in (("missing_examples", has("q") & ~has("o")), ("extra_examples", ~has("q") & has("o"))):
        counted = counted.join(rows.filter(cond).orderBy("s1").limit(10).agg(F.array_sort(F.collect_list("s1")).alias(name)))
    return counted


@dataclass
class Evaluation:
    """The one-row results as plain values."""

    values: dict

    @classmethod
    def of(cls, frame: DataFrame) -> Evaluation:
        return cls(frame.first().asDict())

    def summary(self) -> str:
        return "\n".join(f"{k}: {v:.6f}" if isinstance(v, float) else f"{k}: {v}" for k, v in self.values.items())
