"""Training pairs, the boosted-tree model, scores and decisions."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import pyspark
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DecisionConfig, SamplingConfig, TrainConfig
from ..functions import features, ids, text
from ..sources.files import Files
from .store import VERSION as INDEX_VERSION


def labelled(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Ranked pairs (s1, cand, rank) with label 1 if links(s1, cand) has them."""
    return pairs.join(links.select("s1", "cand").distinct().withColumn("label", F.lit(1)), ["s1", "cand"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def training_pairs(pairs: DataFrame, links: DataFrame, config: SamplingConfig = SamplingConfig()) -> DataFrame:
    """All retrieved links, and negatives sampled from the best-ranked others, of S1 outside the validation split.

    The sample of an S1 depends on the seed and its own ids alone: within the first top_negative_pool negatives by rank
    those with the smallest SHA-256 of seed, S1 and candidate.  Links that were not retrieved are never added.
    """
    return sampled(labelled(pairs.filter(~ids.is_validation(F.col("s1"))), links), config)


def sampled(open_pairs: DataFrame, config: SamplingConfig = SamplingConfig()) -> DataFrame:
    """training_pairs() of pairs with a label."""
    pool = F.row_number().over(W.partitionBy("s1", "label").orderBy("rank", "cand"))
    pooled = open_pairs.withColumn("place", pool).filter((F.col("label") == 1) | (F.col("place") <= config.top_negative_pool))
    key = F.sha2(F.concat_ws("|", F.lit(str(config.seed)), "s1", "cand"), 256)
    pick = F.row_number().over(W.partitionBy("s1", "label").orderBy(key, "cand"))
    return pooled.withColumn("pick", pick).filter((F.col("label") == 1) | (F.col("pick") <= config.negatives_per_s1)).drop("place", "pick")


def pair_counts(queries: DataFrame, pairs: DataFrame, links: DataFrame, chosen: DataFrame) -> DataFrame:
    """groups, positives, missed_positives, negatives, skipped_validation in one row."""
    open_links = links.select("s1", "cand").distinct().filter(~ids.is_validation(F.col("s1")))
    missed = open_links.join(pairs.select("s1", "cand"), ["s1", "cand"], "left_anti").agg(F.count("*").alias("missed_positives"))
    return _pair_counts(queries, missed, chosen)


def pair_counts_by_degree(queries: DataFrame, degrees: DataFrame, chosen: DataFrame) -> DataFrame:
    """pair_counts() from the number of links of each query, degrees(s1, t), and all that sampled() returned."""
    links = degrees.filter(~ids.is_validation(F.col("s1"))).agg(F.coalesce(F.sum("t"), F.lit(0)).alias("links"))
    found = chosen.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("found"))
    return _pair_counts(queries, links.join(found).select((F.col("links") - F.col("found")).cast("long").alias("missed_positives")), chosen)


def _pair_counts(queries: DataFrame, missed: DataFrame, chosen: DataFrame) -> DataFrame:
    spine = queries.select(F.col("entity_id").alias("s1"), ids.is_validation(F.col("entity_id")).alias("held"))
    groups = spine.agg(F.count_if(~F.col("held")).alias("groups"), F.count_if("held").alias("skipped_validation"))
    counted = chosen.agg(F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))
    return groups.join(missed).join(counted).select("groups", "positives", "missed_positives", "negatives", "skipped_validation")


@dataclass
class ModelManifest:
    folder: str
    sha256: str
    feature_names: list[str]
    config: dict
    counts: dict
    candidate_config: dict = field(default_factory=dict)
    feature_version: str = features.VERSION
    normalization_version: str = text.VERSION
    index_version: str = INDEX_VERSION
    model_type: str = "GBTClassificationModel"
    library_version: str = pyspark.__version__


def featurize(pairs: DataFrame) -> DataFrame:
    """pairs with records (retrieval.with_records) -> all features in the order of features.NAMES."""
    return features.char_ratios(features.native(pairs))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(features.NAMES), outputCol="features").transform(rows)


def check_partition(rows: DataFrame, validation: bool) -> None:
    """Raises ValueError if a pair is of the other part of the split."""
    wrong = rows.filter(ids.is_validation(F.col("s1")) != F.lit(validation)).limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0]['s1']} is of the other part of the split")


def train(rows: DataFrame, folder: str, config: TrainConfig = TrainConfig(), validation: DataFrame | None = None, candidate_config: dict | None = None) -> ModelManifest:
    """Fits on featurised rows with a label; validation rows are checked and never fitted.  Writes the model and its manifest."""
    check_partition(rows, False)
    if validation is not None:
        check_partition(validation, True)
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if total > config.max_training_pairs:
        raise ValueError(f"{total} pairs, over {config.max_training_pairs}")
    if not 0 < positive < total:
        raise ValueError("training needs positive and negative pairs")
    learner = GBTClassifier(
        labelCol="label", maxIter=config.rounds, stepSize=config.learning_rate, maxDepth=config.depth, minInstancesPerNode=config.min_rows,
        subsamplingRate=1.0, featureSubsetStrategy="all", seed=config.seed,
    )
    model = learner.fit(_assembled(rows.orderBy("s1", "cand")))
    files, where = Files(rows.sparkSession), f"{folder.rstrip('/')}/model"
    model.write().overwrite().save(where)
    manifest = ModelManifest(where, files.fingerprint(where), list(features.NAMES), config.to_dict(), {"pairs": total, "positives": int(positive)}, candidate_config or {})
    files.write(f"{folder.rstrip('/')}/model.json", json.dumps(asdict(manifest), indent=1, sort_keys=True).encode())
    return manifest


@dataclass
class LoadedModel:
    model: GBTClassificationModel
    manifest: ModelManifest


def load(spark: SparkSession, path: str) -> LoadedModel:
    """The model of a manifest (a Hadoop path), if nothing about it differs; else ValueError."""
    files = Files(spark)
    values = json.loads(files.read(path))
    manifest = ModelManifest(**{k: v for k, v in values.items() if k in ModelManifest.__dataclass_fields__})
    home, where = files.qualified(path).rpartition("/")[0], files.qualified(manifest.folder)
    if not where.startswith(f"{home}/") or ".." in where.split("/"):
        raise ValueError("the model lies outside of its manifest's folder")
    if manifest.feature_version != features.VERSION or manifest.feature_names != list(features.NAMES):
        raise ValueError("the model reads other features")
    if manifest.model_type != "GBTClassificationModel" or manifest.library_version != pyspark.__version__:
        raise ValueError("the model is of another type or library version")
    if files.fingerprint(where) != manifest.sha256:
        raise ValueError("the model's files changed")
    return LoadedModel(GBTClassificationModel.load(where), manifest)


def score(rows: DataFrame, loaded: LoadedModel, normalization_version: str = text.VERSION, index_version: str = INDEX_VERSION, candidate_config: dict | None = None) -> DataFrame:
    """Appends the probability of a link; versions and candidate settings must be those of the training."""
    m = loaded.manifest
    if (m.normalization_version, m.index_version) != (normalization_version, index_version):
        raise ValueError("the model was trained on another normalisation or index")
    if candidate_config is not None and candidate_config != m.candidate_config:
        raise ValueError("the model was trained on other candidates")
    scored = loaded.model.transform(_assembled(rows))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def reached(config: DecisionConfig) -> Column:
    """Whether the score of a pair reaches its source's threshold."""
    return F.col("score") >= F.when(F.col("cand").startswith("S2-"), config.of(2)).otherwise(config.of(3))


def decide(queries: DataFrame, scored: DataFrame, config: DecisionConfig = DecisionConfig()) -> DataFrame:
    """One row per query: the candidates whose score reaches their source's threshold, sorted; possibly none."""
    kept = scored.filter(reached(config)).groupBy("s1").agg(F.array_sort(F.collect_set("cand")).alias("ids"))
    spine = queries.select(F.col("entity_id").alias("s1"), "row_ord")
    return spine.join(kept, "s1", "left").select("s1", "row_ord", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def threshold_sweep(queries: DataFrame, scored: DataFrame, links: DataFrame, thresholds: list[float]) -> DataFrame:
    """Macro F0.5 at each threshold.

    Each pair adds to the thresholds that it reaches, so a query's counts at all thresholds come from one pass over the pairs.
    """
    from ..functions.scores import f_half

    truth = links.select("s1", "cand").distinct()
    marked = scored.select("s1", "cand", "score").join(truth.withColumn("hit", F.lit(1)), ["s1", "cand"], "left")
    columns = []
    for i, t in enumerate(thresholds):
        above = F.col("score") >= t
        columns += [F.count_if(above).alias(f"p{i}"), F.count_if(above & F.col("hit").isNotNull()).alias(f"c{i}")]
    counts = queries.select(F.col("entity_id").alias("s1")).join(truth.groupBy("s1").agg(F.count("*").alias("t")), "s1", "left").join(marked.groupBy("s1").agg(*columns), "s1", "left").na.fill(0)
    means = counts.agg(*[F.avg(f_half(F.col("t"), F.col(f"p{i}"), F.col(f"c{i}"))).alias(f"m{i}") for i in range(len(thresholds))])
    rows = F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"m{i}").alias("macro_f_half")) for i, t in enumerate(thresholds)]))
    return means.select(rows)


def threshold_sweep_by_source(queries: DataFrame, scored: DataFrame, links: DataFrame, thresholds: list[float]) -> DataFrame:
    """Macro F0.5 (source2_threshold, source3_threshold, macro_f_half) at each pair of thresholds for S2 and S3 candidates.

    A query's counts at all thresholds come from one pass over its pairs, for each source apart; each pair of thresholds adds two.
    """
    from ..functions.scores import f_half

    truth = links.select("s1", "cand").distinct()
    marked = scored.select("s1", "cand", "score").join(truth.withColumn("hit", F.lit(1)), ["s1", "cand"], "left")
    columns = []
    for k in (2, 3):
        own = F.col("cand").startswith(f"S{k}-")
        for i, t in enumerate(thresholds):
            above = own & (F.col("score") >= t)
            columns += [F.count_if(above).alias(f"p{k}_{i}"), F.count_if(above & F.col("hit").isNotNull()).alias(f"c{k}_{i}")]
    counts = queries.select(F.col("entity_id").alias("s1")).join(truth.groupBy("s1").agg(F.count("*").alias("t")), "s1", "left").join(marked.groupBy("s1").agg(*columns), "s1", "left").na.fill(0)
    grid = [(i, j) for i in range(len(thresholds)) for j in range(len(thresholds))]
    both = lambda c, i, j: F.col(f"{c}2_{i}") + F.col(f"{c}3_{j}")
    means = counts.agg(*[F.avg(f_half(F.col("t"), both("p", i, j), both("c", i, j))).alias(f"m{i}_{j}") for i, j in grid])
    row = lambda i, j: F.struct(F.lit(thresholds[i]).alias("source2_threshold"), F.lit(thresholds[j]).alias("source3_threshold"), F.col(f"m{i}_{j}").alias("macro_f_half"))
    return means.select(F.inline(F.array(*[row(i, j) for i, j in grid])))
