"""Command line: index, train, retrieve, sweep, evaluate, validate, generate and bench."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quillmatch", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    index = commands.add_parser("index", help="build an index of S2 and S3")
    index.add_argument("--source2", required=True)
    index.add_argument("--source3", required=True)
    index.add_argument("--folder", required=True)
    learn = commands.add_parser("train", help="train a model on the retrieved pairs of S1 records with known links; the validation split is left out")
    learn.add_argument("--source1", required=True)
    learn.add_argument("--truth", required=True)
    learn.add_argument("--manifest", required=True)
    learn.add_argument("--folder", required=True)
    learn.add_argument("--rounds", type=int)
    sweep = commands.add_parser("sweep", help="macro F0.5 on the validation split at thresholds for S2 and S3")
    for name in ("source1", "truth", "manifest"):
        sweep.add_argument(f"--{name}", required=True)
    sweep.add_argument("--model", help="a model's manifest; the rule score without one")
    sweep.add_argument("--thresholds", type=float, nargs="+", default=[0.3, 0.4, 0.5, 0.6, 0.7])
    run = commands.add_parser("retrieve", aliases=["predict"], help="retrieve, score, decide and write both output files")
    run.add_argument("--source1", required=True)
    run.add_argument("--manifest", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--threshold", type=float, default=0.5)
    run.add_argument("--source2-threshold", type=float)
    run.add_argument("--source3-threshold", type=float)
    run.add_argument("--model", help="a model's manifest; the rule score without one")
    evaluate = commands.add_parser("evaluate", help="macro F0.5 of an output file")
    evaluate.add_argument("--truth", required=True)
    evaluate.add_argument("--matches", required=True)
    check = commands.add_parser("validate", help="preflight checks of the output files")
    check.add_argument("--source1", required=True)
    check.add_argument("--matches", required=True)
    check.add_argument("--candidates")
    make = commands.add_parser("generate", help="synthetic sources of n records")
    make.add_argument("--records", type=int, required=True)
    make.add_argument("--folder", required=True)
    bench = commands.add_parser("bench", help="time index and retrieval on files")
    for name in ("source1", "source2", "source3", "folder"):
        bench.add_argument(f"--{name}", required=True)
    bench.add_argument("--truth")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    from .config import DecisionConfig, RetrievalConfig, TrainConfig
    from .functions import features, ids, text
    from .operators import benchmark, evaluation, output, retrieval, store, training
    from .sources import generate, tsv
    from .sources.files import Scratch

    def links_of(spark: SparkSession, path: str):
        return tsv.read_truth(spark, path).select(F.col("source1_entity_id").alias("s1"), F.explode("matched_entity_ids").alias("cand"))

    spark = SparkSession.builder.getOrCreate()
    if args.command == "index":
        records = tsv.read_source(spark, args.source2, "S2-").unionByName(tsv.read_source(spark, args.source3, "S3-"))
        print(store.write(records, args.folder, {"source2": args.source2, "source3": args.source3}).folder)
    elif args.command in ("train", "sweep", "retrieve", "predict"):
        index, settings, scratch = store.open_index(spark, args.manifest), RetrievalConfig(), Scratch(spark, "cli")
        queries = scratch.save(text.normalize(tsv.read_source(spark, args.source1, "S1-")), "queries")
        pairs = scratch.save(retrieval.candidates(queries, index, settings), "pairs")
        rows = training.featurize(retrieval.with_records(pairs, queries, index.records))
        if args.command == "train":
            chosen = training.training_pairs(pairs, links_of(spark, args.truth)).select("s1", "cand", "label")
            config = TrainConfig() if args.rounds is None else TrainConfig(rounds=args.rounds)
            manifest = training.train(rows.join(chosen, ["s1", "cand"]), args.folder, config, candidate_config=settings.to_dict())
            print(f"{args.folder.rstrip('/')}/model.json", manifest.counts)
            return 0
        if args.model:
            rows = training.score(rows, training.load(spark, args.model), candidate_config=settings.to_dict())
        else:
            rows = rows.withColumn("score", features.rule_score())
        scored = scratch.save(rows.select("s1", "cand", "rank", "score"), "scored")
        if args.command == "sweep":
            held = queries.filter(ids.is_validation(F.col("entity_id")))
            for r in training.threshold_sweep_by_source(held, scored, links_of(spark, args.truth), args.thresholds).orderBy(F.desc("macro_f_half")).collect():
                print(f"S2 {r['source2_threshold']:.2f}  S3 {r['source3_threshold']:.2f}  macro F0.5 {r['macro_f_half']:.6f}")
            return 0
        spine = queries.select(F.col("entity_id").alias("s1"), "row_ord")
        decided = training.decide(queries, scored, DecisionConfig(args.threshold, args.source2_threshold, args.source3_threshold))
        lists, matches = scratch.save(retrieval.groups(queries, pairs), "lists"), scratch.save(decided, "matches")
        print(*output.write_outputs(spine, lists, matches, args.output))
    elif args.command == "evaluate":
        as_lists = lambda p: tsv.read_links_lenient(spark, p).select(F.col("source1_entity_id").alias("s1"), F.col("matched_entity_ids").alias("ids"))
        truth, matches = as_lists(args.truth), as_lists(args.matches)
        evaluation.require_same_queries(truth, matches, "predictions")
        print(evaluation.Evaluation.of(evaluation.macro(evaluation.counts(truth, matches))).summary())
    elif args.command == "bench":
        print(benchmark.report(benchmark.run(spark, args.source1, args.source2, args.source3, args.folder, args.truth)))
    elif args.command == "validate":
        found = output.validate_files(spark, args.source1, args.matches, args.candidates, require_candidates=args.candidates is not None)
        print(found.summary())
        return int(not found.passed)
    else:
        for name, df in generate.scale_data(spark, args.records).items():
            if name == "truth":
                df = df.withColumn("matched_entity_ids", F.array_join("matched_entity_ids", ","))
            df.drop("row_ord").coalesce(1).write.options(sep="\t", header=True, emptyValue="").csv(f"{args.folder}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
