"""The paired output files and their validator."""

from __future__ import annotations

import subprocess
import sys
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import ids
from ..sources import tsv
from ..sources.files import Files, Scratch


def _struct(problem: str, where, ids_col=None):
    """A finding about the row's s1."""
    listed = F.slice(ids_col, 1, 10) if ids_col is not None else F.array().cast("array<string>")
    return F.struct(F.lit(problem).alias("problem_type"), listed.alias("invalid_ids"), where.alias("context"))


def _when(condition, finding):
    return F.when(condition, finding)


def row_findings(rows: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """DUPLICATE_IDS, INVALID_ID_PREFIX and, with corpus(entity_id), UNKNOWN_S2S3_IDS of rows(s1, ids, context)."""
    bad = F.filter("ids", lambda x: ~ids.is_id(x, "23"))
    repeated = F.array_distinct(F.filter("ids", lambda x: F.size(F.filter("ids", lambda y: y == x)) > 1))
    where = F.col("context")
    found = F.array(_when(~ids.are_unique(F.col("ids")), _struct("DUPLICATE_IDS", where, repeated)), _when(F.size(bad) > 0, _struct("INVALID_ID_PREFIX", where, bad)))
    out = _listed(rows.select("s1", F.inline(F.filter(found, lambda x: x.isNotNull()))))
    if corpus is None:
        return out
    pairs = rows.select("s1", "context", F.explode(F.filter("ids", lambda x: ids.is_id(x, "23"))).alias("entity_id")).distinct()
    unknown = pairs.join(corpus.select("entity_id"), "entity_id", "left_anti").groupBy("s1", "context").agg(F.array_sort(F.collect_list("entity_id")).alias("u"))
    return out.unionByName(_listed(unknown.select("s1", _struct("UNKNOWN_S2S3_IDS", where, F.col("u")).alias("f")).select("s1", "f.*")))


def _listed(found: DataFrame) -> DataFrame:
    return found.select(F.col("s1").alias("s1_id"), "problem_type", "invalid_ids", "context")


def _examples(odd: DataFrame) -> DataFrame:
    """(problem_type, context, s1) -> one finding for each problem and context, with the number of ids and the first ten."""
    place = F.row_number().over(W.partitionBy("problem_type", "context").orderBy("s1"))
    first = odd.withColumn("place", place).filter(F.col("place") <= 10).groupBy("problem_type", "context").agg(F.array_sort(F.collect_list("s1")).alias("invalid_ids"))
    text = F.concat("context", F.lit(": "), F.col("n").cast("string"))
    one = odd.groupBy("problem_type", "context").agg(F.count("*").alias("n")).join(first, ["problem_type", "context"])
    return one.select(F.lit(None).cast("string").alias("s1_id"), "problem_type", "invalid_ids", text.alias("context"))


def set_findings(queries: DataFrame, rows: DataFrame, countries: DataFrame | None = None, label: str = "france") -> DataFrame:
    """Findings about the S1 ids of rows(s1, ids, context), whose context is matches or candidates, by one full outer join.

    DUPLICATE_S1_ROW and PREDICTION_NOT_SUBSET_OF_CANDIDATES by id; MISSING_S1_ROWS, EXTRA_S1_ROWS and, with countries(s1, country),
    <LABEL>_COVERAGE (queries of the label without a match row) as one finding each.
    """
    given = [r["context"] for r in rows.select("context").distinct().collect()]
    of = {w: F.col("context") == w for w in ("matches", "candidates")}
    per = rows.groupBy("s1").agg(
        *[F.count_if(c).alias(f"{w}_n") for w, c in of.items()], *[F.flatten(F.collect_list(F.when(c, F.col("ids")))).alias(f"{w}_ids") for w, c in of.items()]
    )
    spine = queries.select("s1").distinct().withColumn("asked", F.lit(True)).join(per, "s1", "full")
    if countries is not None:
        labelled = countries.filter(F.lower(F.trim("country")) == label).select("s1").distinct().withColumn("labelled", F.lit(True))
        spine = spine.join(labelled, "s1", "full")
    else:
        spine = spine.withColumn("labelled", F.lit(None).cast("boolean"))
    single, many = [], []
    for w in given:
        n, where = F.coalesce(f"{w}_n", F.lit(0)), F.lit(w)
        single.append(_when(n > 1, _struct("DUPLICATE_S1_ROW", where)))
        many += [_when(F.col("asked") & (n == 0), _struct("MISSING_S1_ROWS", where)), _when(F.col("asked").isNull() & (n > 0), _struct("EXTRA_S1_ROWS", where))]
    if len(given) == 2:
        odd = F.array_sort(F.array_except("matches_ids", "candidates_ids"))
        single.append(_when((F.col("matches_n") > 0) & (F.size(odd) > 0), _struct("PREDICTION_NOT_SUBSET_OF_CANDIDATES", F.lit("matches"), F.slice(odd, 1, 5))))
    if countries is not None:
        many.append(_when(F.col("labelled") & (F.coalesce("matches_n", F.lit(0)) == 0), _struct(f"{label.upper()}_COVERAGE", F.lit("without a match row"))))
    if not single:  # no rows at all: every query is missing from both
        many = [_when(F.col("asked"), _struct("MISSING_S1_ROWS", F.lit(w))) for w in of] + many
    pick = lambda found: spine.select("s1", F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))
    out = _examples(pick(many).select("problem_type", "context", "s1"))
    return out.unionByName(_listed(pick(single))) if single else out


def both_lists(matches: DataFrame | None, candidates: DataFrame | None) -> DataFrame:
    """(s1, ids, context) of one table or both."""
    tables = [t.select("s1", "ids", F.lit(w).alias("context")) for w, t in (("matches", matches), ("candidates", candidates)) if t is not None]
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def table_findings(queries: DataFrame, matches: DataFrame, candidates: DataFrame, corpus: DataFrame | None = None, countries: DataFrame | None = None, label: str = "france") -> DataFrame:
    """All findings about matches(s1, ids) and candidates(s1, ids) for queries(s1).

    The tables are read a few times each: what is costly to compute should be written first.
    """
    rows = both_lists(matches, candidates)
    return set_findings(queries, rows, countries, label).unionByName(row_findings(rows, corpus))


def write_outputs(queries: DataFrame, candidates: DataFrame, matches: DataFrame, folder: str) -> tuple[str, str]:
    """Checks, then writes matching_results.tsv and candidate_pairs.tsv in the order of queries(s1, row_ord).

    folder is a Hadoop path.  Executors write the lines to a staging folder in it; the parts are put together and renamed one
    after the other; at an error nothing is left behind.  Raises ValueError with some findings if a row is missing, unexpected,
    repeated or malformed, or a match is no candidate.
    """
    spark = queries.sparkSession
    found = table_findings(queries, matches, candidates).limit(5).collect()
    if found:
        raise ValueError(f"outputs are not valid: {[(r['problem_type'], r['s1_id'], r['invalid_ids']) for r in found]}")
    files, home = Files(spark), folder.rstrip("/")
    stage = f"{home}/.stage-{uuid.uuid4().hex[:8]}"
    staged: list[tuple[str, str]] = []
    try:
        for rows, header, name in ((matches, schemas.MATCH_HEADER, "matching_results.tsv"), (candidates, schemas.CANDIDATE_HEADER, "candidate_pairs.tsv")):
            lines = queries.select("s1", "row_ord").join(rows.select("s1", "ids"), "s1")
            lines = lines.select("row_ord", "s1", F.concat_ws("\t", "s1", F.array_join(F.array_sort("ids"), ",")).alias("value"))
            lines.orderBy("row_ord", "s1").select("value").write.text(f"{stage}/{name}")
            files.concat(files.listed(f"{stage}/{name}"), f"{stage}/{name}.whole", ("\t".join(header) + "\n").encode())
            staged.append((f"{stage}/{name}.whole", f"{home}/{name}"))
        for whole, target in staged:
            files.replace(whole, target)
    finally:
        files.remove(stage)
    return staged[0][1], staged[1][1]


@dataclass
class Validation:
    """findings(s1_id, problem_type, invalid_ids, context): every problem; counts of them by type and of the files' rows."""

    findings: DataFrame
    counts: dict[str, int]
    total_s1: int = 0
    matching_rows: int = 0
    candidate_rows: int = 0
    empty_matching_rows: int = 0
    empty_candidate_rows: int = 0
    label: str = "france"
    label_total: int = 0
    label_in_output: int = 0

    @property
    def passed(self) -> bool:
        return not self.counts

    def examples(self, most: int = 20) -> list[dict]:
        """The first findings by type and id."""
        return [r.asDict() for r in self.findings.orderBy("problem_type", "s1_id", "context").limit(most).collect()]

    def summary(self, most: int = 20) -> str:
        lines = [
            "PASS" if self.passed else f"FAIL: {sum(self.counts.values())} findings", f"S1 records: {self.total_s1}", f"matching rows: {self.matching_rows}, empty {self.empty_matching_rows}",
            f"candidate rows: {self.candidate_rows}, empty {self.empty_candidate_rows}", f"{self.label} records in the output: {self.label_in_output} of {self.label_total}",
            *[f"{problem}: {n}" for problem, n in sorted(self.counts.items())],
        ]
        return "\n".join(lines + [f"- {f['problem_type']} {f['s1_id'] or ''} {f['invalid_ids']} {f['context']}" for f in ([] if self.passed else self.examples(most))])


def validate_files(
    spark: SparkSession, source1: str, matching: str, candidate: str | None = None, corpus: DataFrame | None = None, countries: DataFrame | None = None, require_candidates: bool = True, label: str = "france",
) -> Validation:
    """Every problem of the output files, as a table; without findings they can be handed in.

    Each file is parsed once, to a scratch table.  A file that is missing or no UTF-8 is one finding; without S1 ids or with such a
    matching file nothing else is looked at.  Malformed lines are findings each, with their content.
    """
    scratch, files = Scratch(spark, "validate"), Files(spark)
    single: list[tuple] = []

    def done(found: DataFrame | None = None, **counted) -> Validation:
        out = spark.createDataFrame(single, schemas.FINDING)
        out = scratch.save(out if found is None else out.unionByName(found), "findings")
        return Validation(out, {r["problem_type"]: r["count"] for r in out.groupBy("problem_type").count().collect()}, label=label, **counted)

    for path, problem in ((source1, "MISSING_TEST_S1_FILE"), (matching, "MISSING_MATCHING_FILE")):
        if not files.exists(path):
            single.append((None, problem, [], path))
            return done()
    queries = scratch.save(tsv.read_s1_ids(spark, source1).select("s1"), "s1")
    tables: dict[str, DataFrame] = {}
    malformed: list[DataFrame] = []
    for name, path, header in (("matches", matching, schemas.MATCH_HEADER), ("candidates", candidate, schemas.CANDIDATE_HEADER)):
        if path is None or not files.exists(path):
            if require_candidates:
                single.append((None, "MISSING_CANDIDATE_FILE", [], str(path)))
            continue
        lines = scratch.save(tsv.parse_output(spark, path), name)
        broken, first = lines.agg(F.min(F.when(~F.col("utf8"), F.col("line"))), F.max(F.when(F.col("line") == 1, F.col("value")))).first()
        if broken is not None:
            single.append((None, "ENCODING_ERROR", [], f"{name}: line {broken} is not UTF-8"))
            if name == "matches":
                return done(total_s1=queries.distinct().count())
            continue
        found = tuple(h.strip().lower() for h in first.split("\t")) if first is not None else ()
        if found != header:
            single.append((None, "WRONG_HEADER", [], f"{name}: {list(found)}"))
        tables[name] = lines.filter("s1 is not null").select("s1", "ids", "line")
        text = F.concat(F.lit(f"{name}: line "), F.col("line").cast("string"), F.lit(" has "), F.col("columns").cast("string"), F.lit(" columns: "), F.col("value"))
        odd = lines.filter("line > 1 and s1 is null").select(F.lit(None).cast("string").alias("s1_id"), F.lit("MALFORMED_ROW").alias("problem_type"), F.array().cast("array<string>").alias("invalid_ids"), text.alias("context"))
        malformed.append(odd)
    # ids are judged by an S1's last row, S1 rows by all of them
    last = {name: scratch.save(tsv.last_rows(rows), f"last-{name}") for name, rows in tables.items()}
    out = set_findings(queries, _with_repeats(tables, last), countries, label).unionByName(row_findings(both_lists(last.get("matches"), last.get("candidates")), corpus))
    for odd in malformed:
        out = out.unionByName(odd)
    sizes = {name: rows.agg(F.count("*"), F.count_if(F.size("ids") == 0)).first() for name, rows in last.items()}
    labelled = (0, 0)
    if countries is not None:
        wanted = countries.filter(F.lower(F.trim("country")) == label).select("s1").distinct()
        labelled = wanted.count(), wanted.join(last["matches"].select("s1"), "s1", "left_semi").count()
    m, c = sizes["matches"], sizes.get("candidates", (0, 0))
    return done(
        out, total_s1=queries.distinct().count(), matching_rows=m[0], empty_matching_rows=m[1], candidate_rows=c[0], empty_candidate_rows=c[1],
        label_total=labelled[0], label_in_output=labelled[1],
    )


def _with_repeats(tables: dict[str, DataFrame], last: dict[str, DataFrame]) -> DataFrame:
    """both_lists of the last rows, and an empty list for each row of an S1 before its last."""
    none = F.array().cast("array<string>")
    rows = both_lists(last.get("matches"), last.get("candidates"))
    for name, table in tables.items():
        repeats = table.groupBy("s1").count().filter("count > 1").select("s1", none.alias("ids"), F.lit(name).alias("context"))
        rows = rows.unionByName(repeats)
    return rows


def find_above(name: str, start: str = ".", levels: int = 8) -> str | None:
    """The file of this relative path in the folder start or in one of so many folders above it."""
    folder = Path(start).resolve()
    return next((str(where / name) for where in [folder, *folder.parents[:levels]] if (where / name).is_file()), None)


def run_external_validator(script: str, *arguments: str, start: str = ".") -> tuple[int, str]:
    """Runs a validator script, looked for from start upwards, in a process of its own: exit code and combined output.

    Exit code 1 and a message if there is no such script."""
    where = find_above(script, start)
    if where is None:
        return 1, f"no {script} in {Path(start).resolve()} or the folders above"
    done = subprocess.run([sys.executable, where, *arguments], capture_output=True, text=True, errors="replace", check=False)
    return done.returncode, done.stdout + done.stderr
