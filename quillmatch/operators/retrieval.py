"""Candidate retrieval: postings, routes, union, ranking and cap.

Queries meet the postings of their keys in blocks (see blocks.py), where pairs
are counted, scored and ranked in memory; they are never shuffled.  Keys that are
too frequent are cut before, so that none makes a quadratic number of pairs: an
exact-name block to its first ids, a token's block by leaving the token out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..config import STOPWORDS, RetrievalConfig
from ..functions.text import trigrams
from ..sources.files import Scratch
from . import blocks


@dataclass
class Index:
    """The tables of a corpus of normalised S2 and S3 records."""

    records: DataFrame
    exact: DataFrame  # name_norm, country_key, entity_id
    name_token: DataFrame  # token, entity_id
    address_token: DataFrame  # token, entity_id
    country: DataFrame  # country_key, entity_id
    frequency: DataFrame  # token, df
    total: int | None  # counted when it is first needed
    numbers: tuple[DataFrame, int] | None = None  # numbered when they are first needed

    TABLES = ("records", "exact", "name_token", "address_token", "country", "frequency")

    def size(self) -> int:
        if self.total is None:
            self.total = self.records.count()
        return self.total

    def numbered(self) -> tuple[DataFrame, int]:
        """entity_id, number: the ids' places in their order, in a scratch table; and how many there are."""
        if self.numbers is None:
            ids = self.records.select("entity_id").distinct().orderBy("entity_id").select("entity_id", F.monotonically_increasing_id().alias("at"))
            saved = Scratch(ids.sparkSession, "numbers").save(ids, "ids")
            part, before, offsets = F.shiftright("at", 33), 0, [F.lit(-1).cast("long"), F.lit(0).cast("long")]
            for r in saved.groupBy(part.alias("part")).count().orderBy("part").collect():
                offsets += [F.lit(r["part"]).cast("long"), F.lit(before - (r["part"] << 33)).cast("long")]
                before += r["count"]
            self.numbers = saved.select("entity_id", (F.col("at") + F.element_at(F.create_map(*offsets), part)).alias("number")), before
        return self.numbers

    def countries(self) -> DataFrame:
        return self.country.select("country_key").distinct().orderBy("country_key")

    def lookup(self, wanted: DataFrame, strict: bool = True) -> DataFrame:
        """The records of wanted(entity_id); strict stops the job at an id without one."""
        found = wanted.join(self.records.withColumn("__found", F.lit(True)), "entity_id", "left")
        if not strict:
            return found.filter("__found").drop("__found")
        missing = F.raise_error(F.concat(F.lit("no record of "), F.col("entity_id")))
        return found.withColumn("__found", F.coalesce(F.col("__found"), missing)).filter("__found").drop("__found")


def build(normalized: DataFrame) -> Index:
    """Postings of normalised records, lazily."""
    postings = lambda column: normalized.select(F.explode(F.array_distinct(column)).alias("token"), "entity_id")
    names = postings("name_tokens")
    return Index(
        records=normalized,
        exact=normalized.filter("name_norm <> ''").select("name_norm", "country_key", "entity_id"),
        name_token=names,
        address_token=postings("address_tokens"),
        country=normalized.filter("country_key <> ''").select("country_key", "entity_id"),
        frequency=names.groupBy("token").agg(F.count("*").alias("df")),
        total=None,
    )


def _hits(df: DataFrame, route: str) -> DataFrame:
    return df.select("s1", "cand", F.lit(route).alias("route"), F.col("score").cast("double").alias("score"))


def exact_name(queries: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """Equal nonempty names; equal countries too unless the query has none.  Blocks keep their first max_block ids."""
    named = queries.filter("name_norm <> ''").select(F.col("entity_id").alias("s1"), "name_norm", "country_key")

    def block(keys: list[str]) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy("entity_id"))
        return index.exact.withColumn("rank", rank).filter(F.col("rank") <= config.max_block).select(*keys, F.col("entity_id").alias("cand"))

    within = named.filter("country_key <> ''").join(block(["name_norm", "country_key"]), ["name_norm", "country_key"])
    across = named.filter("country_key = ''").join(block(["name_norm"]), "name_norm")
    return _hits(within.select("s1", "cand").unionByName(across.select("s1", "cand")).withColumn("score", F.lit(1.0)), "exact_name")


def rare_tokens(index: Index, config: RetrievalConfig) -> DataFrame:
    """token, df of those below the frequency bound; usable: not skipped for an oversized block."""
    most = max(10, int(index.size() * config.df_ratio))
    kept = (F.length("token") >= config.min_token) & ~F.col("token").isin(*STOPWORDS) & (F.col("df") <= most)
    return index.frequency.filter(kept).withColumn("usable", F.col("df") <= config.max_block)


def rare_bound(frequency: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """The tokens of frequency(token, df) that are over a bound and so meet no query."""
    return frequency.filter(F.col("df") > min(config.max_block, max(10, int(index.size() * config.df_ratio))))


def _asked(queries: DataFrame, index: Index, config: RetrievalConfig, routes: set[str]) -> DataFrame:
    """The queries' keys of the routes: s1, route (its number), key, n (how often the query has it), usable (the line of the score)."""
    s1, found = F.col("entity_id").alias("s1"), []
    number = {r: F.lit(i).alias("route") for i, r in enumerate(blocks.ROUTES)}
    if "exact_name" in routes:
        key = F.when(F.col("country_key") != "", _exact_keys()[0]).otherwise(_exact_keys()[1])
        found.append(queries.filter("name_norm <> ''").select(s1, number["exact_name"], key.alias("key"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("usable")))
    if "name_token" in routes:
        asked = queries.select(s1, F.explode("name_tokens").alias("token"))
        asked = asked.join(rare_tokens(index, config).filter("usable").select("token"), "token").groupBy("s1", "token").agg(F.count("*").alias("n"))
        asked = asked.withColumn("usable", F.sum("n").over(W.partitionBy("s1")))
        found.append(asked.select("s1", number["name_token"], F.concat(F.lit("1"), "token").alias("key"), "n", "usable"))
    if "address" in routes:
        asked = queries.select(s1, F.explode(F.array_distinct("address_tokens")).alias("token")).filter(F.length("token") >= config.min_token)
        asked = asked.withColumn("usable", F.count("*").over(W.partitionBy("s1")))
        found.append(asked.select("s1", number["address"], F.concat(F.lit("2"), "token").alias("key"), F.lit(1).cast("long").alias("n"), "usable"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _exact_keys() -> tuple[Column, Column]:
    """Keys of a name within its country and across countries; a normalised name has no line break."""
    return F.concat(F.lit("0w"), "name_norm", F.lit("\n"), "country_key"), F.concat(F.lit("0a"), "name_norm")


def _postings(index: Index, config: RetrievalConfig, routes: set[str]) -> DataFrame:
    """key, part, ids: the places in the part of the records that have the key; without keys that are too frequent."""
    numbers, total = index.numbered()
    rows = index.records.select("entity_id", "name_norm", "country_key", "name_tokens", "address_tokens").join(numbers, "entity_id").drop("entity_id")
    keyed = lambda mark, column: F.transform(F.array_distinct(column), lambda t: F.concat(F.lit(mark), t))
    tokens, frequent = [], []
    if "name_token" in routes:
        tokens.append(keyed("1", "name_tokens"))
        frequent.append(rare_bound(index.frequency, index, config).select(F.concat(F.lit("1"), "token").alias("key")))
    if "address" in routes:
        tokens.append(keyed("2", "address_tokens"))
        sizes = index.address_token.groupBy("token").agg(F.count("*").alias("df"))
        frequent.append(sizes.filter(F.col("df") > config.max_block).select(F.concat(F.lit("2"), "token").alias("key")))
    found = []
    if tokens:
        posted = rows.select(F.explode(F.concat(*tokens)).alias("key"), "number")
        for keys in frequent:  # few: each has over max_block or df_ratio of the records
            posted = posted.join(F.broadcast(keys), "key", "left_anti")
        found.append(posted)
    if "exact_name" in routes:
        named = rows.filter("name_norm <> ''").select(F.explode(F.array(*_exact_keys())).alias("key"), "number")
        rank = F.row_number().over(W.partitionBy("key").orderBy("number"))
        found.append(named.withColumn("rank", rank).filter(F.col("rank") <= config.max_block).select("key", "number"))
    out = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    place = (F.col("number") % (1 << blocks.PART_BITS)).cast("int")
    return out.groupBy("key", F.shiftright("number", blocks.PART_BITS).alias("part")).agg(F.collect_list(place).alias("ids"))


def _meet(queries: DataFrame, index: Index, config: RetrievalConfig, on: tuple[str, ...], best: int | None = None, counted: bool = False) -> DataFrame:
    """blocks.meet of the queries and the index by the routes ``on``."""
    routes = {r for r in on if r != "combined"} | ({"name_token", "address"} if "combined" in on else set())
    numbers, total = index.numbered()
    place = F.col("number") % (1 << blocks.PART_BITS)
    chunk = (place - place % blocks.NAMES).alias("first")
    names = numbers.groupBy(F.shiftright("number", blocks.PART_BITS).alias("part"), chunk).agg(F.array_sort(F.collect_list("entity_id")).alias("names"))
    rows, cells = blocks.cells(_asked(queries, index, config, routes), queries.count(), _postings(index, config, routes), names, total)
    return blocks.meet(rows, cells, on, best, counted)


def _route(queries: DataFrame, index: Index, config: RetrievalConfig, route: str) -> DataFrame:
    found = _meet(queries, index, config, (route,))
    return _hits(found.withColumnRenamed(f"__{route}", "score"), route)


def name_token(queries: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """Share of the query's usable rare tokens, repeats counted, that a record has."""
    return _route(queries, index, config, "name_token")


def address(queries: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """Share of the query's distinct address tokens; at least two must agree.  Oversized tokens count below the line only."""
    return _route(queries, index, config, "address")


def combined(queries: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """Records found by both the name-token and the address route, with the mean of the scores."""
    return _route(queries, index, config, "combined")


def fuzzy_name(queries: DataFrame, index: Index, config: RetrievalConfig, least: float = 0.5) -> DataFrame:
    """Jaccard similarity of the names' character trigrams, found through the rare ones, at least ``least``."""
    most = min(config.max_block, max(10, int(index.size() * config.df_ratio)))
    grams = index.records.select(F.col("entity_id").alias("cand"), trigrams(F.col("name_norm")).alias("cg"))
    posted = grams.select("cand", F.size("cg").alias("cn"), F.explode("cg").alias("gram"))
    rare = posted.groupBy("gram").count().filter(F.col("count") <= most).select("gram")
    asked = queries.select(F.col("entity_id").alias("s1"), trigrams(F.col("name_norm")).alias("qg"))
    pairs = asked.select("s1", F.explode("qg").alias("gram")).join(posted.join(rare, "gram").select("gram", "cand"), "gram").select("s1", "cand").distinct()
    scored = pairs.join(asked, "s1").join(grams, "cand")
    common = F.size(F.array_intersect("qg", "cg"))
    scored = scored.withColumn("score", common / (F.size("qg") + F.size("cg") - common))
    return _hits(scored.filter(F.col("score") >= least), "fuzzy_name")


ROUTES = {"exact_name": exact_name, "name_token": name_token, "address": address, "combined": combined, "fuzzy_name": fuzzy_name}


def hits(queries: DataFrame, index: Index, config: RetrievalConfig = RetrievalConfig()) -> DataFrame:
    """All hits (s1, cand, route, score) of the routes that are on; those that are off are absent from the plan."""
    out = None
    for route in config.routes:
        found = ROUTES[route](queries, index, config)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else queries.sparkSession.createDataFrame([], schemas.HITS)


def union(found: DataFrame) -> DataFrame:
    """One row per pair: sorted routes, their scores by route, and the sum.

    Each route has a column of its own, so the aggregation keeps plain numbers and no lists.
    """
    return _described(found.groupBy("s1", "cand").agg(*[F.max(F.when(F.col("route") == r, F.col("score"))).alias(f"__{r}") for r in sorted(ROUTES)]))


def _described(rows: DataFrame) -> DataFrame:
    """union() of pairs with a column of scores for each route, null where it did not find the pair."""
    of = {r: F.col(f"__{r}") if f"__{r}" in rows.columns else F.lit(None).cast("double") for r in sorted(ROUTES)}
    routes = F.filter(F.array(*[F.when(c.isNotNull(), F.lit(r)) for r, c in of.items()]), lambda x: x.isNotNull())
    entries = F.filter(F.array(*[F.struct(F.lit(r).alias("route"), c.alias("score")) for r, c in of.items()]), lambda x: x["score"].isNotNull())
    total = sum((F.coalesce(c, F.lit(0.0)) for c in of.values()), F.lit(0.0))
    count = sum((c.isNotNull().cast("long") for c in of.values()), F.lit(0))
    return rows.select("s1", "cand", routes.alias("routes"), F.map_from_entries(entries).alias("scores"), F.round(total, 12).alias("total"), count.cast("long").alias("n_routes"))


def ranked(pairs: DataFrame, cap: int | None) -> DataFrame:
    """Rank by more routes, higher sum, id; at most cap of each query stay.  ``found`` counts them before the cap."""
    order = [F.desc("n_routes"), F.desc("total"), F.asc("cand")]
    out = pairs.withColumn("rank", F.row_number().over(W.partitionBy("s1").orderBy(*order)).cast("long"))
    return out.filter(F.col("rank") <= cap) if cap is not None else out


def _blockwise(config: RetrievalConfig) -> bool:
    """Whether blocks.py knows all routes that are on; fuzzy names are compared by trigrams and joined."""
    return bool(config.routes) and set(config.routes) <= set(blocks.SCORES)


def best(queries: DataFrame, index: Index, config: RetrievalConfig, cap: int) -> DataFrame:
    """Ranked pairs, at most cap of each query: cells keep their best, and these are ranked."""
    if not _blockwise(config):
        return ranked(union(hits(queries, index, config)), cap)
    return ranked(_described(_meet(queries, index, config, config.routes, cap)), cap)


def candidates(queries: DataFrame, index: Index, config: RetrievalConfig = RetrievalConfig()) -> DataFrame:
    return best(queries, index, config, config.max_candidates)


def groups(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per query, without candidates too: the ids by rank."""
    listed = pairs.groupBy("s1").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand"))), lambda x: x["cand"]).alias("ids"))
    spine = queries.select(F.col("entity_id").alias("s1"), "row_ord")
    return spine.join(listed, "s1", "left").select("s1", "row_ord", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def statistics(queries: DataFrame, index: Index, config: RetrievalConfig) -> DataFrame:
    """Queries, pairs, mean, most, empty queries and queries over the cap."""
    cap = config.max_candidates
    if _blockwise(config):
        sizes = _meet(queries, index, config, config.routes, counted=True).groupBy("s1").agg(F.sum("pairs").alias("before"))
    else:
        sizes = union(hits(queries, index, config)).groupBy("s1").agg(F.count("*").alias("before"))
    sizes = queries.select(F.col("entity_id").alias("s1")).join(sizes, "s1", "left").select(F.coalesce("before", F.lit(0)).alias("before"))
    after = F.least("before", F.lit(cap))
    return sizes.agg(
        F.count("*").alias("s1_count"), F.sum(after).alias("pairs"), F.round(F.avg(after), 6).alias("mean_candidates"), F.max(after).cast("long").alias("max_candidates"),
        F.count_if(F.col("before") == 0).alias("empty_s1"), F.count_if(F.col("before") > cap).alias("over_cap"),
    )


def route_contribution(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode("routes").alias("route")).groupBy("route").agg(F.count("*").alias("pairs"))


def with_records(pairs: DataFrame, queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """The normalised columns of both sides with the prefixes q_ and c_; a candidate without a record stops the job."""
    columns = ["name_norm", "address_norm", "country_key", "name_tokens", "address_tokens"]
    q = queries.select(F.col("entity_id").alias("s1"), *[F.col(c).alias(f"q_{c}") for c in columns])
    c = corpus.select(F.col("entity_id").alias("cand"), *[F.col(c).alias(f"c_{c}") for c in columns], F.lit(True).alias("__found"))
    missing = F.raise_error(F.concat(F.lit("no record of "), F.col("cand")))
    joined = pairs.join(q, "s1").join(c, "cand", "left")
    return joined.withColumn("__found", F.coalesce(F.col("__found"), missing)).filter("__found").drop("__found")


def source_of(cand: Column) -> Column:
    return F.substring(cand, 2, 1).cast("int")
