"""DuckDB SQL that gives the rows of the registered queries, from the same tables."""

from __future__ import annotations

from ..config import STOPWORDS, RetrievalConfig, SamplingConfig
from ..functions.features import CHAR_RATIOS, NAMES


def _score(kind: str) -> str:
    value = {"f_half": "1.25 * common / (0.25 * true_n + pred_n)", "precision": "common / pred_n", "recall": "common / true_n"}[kind]
    return f"CASE WHEN true_n = 0 AND pred_n = 0 THEN 1.0 WHEN true_n = 0 OR pred_n = 0 THEN 0.0 ELSE ({value})::DOUBLE END"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def _contain(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / least(len(list_distinct({a})), len(list_distinct({b}))) END"


def _length(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE least(length({a}), length({b}))::DOUBLE / greatest(length({a}), length({b})) END"


def _key(column: str) -> str:
    return f"trim(regexp_replace(replace(replace(lower(coalesce({column}, '')), 'ß', 'ss'), '&', ' and '), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g'))"


def base(config: RetrievalConfig) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    words = lambda c: f"CASE WHEN {c} = '' THEN []::VARCHAR[] ELSE string_split({c}, ' ') END"
    grams = "CASE WHEN name_norm = '' THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, length(name_norm) + 1), lambda i: substr(' ' || name_norm || ' ', i, 3))) END"
    return f"""
WITH t AS (SELECT doc_id, lang, {_key("text")} AS n FROM documents),
w AS (SELECT doc_id, lang, {words("n")} AS w FROM t),
rec AS (
  SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, doc_id AS row_ord, coalesce(lang, '') AS country, array_to_string(w[1:6], ' ') AS name,
    array_to_string(w[greatest(len(w) - 7, 1):len(w)], ' ') AS address, array_to_string(w[1:8], ' ') AS head FROM w
),
norm AS (SELECT entity_id, row_ord, country, lower(country) AS country_key, head, name AS name_norm, address AS address_norm, {words("name")} AS nt, {words("address")} AS at_ FROM rec),
q AS (SELECT * FROM norm WHERE entity_id LIKE 'S1-%'), c AS (SELECT * FROM norm WHERE entity_id NOT LIKE 'S1-%'),
links AS (
  SELECT q.entity_id AS s1, c.entity_id AS cand FROM q JOIN c ON q.head = c.head WHERE q.head <> ''
  UNION SELECT q.entity_id, c.entity_id FROM q JOIN c ON q.address_norm = c.address_norm WHERE q.address_norm <> ''
),
n AS (SELECT count(*) AS n FROM c),
nt_post AS (SELECT DISTINCT entity_id, unnest(nt) AS token FROM c), at_post AS (SELECT DISTINCT entity_id, unnest(at_) AS token FROM c),
freq AS (SELECT token, count(*) AS df FROM nt_post GROUP BY token),
rare AS (SELECT token FROM freq, n WHERE length(token) >= {config.min_token} AND token NOT IN ({stop}) AND df <= greatest(10, floor(n.n * {config.df_ratio})) AND df <= {config.max_block}),
block2 AS (SELECT name_norm, country_key, entity_id, row_number() OVER (PARTITION BY name_norm, country_key ORDER BY entity_id) AS r FROM c WHERE name_norm <> ''),
block1 AS (SELECT name_norm, entity_id, row_number() OVER (PARTITION BY name_norm ORDER BY entity_id) AS r FROM c WHERE name_norm <> ''),
exact_name AS (
  SELECT q.entity_id AS s1, b.entity_id AS cand, 1.0::DOUBLE AS score FROM q JOIN block2 b ON q.name_norm = b.name_norm AND q.country_key = b.country_key WHERE q.country_key <> '' AND b.r <= {config.max_block}
  UNION ALL SELECT q.entity_id, b.entity_id, 1.0::DOUBLE FROM q JOIN block1 b ON q.name_norm = b.name_norm WHERE q.country_key = '' AND b.r <= {config.max_block}
),
nq AS (SELECT s1, token, count(*) AS k FROM (SELECT entity_id AS s1, unnest(nt) AS token FROM q) JOIN rare USING (token) GROUP BY s1, token),
nu AS (SELECT s1, sum(k) AS usable FROM nq GROUP BY s1),
name_token AS (SELECT s1, p.entity_id AS cand, sum(k)::DOUBLE / first(usable) AS score FROM nq JOIN nt_post p USING (token) JOIN nu USING (s1) GROUP BY s1, p.entity_id),
aq AS (SELECT DISTINCT entity_id AS s1, unnest(at_) AS token FROM q), aq2 AS (SELECT * FROM aq WHERE length(token) >= {config.min_token}),
au AS (SELECT s1, count(*) AS usable FROM aq2 GROUP BY s1),
ab AS (SELECT token FROM at_post GROUP BY token HAVING count(*) <= {config.max_block}),
address AS (SELECT s1, p.entity_id AS cand, count(*)::DOUBLE / first(usable) AS score FROM aq2 JOIN ab USING (token) JOIN at_post p USING (token) JOIN au USING (s1) GROUP BY s1, p.entity_id HAVING count(*) >= 2),
combined AS (SELECT s1, cand, (a.score + b.score) / 2 AS score FROM name_token a JOIN address b USING (s1, cand)),
gc AS (SELECT entity_id AS cand, {grams} AS g FROM c), gq AS (SELECT entity_id AS s1, {grams} AS g FROM q),
gp AS (SELECT cand, unnest(g) AS gram FROM gc), gr AS (SELECT gram FROM gp, n GROUP BY gram, n.n HAVING count(*) <= least({config.max_block}, greatest(10, floor(n.n * {config.df_ratio})))),
gpairs AS (SELECT DISTINCT x.s1, p.cand FROM (SELECT s1, unnest(g) AS gram FROM gq) x JOIN gr USING (gram) JOIN gp p USING (gram)),
gs AS (SELECT s1, cand, len(list_intersect(gq.g, gc.g)) AS k, len(gq.g) + len(gc.g) AS both_n FROM gpairs JOIN gq USING (s1) JOIN gc USING (cand)),
fuzzy_name AS (SELECT s1, cand, k::DOUBLE / (both_n - k) AS score FROM gs WHERE k::DOUBLE / (both_n - k) >= 0.5),
hits AS ({" UNION ALL ".join(f"SELECT s1, cand, '{r}' AS route, score FROM {r}" for r in config.routes)}),
pairs AS (SELECT s1, cand, string_agg(route, ',' ORDER BY route) AS routes, count(*) AS n_routes, round(sum(score), 12) AS total FROM hits GROUP BY s1, cand),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY n_routes DESC, total DESC, cand) AS rank FROM pairs),
cands AS (SELECT * FROM ranked WHERE rank <= {config.max_candidates}),
lists AS (SELECT q.entity_id AS s1, q.row_ord, coalesce(list(cand ORDER BY rank) FILTER (cand IS NOT NULL), []::VARCHAR[]) AS ids FROM q LEFT JOIN cands ON q.entity_id = cands.s1 GROUP BY ALL),
truth AS (SELECT q.entity_id AS s1, coalesce(list(cand ORDER BY cand) FILTER (cand IS NOT NULL), []::VARCHAR[]) AS ids FROM q LEFT JOIN links ON q.entity_id = links.s1 GROUP BY ALL),
both_sides AS (
  SELECT x.s1, x.cand, x.rank, x.n_routes, q.name_norm AS qn, c.name_norm AS cn, q.address_norm AS qa, c.address_norm AS ca, q.nt AS qnt, c.nt AS cnt, q.at_ AS qat, c.at_ AS cat,
    list_distinct(regexp_extract_all(array_to_string(list_concat(q.nt, q.at_), ' '), '\\p{{Nd}}+')) AS qd, list_distinct(regexp_extract_all(array_to_string(list_concat(c.nt, c.at_), ' '), '\\p{{Nd}}+')) AS cd
  FROM cands x JOIN q ON x.s1 = q.entity_id JOIN c ON x.cand = c.entity_id
),
scored AS (SELECT s1, cand, rank, {_jaccard("qnt", "cnt")} AS score FROM both_sides),
decided AS (SELECT q.entity_id AS s1, q.row_ord, coalesce(list(cand ORDER BY cand) FILTER (cand IS NOT NULL), []::VARCHAR[]) AS ids FROM q LEFT JOIN (SELECT * FROM scored WHERE score >= 0.6) x ON q.entity_id = x.s1 GROUP BY ALL),
counted AS (SELECT t.s1, len(t.ids) AS true_n, len(d.ids) AS pred_n, len(list_intersect(t.ids, d.ids)) AS common FROM truth t JOIN decided d USING (s1)),
val AS (SELECT entity_id AS s1, ('0x' || sha256('2026|' || entity_id)[1:16])::UBIGINT % 10 AS residue FROM q)
"""


def sql(config: RetrievalConfig, thresholds: list[float], sampling: SamplingConfig) -> dict[str, str]:
    cap = config.max_candidates
    measures = f"round(avg({_score('f_half')}), 6) AS macro_f_half, round(avg({_score('precision')}), 6) AS macro_precision, round(avg({_score('recall')}), 6) AS macro_recall"
    k = lambda s: f"(count(*) FILTER ({s}))::BIGINT"
    prefix = "CASE WHEN qn = '' OR cn = '' THEN 0.0 ELSE coalesce(list_position(list_transform(range(1, least(length(qn), length(cn)) + 1), lambda i: substr(qn, i, 1) <> substr(cn, i, 1)), true) - 1, least(length(qn), length(cn)))::DOUBLE / least(length(qn), length(cn)) END"
    flag = lambda s: f"({s})::INT::DOUBLE"
    feature = {
        "name_exact": flag("qn = cn AND qn <> ''"), "name_token_jaccard": _jaccard("qnt", "cnt"), "name_token_containment": _contain("qnt", "cnt"), "name_length_ratio": _length("qn", "cn"),
        "name_prefix_ratio": prefix, "s1_name_missing": flag("qn = ''"), "candidate_name_missing": flag("cn = ''"), "address_exact": flag("qa = ca AND qa <> ''"),
        "address_token_jaccard": _jaccard("qat", "cat"), "address_token_containment": _contain("qat", "cat"), "address_length_ratio": _length("qa", "ca"), "s1_address_missing": flag("qa = ''"),
        "candidate_address_missing": flag("ca = ''"), "both_addresses_missing": flag("qa = '' AND ca = ''"), "number_overlap_count": "len(list_intersect(qd, cd))::DOUBLE",
        "number_jaccard": _jaccard("qd", "cd"), "number_any_agreement": flag("len(list_intersect(qd, cd)) > 0"), "number_conflict": flag("len(qd) > 0 AND len(cd) > 0 AND list_sort(qd) <> list_sort(cd)"),
        "is_source2": flag("cand LIKE 'S2-%'"), "is_source3": flag("cand LIKE 'S3-%'"), "retrieval_route_count": "n_routes::DOUBLE",
    }
    native = ", ".join(f"round({feature[n]}, 6) AS {n}" for n in NAMES if n not in CHAR_RATIOS)
    chosen = f"""
labelled AS (SELECT x.s1, x.cand, x.rank, (l.cand IS NOT NULL)::BIGINT AS label FROM cands x JOIN val v ON x.s1 = v.s1 LEFT JOIN links l ON x.s1 = l.s1 AND x.cand = l.cand WHERE v.residue <> 0),
pooled AS (SELECT *, row_number() OVER (PARTITION BY s1, label ORDER BY rank, cand) AS place FROM labelled),
picked AS (SELECT *, row_number() OVER (PARTITION BY s1, label ORDER BY sha256('{sampling.seed}|' || s1 || '|' || cand), cand) AS pick FROM pooled WHERE label = 1 OR place <= {sampling.top_negative_pool}),
chosen AS (SELECT s1, cand, label FROM picked WHERE label = 1 OR pick <= {sampling.negatives_per_s1})
"""
    missed = "list_filter(t.ids, lambda x: NOT list_contains(d.ids, x))"
    errors = f"""
e AS (SELECT t.s1, t.ids AS t, d.ids AS p, l.ids AS c, list_sort({missed}) AS missed, list_sort(list_filter(d.ids, lambda x: NOT list_contains(t.ids, x))) AS wrong FROM truth t JOIN decided d USING (s1) JOIN lists l USING (s1)),
real AS (SELECT * FROM e WHERE NOT (len(t) = 0 AND len(p) > 0)),
errors AS (
  SELECT 'retrieval_miss' AS category, s1, unnest(list_filter(missed, lambda x: NOT list_contains(c, x))) AS detail FROM real
  UNION ALL SELECT 'scoring_false_negative', s1, unnest(list_filter(missed, lambda x: list_contains(c, x))) FROM real
  UNION ALL SELECT 'false_positive', s1, unnest(wrong) FROM real
  UNION ALL SELECT 'wrong_singleton', s1, missed[1] FROM real WHERE len(t) = 1 AND len(p) = 1 AND len(missed) = 1
  UNION ALL SELECT 'multi_match_partial', s1, array_to_string(missed[1:3], ',') FROM real WHERE len(t) > 1 AND len(missed) > 0
  UNION ALL SELECT 'empty_case_false_positive', s1, array_to_string(list_sort(p)[1:3], ',') FROM e WHERE len(t) = 0 AND len(p) > 0
)
"""
    sweep = " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS threshold, round(avg({_score('f_half')}), 6) AS macro_f_half FROM (SELECT t.s1, len(t.ids) AS true_n, count(x.cand) AS pred_n, count(l.cand) AS common FROM truth t LEFT JOIN (SELECT * FROM scored WHERE score >= {t}) x ON t.s1 = x.s1 LEFT JOIN links l ON x.s1 = l.s1 AND x.cand = l.cand GROUP BY t.s1, t.ids)"
        for t in thresholds
    )
    pair = lambda a, b: f"SELECT {a}::DOUBLE AS source2_threshold, {b}::DOUBLE AS source3_threshold, round(avg({_score('f_half')}), 6) AS macro_f_half FROM (SELECT t.s1, len(t.ids) AS true_n, count(x.cand) AS pred_n, count(l.cand) AS common FROM truth t LEFT JOIN (SELECT * FROM scored WHERE score >= CASE WHEN cand LIKE 'S2-%' THEN {a} ELSE {b} END) x ON t.s1 = x.s1 LEFT JOIN links l ON x.s1 = l.s1 AND x.cand = l.cand GROUP BY t.s1, t.ids)"
    of = lambda a, n: f"len(list_filter({a}, lambda x: x LIKE 'S{n}-%'))"
    rows = f"SELECT len(t.ids) AS t, len(list_intersect(t.ids, l.ids)) AS h, {of('t.ids', 2)} AS t2, {of('t.ids', 3)} AS t3, {of('list_intersect(t.ids, l.ids)', 2)} AS h2, {of('list_intersect(t.ids, l.ids)', 3)} AS h3 FROM truth t JOIN lists l USING (s1)"
    nan = lambda a, b: f"round(CASE WHEN {b} = 0 THEN 'NaN'::DOUBLE ELSE ({a})::DOUBLE / {b} END, 6)"
    oracle = "CASE WHEN t = 0 THEN 1.0 WHEN h = 0 THEN 0.0 ELSE 1.25 * h / (0.25 * t + h) END"
    found = r"""
faulty AS (
  SELECT s1, CASE WHEN row_ord % 5 = 0 THEN list_append(list_sort(ids), 'S2-none') WHEN row_ord % 7 = 0 THEN list_concat(list_sort(ids), ['X-1', 'X-1']) ELSE list_sort(ids) END AS ids FROM lists WHERE row_ord % 11 <> 0
  UNION ALL SELECT s1, list_sort(ids) FROM lists WHERE row_ord % 13 = 1
  UNION ALL SELECT s1 || '-x', []::VARCHAR[] FROM lists WHERE row_ord % 17 = 2
),
lost AS (SELECT entity_id AS s1 FROM q WHERE entity_id NOT IN (SELECT s1 FROM faulty)), spare AS (SELECT DISTINCT s1 FROM faulty WHERE s1 NOT IN (SELECT entity_id FROM q)),
french AS (SELECT DISTINCT entity_id AS s1 FROM q WHERE lower(trim(country)) = 'fr' AND entity_id NOT IN (SELECT s1 FROM faulty)),
merged AS (SELECT s1, flatten(list(ids)) AS ids FROM faulty GROUP BY s1),
odd AS (SELECT m.s1, list_sort(list_distinct(list_filter(m.ids, lambda x: NOT list_contains(coalesce(l.ids, []::VARCHAR[]), x)))) AS u FROM merged m LEFT JOIN lists l USING (s1)),
findings AS (
  SELECT s1, 'DUPLICATE_IDS' AS problem_type, array_to_string(list_distinct(list_filter(ids, lambda x: len(list_filter(ids, lambda y: y = x)) > 1)), ',') AS u FROM faulty WHERE len(ids) <> len(list_distinct(ids))
  UNION ALL SELECT s1, 'INVALID_ID_PREFIX', array_to_string(list_filter(ids, lambda x: NOT regexp_matches(x, '^S[23]-.+'))[1:10], ',') FROM faulty WHERE len(list_filter(ids, lambda x: NOT regexp_matches(x, '^S[23]-.+'))) > 0
  UNION ALL SELECT s1, 'UNKNOWN_S2S3_IDS', array_to_string(list_sort(list(DISTINCT id))[1:10], ',') FROM (SELECT s1, unnest(ids) AS id FROM faulty) f WHERE regexp_matches(f.id, '^S[23]-.+') AND f.id NOT IN (SELECT entity_id FROM c) GROUP BY s1
  UNION ALL SELECT s1, 'DUPLICATE_S1_ROW', '' FROM faulty GROUP BY s1 HAVING count(*) > 1
  UNION ALL SELECT NULL, 'MISSING_S1_ROWS', array_to_string(list_sort(list(s1))[1:10], ',') FROM lost HAVING count(*) > 0
  UNION ALL SELECT NULL, 'EXTRA_S1_ROWS', array_to_string(list_sort(list(s1))[1:10], ',') FROM spare HAVING count(*) > 0
  UNION ALL SELECT NULL, 'FR_COVERAGE', array_to_string(list_sort(list(s1))[1:10], ',') FROM french HAVING count(*) > 0
  UNION ALL SELECT s1, 'PREDICTION_NOT_SUBSET_OF_CANDIDATES', array_to_string(u[1:5], ',') FROM odd WHERE len(u) > 0
)
"""
    sample = """
picks AS (SELECT * FROM rec WHERE entity_id LIKE 'S1-%' ORDER BY row_ord LIMIT 20),
need AS (SELECT DISTINCT cand AS entity_id FROM links WHERE s1 IN (SELECT entity_id FROM picks)),
""" + ", ".join(
        f"must{n} AS (SELECT entity_id FROM rec WHERE entity_id LIKE 'S{n}-%' AND entity_id IN (SELECT entity_id FROM need)), "
        f"more{n} AS (SELECT entity_id, row_number() OVER (ORDER BY row_ord) AS r FROM rec WHERE entity_id LIKE 'S{n}-%' AND entity_id NOT IN (SELECT entity_id FROM need))"
        for n in (2, 3)
    )
    picked = "SELECT entity_id FROM picks" + "".join(f" UNION ALL SELECT entity_id FROM must{n} UNION ALL SELECT entity_id FROM more{n} WHERE r <= greatest(0, 20 - (SELECT count(*) FROM must{n}))" for n in (2, 3))
    body = {
        "normalize_records": "SELECT entity_id, name_norm, address_norm, country_key FROM norm",
        "country_keys": "SELECT country_key, count(*) AS records FROM norm GROUP BY country_key",
        "tokens": "SELECT entity_id, generate_subscripts(nt, 1) - 1 AS pos, unnest(nt) AS token FROM norm",
        "normalize_texts": f"SELECT 'p' || page_id AS key, {_key('html')} AS norm FROM pages UNION ALL SELECT 'c' || conv_id || '-' || turn, {_key('text')} FROM conversations UNION ALL SELECT 'b' || item_id, {_key('text')} FROM benchmark UNION ALL SELECT 'd' || doc_id, {_key('text')} FROM documents",
        "split_assignment": "SELECT s1 AS entity_id, residue::BIGINT AS residue, residue = 0 AS validation FROM val",
        "split_counts": "SELECT residue = 0 AS validation, count(*) AS records FROM val GROUP BY 1",
        "id_validation": "SELECT regexp_matches(id, '^S[123]-.+') AS valid, regexp_matches(id, '^S[23]-.+') AS candidate, count(*) AS ids FROM (SELECT unnest([entity_id, 'x' || entity_id, substr(entity_id, 1, 3), 'S4-' || entity_id]) AS id FROM rec) GROUP BY ALL",
        "postings_exact": "SELECT name_norm, country_key, entity_id FROM c WHERE name_norm <> ''",
        "postings_name_token": "SELECT token, entity_id FROM nt_post",
        "postings_address_token": "SELECT token, entity_id FROM at_post",
        "country_entities": "SELECT country_key, entity_id FROM c WHERE country_key <> ''",
        "token_doc_freq": "SELECT token, df FROM freq",
        "countries": "SELECT DISTINCT country_key FROM c WHERE country_key <> ''",
        "record_lookup": "SELECT entity_id, name_norm, country_key FROM c WHERE entity_id IN (SELECT cand FROM links)",
        **{f"route_{r}": f"SELECT s1, cand, round(score, 6) AS score FROM {r}" for r in ("exact_name", "name_token", "address", "combined", "fuzzy_name")},
        "candidate_pairs_ranked": "SELECT s1, cand, rank, n_routes, routes, round(total, 6) AS total FROM cands",
        "candidate_groups": "SELECT s1, array_to_string(ids, ',') AS candidates FROM lists",
        "route_contribution": "SELECT unnest(string_split(routes, ',')) AS route, count(*) AS pairs FROM cands GROUP BY 1",
        "retrieval_stats": f"SELECT count(*) AS s1_count, sum(least(k, {cap}))::BIGINT AS pairs, round(avg(least(k, {cap})), 6) AS mean_candidates, max(least(k, {cap})) AS max_candidates, {k('k = 0')} AS empty_s1, {k(f'k > {cap}')} AS over_cap FROM (SELECT count(cand) AS k FROM q LEFT JOIN pairs ON q.entity_id = pairs.s1 GROUP BY q.entity_id)",
        "cap_sweep": "SELECT cap, count(*) AS pairs, count(l.cand) AS edges_recalled FROM ranked r JOIN (SELECT unnest([16, 32, 64])::BIGINT AS cap) x ON r.rank <= x.cap LEFT JOIN links l ON r.s1 = l.s1 AND r.cand = l.cand GROUP BY cap",
        "features_native": f"SELECT s1, cand, {native} FROM both_sides",
        "training_pairs_hash": (chosen, "SELECT s1, cand, label FROM chosen"),
        "pair_counts": (
            chosen,
            f"SELECT (SELECT count(*) FROM val WHERE residue <> 0) AS groups, {k('label = 1')} AS positives, (SELECT count(*) FROM links l JOIN val v ON l.s1 = v.s1 AND v.residue <> 0 LEFT JOIN cands x ON l.s1 = x.s1 AND l.cand = x.cand WHERE x.cand IS NULL) AS missed_positives, {k('label = 0')} AS negatives, (SELECT count(*) FROM val WHERE residue = 0) AS skipped_validation FROM chosen",
        ),
        "decisions": "SELECT s1, array_to_string(ids, ',') AS matched FROM decided",
        "threshold_sweep": sweep,
        "threshold_sweep_by_source": " UNION ALL ".join(pair(a, b) for a in thresholds for b in thresholds),
        "strict_reader": "SELECT CASE WHEN row_ord % 9 = 0 OR row_ord % 10 = 0 THEN 'malformed' ELSE entity_id END AS s1, CASE WHEN row_ord % 9 = 0 THEN entity_id || chr(9) || 'S2-1,S3-2' || chr(9) || 'more' WHEN row_ord % 10 = 0 THEN entity_id WHEN row_ord % 4 = 0 THEN '' WHEN row_ord % 3 = 0 THEN 'S2-1,S2-1,,' ELSE 'S2-1,S3-2' END AS ids FROM rec",
        "lenient_reader": "SELECT entity_id AS s1, CASE WHEN row_ord % 9 = 0 THEN 'S2-1,S3-2' || chr(9) || 'more' WHEN row_ord % 10 = 0 THEN '' WHEN row_ord % 4 = 0 THEN '' WHEN row_ord % 3 = 0 THEN 'S2-1' ELSE 'S2-1,S3-2' END AS ids FROM rec",
        "eval_per_entity": f"SELECT s1, round({_score('f_half')}, 6) AS f_half, round({_score('precision')}, 6) AS precision, round({_score('recall')}, 6) AS recall FROM counted",
        "eval_macro": f"SELECT {measures}, count(*) AS total_s1, {k('true_n = 0')} AS true_empty, {k('pred_n = 0')} AS pred_empty, sum(pred_n - common)::BIGINT AS false_positives, sum(true_n - common)::BIGINT AS false_negatives, {k('true_n = 0 AND pred_n = 0')} AS singletons_correct, {nan(k('true_n = 0 AND pred_n = 0'), k('true_n = 0'))} AS singleton_accuracy FROM counted",
        "eval_by_country": f"SELECT q.country, count(*) AS total_s1, {measures} FROM counted JOIN q ON counted.s1 = q.entity_id WHERE q.country <> '' GROUP BY q.country",
        "candidate_eval": f"SELECT sum(t)::BIGINT AS true_edges, sum(h)::BIGINT AS edges_recalled, {nan('sum(h)', 'sum(t)')} AS edge_recall, {nan('sum(h2)', 'sum(t2)')} AS s2_recall, {nan('sum(h3)', 'sum(t3)')} AS s3_recall, {nan(k('t > 0 AND t = h'), k('t > 0'))} AS complete_recall, round(avg({oracle}), 6) AS oracle_macro_f_half FROM ({rows})",
        "candidate_distribution": "SELECT min(n)::BIGINT AS min_n, round(avg(n), 6) AS mean_n, max(n)::BIGINT AS max_n, quantile_disc(n, 0.5)::BIGINT AS p50, quantile_disc(n, 0.95)::BIGINT AS p95, quantile_disc(n, 0.99)::BIGINT AS p99, round(quantile_cont(n::DOUBLE, 0.5), 6) AS median FROM (SELECT len(ids) AS n FROM lists)",
        "reduction_ratios": "SELECT s1_count, pairs, round(pairs / (s1_count * total), 9) AS kept_ratio, round(1 - pairs / (s1_count * total), 9) AS reduction_ratio FROM (SELECT count(*) AS s1_count, sum(len(ids))::BIGINT AS pairs, (SELECT n FROM n)::DOUBLE AS total FROM lists)",
        "benchmark_stats": f"SELECT count(*) AS s1_count, sum(c)::BIGINT AS pairs, round(avg(c), 6) AS mean_n, round(quantile_cont(c::DOUBLE, 0.5), 6) AS median_n, min(c)::BIGINT AS min_n, max(c)::BIGINT AS max_n, round(1 - sum(c) / (count(*) * (SELECT n FROM n)::DOUBLE), 6) AS reduction_ratio, round(CASE WHEN sum(t) = 0 THEN 1.0 ELSE sum(h)::DOUBLE / sum(t) END, 6) AS edge_recall, round(CASE WHEN {k('t > 0')} = 0 THEN 1.0 ELSE {k('t > 0 AND t = h')}::DOUBLE / {k('t > 0')} END, 6) AS complete_coverage FROM (SELECT len(l.ids) AS c, len(t.ids) AS t, len(list_intersect(t.ids, l.ids)) AS h FROM lists l JOIN truth t USING (s1))",
        "oracle_check": f"SELECT model, oracle, model <= oracle + 1e-9 AS holds FROM (SELECT round(avg({_score('f_half')}), 6) AS model FROM counted), (SELECT round(avg({oracle}), 6) AS oracle FROM ({rows}))",
        "error_counts": (errors, "SELECT category, count(*) AS errors FROM errors GROUP BY category"),
        "error_examples": (errors, "SELECT category, s1, detail, place FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s1, detail) AS place FROM errors) WHERE place <= 10"),
        "matching_results": "SELECT row_ord, s1 || chr(9) || array_to_string(ids, ',') AS line FROM decided",
        "candidate_file": "SELECT row_ord, s1 || chr(9) || array_to_string(list_sort(ids), ',') AS line FROM lists",
        "validate_findings": (found, "SELECT problem_type, count(*) AS findings, min(s1) AS first_s1, min(u) AS first_ids FROM findings GROUP BY problem_type"),
        "coverage_check": f"SELECT count(*) AS total_s1, {k('shown')} AS output_s1, {k('NOT shown')} AS missing, 0::BIGINT AS extra, {k('fr')} AS label_total, {k('fr AND shown')} AS label_in_output, {k('fr AND NOT shown')} AS label_missing, coalesce(array_to_string((list(s1 ORDER BY s1) FILTER (NOT shown))[1:10], ','), '') AS missing_examples, '' AS extra_examples FROM (SELECT d.s1, len(d.ids) > 0 AS shown, lower(trim(q.country)) = 'fr' AS fr FROM q JOIN decided d ON q.entity_id = d.s1)",
        "data_audit": f"SELECT substr(entity_id, 1, 2) AS source, country, count(*) AS records, {k(chr(34) + 'name' + chr(34) + ' = ' + chr(39) * 2)} AS empty_names, {k('address = ' + chr(39) * 2)} AS empty_addresses, 0::BIGINT AS bad_ids FROM rec GROUP BY ALL",
        "match_length_histogram": "SELECT len(ids) AS links, count(*) AS queries FROM truth GROUP BY 1",
        "benchmark_sample": (sample, picked),
    }
    head = base(config)
    out = {name: head + (f", {b[0]} {b[1]}" if isinstance(b, tuple) else b) for name, b in body.items()}
    out["scale_data"] = """
WITH s AS (
  SELECT 1 AS k, i FROM range(100) r(i) UNION ALL SELECT 2, i FROM range(1000) r(i) UNION ALL SELECT 3, i FROM range(1000) r(i)
)
SELECT 'S' || k || '-' || i AS entity_id, 'Business ' || i AS business_name, i || ' Main Street' AS business_address, (CASE WHEN k > 1 THEN -1 WHEN i < 80 THEN 2 ELSE 0 END)::BIGINT AS links FROM s
"""
    return out
