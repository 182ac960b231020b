"""Queries over the driver's tables, one or more for each operator of the matching engine, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .config import ADDRESS, FEATURES, LEGAL, SAMPLE_TREES, SWEEP, MatchConfig
from .functions import normalize as N
from .functions.lists import jaccard, join_ids, overlap, parse_ids
from .functions.similarity import lcs_column, partial_udf, ratio_udf, token_set_udf, token_sort_udf
from .operators import blocking as B
from .operators import evaluation as E
from .operators import profiling as P
from .operators import passes as G
from .operators import tfidf as TF
from .operators import training as T
from .operators import trees as TR
from .operators.features import pair_attributes, pair_features, spread
from .operators.records import normalize_records
from .operators.scoring import accept, assemble, fallback_score, resolved_threshold
from .operators.validation import CANDIDATE_HEADER, MATCH_HEADER, exit_code, list_findings, result_rows, subset_findings, validate
from .plans.matching import compare_records, cross_validate, match_chosen
from .sources.adapters import biz_records, ground_truth, of_source
from .sources.scratch import materialize, materialize_all, scratch
from .sources.tsv import filtered_scan, first_by_key, first_rows, last_by_key, read_ids, read_lines, read_tsv, run_summary, with_ordinal, write_candidate_pairs, write_matching_results
from .streaming.arrivals import match_arrivals

CONFIG = MatchConfig()
#: A cap at which the small tables have hot keys.
SMALL_CAP = MatchConfig(max_key_freq=20)


# --- inputs -------------------------------------------------------------------------------------------------------------


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def records(spark: SparkSession, d: str) -> DataFrame:
    """Normalized records, computed once however often a plan (or the next query) reads them; evicted parts are recomputed."""
    return normalize_records(biz_records(spark, d)).persist()


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = records(spark, d)
    return of_source(r, 1), r.where(~F.col("entity_id").startswith("S1-"))


def targets(spark: SparkSession, d: str) -> DataFrame:
    return sides(spark, d)[1]


def first_hits(spark: SparkSession, d: str) -> DataFrame:
    s1, s23 = sides(spark, d)
    return B.hits(B.postings(s1), B.prune_hot_keys(B.postings(s23)))


def best_first_hits(spark: SparkSession, d: str) -> DataFrame:
    s1, s23 = sides(spark, d)
    return B.best_hits(B.postings(s1), B.prune_hot_keys(B.postings(s23)))


def cut_pairs(spark: SparkSession, d: str) -> DataFrame:
    s1, s23 = sides(spark, d)
    return B.Blocker().fit(s23).pairs(s1)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    s1, s23 = sides(spark, d)
    return B.Blocker().fit(s23).candidates(s1)


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with the fallback score, without the features that it does not need."""
    c = candidates(spark, d).withColumn("country_match", F.when(F.col("s1_country") == F.col("c_country"), 1.0).otherwise(0.0))
    return c.withColumnsRenamed({"name_sim": "name_token_set", "addr_sim": "addr_token_set"}).withColumn("prob", fallback_score())


def truth(spark: SparkSession, d: str) -> DataFrame:
    return E.truth_sets(ground_truth(biz_records(spark, d)))


def results(spark: SparkSession, d: str) -> DataFrame:
    return assemble(sides(spark, d)[0], scored(spark, d), CONFIG.fallback_threshold)


# --- SQL pieces ---------------------------------------------------------------------------------------------------------


def sql_map(words: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in words.items()) + "}"


def sql_clean(x: str) -> str:
    return f"trim(regexp_replace(replace(strip_accents(lower(coalesce({x}, ''))), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def sql_expand(x: str, words: dict[str, str]) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: coalesce(map_extract_value({sql_map(words)}, t), t)), ' ')"


def sql_country(x: str) -> str:
    u = f"upper(trim(coalesce({x}, '')))"
    return f"CASE WHEN {u} = '' THEN 'UNKNOWN' WHEN {u} IN ('INDIA', 'IN', 'IND') THEN 'INDIA' WHEN {u} IN ('US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA') THEN 'US' WHEN {u} IN ('FR', 'FRA', 'FRANCE') THEN 'FRANCE' ELSE {u} END"


def sql_lcs(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_reduce(range(1, length({a}) + 1), lambda row_, i: list_reduce(range(1, length({b}) + 1), "
        f"lambda n_, j: list_append(n_, CASE WHEN substring({a}, i, 1) = substring({b}, j, 1) THEN row_[j] + 1 ELSE greatest(row_[j + 1], n_[j]) END), [0::BIGINT]), "
        f"list_resize([0::BIGINT], length({b}) + 1, 0::BIGINT))[length({b}) + 1] END"
    )


def sql_ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 ELSE 2.0 * ({sql_lcs(a, b)}) / (length({a}) + length({b})) END"


def sql_lcs_bits(m: str, marks: str) -> str:
    """Length of a longest common subsequence, by adding bits: ``m`` is one side's length (at most 120), ``marks`` has, for each
    character of the other side, the places on the first one that hold it."""
    ones = f"((1::HUGEINT << {m}::INT) - 1)"
    step = f"(((v + (v & k)) | (v - (v & k))) & {ones})"
    return f"({m} - bit_count(list_reduce({marks}, lambda v, k: {step}, {ones})))"


def sql_rows(names: str, rows) -> str:
    """A table of literal rows as a subquery."""
    cells = lambda r: ", ".join("NULL" if x is None else repr(x) if isinstance(x, (int, float)) else f"'{x}'" for x in r)
    return "(SELECT * FROM (VALUES " + ", ".join(f"({cells(r)})" for r in rows) + f") AS t({names}))"


def sql_sorted(a: str) -> str:
    return f"array_to_string(list_sort(string_split({a}, ' ')), ' ')"


def sql_token_set(src: str, a: str, b: str, name: str) -> str:
    """CTEs that add column ``name`` to ``src`` as table ``name``_t."""
    t = name + "_"
    return f"""
{t}1 AS (SELECT *, list_filter(list_distinct(string_split({a}, ' ')), lambda z: z <> '') AS {t}a, list_filter(list_distinct(string_split({b}, ' ')), lambda z: z <> '') AS {t}b FROM {src}),
{t}2 AS (SELECT *, array_to_string(list_sort(list_filter({t}a, lambda z: list_contains({t}b, z))), ' ') AS {t}i,
  array_to_string(list_sort(list_filter({t}a, lambda z: NOT list_contains({t}b, z))), ' ') AS {t}x,
  array_to_string(list_sort(list_filter({t}b, lambda z: NOT list_contains({t}a, z))), ' ') AS {t}y FROM {t}1),
{t}3 AS (SELECT *, {sql_lcs(t + "x", t + "y")} AS {t}l, length({t}i) AS {t}s, length({t}x) AS {t}la, length({t}y) AS {t}lb FROM {t}2),
{t}4 AS (SELECT *, {t}s + (CASE WHEN {t}s > 0 THEN 1 ELSE 0 END) + {t}la AS {t}fa, {t}s + (CASE WHEN {t}s > 0 THEN 1 ELSE 0 END) + {t}lb AS {t}fb FROM {t}3),
{t}t AS (SELECT * EXCLUDE ({t}a, {t}b, {t}i, {t}x, {t}y, {t}l, {t}s, {t}la, {t}lb, {t}fa, {t}fb),
  CASE WHEN len({t}a) = 0 OR len({t}b) = 0 THEN 0.0::DOUBLE WHEN {t}s > 0 AND ({t}x = '' OR {t}y = '') THEN 1.0::DOUBLE
    WHEN {t}s = 0 THEN 1.0::DOUBLE - ({t}la + {t}lb - 2 * {t}l)::DOUBLE / greatest({t}fa + {t}fb, 1)
    ELSE greatest(1.0::DOUBLE - ({t}la + {t}lb - 2 * {t}l)::DOUBLE / greatest({t}fa + {t}fb, 1), 1.0::DOUBLE - (1 + {t}la)::DOUBLE / ({t}s + {t}fa), 1.0::DOUBLE - (1 + {t}lb)::DOUBLE / ({t}s + {t}fb)) END AS {name}
  FROM {t}4)"""


_W = f"string_split({sql_clean('text')}, ' ')"
BIZ = f"""
w AS (SELECT doc_id, lang, source, n_chars, md5(coalesce(text, '')) AS copy_of, {_W} AS w FROM documents),
biz AS (SELECT 'S' || (CAST(substr(source, 4) AS INT) % 3 + 1) || '-' || doc_id AS entity_id,
  trim(array_to_string(w[1:4], ' ') || ' ' || ['', 'pvt ltd', 'corp', 'sarl', 'inc'][doc_id % 5 + 1]) AS business_name,
  n_chars || ' ' || ['rd', 'st', 'ave', 'blvd'][doc_id % 4 + 1] || ' ' || array_to_string(w[5:14], ' ') AS business_address,
  lang AS country, doc_id AS ordinal, copy_of FROM w)"""
NORM = f"""{BIZ},
norm AS (SELECT entity_id, ordinal, copy_of, {sql_expand(sql_clean("business_name"), LEGAL)} AS norm_name, {sql_expand(sql_clean("business_address"), {**LEGAL, **ADDRESS})} AS norm_addr, {sql_country("country")} AS norm_country FROM biz),
recs AS (SELECT *, list_filter(string_split(norm_addr, ' '), lambda t: regexp_full_match(t, '[0-9]+')) AS addr_numbers FROM norm)"""
POSTINGS = f"""{NORM},
toks AS (SELECT *, list_filter(string_split(norm_name, ' '), lambda z: length(z) >= 3) AS tk FROM recs),
postings AS (
  SELECT entity_id, norm_country AS country, 'pfx4' AS kind, substr(norm_name, 1, 4) AS key, 2 AS weight FROM toks WHERE length(norm_name) >= 4
  UNION ALL SELECT entity_id, norm_country, 'pfx3', norm_name, 2 FROM toks WHERE length(norm_name) = 3
  UNION ALL SELECT entity_id, norm_country, 'tok', unnest((list_filter(tk, lambda z, i: list_position(tk, z) = i))[1:4]), 1 FROM toks
  UNION ALL SELECT entity_id, norm_country, 'num', unnest(list_filter(addr_numbers[1:2], lambda z: length(z) >= 2)), 1 FROM toks)"""


def _hits_sql(cap: int = CONFIG.max_key_freq) -> str:
    return f"""{POSTINGS},
hot AS (SELECT country, kind, key FROM postings WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL HAVING count(*) > {cap}),
idx AS (SELECT * FROM postings ANTI JOIN hot USING (country, kind, key) WHERE entity_id NOT LIKE 'S1-%'),
hits AS (SELECT q.entity_id AS s1_id, i.entity_id AS cand_id, CAST(sum(q.weight) AS BIGINT) AS hits FROM postings q JOIN idx i USING (country, kind, key) WHERE q.entity_id LIKE 'S1-%' GROUP BY ALL)"""


HITS = _hits_sql()
CUT = f"""{HITS},
top12 AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY hits DESC, cand_id) AS r FROM hits) WHERE r <= 12),
cut AS (SELECT t.*, a.norm_name AS s1_name, a.norm_addr AS s1_addr, a.norm_country AS s1_country, a.addr_numbers AS s1_nums, b.norm_name AS c_name, b.norm_addr AS c_addr, b.norm_country AS c_country, b.addr_numbers AS c_nums
  FROM top12 t JOIN recs a ON a.entity_id = s1_id JOIN recs b ON b.entity_id = cand_id)"""
CANDIDATES = f"""{CUT},
{sql_token_set("cut", "s1_name", "c_name", "name_sim")},
floored AS (SELECT * FROM name_sim_t WHERE name_sim >= 0.25),
{sql_token_set("floored", "s1_addr", "c_addr", "addr_sim")},
combined AS (SELECT *, round(0.65::DOUBLE * name_sim + 0.35::DOUBLE * addr_sim, 9) AS score FROM addr_sim_t),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, hits DESC, cand_id) AS rank FROM combined WHERE score >= 0.30 OR name_sim >= 0.70) WHERE rank <= 8)"""
SCORED = f"""{CANDIDATES},
scored AS (SELECT *, round(0.60::DOUBLE * name_sim + 0.30::DOUBLE * addr_sim + 0.10::DOUBLE * (CASE WHEN s1_country = c_country THEN 1.0 ELSE 0.0 END), 9) AS prob FROM cands)"""
TRUTH = """
gt AS (SELECT s.entity_id AS s1_id, list(DISTINCT o.entity_id) FILTER (o.entity_id IS NOT NULL) AS ids FROM (SELECT * FROM biz WHERE entity_id LIKE 'S1-%') s LEFT JOIN (SELECT * FROM biz WHERE entity_id NOT LIKE 'S1-%') o USING (copy_of) GROUP BY 1),
truth AS (SELECT s1_id, coalesce(ids, []) AS truth FROM gt)"""
F05 = """CASE WHEN len(truth) = 0 AND len(pred) = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / len(pred)) * (tp / len(truth)) / (0.25 * (tp / len(pred)) + tp / len(truth)) END AS f05,
  CASE WHEN len(truth) = 0 AND len(pred) = 0 THEN 1.0 WHEN len(pred) = 0 THEN 0.0 ELSE tp / len(pred) END AS precision,
  CASE WHEN len(truth) = 0 AND len(pred) = 0 THEN 1.0 WHEN len(truth) = 0 THEN 0.0 ELSE tp / len(truth) END AS recall"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# --- normalization ------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, md5(strip_accents(lower(coalesce(text, '')))) AS unaccented FROM documents")
def n03_unaccent(spark, d):
    return docs(spark, d).select("doc_id", F.md5(N.unaccent(F.lower(F.coalesce("text", F.lit("")))).cast("binary")).alias("unaccented"))


@query(f"SELECT doc_id, md5({sql_clean('text')}) AS cleaned, length({sql_clean('text')}) AS n FROM documents")
def n08_clean_basic(spark, d):
    c = N.with_clean(docs(spark, d), {"c": "text"})
    return c.select("doc_id", F.md5(F.col("c").cast("binary")).alias("cleaned"), F.length("c").cast("long").alias("n"))


@query(f"WITH {BIZ} SELECT entity_id, {sql_expand(sql_clean('business_name'), LEGAL)} AS expanded FROM biz")
def n09_legal_expand(spark, d):
    return N.with_normalized(biz_records(spark, d), {"expanded": "business_name"}, {}).select("entity_id", "expanded")


@query(f"WITH {BIZ} SELECT entity_id, {sql_expand(sql_clean('business_address'), {**LEGAL, **ADDRESS})} AS expanded FROM biz")
def n10_addr_expand(spark, d):
    return N.with_normalized(biz_records(spark, d), {}, {"expanded": "business_address"}).select("entity_id", "expanded")


@query(f"SELECT doc_id, md5({sql_expand(sql_clean('text'), LEGAL)}) AS norm_name FROM documents")
def n11_name_norm(spark, d):
    return N.with_normalized(docs(spark, d), {"n": "text"}, {}).select("doc_id", F.md5(F.col("n").cast("binary")).alias("norm_name"))


@query(f"SELECT doc_id, md5({sql_sorted(sql_expand(sql_clean('text'), LEGAL))}) AS sorted_name FROM documents")
def n12_token_sort(spark, d):
    return N.with_normalized(docs(spark, d), {"n": "text"}, {}).select("doc_id", F.md5(N.sort_tokens("n").cast("binary")).alias("sorted_name"))


@query(f"SELECT doc_id, md5({sql_expand(sql_clean('text'), {**LEGAL, **ADDRESS})}) AS norm_addr FROM documents")
def n13_addr_norm(spark, d):
    return N.with_normalized(docs(spark, d), {}, {"n": "text"}).select("doc_id", F.md5(F.col("n").cast("binary")).alias("norm_addr"))


@query(f"SELECT doc_id, array_to_string(list_filter(string_split({sql_clean('text')}, ' '), lambda t: regexp_full_match(t, '[0-9]+')), ',') AS numbers FROM documents")
def n14_numbers(spark, d):
    return N.with_clean(docs(spark, d), {"n": "text"}).select("doc_id", F.array_join(N.numeric_tokens("n"), ",").alias("numbers"))


COUNTRY_SAMPLES = ["India", " in ", "IND", "usa", "United States", "us", "fr", "FRANCE", "de", "", "  ", "unknown"]


@query(
    f"SELECT n_nationkey, {sql_country('c')} AS country FROM (SELECT n_nationkey, n_name AS c FROM nation UNION ALL SELECT -1 - i, s[i + 1] FROM (SELECT {COUNTRY_SAMPLES!r} AS s), range({len(COUNTRY_SAMPLES)}) t(i) UNION ALL SELECT -100, NULL)"
)
def n15_country(spark, d):
    names = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("long"), F.col("n_name").alias("c"))
    more = spark.createDataFrame([(-1 - i, c) for i, c in enumerate(COUNTRY_SAMPLES)] + [(-100, None)], "n_nationkey long, c string")
    return names.union(more).select("n_nationkey", N.normalize_country("c").alias("country"))


@query(f"WITH {NORM} SELECT entity_id, norm_name, {sql_sorted('norm_name')} AS sorted_name, norm_addr, norm_country, array_to_string(addr_numbers, ',') AS addr_numbers FROM recs")
def n16_normalize_records(spark, d):
    return records(spark, d).select("entity_id", "norm_name", "sorted_name", "norm_addr", "norm_country", F.array_join("addr_numbers", ",").alias("addr_numbers"))


@query("SELECT doc_id, len(list_filter(string_split(lower(coalesce(text, '')), ' '), lambda t: t NOT IN ('the', 'and', 'of', 'in', 'at', 'on', 'for', 'to', 'a', 'an', 'by', 'de', 'la', 'le', 'et', 'du', 'des', 'en', 'les'))) AS n FROM documents WHERE coalesce(text, '') <> ''")
def n17_drop_fillers(spark, d):
    kept = N.drop_fillers(F.lower(F.coalesce("text", F.lit(""))))
    return docs(spark, d).where("coalesce(text, '') <> ''").select("doc_id", F.size(F.split(kept, " ", -1)).cast("long").alias("n"))


# --- lists, sources -----------------------------------------------------------------------------------------------------


RAGGED = "concat(' S2-', doc_id, ' ,, S3-', doc_id % 7, ',S2-', doc_id, ', ')"


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'S2-' || doc_id || ',S3-' || doc_id % 7 END AS ids, CAST(CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n FROM documents")
def p13_parse_id_list(spark, d):
    ids = parse_ids(F.expr(f"CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 5 THEN '  ' ELSE {RAGGED} END"))
    return docs(spark, d).select("doc_id", F.array_join(ids, ",").alias("ids"), F.size(ids).cast("long").alias("n"))


@query(f"WITH {BIZ}, {TRUTH.strip()} SELECT s1_id AS source1_entity_id, array_to_string(list_sort(truth), ',') AS matched_entity_ids FROM truth")
def m11_ground_truth(spark, d):
    t = truth(spark, d)
    return t.select(F.col("s1_id").alias("source1_entity_id"), join_ids(F.col("truth")).alias("matched_entity_ids"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def s03_dedupe_first(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type")
    return first_by_key(e, "user_id", "event_id")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, min(event_id) AS event_id FROM events GROUP BY user_id")
def s03_dedupe_last(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type")
    return last_by_key(e, "user_id", "event_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id < 50")
def src02_first_rows(spark, d):
    return first_rows(docs(spark, d).select("doc_id", "lang"), 50, "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id % 100 < 15 OR doc_id IN (SELECT doc_id FROM labels)")
def src03_filtered_scan(spark, d):
    needed = spark.read.parquet(f"{d}/labels.parquet").select("doc_id")
    return filtered_scan(docs(spark, d).select("doc_id", "source", F.col("doc_id").alias("ordinal")), needed, 100, 15, "doc_id").select("doc_id", "source")


@query(f"WITH {BIZ} SELECT * EXCLUDE (copy_of) FROM biz")
def src04_biz_records(spark, d):
    return biz_records(spark, d).drop("copy_of")


@query(f"WITH {BIZ} SELECT substr(entity_id, 1, 2) AS source, count(*) AS n FROM (SELECT * FROM biz WHERE entity_id LIKE 'S2-%' UNION ALL SELECT * FROM biz WHERE entity_id LIKE 'S3-%') GROUP BY 1")
def s01_union_targets(spark, d):
    r = biz_records(spark, d)
    return of_source(r, 2).unionByName(of_source(r, 3)).groupBy(F.substring("entity_id", 1, 2).alias("source")).agg(F.count(F.lit(1)).alias("n"))


# --- blocking -----------------------------------------------------------------------------------------------------------


@query(f"WITH {POSTINGS} SELECT entity_id, country, kind, key, weight FROM postings")
def b02_postings(spark, d):
    return B.postings(records(spark, d))


@query(f"WITH {POSTINGS} SELECT country, kind, key, count(*) AS n FROM postings WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL")
def a02_key_counts(spark, d):
    return B.key_counts(B.postings(targets(spark, d)))


@query(f"WITH {_hits_sql(SMALL_CAP.max_key_freq)} SELECT entity_id, country, kind, key FROM idx")
def b07_hot_key_prune(spark, d):
    return B.prune_hot_keys(B.postings(targets(spark, d)), SMALL_CAP).select("entity_id", "country", "kind", "key")


@query(f"WITH {HITS} SELECT * FROM hits")
def a03_hits(spark, d):
    return first_hits(spark, d)


@query(f"WITH {CUT} SELECT * FROM top12")
def r01_top12(spark, d):
    return best_first_hits(spark, d)


@query(f"WITH {CANDIDATES} SELECT s1_id, cand_id, hits, round(name_sim, 6) AS name_sim, round(addr_sim, 6) AS addr_sim, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM cands")
def r02_candidates(spark, d):
    return candidates(spark, d).select("s1_id", "cand_id", "hits", r6("name_sim"), r6("addr_sim"), r6("score"), "rank")


@query(f"WITH {CANDIDATES}, lists AS (SELECT s1_id, string_agg(cand_id, ',' ORDER BY rank) AS l FROM cands GROUP BY 1) SELECT entity_id AS source1_entity_id, coalesce(l, '') AS candidate_entity_ids FROM recs LEFT JOIN lists ON entity_id = s1_id WHERE entity_id LIKE 'S1-%'")
def snk02_candidate_pairs(spark, d):
    lists = B.candidate_lists(sides(spark, d)[0], candidates(spark, d))
    return lists.select(F.col("s1_id").alias("source1_entity_id"), F.array_join("candidates", ",").alias("candidate_entity_ids"))


# --- further passes of blocking -----------------------------------------------------------------------------------------

_TFIDF = """
tn AS (SELECT norm_country AS c, norm_name AS n, bool_or(entity_id LIKE 'S1-%') AS asked, bool_or(entity_id NOT LIKE 'S1-%') AS held FROM recs WHERE norm_name <> '' GROUP BY ALL),
tg AS (SELECT c, n, gram, count(*) AS tf FROM (SELECT c, n, unnest(list_transform(range(1, length(n) + 1), lambda i: substr(' ' || n || ' ', i, 3))) AS gram FROM tn) GROUP BY ALL),
ti AS (SELECT gram, ln((1 + (SELECT count(*) FROM tn))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tg GROUP BY gram),
tw AS (SELECT c, n, gram, tf * idf AS w FROM tg JOIN ti USING (gram)),
tu AS (SELECT c, n, gram, w / sqrt(sum(w * w) OVER (PARTITION BY c, n)) AS w FROM tw),
tc AS (SELECT a.c, a.n AS an, b.n AS bn, round(sum(a.w * b.w), 9) AS cosine
  FROM (SELECT * FROM tu SEMI JOIN (SELECT c, n FROM tn WHERE asked) USING (c, n)) a JOIN (SELECT * FROM tu SEMI JOIN (SELECT c, n FROM tn WHERE held) USING (c, n)) b ON a.c = b.c AND a.gram = b.gram GROUP BY ALL),
tfidf AS (SELECT * FROM (SELECT s.entity_id AS s1_id, t.entity_id AS cand_id, cosine, row_number() OVER (PARTITION BY s.entity_id ORDER BY cosine DESC, t.entity_id) AS rank
  FROM tc JOIN recs s ON s.norm_country = c AND s.norm_name = an JOIN recs t ON t.norm_country = c AND t.norm_name = bn WHERE cosine >= 0.5 AND s.entity_id LIKE 'S1-%' AND t.entity_id NOT LIKE 'S1-%') WHERE rank <= 8)"""


@query(f"WITH {NORM}, {_TFIDF} SELECT s1_id, cand_id, round(cosine, 6) AS cosine, rank::INTEGER AS rank FROM tfidf")
def b12_tfidf_cosine(spark, d):
    """The eight targets of each record with the greatest cosines of character trigrams."""
    return TF.cosine_candidates(*sides(spark, d)).select("s1_id", "cand_id", r6("cosine"), "rank")


_SORTED = """
so AS (SELECT entity_id, norm_country, row_number() OVER (ORDER BY norm_country NULLS FIRST, norm_name NULLS FIRST, norm_addr NULLS FIRST, entity_id) AS p FROM recs),
neighbours AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, abs(a.p - b.p)::INTEGER AS distance FROM so a JOIN so b ON b.p BETWEEN a.p - 4 AND a.p + 4 AND a.norm_country = b.norm_country WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"""


@query(f"WITH {NORM}, {_SORTED} SELECT * FROM neighbours")
def b13_sorted_neighbourhood(spark, d):
    return G.sorted_neighbourhood(*sides(spark, d))


#: Sound classes of a to z (7: passed over), then those of digits.
_SOUNDS = "translate(t, 'abcdefghijklmnopqrstuvwxyz0123456789', '012301270224550126230172020000000000')"


def sql_soundex(t: str) -> str:
    x = _SOUNDS.replace("translate(t,", f"translate({t},")
    x = f"substr({x}, 1, 1) || replace(substr({x}, 2), '7', '')"
    for k in range(1, 7):
        x = f"regexp_replace({x}, '{k}+', '{k}', 'g')"
    return f"upper(substr({t}, 1, 1)) || rpad(substr(replace(substr({x}, 2), '0', ''), 1, 3), 3, '0')"


def sql_codes(name: str) -> str:
    return f"list_distinct(list_transform(list_filter(string_split({name}, ' '), lambda t: length(t) >= 3 AND regexp_matches(t, '^[a-z]')), lambda t: {sql_soundex('t')}))"


_PHONETIC = f"""
sk AS (SELECT DISTINCT entity_id, country, substr(code, 1, i - 1) || '*' || substr(code, i + 1) AS key FROM (SELECT entity_id, norm_country AS country, unnest({sql_codes("norm_name")}) AS code FROM recs), (VALUES (2), (3), (4)) AS v(i)),
sh AS (SELECT country, key FROM sk WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL HAVING count(*) > {CONFIG.max_key_freq}),
phonetic AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY hits DESC, cand_id) AS rank FROM (
  SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, count(*) AS hits FROM sk a JOIN (SELECT * FROM sk ANTI JOIN sh USING (country, key)) b USING (country, key) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY ALL)) WHERE rank <= 12)"""


@query(f"WITH {NORM}, {_PHONETIC} SELECT s1_id, cand_id, hits FROM phonetic")
def b14_phonetic_pass(spark, d):
    """Targets whose names sound most alike: equal codes, and codes one sound apart."""
    return G.phonetic_candidates(*sides(spark, d))


@query(
    f"WITH {CUT}, codes AS (SELECT s1_id, cand_id, {sql_codes('s1_name')} AS a, {sql_codes('c_name')} AS b FROM cut) SELECT s1_id, cand_id, round(CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS phonetic_overlap FROM codes"
)
def x22_phonetic_overlap(spark, d):
    """A feature beyond the 21: overlap of the names' codes."""
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(G.phonetic_overlap(F.col("s1_name"), F.col("c_name")), 6).alias("phonetic_overlap"))


_EDGES = f"""{CANDIDATES}, {_TFIDF}, {_SORTED}, {_PHONETIC},
passes AS (SELECT s1_id, cand_id, score, 'keys' AS pass FROM cands UNION ALL SELECT s1_id, cand_id, cosine, 'cosine' FROM tfidf
  UNION ALL SELECT s1_id, cand_id, 1 - distance / 5::DOUBLE, 'sorted' FROM neighbours UNION ALL SELECT s1_id, cand_id, least(hits, 12) / 12::DOUBLE, 'phonetic' FROM phonetic),
edges AS (SELECT s1_id, cand_id, sum(round(score * 1000000)::BIGINT)::BIGINT AS weight, string_agg(pass, ',' ORDER BY pass) AS passes FROM passes GROUP BY ALL),
pruned AS (SELECT s1_id, cand_id, weight, passes, row_number() OVER (PARTITION BY s1_id ORDER BY weight DESC, cand_id) AS rank FROM (
  SELECT *, weight * count(*) OVER (PARTITION BY s1_id) >= sum(weight) OVER (PARTITION BY s1_id) OR weight * count(*) OVER (PARTITION BY cand_id) >= sum(weight) OVER (PARTITION BY cand_id) AS heavy FROM edges) WHERE heavy)"""


def _passes(spark, d) -> dict[str, DataFrame]:
    """Each pass is written once: one plan of all of them takes too much of the driver's memory. They run side by side over records that are
    written first, with the columns that passes read."""
    r = materialize(normalize_records(biz_records(spark, d)).select("entity_id", "norm_name", "norm_addr", "norm_country", "addr_numbers"), "records")
    s1, s23 = of_source(r, 1), r.where(~F.col("entity_id").startswith("S1-"))
    passes = {
        "keys": lambda: B.Blocker().fit(s23).candidates(s1),
        "cosine": lambda: TF.cosine_candidates(s1, s23).withColumnRenamed("cosine", "score"),
        "sorted": lambda: G.sorted_neighbourhood(s1, s23).withColumn("score", 1 - F.col("distance") / F.lit(5.0)),
        "phonetic": lambda: G.phonetic_candidates(s1, s23).withColumn("score", F.least("hits", F.lit(12)) / F.lit(12.0)),
    }
    return materialize_all(spark, {k: lambda f=f: f().select("s1_id", "cand_id", "score") for k, f in passes.items()}, "pass")


@query(f"WITH {_EDGES} SELECT s1_id, cand_id, weight, passes, rank::INTEGER AS rank FROM pruned WHERE rank <= 19")
def b15_pass_union(spark, d):
    """Candidates of four passes as a weighted graph, pruned at both ends to fewer than twenty for each entity."""
    return G.prune_graph(G.candidate_graph(_passes(spark, d)))


@query(
    f"""WITH {_EDGES}, {TRUTH.strip()},
every AS (SELECT pass, s1_id, cand_id FROM passes UNION ALL SELECT 'union', s1_id, cand_id FROM pruned WHERE rank <= 19),
pairs AS (SELECT s1_id, unnest(truth) AS cand_id FROM truth)
SELECT pass, (SELECT count(*) FROM truth) AS entities, (SELECT count(*) FROM pairs) AS true_pairs, count(p.s1_id) AS found_pairs, count(*) AS candidate_pairs,
  round(count(p.s1_id) / (SELECT count(*) FROM pairs), 6) AS pair_completeness, round(count(*) / (SELECT count(*) FROM truth), 6) AS avg_candidates
FROM every LEFT JOIN pairs p USING (s1_id, cand_id) GROUP BY pass"""
)
def e07_pass_quality(spark, d):
    """Completeness and candidates for an entity of each pass and of their union."""
    passes = _passes(spark, d)
    union = materialize(G.prune_graph(G.candidate_graph(passes)), "pass-union")
    return G.pass_quality({**passes, "union": union}, truth(spark, d)).withColumns({c: F.round(c, 6) for c in ("pair_completeness", "avg_candidates")})


# --- similarity and features --------------------------------------------------------------------------------------------


@query(f"WITH {CUT} SELECT s1_id, cand_id, round({sql_ratio('s1_name', 'c_name')}, 6) AS name_lev, round({sql_ratio('s1_addr', 'c_addr')}, 6) AS addr_lev FROM cut")
def f01_indel(spark, d):
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(ratio_udf("s1_name", "c_name"), 6).alias("name_lev"), F.round(ratio_udf("s1_addr", "c_addr"), 6).alias("addr_lev"))


@query(f"WITH {CUT} SELECT s1_id, cand_id, {sql_lcs('s1_name', 'c_name')} AS lcs FROM cut")
def f01_lcs_native(spark, d):
    return cut_pairs(spark, d).select("s1_id", "cand_id", lcs_column(F.col("s1_name"), F.col("c_name")).cast("long").alias("lcs"))


@query(f"WITH {CUT}, {sql_token_set('cut', 's1_name', 'c_name', 'name_sim')}, {sql_token_set('name_sim_t', 's1_addr', 'c_addr', 'addr_sim')} SELECT s1_id, cand_id, round(name_sim, 6) AS name_sim, round(addr_sim, 6) AS addr_sim FROM addr_sim_t")
def f02_token_set(spark, d):
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(token_set_udf("s1_name", "c_name"), 6).alias("name_sim"), F.round(token_set_udf("s1_addr", "c_addr"), 6).alias("addr_sim"))


@query(f"WITH {CUT}, s AS (SELECT s1_id, cand_id, {sql_sorted('s1_name')} AS a, {sql_sorted('c_name')} AS b FROM cut) SELECT s1_id, cand_id, round({sql_ratio('a', 'b')}, 6) AS name_token_sort FROM s")
def f03_token_sort(spark, d):
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(token_sort_udf("s1_name", "c_name"), 6).alias("name_token_sort"))


PARTIAL = f"""{CUT},
sides AS (SELECT s1_id, cand_id, s1_name AS a, c_name AS b FROM cut WHERE length(s1_name) <= length(c_name) UNION ALL SELECT s1_id, cand_id, c_name, s1_name FROM cut WHERE length(c_name) <= length(s1_name)),
wins AS (SELECT s1_id, cand_id, a, substring(b, greatest(e - length(a), 0) + 1, least(e, length(b)) - greatest(e - length(a), 0)) AS v FROM (SELECT *, unnest(range(1, length(a) + length(b))) AS e FROM sides WHERE a <> ''))"""


@query(f"WITH {PARTIAL} SELECT s1_id, cand_id, round(max({sql_ratio('a', 'v')}), 6) AS name_partial FROM wins GROUP BY ALL")
def f04_partial(spark, d):
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(partial_udf("s1_name", "c_name"), 6).alias("name_partial"))


_JAC = "CASE WHEN len(s1_nums) = 0 AND len(c_nums) = 0 THEN 1.0 ELSE len(list_intersect(s1_nums, c_nums)) / len(list_distinct(list_concat(s1_nums, c_nums))) END"


@query(f"WITH {CUT} SELECT s1_id, cand_id, round({_JAC}, 6) AS num_jaccard, CASE WHEN len(list_intersect(s1_nums, c_nums)) > 0 THEN 1 ELSE 0 END AS common FROM cut")
def f05_jaccard(spark, d):
    a, b = F.array_distinct("s1_nums"), F.array_distinct("c_nums")
    return cut_pairs(spark, d).select("s1_id", "cand_id", F.round(jaccard(a, b), 6).alias("num_jaccard"), (overlap(a, b) > 0).cast("int").alias("common"))


_X = f"""{CANDIDATES},
sorted AS (SELECT *, {sql_sorted("s1_name")} AS sn, {sql_sorted("c_name")} AS cn, {sql_sorted("s1_addr")} AS sa, {sql_sorted("c_addr")} AS ca FROM cands)
SELECT s1_id, cand_id, round({sql_ratio("s1_name", "c_name")}, 6) AS name_lev, round(name_sim, 6) AS name_token_set, round({sql_ratio("sn", "cn")}, 6) AS name_token_sort,
  CASE WHEN s1_name = c_name AND s1_name <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS name_exact,
  CASE WHEN length(s1_name) >= 3 AND length(c_name) >= 3 AND substr(s1_name, 1, 3) = substr(c_name, 1, 3) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS name_pfx_3,
  abs(length(s1_name) - length(c_name))::DOUBLE AS name_len_diff, round({sql_ratio("s1_addr", "c_addr")}, 6) AS addr_lev, round(addr_sim, 6) AS addr_token_set, round({sql_ratio("sa", "ca")}, 6) AS addr_token_sort,
  CASE WHEN s1_addr = c_addr AND s1_addr <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS addr_exact, abs(length(s1_addr) - length(c_addr))::DOUBLE AS addr_len_diff,
  round({_JAC}, 6) AS num_jaccard, CASE WHEN len(list_intersect(s1_nums, c_nums)) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_common_num,
  CASE WHEN s1_country = c_country THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS country_match, CASE WHEN cand_id LIKE 'S2-%' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_s2, CASE WHEN cand_id LIKE 'S3-%' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_s3,
  round(name_sim * addr_sim, 6) AS name_addr_interaction, CASE WHEN name_sim >= 0.85 AND addr_sim < 0.35 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS name_high_addr_low, CASE WHEN name_sim < 0.35 AND addr_sim >= 0.85 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS name_low_addr_high
FROM sorted"""


@query(f"WITH {_X}")
def x_features(spark, d):
    """All features but the two partial ratios, which x04_x11_partial has."""
    f = pair_features(candidates(spark, d))
    return f.select("s1_id", "cand_id", *(r6(c) for c in FEATURES if c not in ("name_partial", "addr_partial")))


def sql_partial(a: str, b: str, name: str) -> str:
    """CTE ``name`` (s1_id, cand_id, name): the best window of the longer side against the shorter one, both ways where equally long."""
    place = "list_transform(range(1, length(b) + 1), lambda j: list_reduce(list_transform(range(1, length(a) + 1), lambda i: CASE WHEN substring(a, i, 1) = substring(b, j, 1) THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END), lambda x, y: x | y))"
    return f"""
{name}_s AS (SELECT s1_id, cand_id, {a} AS a, {b} AS b FROM cands WHERE length({a}) <= length({b}) UNION ALL SELECT s1_id, cand_id, {b}, {a} FROM cands WHERE length({b}) <= length({a})),
{name}_m AS (SELECT *, CASE WHEN length(a) BETWEEN 1 AND 120 THEN {place} ELSE [] END AS marks FROM {name}_s),
{name}_w AS (SELECT s1_id, cand_id, a, length(a) AS m, substring(b, f + 1, t - f) AS v, marks[f + 1:t] AS marks FROM (SELECT *, greatest(e - length(a), 0) AS f, least(e, length(b)) AS t FROM (SELECT *, unnest(range(1, length(a) + length(b))) AS e FROM {name}_m WHERE a <> ''))),
{name} AS (SELECT s1_id, cand_id, round(max(2.0::DOUBLE * (CASE WHEN m <= 120 THEN {sql_lcs_bits("m", "marks")} ELSE {sql_lcs("a", "v")} END) / (m + length(v))), 6) AS {name} FROM {name}_w GROUP BY ALL
  UNION ALL SELECT DISTINCT s1_id, cand_id, CASE WHEN b = '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM {name}_s WHERE a = '')"""


@query(f"WITH {CANDIDATES}, {sql_partial('s1_name', 'c_name', 'name_partial')}, {sql_partial('s1_addr', 'c_addr', 'addr_partial')} SELECT s1_id, cand_id, name_partial, addr_partial FROM name_partial JOIN addr_partial USING (s1_id, cand_id)")
def x04_x11_partial(spark, d):
    return pair_features(candidates(spark, d)).select("s1_id", "cand_id", r6("name_partial"), r6("addr_partial"))


# --- scores and results -------------------------------------------------------------------------------------------------


@query(f"WITH {SCORED} SELECT s1_id, cand_id, round(prob, 6) AS prob FROM scored WHERE prob >= 0.75")
def m02_matches(spark, d):
    return accept(scored(spark, d), CONFIG.fallback_threshold).select("s1_id", "cand_id", r6("prob"))


@query(f"WITH {SCORED}, m AS (SELECT s1_id, string_agg(cand_id, ',' ORDER BY cand_id) AS l FROM scored WHERE prob >= 0.75 GROUP BY 1) SELECT entity_id AS source1_entity_id, coalesce(l, '') AS matched_entity_ids FROM recs LEFT JOIN m ON entity_id = s1_id WHERE entity_id LIKE 'S1-%'")
def snk01_matching_results(spark, d):
    return results(spark, d).select("source1_entity_id", join_ids(F.col("matched")).alias("matched_entity_ids"))


@query(
    f"WITH {SCORED}, per AS (SELECT entity_id, count(cand_id) AS c, count(cand_id) FILTER (prob >= 0.75) AS m FROM recs LEFT JOIN scored ON entity_id = s1_id WHERE entity_id LIKE 'S1-%' GROUP BY 1) SELECT count(*) AS entities, count(*) FILTER (m = 0) AS singletons, round(count(*) FILTER (m = 0) / count(*), 6) AS singleton_share, sum(m)::BIGINT AS links, sum(c)::BIGINT AS candidate_pairs, round(sum(c) / count(*), 6) AS avg_candidates FROM per"
)
def snk05_run_summary(spark, d):
    return run_summary(results(spark, d))


_PAGE = f"""{BIZ},
basic AS (SELECT entity_id, ordinal, business_name, {sql_clean("business_name")} AS norm_name, {sql_clean("business_address")} AS norm_addr, {sql_country("country")} AS norm_country FROM biz),
page_recs AS (SELECT *, list_filter(string_split(norm_addr, ' '), lambda t: regexp_full_match(t, '[0-9]+')) AS nums FROM basic),
pairs AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, b.business_name, a.norm_name AS s1_name, b.norm_name AS c_name, a.norm_addr AS s1_addr, b.norm_addr AS c_addr,
  CASE WHEN len(list_intersect(a.nums, b.nums)) > 0 THEN 1 ELSE 0 END AS common, CASE WHEN a.norm_country = b.norm_country THEN 1 ELSE 0 END AS same_country FROM page_recs a, page_recs b WHERE a.entity_id LIKE 'S1-%' AND a.ordinal % 100 = 0 AND b.entity_id NOT LIKE 'S1-%'),
{sql_token_set("pairs", "s1_name", "c_name", "n_sim")},
{sql_token_set("n_sim_t", "s1_addr", "c_addr", "a_sim")},
page AS (SELECT *, round(greatest(0.01::DOUBLE, least(0.99::DOUBLE, 0.35::DOUBLE * n_sim + 0.25::DOUBLE * ({sql_ratio("s1_name", "c_name")}) + 0.20::DOUBLE * a_sim + 0.10::DOUBLE * common + 0.10::DOUBLE * same_country - 0.25::DOUBLE * (CASE WHEN n_sim >= 0.85 AND a_sim < 0.35 THEN 1 ELSE 0 END))), 9) AS score FROM a_sim_t),
placed AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS rank FROM page)"""


@query(f"WITH {_PAGE} SELECT s1_id, rank::INTEGER AS rank, cand_id, business_name, round(score, 6) AS score, printf('%.3f', n_sim) AS name_similarity, printf('%.3f', a_sim) AS address_similarity FROM placed WHERE rank <= 20")
def m03_dashboard_score(spark, d):
    """The matcher page: the 20 best targets of every S1 record whose number is divisible by 100, over all targets."""
    r = biz_records(spark, d)
    found = match_chosen(of_source(r, 1).where(F.col("ordinal") % 100 == 0), r.where(~F.col("entity_id").startswith("S1-")))
    return found.withColumn("score", F.round("score", 6)).drop("score_text")


_TYPED = f"""{CUT},
{sql_token_set("cut", "s1_name", "c_name", "n_sim")},
{sql_token_set("n_sim_t", "s1_addr", "c_addr", "a_sim")}"""


@query(f"WITH {_TYPED} SELECT s1_id, cand_id, s1_name AS name_1, c_name AS name_2, round(100 * n_sim, 6) AS name_similarity, round(100 * a_sim, 6) AS addr_similarity, round(100 * n_sim, 6) > 80 AND round(100 * a_sim, 6) > 80 AS same FROM a_sim_t")
def d03_compare_typed(spark, d):
    """Raw records compared as the page compares two typed ones: all pairs of the first cut."""
    raw = biz_records(spark, d)
    side = lambda id_, k: raw.select(F.col("entity_id").alias(id_), F.col("business_name").alias(f"n{k}"), F.col("business_address").alias(f"a{k}"))
    pairs = best_first_hits(spark, d).select("s1_id", "cand_id").join(side("s1_id", 1), "s1_id").join(side("cand_id", 2), "cand_id")
    return compare_records(pairs).select("s1_id", "cand_id", "name_1", "name_2", "name_similarity", "addr_similarity", "same")


@query(f"WITH {CANDIDATES} SELECT s1_id, cand_id, rank, round(score, 6) AS score FROM cands")
def b09_index_reused(spark, d):
    """One index, built and held once, asked twice: for S1 records of even and of odd ordinals."""
    s1, s23 = sides(spark, d)
    blocker = B.MultiStrategyBlocker().fit(s23).keep()
    both = [blocker.candidates(s1.where(F.col("ordinal") % 2 == k)) for k in (0, 1)]
    found = materialize(both[0].unionByName(both[1]).select("s1_id", "cand_id", F.col("rank").cast("long").alias("rank"), r6("score")), "reused")
    blocker.release()
    return found


# --- files and streams --------------------------------------------------------------------------------------------------


def _write_source(spark, d, source: int, path: str) -> None:
    """Raw records of a source as a TSV folder in document order, a header in each file."""
    columns = ["entity_id", "business_name", "business_address", "country"]
    of_source(biz_records(spark, d), source).orderBy("ordinal").select(*columns).write.csv(path, sep="\t", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query(f"WITH {BIZ} SELECT entity_id, business_name, business_address, country, row_number() OVER (ORDER BY ordinal) - 1 AS row_no FROM biz WHERE entity_id LIKE 'S1-%'")
def src01_tsv_records(spark, d):
    """Written as TSV and read again, rows numbered in the order of the files."""
    path = scratch(spark, "source1")
    _write_source(spark, d, 1, path)
    return with_ordinal(read_tsv(spark, path), "row_no")


@query(f"WITH {BIZ} SELECT DISTINCT entity_id FROM biz WHERE entity_id LIKE 'S2-%'")
def src05_read_ids(spark, d):
    path = scratch(spark, "source2")
    _write_source(spark, d, 2, path)
    return read_ids(spark, path)


def _file_sql(header: str, ids: str, where: str) -> str:
    """Lines of a result file: ids of each S1 record in the order of documents."""
    return (
        f"WITH {SCORED}, m AS (SELECT s1_id, {ids} AS l FROM scored WHERE {where} GROUP BY 1) "
        f"SELECT 1::BIGINT AS line_no, replace('{header}', chr(92) || 't', chr(9)) AS value UNION ALL "
        "SELECT row_number() OVER (ORDER BY ordinal) + 1, entity_id || chr(9) || coalesce(l, '') FROM recs LEFT JOIN m ON entity_id = s1_id WHERE entity_id LIKE 'S1-%'"
    )


@query(_file_sql("source1_entity_id\\tmatched_entity_ids", "string_agg(cand_id, ',' ORDER BY cand_id)", "prob >= 0.75"))
def snk01_result_file(spark, d):
    """matching_results, written and read again line by line."""
    path = scratch(spark, "matches")
    write_matching_results(results(spark, d), path)
    return read_lines(spark, path).select("line_no", "value")


@query(_file_sql("source1_entity_id\\tcandidate_entity_ids", "string_agg(cand_id, ',' ORDER BY rank)", "true"))
def snk02_candidate_file(spark, d):
    """candidate_pairs, written and read again line by line."""
    path = scratch(spark, "candidates")
    write_candidate_pairs(results(spark, d), path)
    return read_lines(spark, path).select("line_no", "value")


@query(ORACLE_SQL["snk01_matching_results"])
def stream_arrivals(spark, d):
    """S1 records that arrive as files of a stream, two a batch, against a fixed index."""
    at = scratch(spark, "stream")
    s1 = of_source(biz_records(spark, d), 1).select("entity_id", "business_name", "business_address", "country", F.col("ordinal").cast("long").alias("ordinal"))
    s1.repartition(5, "entity_id").write.parquet(f"{at}/in")
    blocker = B.Blocker().fit(targets(spark, d))
    arrivals = spark.readStream.schema("entity_id string, business_name string, business_address string, country string, ordinal long").option("maxFilesPerTrigger", 2).parquet(f"{at}/in")
    match_arrivals(arrivals, blocker, f"{at}/out", f"{at}/checkpoint").awaitTermination()
    blocker.release()
    return spark.read.parquet(f"{at}/out").select("source1_entity_id", join_ids(F.col("matched")).alias("matched_entity_ids"))


# --- evaluation, tuning, sampling ---------------------------------------------------------------------------------------

_EVAL = f"""{SCORED}, {TRUTH.strip()},
preds AS (SELECT s1_id, list(cand_id) AS pred FROM scored WHERE prob >= 0.75 GROUP BY 1),
ev AS (SELECT s1_id, truth, coalesce(pred, []) AS pred, len(list_intersect(truth, coalesce(pred, [])))::DOUBLE AS tp FROM truth LEFT JOIN preds USING (s1_id)),
per AS (SELECT s1_id, {F05} FROM ev)"""


def _predictions(spark, d):
    return results(spark, d).select(F.col("source1_entity_id").alias("s1_id"), F.col("matched").alias("pred"))


@query(f"WITH {_EVAL} SELECT s1_id, round(f05, 6) AS f05, round(precision, 6) AS precision, round(recall, 6) AS recall FROM per")
def e01_entity_f05(spark, d):
    return E.entity_f05(truth(spark, d).join(_predictions(spark, d), "s1_id")).select("s1_id", r6("f05"), r6("precision"), r6("recall"))


@query(f"WITH {_EVAL} SELECT round(avg(f05), 6) AS macro_f05, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, count(*) AS entities FROM per")
def e02_macro(spark, d):
    m = E.evaluate_predictions(truth(spark, d), _predictions(spark, d))
    return m.select(r6("macro_f05"), r6("macro_precision"), r6("macro_recall"), "entities")


@query(
    f"WITH {CANDIDATES}, {TRUTH.strip()}, l AS (SELECT s1_id, list(cand_id) AS c FROM cands GROUP BY 1), s AS (SELECT count(*) AS entities, sum(len(truth))::BIGINT AS true_pairs, sum(len(list_intersect(truth, coalesce(c, []))))::BIGINT AS found_pairs, sum(len(coalesce(c, [])))::BIGINT AS candidate_pairs FROM truth LEFT JOIN l USING (s1_id)), t AS (SELECT count(*) AS n FROM recs WHERE entity_id NOT LIKE 'S1-%') SELECT entities, true_pairs, found_pairs, candidate_pairs, round(found_pairs / true_pairs, 6) AS pair_completeness, round(1 - candidate_pairs / (entities * n), 6) AS reduction_ratio, round(candidate_pairs / entities, 6) AS avg_candidates FROM s, t"
)
def e03_blocking_quality(spark, d):
    s1, s23 = sides(spark, d)
    q = E.evaluate_blocking(truth(spark, d), B.candidate_lists(s1, candidates(spark, d)), s23.agg(F.count(F.lit(1)).alias("n")))
    return q.select("entities", "true_pairs", "found_pairs", "candidate_pairs", r6("pair_completeness"), r6("reduction_ratio"), r6("avg_candidates"))


_SWEEP = f"""{SCORED}, {TRUTH.strip()},
grid AS (SELECT unnest({SWEEP!r})::DOUBLE AS threshold),
preds AS (SELECT threshold, s1_id, list(cand_id) AS pred FROM scored, grid WHERE prob >= threshold GROUP BY ALL),
ev AS (SELECT threshold, s1_id, truth, coalesce(pred, []) AS pred, len(list_intersect(truth, coalesce(pred, [])))::DOUBLE AS tp FROM (SELECT * FROM truth, grid) LEFT JOIN preds USING (threshold, s1_id)),
per AS (SELECT threshold, {F05} FROM ev),
sweep AS (SELECT threshold, round(avg(f05), 6) AS macro_f05, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall FROM per GROUP BY 1)"""


@query(f"WITH {_SWEEP} SELECT * FROM sweep")
def m09_threshold_sweep(spark, d):
    return sweep(scored(spark, d).select("s1_id", "cand_id", "prob"), truth(spark, d))


def sweep(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    return T.sweep_thresholds(pairs, truth).select("threshold", r6("macro_f05"), r6("macro_precision"), r6("macro_recall"))


@query(f"WITH {_SWEEP} SELECT * FROM sweep ORDER BY macro_f05 DESC, threshold LIMIT 1")
def a14_best_threshold(spark, d):
    return T.best_threshold(m09_threshold_sweep(spark, d))


_SPLIT = "CAST(('0x' || substr(md5('42' || s1_id), 1, 8)) AS BIGINT) % 100"


@query(f"WITH {BIZ} SELECT entity_id AS s1_id, {_SPLIT.replace('s1_id', 'entity_id')} < 20 AS validation FROM biz WHERE entity_id LIKE 'S1-%'")
def m05_split(spark, d):
    s1 = of_source(biz_records(spark, d), 1).select(F.col("entity_id").alias("s1_id"))
    train, val = T.split_entities(s1, "s1_id")
    return train.withColumn("validation", F.lit(False)).unionByName(val.withColumn("validation", F.lit(True)))


_NEG = f"""{CANDIDATES}, {TRUTH.strip()},
wrong AS (SELECT s1_id, cand_id FROM cands ANTI JOIN (SELECT s1_id, unnest(truth) AS cand_id FROM truth) USING (s1_id, cand_id)),
neg AS (SELECT s1_id, cand_id FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY md5('42' || s1_id || cand_id), cand_id) AS r FROM wrong) WHERE r <= 6)"""


@query(f"WITH {_NEG} SELECT * FROM neg")
def j11_hard_negatives(spark, d):
    return T.hard_negatives(candidates(spark, d), truth(spark, d))


@query(f"WITH {_NEG}, pairs AS (SELECT 0 AS label FROM neg UNION ALL SELECT 1 FROM (SELECT unnest(truth) FROM truth)) SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, round(least(count(*) FILTER (label = 0) / greatest(count(*) FILTER (label = 1), 1), 4.0), 6) AS weight FROM pairs")
def m07_training_pairs(spark, d):
    pairs = T.training_pairs(candidates(spark, d), truth(spark, d), targets(spark, d))
    return T.class_weight(pairs).select("positives", "negatives", r6("weight"))


_MEDIUM = f"""{CANDIDATES}, {TRUTH.strip()},
known AS (SELECT s1_id, cand_id FROM cands UNION SELECT s1_id, unnest(truth) FROM truth),
numbered AS (SELECT norm_country, entity_id, row_number() OVER (PARTITION BY norm_country ORDER BY md5('42' || entity_id), entity_id) - 1 AS p, count(*) OVER (PARTITION BY norm_country) AS n FROM recs WHERE entity_id NOT LIKE 'S1-%'),
asked AS (SELECT entity_id AS s1_id, norm_country, n, coalesce(k, 0) AS k, ('0x' || substr(md5('42' || entity_id || 'start'), 1, 8))::BIGINT % n AS start
  FROM recs JOIN (SELECT DISTINCT norm_country, n FROM numbered) USING (norm_country) LEFT JOIN (SELECT s1_id AS entity_id, count(*) AS k FROM known GROUP BY 1) USING (entity_id) WHERE entity_id LIKE 'S1-%'),
draws AS (SELECT s1_id, norm_country, draw, (start + draw * (2147483647 % n)) % n AS p FROM (SELECT *, unnest(range(0, least(n, 3 + k))) AS draw FROM asked)),
medium AS (SELECT s1_id, cand_id FROM (SELECT s1_id, entity_id AS cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY draw) AS r
  FROM draws JOIN numbered USING (norm_country, p) WHERE (s1_id, entity_id) NOT IN (SELECT s1_id, cand_id FROM known)) WHERE r <= 3)"""


@query(f"WITH {_MEDIUM} SELECT * FROM medium")
def m12_medium_negatives(spark, d):
    """Three targets of the same country for each entity that are neither true matches nor candidates."""
    s1, s23 = sides(spark, d)
    true_pairs = truth(spark, d).select("s1_id", F.explode("truth").alias("cand_id"))
    known = materialize(candidates(spark, d).select("s1_id", "cand_id").unionByName(true_pairs).distinct(), "known")
    return T.medium_negatives(s1, s23, known)


#: (setting, override, the config's threshold or None for the best of the sweep, is there a model)
SETTINGS = [("fallback", 0.4, 0.6, False), ("override", 0.4, 0.6, True), ("config", None, 0.6, True), ("default", None, None, True), ("zero", 0.0, None, True)]


@query(
    f"""WITH {SCORED},
settings AS (SELECT * FROM {sql_rows("setting, override, configured, has_model", [(s, o, c, int(m)) for s, o, c, m in SETTINGS])} UNION ALL SELECT 'tuned', NULL, (SELECT threshold FROM ({ORACLE_SQL["a14_best_threshold"]})), 1),
resolved AS (SELECT setting, (CASE WHEN has_model = 1 THEN coalesce(override, configured, 0.7) ELSE 0.75 END)::DOUBLE AS threshold FROM settings)
SELECT setting, threshold, count(s1_id) AS accepted, count(DISTINCT s1_id) AS matched FROM resolved LEFT JOIN scored ON prob >= threshold GROUP BY ALL"""
)
def m04_thresholds(spark, d):
    """What the threshold of each setting accepts of all scored pairs; one setting has the threshold that the sweep finds best."""
    schema = "setting string, override double, configured double, has_model boolean"
    # both the sweep and the settings read the scores
    pairs = materialize(scored(spark, d).select("s1_id", "cand_id", "prob"), "scored")
    tuned = T.best_threshold(sweep(pairs, truth(spark, d))).select(F.lit("tuned").alias("setting"), F.lit(None).cast("double").alias("override"), F.col("threshold").alias("configured"), F.lit(True).alias("has_model"))
    settings = spark.createDataFrame(SETTINGS, schema).unionByName(tuned)
    resolved = settings.select("setting", resolved_threshold(F.col("override"), F.col("configured"), F.col("has_model")).alias("threshold"))
    return T.accepted_counts(resolved, pairs)


_TREE_FEATURES = [f for f in FEATURES if f not in ("name_partial", "addr_partial")]


@query(
    f"""WITH RECURSIVE x AS (SELECT s1_id, cand_id, [{", ".join(_TREE_FEATURES)}] AS v FROM (WITH {_X})),
nodes AS (SELECT * FROM {sql_rows("tree, node, feature, threshold, l, r, value", [(t, n, _TREE_FEATURES.index(f) if f else -1, float(c), lo, hi, float(v)) for t, n, f, c, lo, hi, v in SAMPLE_TREES])}),
walk AS (SELECT s1_id, cand_id, tree, 0 AS node FROM x, (SELECT DISTINCT tree FROM nodes)
  UNION ALL SELECT s1_id, cand_id, tree, CASE WHEN v[feature + 1] <= threshold THEN l ELSE r END FROM walk JOIN nodes USING (tree, node) JOIN x USING (s1_id, cand_id) WHERE feature >= 0)
SELECT s1_id, cand_id, round(1 / (1 + exp(-sum(value)::DOUBLE)), 6) AS prob FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY ALL"""
)
def m01_tree_scores(spark, d):
    """An ensemble written as a table of nodes, read again, and evaluated on the features of all candidates."""
    path = scratch(spark, "trees")
    cells = [(t, n, FEATURES.index(f) if f else -1, float(c), lo, hi, float(v)) for t, n, f, c, lo, hi, v in SAMPLE_TREES]
    spark.createDataFrame(cells, TR.NODES).write.parquet(path)
    return TR.score_by_trees(pair_features(candidates(spark, d)), TR.read_trees(spark, path)).select("s1_id", "cand_id", r6("prob"))


def _labelled(spark, d, c: DataFrame) -> DataFrame:
    """(s1_id, features, label) of the training pairs, written once: every pass of a fit reads them."""
    s1, s23 = sides(spark, d)
    pairs = T.training_pairs(c, truth(spark, d), s23)
    return materialize(pair_features(spread(pair_attributes(pairs, s1, s23))).select("s1_id", *FEATURES, "label"), "labelled")


@query()
def m08_gbt_scores(spark, d):
    """Scores of boosted trees of the default size, grown leaf by leaf, on all candidates."""
    c = materialize(spread(candidates(spark, d)), "candidates")
    model = TR.fit_trees(_labelled(spark, d, c))[0]
    return TR.score_by_trees(pair_features(c), model.table(spark)).select("s1_id", "cand_id", r6("prob"))


@query()
def m13_cross_validation(spark, d):
    """F0.5 of five folds by entity, each scored by trees that never saw it, at the threshold that is best over all of them."""
    c = materialize(spread(candidates(spark, d)), "candidates")
    _, quality = cross_validate(_labelled(spark, d, c), pair_features(c), truth(spark, d), 5, TR.TreeRule(trees=30))
    return quality.select("fold", "entities", "threshold", r6("macro_f05"), r6("macro_precision"), r6("macro_recall"), r6("spread"))


# --- validation, profiling ----------------------------------------------------------------------------------------------


def _faulty_lines(spark, d):
    """Result lines made from the documents, with some of every fault."""
    line = F.expr(
        """CASE WHEN doc_id % 50 = 1 THEN concat('S1-', doc_id) WHEN doc_id % 50 = 2 THEN '   '
        WHEN doc_id % 50 = 3 THEN concat('S1-', doc_id, '\t', 'S2-1,S2-1') WHEN doc_id % 50 = 4 THEN concat('S1-', doc_id, '\t', 'S1-7')
        WHEN doc_id % 50 = 5 THEN concat('S1-', doc_id, '\t', 'S2-1,') WHEN doc_id % 50 = 6 THEN concat('S1-', doc_id + 1, '\t') WHEN doc_id % 50 = 8 THEN concat('S1-', doc_id, '\t', 'S3-999999')
        WHEN doc_id % 50 = 9 THEN concat('S1-x', doc_id, '\t') ELSE concat('S1-', doc_id, '\t', 'S2-', doc_id % 11, ',S3-', doc_id % 7) END"""
    )
    body = docs(spark, d).select((F.col("doc_id") + 2).alias("line_no"), line.alias("value"))
    return spark.createDataFrame([(1, "source1_entity_id,matched")], "line_no long, value string").union(body)


_LINES = """lines AS (SELECT doc_id + 2 AS line_no, CASE WHEN doc_id % 50 = 1 THEN 'S1-' || doc_id WHEN doc_id % 50 = 2 THEN '   '
  WHEN doc_id % 50 = 3 THEN 'S1-' || doc_id || chr(9) || 'S2-1,S2-1' WHEN doc_id % 50 = 4 THEN 'S1-' || doc_id || chr(9) || 'S1-7'
  WHEN doc_id % 50 = 5 THEN 'S1-' || doc_id || chr(9) || 'S2-1,' WHEN doc_id % 50 = 6 THEN 'S1-' || (doc_id + 1) || chr(9) WHEN doc_id % 50 = 8 THEN 'S1-' || doc_id || chr(9) || 'S3-999999'
  WHEN doc_id % 50 = 9 THEN 'S1-x' || doc_id || chr(9) ELSE 'S1-' || doc_id || chr(9) || 'S2-' || doc_id % 11 || ',S3-' || doc_id % 7 END AS value FROM documents),
body AS (SELECT line_no, instr(value, chr(9)) > 0 AS has_tab, split_part(value, chr(9), 1) AS s1_id, CASE WHEN split_part(value, chr(9), 2) = '' THEN [] ELSE string_split(split_part(value, chr(9), 2), ',') END AS ids FROM lines WHERE trim(value) <> ''),
good AS (SELECT * FROM body WHERE has_tab), each AS (SELECT unnest(ids) AS id FROM good),
required AS (SELECT 'S1-' || doc_id AS entity_id FROM documents),
valid AS (SELECT 'S2-' || doc_id AS entity_id FROM documents UNION SELECT 'S3-' || doc_id FROM documents),
found AS (SELECT 'V-03' AS rule, 'source1_entity_id,matched' AS e
  UNION ALL SELECT 'V-05', 'line ' || lpad(line_no::VARCHAR, 9, '0') FROM body WHERE NOT has_tab
  UNION ALL SELECT 'V-06', s1_id FROM good GROUP BY s1_id HAVING count(*) > 1
  UNION ALL SELECT 'V-07', s1_id FROM good WHERE len(ids) <> len(list_distinct(ids))
  UNION ALL SELECT 'V-08', id FROM each WHERE id LIKE 'S1-%'
  UNION ALL SELECT 'V-09', id FROM each WHERE NOT regexp_matches(id, '^S[123]-')
  UNION ALL SELECT 'V-10', id FROM (SELECT DISTINCT id FROM each WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM valid))
  UNION ALL SELECT 'V-11', entity_id FROM required WHERE entity_id NOT IN (SELECT s1_id FROM good)
  UNION ALL SELECT 'V-12', s1_id FROM (SELECT DISTINCT s1_id FROM good WHERE s1_id NOT IN (SELECT entity_id FROM required)))"""


@query(f"WITH {_LINES} SELECT rule, 'error' AS level, count(*) AS n, array_to_string((list(e ORDER BY e))[1:5], ',') AS examples FROM found GROUP BY 1 UNION ALL SELECT 'V-18', 'info', count(*), 'empty ' || count(*) FILTER (len(ids) = 0) || ',non-empty ' || count(*) FILTER (len(ids) > 0) FROM good")
def v_rules(spark, d):
    ids = docs(spark, d).select("doc_id")
    required = ids.select(F.concat(F.lit("S1-"), "doc_id").alias("entity_id"))
    valid = ids.select(F.concat(F.lit("S2-"), "doc_id").alias("entity_id")).union(ids.select(F.concat(F.lit("S3-"), "doc_id")))
    return list_findings(_faulty_lines(spark, d), MATCH_HEADER, required, valid).withColumn("examples", F.array_join("examples", ","))


@query(f"WITH {_LINES}, off AS (SELECT s1_id FROM (SELECT s1_id, arg_max(ids, line_no) AS m FROM good GROUP BY 1) WHERE len(list_filter(m, lambda x: x LIKE 'S3-%')) > 0) SELECT 'V-16' AS rule, 'warning' AS level, count(*) AS n, array_to_string((list(s1_id ORDER BY s1_id))[1:5], ',') AS examples FROM off")
def v16_subset(spark, d):
    lines = _faulty_lines(spark, d)
    only_s2 = lines.withColumn("value", F.regexp_replace("value", ",?S3-[0-9]+", ""))
    return subset_findings(lines, only_s2).withColumn("examples", F.array_join("examples", ","))


@query(f"WITH {_LINES} SELECT line_no, has_tab, s1_id, array_to_string(ids, ',') AS ids FROM body")
def src06_result_rows(spark, d):
    return result_rows(_faulty_lines(spark, d)).withColumn("ids", F.array_join("ids", ","))


_FILES = """n AS (SELECT count(*) AS n, count(*) FILTER (doc_id % 3 = 0) AS off FROM documents)
SELECT c.cases AS case_name, c.rule, c.level, CASE c.n WHEN -1 THEN n.n WHEN -2 THEN n.off ELSE c.n END::BIGINT AS n, c.code::INT AS exit_code FROM n, """ + sql_rows("cases, rule, level, n, code", [
    ("no source", "V-13", "error", 1, 1),
    ("no result", "V-14", "warning", 1, 1), ("no result", "V-01", "error", 1, 1),
    ("empty", "V-14", "warning", 1, 1), ("empty", "V-02", "error", 1, 1), ("empty", "V-11", "error", -1, 1), ("empty", "V-18", "info", 0, 1), ("empty", "V-15", "warning", 1, 1),
    ("bytes", "V-14", "warning", 1, 1), ("bytes", "V-17", "error", 1, 1), ("bytes", "V-18", "info", -1, 1), ("bytes", "V-15", "warning", 1, 1),
    ("header", "V-14", "warning", 1, 1), ("header", "V-04", "error", 1, 1), ("header", "V-18", "info", -1, 1), ("header", "V-15", "warning", 1, 1),
    ("subset", "V-18", "info", -1, 0), ("subset", "V-18", "info", -1, 0), ("subset", "V-16", "warning", -2, 0),
]) + " c"


@query(f"WITH {_FILES}")
def v_files(spark, d):
    """Findings and exit codes of written files: sources or results that are missing, empty ones, bytes that are no UTF-8, wrong headers,
    matches that are no candidates."""
    at = scratch(spark, "validated")
    ids = docs(spark, d).select("doc_id").orderBy("doc_id")

    def write(name: str, header: str, line: str, rows: DataFrame = ids) -> str:
        body = rows.select(F.lit(1).alias("o"), "doc_id", F.expr(line).alias("value"))
        head = spark.range(1).select(F.lit(0).alias("o"), F.lit(0).cast("long").alias("doc_id"), F.lit(header).alias("value"))
        # several files in order; the header is the first line of the first
        lines = head.union(body).repartitionByRange(4, "o", "doc_id") if header else body.coalesce(1)
        lines.sortWithinPartitions("o", "doc_id").select("value").write.text(f"{at}/{name}")
        return f"{at}/{name}"

    for k in (1, 2, 3):
        write(f"full/test_source{k}.tsv", "entity_id\tbusiness_name", f"concat('S{k}-', doc_id, '\t')")
    write("first/test_source1.tsv", "entity_id\tbusiness_name", "concat('S1-', doc_id, '\t')")
    both = "concat('S1-', doc_id, '\t', 'S2-', doc_id, ',S3-', doc_id)"
    least = docs(spark, d).agg(F.min("doc_id").alias("least"))
    odd = ids.crossJoin(F.broadcast(least))
    matches = write("matches.tsv", MATCH_HEADER, both)
    cases = {
        "no source": (matches, None, f"{at}/none", False),
        "no result": (f"{at}/none.tsv", None, f"{at}/first", False),
        "empty": (write("empty.tsv", "", both, ids.where("false")), None, f"{at}/first", True),
        "bytes": (write("bytes.tsv", MATCH_HEADER, "concat('S1-', doc_id, '\t', 'S2-', CASE WHEN doc_id = least THEN CAST(X'FF' AS STRING) ELSE CAST(doc_id AS STRING) END)", odd), None, f"{at}/first", False),
        "header": (write("header.tsv", "source1\tmatched", both), None, f"{at}/first", False),
        "subset": (matches, write("candidates.tsv", CANDIDATE_HEADER, "concat('S1-', doc_id, '\t', 'S2-', doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat(',S3-', doc_id) END)"), f"{at}/full", True),
    }
    out = None
    for name, (result, candidate, sources, check) in cases.items():
        found = validate(spark, result, candidate, sources, check)
        one = found.select(F.lit(name).alias("case_name"), "rule", "level", F.col("n").cast("long").alias("n"), F.lit(exit_code(found)).alias("exit_code"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT lang AS country, count(*) AS n FROM documents GROUP BY 1")
def a05_value_counts(spark, d):
    return P.value_counts(biz_records(spark, d), "country")


@query("SELECT count(*) AS n_rows, 3::BIGINT AS n_columns, count(*) FILTER (doc_id IS NULL) AS null_doc_id, count(*) FILTER (quality IS NULL) AS null_quality, count(*) FILTER (toxic IS NULL) AS null_toxic FROM (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))")
def a06_null_counts(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return P.null_counts(docs(spark, d).select("doc_id").join(labels, "doc_id", "left").select("doc_id", "quality", "toxic"))


@query(f"WITH {BIZ}, {TRUTH.strip()} SELECT len(truth) AS n_matches, count(*) AS n FROM truth GROUP BY 1")
def a08_match_histogram(spark, d):
    return P.match_histogram(ground_truth(biz_records(spark, d)))


@query(f"WITH {BIZ}, {TRUTH.strip()}, e AS (SELECT unnest(truth) AS id FROM truth) SELECT count(*) FILTER (id LIKE 'S2-%') AS s2, count(*) FILTER (id LIKE 'S3-%') AS s3, count(*) AS total FROM e")
def a09_source_totals(spark, d):
    return P.source_totals(ground_truth(biz_records(spark, d)))


@query(f"WITH {BIZ}, {TRUTH.strip()}, f AS (SELECT * FROM truth WHERE len(truth) >= 2 ORDER BY s1_id LIMIT 3), e AS (SELECT s1_id, unnest(truth) AS cand_id FROM f) SELECT s1_id AS source1_entity_id, cand_id, substr(cand_id, 1, 2) AS found_in, business_name FROM e JOIN biz ON cand_id = entity_id")
def j15_describe_matches(spark, d):
    r = biz_records(spark, d)
    return P.describe_matches(P.many_matches(ground_truth(r)), of_source(r, 2), of_source(r, 3))


__all__ = ["CANDIDATE_HEADER", "ORACLE_SQL", "QUERIES", "W"]
