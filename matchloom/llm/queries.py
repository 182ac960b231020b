"""The operators of this folder as queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, embeddings, mixing, ngram_join, pii, quality, resample, search, secrets, spans, substring, toxicity, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of documents."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    return spans.digest(found, "doc_id", secrets.BASE_KINDS)


#: The rules of op2's contract.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of pages."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules(v, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT *, (SELECT max({'n': length(h || p), 'v': v, 'rule': h || p}) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS b FROM cut
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.v, 'allow') AS verdict FROM judged
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles overlap by 85 in 100."""
    found = ngram_join.similar_documents(table(spark, sf_dir, "documents"), ngram_join.JoinRule(words=4, num=85, den=100))
    return found.withColumnRenamed("component", "component_id")


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
often AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM (SELECT * FROM s SEMI JOIN often USING (g)) a JOIN (SELECT * FROM s SEMI JOIN often USING (g)) b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * i >= 85 * (na.n + nb.n - i)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
m AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON w.doc_id = m.a
"""


def op3_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the number of documents that each one links with."""
    found = ngram_join.similar_documents(table(spark, sf_dir, "documents"), ngram_join.JoinRule(words=4, num=85, den=100), with_links=True)
    return found.withColumnRenamed("component", "component_id")


OP3_LINKS_SQL = OP3_SQL.replace("AS n_shingles,", "AS n_shingles, (SELECT count(*) FROM links WHERE links.a = w.doc_id) AS n_links,")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents outside all 13-word windows that an earlier document holds."""
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)
), late AS (SELECT doc_id, i FROM win JOIN (SELECT g, min(doc_id) AS m FROM win GROUP BY g) USING (g) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM late),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of documents."""
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    return spans.digest(found, "doc_id", pii.BASE_KINDS)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted and read back."""
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    read = chat.read_back(chat.expand_conversations(rows))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), laid AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length(regexp_replace(role, '([\\<\[|])', '\1\1', 'g')) + length(regexp_replace(text, '([\\<\[])', '\1\1', 'g')) + 11) OVER w AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM laid GROUP BY conv_id
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH iw AS (
  SELECT item_id, w, len(w) AS n, least(len(w), 10) AS m
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
), windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS win FROM (SELECT *, unnest(range(1, n - m + 2)) AS s FROM iw WHERE n > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), dwin AS (
  SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
), hits AS (SELECT doc_id, item_id, m, s FROM dwin JOIN windows USING (m, win)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS i FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labelled rows outside the held-out quarter."""
    held_out = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id")).select("doc_id", "toxic")
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("segments").alias("n_segments"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 by source."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings at cosine 0.95."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_dot_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_ids AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN least_ids ON vec_id = least_ids.a LEFT JOIN n ON vec_id = n.a
"""

def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labelled rows outside the held-out third."""
    held_out = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id")).select("doc_id", "quality")
    scored = quality.score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents drawn towards the words of benchmark."""
    found = resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), resample.Draw(longest=1))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), dw AS (SELECT doc_id, {_TERMS} AS w FROM documents),
dk AS (SELECT doc_id, word, count(*) AS k FROM (SELECT doc_id, unnest(w) AS word FROM dw) GROUP BY ALL),
bk AS (SELECT word, count(*) AS k FROM (SELECT unnest({_TERMS}) AS word FROM benchmark) GROUP BY ALL),
vocabulary AS (
  SELECT word, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dk UNION SELECT word FROM bk)), steps
), s AS (SELECT bucket, sum(k) AS s FROM dk JOIN vocabulary USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(k) AS t FROM bk JOIN vocabulary USING (word) GROUP BY 1),
sums AS (SELECT coalesce((SELECT sum(s) FROM s), 0) + 10000 AS ss, coalesce((SELECT sum(t) FROM t), 0) + 10000 AS tt),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ss::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * tt::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), sums
), weighed AS (
  SELECT doc_id, sum(k) AS n, floor(sum(k * gain)::DOUBLE / sum(k)::DOUBLE)::BIGINT AS weight FROM dk JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM dw LEFT JOIN weighed USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = f"""
WITH dw AS (SELECT doc_id, {_TERMS} AS w FROM documents),
counts AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS words FROM dw),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM dw) SEMI JOIN items USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, counts GROUP BY term, docs),
gives AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))) AS g FROM tf JOIN weights USING (term), counts),
found AS (SELECT item_id, doc_id, sum(g)::BIGINT AS score FROM gives JOIN items USING (term) GROUP BY ALL HAVING sum(g) > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM found)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 50
"""


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_urls": op2_urls,
    "op3_ngram_join": op3_ngram_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_pii": op5_pii,
    "op6_chat": op6_chat,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_mix": op9_mix,
    "op10_embeddings": op10_embeddings,
    "op11_quality": op11_quality,
    "op12_resample": op12_resample,
    "op13_search": op13_search,
    "op3_ngram_links": op3_ngram_links,
}
ORACLE_SQL = {"op2_urls": OP2_SQL, "op3_ngram_join": OP3_SQL, "op3_ngram_links": OP3_LINKS_SQL, "op4_substring_dedup": OP4_SQL, "op6_chat": OP6_SQL, "op7_decontaminate": OP7_SQL, "op10_embeddings": OP10_SQL, "op12_resample": OP12_SQL, "op13_search": OP13_SQL}
