"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.chat import formatted_and_read
from casegrid.llm.codebooks import compress_vectors
from casegrid.llm.decontaminate import find_contamination
from casegrid.llm.jaccard import jaccard_components
from casegrid.llm.neighbours import nearest_neighbours
from casegrid.llm.packing import best_fit_packing
from casegrid.llm.quality import fit_quality, score_quality
from casegrid.llm.substring import remove_repeated
from casegrid.llm.token_files import read_token_files, write_token_files
from casegrid.llm.toxicity import fit_toxicity, score_toxicity
from casegrid.llm.url_filter import KEPT_SHARE, PRIOR_PAGES, REJECT_AT, judge_urls
from casegrid.llm.warc import read_archive, write_archive
from casegrid.llm.whitening import whiten
from casegrid.operators.storage import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _rule_rows_sql() -> str:
    split = [(rule, *rule.partition("/"), verdict) for rule, verdict in RULES]
    return ", ".join(f"('{rule}', '{host}', '{slash}{path}', '{verdict}')" for rule, host, slash, path, verdict in split)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP1_SQL = rf"""
WITH rules(rule, of_host, of_path, verdict) AS (VALUES {_rule_rows_sql()}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
paths AS (SELECT host, path, count(*) AS n FROM urls GROUP BY ALL),
given AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS given
          FROM paths JOIN rules ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path)
          GROUP BY ALL),
cut AS (SELECT host, path, n, string_split(regexp_replace(path, '^/', ''), '/') AS s FROM paths),
spread AS (SELECT host, path, n, i - 1 AS place, s[i] AS segment, regexp_replace(s[i], '[0-9]+', '#', 'g') AS shape,
                  regexp_replace(array_to_string(s[1:i - 1], '/'), '[0-9]+', '#', 'g') AS node
           FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM cut)),
general AS (
    SELECT host, path, place,
           CASE WHEN sum(n) OVER (PARTITION BY host, node, segment) * {KEPT_SHARE} >= sum(n) OVER (PARTITION BY host, node)
                THEN segment
                WHEN contains(shape, '#') AND sum(n) OVER (PARTITION BY host, node, shape) * {KEPT_SHARE}
                     >= sum(n) OVER (PARTITION BY host, node) THEN shape
                ELSE '*' END AS g
    FROM spread),
parts AS (SELECT host, path, list(g ORDER BY place) AS g FROM general GROUP BY ALL),
found AS (SELECT host, path, len(g) AS depth, array_to_string(g[1:len(g) - 1], '/') AS branch, g[len(g)] AS leaf,
                 n, rule, given
          FROM parts JOIN paths USING (host, path) LEFT JOIN given USING (host, path)),
leaves AS (SELECT host, depth, branch, leaf, sum(n)::BIGINT AS n,
                  coalesce(sum(n) FILTER (given IS NOT NULL), 0)::BIGINT AS labelled,
                  coalesce(sum(n) FILTER (given = 'block'), 0)::BIGINT AS blocked FROM found GROUP BY ALL),
shares AS (SELECT *, (n * 8 + of_branch) // (of_branch * 2) AS quarters
           FROM (SELECT *, (sum(n) OVER (PARTITION BY host, depth, branch))::BIGINT AS of_branch FROM leaves)),
signatures AS (SELECT host, depth, branch,
                      coalesce(list((leaf, quarters) ORDER BY leaf) FILTER (quarters > 0), [])::VARCHAR AS signature
               FROM shares GROUP BY ALL),
merged AS (SELECT host, depth, branch, min(branch) OVER (PARTITION BY host, depth, signature) AS merged FROM signatures),
hosts AS (SELECT host, (sum(blocked)::BIGINT + {PRIOR_PAGES}::DOUBLE * 0.5::DOUBLE)
                       / (sum(labelled)::BIGINT + {PRIOR_PAGES}::DOUBLE) AS prior FROM leaves GROUP BY 1),
pure AS (SELECT host, depth, merged, leaf, sum(labelled)::BIGINT AS labelled, sum(blocked)::BIGINT AS blocked
         FROM leaves JOIN merged USING (host, depth, branch) GROUP BY ALL),
judged AS (SELECT f.host, f.path, f.rule, coalesce(f.given, CASE
                  WHEN (p.blocked + h.prior * {PRIOR_PAGES}::DOUBLE) / (p.labelled + {PRIOR_PAGES}::DOUBLE) >= {REJECT_AT}::DOUBLE
                  THEN 'block' ELSE 'allow' END) AS verdict
           FROM found f JOIN merged m USING (host, depth, branch)
           JOIN pure p ON p.host = f.host AND p.depth = f.depth AND p.merged = m.merged AND p.leaf = f.leaf
           JOIN hosts h ON h.host = f.host)
SELECT page_id, host, path, rule, verdict FROM urls JOIN judged USING (host, path)
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    items = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {OP2_WORDS} AS w FROM documents),
i AS (SELECT item_id, {OP2_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
          FROM i WHERE len(w) > 0)),
starts AS (
    SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, item_id FROM starts JOIN windows USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("id").cast("string")) % modulus


def with_decision(scores: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), usable=remainder(4) != 2)
    return with_decision(score_toxicity(docs, model), F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 0.3)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), word_tokenizer(), end_id=1, capacity=4096)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("node") % 20 == 0, k=20)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(docs)
    write_token_files(docs, path, word_tokenizer(), end_id=2)
    return read_token_files(spark, path, with_ids=False)


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return formatted_and_read(turns.unionByName(added))


OP7_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
sized AS (
    SELECT *, 10 + length(role) + length(t)
        + length(regexp_replace(role || t, '[^<|\[\\]', '', 'g')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated(table(spark, sf_dir, "documents"), least=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q
         FROM windows JOIN firsts USING (k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS text
         FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY 1),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), usable=remainder(3) != 1)
    return with_decision(score_quality(docs, model), F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 0.5)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


OP10_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + least(3, len(w)) - 1], ' ')) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS MATERIALIZED (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
                      FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
reached AS (SELECT doc_id AS a, doc_id AS c FROM documents
            UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.c)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(c) AS c FROM reached GROUP BY 1) USING (doc_id)
"""


PARTS, ENTRIES, ROUNDS = 16, 64, 2


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"), PARTS, ENTRIES, ROUNDS, scale=256)
    return coded.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


def _op11_sql() -> str:
    near = lambda k: f"""
near{k} AS MATERIALIZED (
    SELECT row, part, arg_min(entry, far * 256 + entry) AS entry, min(far) AS far
    FROM (SELECT row, p.part, entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
          FROM p JOIN b{k} b USING (part))
    GROUP BY row, part)"""  # noqa: E731
    moved = lambda k: f"""
m{k} AS (SELECT part, entry, i, sum(x)::BIGINT AS s, count(*) AS n
         FROM (SELECT part, entry, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM p JOIN near{k} USING (row, part))
         GROUP BY ALL),
f{k} AS (SELECT part, entry, list((s - ((s % n + n) % n)) // n ORDER BY i) AS v FROM m{k} GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(f{k}.v, b{k}.v) AS v FROM b{k} LEFT JOIN f{k} USING (part, entry))"""  # noqa: E731
    rounds = ",".join(near(k) + "," + moved(k) for k in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
    SELECT row, part, x[part * (len(x) // {PARTS}) + 1:(part + 1) * (len(x) // {PARTS})] AS v
    FROM (SELECT row, x, unnest(range({PARTS})) AS part FROM kept)),
b0 AS MATERIALIZED (SELECT part, row AS entry, v FROM p WHERE row < {ENTRIES}),{rounds},{near(ROUNDS)},
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
          FROM near{ROUNDS} GROUP BY row),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS sha FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM coded JOIN kept USING (row), books
"""


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(pages)
    write_archive(pages, path, least=0)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT b, max(page_id) AS response FROM p GROUP BY b),
r AS (SELECT page_id, h, octet_length(p.b) AS n, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS kind, response
      FROM p JOIN g ON p.b = g.b),
fives AS (SELECT DISTINCT h, i, ('0x' || substr(h, i * 5 + 1, 5))::INTEGER AS v FROM (SELECT h, unnest(range(8)) AS i FROM r)),
digests AS (
    SELECT h, string_agg(substr(a, (v >> 15) + 1, 1) || substr(a, ((v >> 10) & 31) + 1, 1) || substr(a, ((v >> 5) & 31) + 1, 1)
                         || substr(a, (v & 31) + 1, 1), '' ORDER BY i) AS d
    FROM fives, (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a) GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, kind AS record_type,
       CASE WHEN kind = 'revisit' THEN response END AS refers_to
FROM r JOIN digests USING (h)
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64, offset=1_000_000)
    return found.withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_token_files": op6_token_files,
    "op7_chat_format": op7_chat_format,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality": op9_quality,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_warc": op12_warc,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op2_decontamination": OP2_SQL,
    "op7_chat_format": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_warc": OP12_SQL,
}
