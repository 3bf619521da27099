"""Registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm import chats, exact_dedup, hnsw, languages, minhash, mixing, phrases, pieces, runs, secrets, sharding, toxicity, url_filters
from codesieve.llm.common import documents, table
from codesieve.llm.url_filters import UrlRule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_hnsw(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op2_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


ORACLE["op2_mix_sources"] = """
    WITH RECURSIVE counts AS (SELECT source, count(*) AS c FROM documents GROUP BY source),
    shares AS (SELECT source, greatest(1, CAST(floor(1000 * sqrt(c) / (SELECT sum(sqrt(c)) FROM counts) + 0.5) AS INT))
                      AS n, row_number() OVER (ORDER BY source NULLS FIRST) AS k FROM counts),
    whole AS (SELECT CAST(sum(n) AS BIGINT) AS d, list(n ORDER BY k) AS ns FROM shares),
    edf(t, done, pick) AS (
        SELECT CAST(-1 AS BIGINT), list_transform(ns, lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM whole
        UNION ALL
        SELECT next.t, list_transform(next.done, lambda x, j: x + CASE WHEN j = next.pick THEN 1 ELSE 0 END), next.pick
        FROM (SELECT e.t + 1 AS t, e.done AS done,
                     list_min(list_filter(list_transform(e.done, lambda x, j: CASE
                        WHEN x < w.ns[j] AND (x * w.d) // w.ns[j] <= e.t + 1
                        THEN (((x + 1) * w.d + w.ns[j] - 1) // w.ns[j]) * 1000000 + j END), lambda y: y IS NOT NULL)) % 1000000 AS pick
              FROM edf e, whole w WHERE e.t + 1 < w.d) next),
    period AS (SELECT pick AS k, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS i FROM edf WHERE t >= 0),
    rows AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY
                    md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r FROM documents)
    SELECT doc_id, r.source AS source, r // 64 AS block, (r // 64) // n * (SELECT d FROM whole) + p.t AS slot, r % 64 AS place
    FROM rows r JOIN shares s ON r.source IS NOT DISTINCT FROM s.source JOIN period p ON p.k = s.k AND p.i = (r // 64) % n"""


TOXIC_FROM = 0.7


def remainder(divisor: int, column: str = "doc_id"):
    """The contract's split: CRC-32 of the id as text, modulo."""
    return F.crc32(F.col(column).cast("string")) % divisor


def toxicity_machine(spark, docs, sf_dir):
    """Machine that has seen no label of a held-out document."""
    labels = table(spark, sf_dir, "labels").where(remainder(3) != 1)
    return toxicity.fit(docs, labels)


@query
def op3_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity_machine(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "worst")


@query
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.find_duplicates(documents(spark, sf_dir))


ORACLE["op4_exact_dedup"] = r"""
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
               FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)"""


@query
def op5_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


@query
def op6_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir))


# Rules fixed by the contract.
URL_RULES = [UrlRule("com", "/", "allow"), UrlRule("example.com", "/en/", "block"),
             UrlRule("www.example.com", "/en/", "allow"), UrlRule("net", "/es/", "block"),
             UrlRule("net", "/fr/", "block")]


@query
def op7_url_filters(spark, sf_dir):
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op7_url_filters"] = r"""
    WITH rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
            ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    parts AS (SELECT row_number() OVER () AS n, page_id, strpos(coalesce(url, ''), '://') AS sep, url FROM pages),
    p AS (SELECT n, page_id,
                 CASE WHEN sep = 0 THEN '' ELSE translate(regexp_extract(substr(url, sep + 3), '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
                 CASE WHEN sep = 0 THEN '' ELSE regexp_extract(substr(url, sep + 3), '^[^/?#]*([^?#]*)', 1) END AS path
          FROM parts),
    fits AS (SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                    arg_max(verdict, length(rule_host || rule_path)) AS verdict
             FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                              AND starts_with(path, rule_path) GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (n)"""


@query
def op8_secret_scans(spark, sf_dir):
    found = secrets.find_secrets(documents(spark, sf_dir))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


@query
def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    profiles = languages.fit(docs.where(remainder(4) != 2))
    found = languages.identify(docs, profiles)
    return found.withColumn("held_out", F.coalesce(remainder(4) == 2, F.lit(False)))


@query
def op10_sentencepiece(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encode_and_decode(documents(spark, sf_dir), model))


def planted_runs(docs):
    """Documents of op11's contract: every tenth text repeats from some word on (by the CRC-32 of the id)."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", crc.alias("h"), F.when(crc % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(repeated, " "))
                       .otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = runs.periodic_runs(planted_runs(documents(spark, sf_dir)))

    def better(best, run):
        """Greater length / period, then smaller start, then smaller period; runs come by start and period."""
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    kind = "struct<start:long,length:long,period:long>"
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_phrase_mining(spark, sf_dir):
    return phrases.collocations(documents(spark, sf_dir))


ORACLE["op12_phrase_mining"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    listed AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
    starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM listed),
    grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
              FROM starts, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(ws)),
    counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
    sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k AS size, string_split(phrase, ' ') AS ws, phrase, f AS a FROM counts WHERE k > 1 AND f >= 10),
    parts AS MATERIALIZED (
        SELECT lang, phrase, a, k AS cut, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
    cuts AS (SELECT p.lang, p.phrase, a, cut, l.f AS l, r.f AS r,
                    (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS score
             FROM parts p JOIN counts l ON l.lang = p.lang AND l.phrase = p.first
             JOIN counts r ON r.lang = p.lang AND r.phrase = p.rest),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inside AS (SELECT lang, phrase, max(a) AS longer FROM (
                   SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM candidates WHERE size = 3 UNION ALL
                   SELECT lang, array_to_string(ws[2:3], ' ') AS phrase, a FROM candidates WHERE size = 3) GROUP BY lang, phrase),
    ranked AS (SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank,
                      c.phrase, a, l, r, score
               FROM lowest c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
               WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""


#: Added to the conversations by the contract: a user, then an assistant, say this.
PLANTED_CHAT, PLANTED_TEXT = -7, r"\### Assistant: </turn> ok"


@query
def op13_chat_formatting(spark, sf_dir):
    planted = spark.range(2).select(
        F.lit(PLANTED_CHAT).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(*planted.columns).union(planted)
    found = chats.format_turns(rows).select(
        "conv_id", chats.turns_of(F.col("formatted")).alias("turns"),
        F.array_join(chats.learned_texts(F.col("formatted"), F.col("loss_spans")), "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                        "formatted_chars")


ORACLE["op13_chat_formatting"] = r"""
    WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    escaped AS (SELECT *, replace(replace(replace(text, '\', '\0;'), '###', '\1;'), '</turn>', '\2;') AS body,
                       replace(replace(replace(replace(role, '\', '\0;'), '###', '\1;'), '</turn>', '\2;'), chr(10), '\3;')
                       AS head FROM rows)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(4 + length(head) + 2 + length(body) + 8) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id"""
