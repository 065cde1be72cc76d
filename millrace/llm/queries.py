"""The operators as queries over the driver tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, hmm, licenses, lsh, minhash, mixing, passages, quality, repair, runs, toxicity, unigram, urllists
from .text import unit_draw


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_quality_rules(spark, folder):
    return quality.quality(_read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "token_entropy", "reason",
    )


# --- temporal list join: list changes and fetch days are derived from the pages ---------------------------------

LISTS = ("adult", "malware", "spam")
FIRST_DAY = "2021-01-01"


def _host_changes(pages: DataFrame) -> DataFrame:
    """Dated additions and removals for half of all (list, host or its domain); a second addition for half of these."""
    host = urllists.url_host(F.col("url"))
    hosts = pages.select(host.alias("key")).where("key IS NOT NULL").distinct()
    domain = F.array_join(F.slice(F.split("key", r"\."), -2, 2), ".")
    keys = hosts.unionByName(hosts.where(F.size(F.split("key", r"\.")) > 2).select(domain.alias("key"))).distinct()
    listed = keys.select(F.explode(F.array(*map(F.lit, LISTS))).alias("list"), "key")
    draw = lambda what: unit_draw(what, F.col("list"), F.col("key"))
    first = F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(draw("added") * 400).cast("int"))
    gone = F.date_add(first, (30 + F.floor(draw("removed") * 300)).cast("int"))
    events = F.array(
        F.struct(first.alias("changed"), F.lit(True).alias("active")),
        F.struct(gone.alias("changed"), F.lit(False).alias("active")),
        F.when(draw("again") < 0.5, F.struct(F.date_add(gone, 60).alias("changed"), F.lit(True).alias("active"))),
    )
    some = listed.where(draw("listed") < 0.5)
    return some.select("list", "key", F.explode(F.array_compact(events)).alias("e")).select("list", "key", "e.*")


def op2_url_lists(spark, folder):
    pages = _read(spark, folder, "pages").select("page_id", "url")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(unit_draw("fetched", F.col("page_id")) * 1000).cast("int"))
    captures = pages.withColumn("day", day)
    found = urllists.listed_captures(captures, urllists.validity_intervals(_host_changes(pages)), "url", "day")
    return found.select(
        "row.page_id", "host", F.col("fetched").cast("string").alias("fetched"), "n_active", "lists",
        F.col("newest").cast("string").alias("newest"), "blocked",
    )


def _draw_sql(what: str, *keys: str) -> str:
    joined = " || ':' || ".join([f"'{what}'", *(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)])
    return f"(CAST(('0x' || substr(md5({joined}), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)"


_OP2 = f"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
         DATE '{FIRST_DAY}' + CAST(floor({_draw_sql("fetched", "page_id")} * 1000) AS INTEGER) AS day
  FROM pages),
hosts AS (SELECT DISTINCT host AS key FROM p WHERE host IS NOT NULL),
keys AS (
  SELECT key FROM hosts
  UNION SELECT array_to_string(list_slice(string_split(key, '.'), -2, -1), '.') FROM hosts
  WHERE len(string_split(key, '.')) > 2),
listed AS (
  SELECT list, key, DATE '{FIRST_DAY}' + CAST(floor({_draw_sql("added", "list", "key")} * 400) AS INTEGER) AS first
  FROM keys, (SELECT unnest({list(LISTS)}) AS list) l WHERE {_draw_sql("listed", "list", "key")} < 0.5),
gone AS (SELECT *, first + (30 + CAST(floor({_draw_sql("removed", "list", "key")} * 300) AS INTEGER)) AS gone FROM listed),
entries AS (
  SELECT list, key, first AS since, gone AS until FROM gone
  UNION ALL SELECT list, key, gone + 60, NULL FROM gone WHERE {_draw_sql("again", "list", "key")} < 0.5)
SELECT page_id, any_value(host) AS host, CAST(any_value(day) AS VARCHAR) AS fetched, count(list) AS n_active,
       string_agg(DISTINCT list, ',' ORDER BY list) AS lists, CAST(max(since) AS VARCHAR) AS newest,
       count(list) > 0 AS blocked
FROM p LEFT JOIN entries
  ON (host = key OR ends_with(host, '.' || key)) AND since <= day AND (until IS NULL OR day < until)
GROUP BY rid, page_id
"""


def op3_source_mix(spark, folder):
    return mixing.mix_sizes(_read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate"
    )


_OP3 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 2 * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER full_first AS k,
         ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER (full_first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (full_first ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW full_first AS (ORDER BY cap / weight::DOUBLE, source NULLS LAST)),
l AS (SELECT min_by(level, k) AS level FROM o WHERE cap > level * weight),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT level FROM l)) AS target FROM w),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT doc_id, size, source_size, target, rate,
       size * CAST(floor(rate) + CAST({_draw_sql("mix", "doc_id")} < rate - floor(rate) AS BIGINT) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""


def op4_token_counts(spark, folder):
    return unigram.token_counts(_read(spark, folder, "documents"))


def op5_license_rules(spark, folder):
    found = licenses.scan(_read(spark, folder, "documents"))
    return found.select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"),
    )


def op6_word_bpe(spark, folder):
    return bpe.digests(_read(spark, folder, "documents"))


def op7_toxic_neighbours(spark, folder):
    found = toxicity.scores(_read(spark, folder, "documents"), _read(spark, folder, "labels").select("doc_id", "toxic"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("evidence").alias("n_evidence"))


def op8_multiprobe_lsh(spark, folder):
    return lsh.nearest(_read(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op9_hmm_score(spark, folder):
    return hmm.score(_read(spark, folder, "documents"))


def op10_minhash_dedup(spark, folder):
    return minhash.near_duplicates(_read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op11_conversation_repair(spark, folder):
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.report(repair.edits(repair.damaged(rows)))
    # Conversations of which nothing is left after the damage are in the report as well.
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_periodic_runs(spark, folder):
    found = runs.periodic_runs(runs.with_planted_runs(_read(spark, folder, "documents")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_repeated_passages(spark, folder):
    found = passages.repeated_passages(_read(spark, folder, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_url_lists, op3_source_mix, op4_token_counts, op5_license_rules, op6_word_bpe,
        op7_toxic_neighbours, op8_multiprobe_lsh, op9_hmm_score, op10_minhash_dedup, op11_conversation_repair, op12_periodic_runs, op13_repeated_passages)
}

ORACLE = {"op2_url_lists": _OP2, "op3_source_mix": _OP3}
