"""The registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (chats, decontamination, fingerprints, host_rules, languages, licenses, middle, mixing, near_copies,
                          periodic, private_data, quality, toxicity)
from millrace.llm.shared import prepared

CONTROL = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the benchmark items it holds."""
    return decontamination.flagged(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that the mixture takes."""
    return mixing.mix(_table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "rate", "copies")


def op3_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _table(spark, folder, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = languages.learn(docs.where(~F.coalesce(held, F.lit(False))).select("text", "lang"))
    found = languages.predict(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "langs")


def op4_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted text."""
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    read = chats.read_back(chats.format_chats(table.unionByName(extra)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(F.col("id").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
marked AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS safe,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(safe) + CASE WHEN before IS NULL THEN length('<|im_start|>') + length(role) + 1
    WHEN before = role THEN length('<|im_sep|>') ELSE length('<|im_end|>') + 1 + length('<|im_start|>') + length(role) + 1 END)
    + length('<|im_end|>') + 1 AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op5_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies over three-word shingles at a similarity of 0.85."""
    return near_copies.near_copies(_table(spark, folder, "documents"), width=3, percent=85).withColumnRenamed("id", "doc_id")


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
classes AS MATERIALIZED (SELECT min(doc_id) AS rep, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
shingles AS MATERIALIZED (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y),
component AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY x),
named AS (SELECT classes.s AS s, component_id FROM classes JOIN component USING (rep))
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN named ON list_sort(named.s) = list_sort(sets.s) AND len(sets.s) > 0
"""


def op6_private_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    found = private_data.detect(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", *private_data.digest())


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of every document along the chain, and whether it is rejected."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, _table(spark, folder, "labels"))
    scored = toxicity.predict(docs, chain)
    return scored.select("row.doc_id", *[f"p_{c}" for c in chain.categories], F.col("rejected").alias("toxic"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document with its source as host and the source's language section as path."""
    docs = _table(spark, folder, "documents")
    found = quality.quality(docs, _table(spark, folder, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return found.withColumnRenamed("id", "doc_id").withColumn("keep", F.col("quality") >= 0.5)


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families of every document with a licensing paragraph."""
    return licenses.scan(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edits(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op11_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document and whether its own rules and its host's verdict keep it."""
    found = host_rules.judge(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        F.array_join("failed", ",").alias("failed"), F.round("host_rate", 6).alias("host_rate"), "base_failed", "kept")


OP11_SQL = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(8) AS t(k) GROUP BY doc_id),
base AS MATERIALIZED (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
rules AS MATERIALIZED (
  SELECT *, [CASE WHEN n_words < 20 THEN 'short' END, CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 'repetitive' END,
    CASE WHEN 10 * n_symbols > n_words THEN 'symbols' END,
    CASE WHEN word_chars < 3 * n_words OR word_chars > 10 * n_words THEN 'word_length' END,
    CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 'lines' END] AS failed FROM base),
long AS (
  SELECT host, unnest(['short', 'repetitive', 'symbols', 'word_length', 'lines', 'any']) AS rule,
    unnest(list_transform(failed, lambda x: (x IS NOT NULL)::BIGINT) || [(len(list_filter(failed, lambda x: x IS NOT NULL)) > 0)::BIGINT]) AS f FROM rules),
counts AS MATERIALIZED (SELECT rule, host, sum(f)::DOUBLE AS f, count(*)::DOUBLE AS n FROM long GROUP BY rule, host),
total AS (SELECT rule, sum(f) / sum(n) AS mean, sum(n) AS n, sum(n * n) AS squares, count(*) - 1 AS free FROM counts GROUP BY rule),
spread AS (
  SELECT rule, any_value(mean) AS mean, any_value(mean * (1 - mean)) AS chance, any_value(total.free) AS free,
    any_value(total.n - squares / total.n - total.free) AS room, sum(counts.n * (f / counts.n - mean) ** 2) AS s
  FROM counts JOIN total USING (rule) GROUP BY rule),
within AS (SELECT *, CASE WHEN chance * room > 0 THEN (s - chance * free) / (chance * room) ELSE 0 END AS r FROM spread),
prior AS (SELECT rule, mean, CASE WHEN r > 0 THEN least(greatest(1 / r - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM within),
rate AS (SELECT rule, host, mean, strength, n, (f + mean * strength) / (n + strength) AS rate FROM counts JOIN prior USING (rule)),
least_rate AS (SELECT *, rate - 2.0 * sqrt(rate * (1 - rate) / (n + strength + 1)) AS low FROM rate),
verdict AS (
  SELECT host, max(rate) FILTER (rule = 'any') AS host_rate, bool_or(rule = 'any' AND low > 0.5) AS rejected,
    coalesce(list(rule) FILTER (rule <> 'any' AND low > greatest(0.1, 2 * mean)), []) AS strict FROM least_rate GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, array_to_string(list_filter(failed, lambda x: x IS NOT NULL), ',') AS failed,
  round(host_rate, 6) AS host_rate, failed[1] IS NOT NULL OR failed[2] IS NOT NULL AS base_failed,
  NOT (failed[1] IS NOT NULL OR failed[2] IS NOT NULL OR rejected OR len(list_intersect(failed, strict)) > 0) AS kept
FROM rules JOIN verdict USING (host)
"""


def op12_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut for filling in its middle: digests of the output and of the text rebuilt from it."""
    filled = middle.fill(middle.frames(_table(spark, folder, "documents")))
    return middle.digests(filled).withColumnRenamed("id", "doc_id")


OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
draws AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (
  SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document's words; a tenth of the documents, by their ids, repeat a part of themselves to the end."""
    docs = _table(spark, folder, "documents").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.array_remove(F.split("text", host_rules.WORD_GAP), "")
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(F.col("text"))
    found = periodic.find(docs.select("doc_id", text.alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    runs = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.select("id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("best"), F.sha2(runs, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select(F.col("id").alias("doc_id"), "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
                        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The whole corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_mix, op3_languages, op4_chats, op5_near_copies, op6_private_data,
                                   op7_toxicity, op8_quality, op9_licenses, op10_fingerprints, op11_host_rules, op12_middle, op13_periodic_runs, pipeline)}
ORACLES = {"op4_chats": OP4_SQL, "op5_near_copies": OP5_SQL, "op11_host_rules": OP11_SQL, "op12_middle": OP12_SQL}
