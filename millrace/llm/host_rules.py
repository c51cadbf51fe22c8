"""Quality rules that judge a document together with its host.

Every text is measured whole (words, their characters, symbols, repeated lines, words in repeated
windows of ``WINDOW`` words) and held against the rules of ``RULES``. Failures of each rule are summed by
host. Between hosts the failure rate of a rule is taken to follow a beta distribution whose mean and
strength are found by moments over all hosts; a host's rate is its posterior mean, so a host with a few
documents stays near the mean of all. A host is

* ``rejected`` if its rate of documents that fail any rule is above ``REJECT`` by ``SURE`` standard deviations,
* ``strict`` for a rule whose rate is above ``STRICT`` and twice the overall rate by as much,
* trusted otherwise.

The verdicts are joined back: a document goes if it fails a base rule (too short, too repetitive), if its
host is rejected, or if it fails a rule for which its host is strict. A document of a trusted host that
fails another rule stays.

Only DataFrame operations are used. Windows are compared by 64-bit hashes of the hashes of their words.
Null and empty texts have no words and fail the base rule on length. Documents with a null host form a host of
their own. Rows that repeat an id are judged each; other columns are not read. Without rows there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shared import prepared, stored
from millrace.operators.relational import hot_split_join

WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
REJECT, STRICT, SURE = 0.5, 0.1, 2.0
STRONGEST = 1e6
"""Documents that the prior counts as where hosts do not differ beyond chance."""
RULES = ("short", "repetitive", "symbols", "word_length", "lines")
BASE = ("short", "repetitive")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(windows: str) -> Column:
    """Words covered by the windows that occur at least twice."""
    pairs = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(s, j)["w"] == F.get(s, k)["w"], F.lit(False))
        spots = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.sort_array(F.transform(spots, lambda j: F.get(s, j)["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    no_repeat = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(no_repeat, F.lit(0).cast("bigint")).otherwise(_bound(_bound(pairs, places), covered))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every row; no shuffle."""
    host = F.coalesce(F.concat(F.lit("s"), F.col(host_col).cast("string")), F.lit("n"))
    rows = docs.select(F.col(id_col).alias("id"), host.alias("host"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", "host", "text", F.array_remove(F.split("text", WORD_GAP), "").alias("words"),
                       F.filter(F.split("text", "\n"), lambda line: F.translate(line, BLANKS, "") != "").alias("lines"))

    def windows(h: Column) -> Column:
        last = F.size(h) - WINDOW
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    length = lambda text: F.char_length(text).cast("bigint")
    rows = rows.select(
        "id", "host", F.size("words").cast("bigint").alias("n_words"), length(F.translate("text", BLANKS, "")).alias("word_chars"),
        (length("text") - length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _bound(F.transform("words", lambda w: F.xxhash64(w)), windows).alias("windows"))
    return rows.select(*[c for c in rows.columns if c != "windows"], _repeated("windows").alias("n_repeat_words"))


def failures() -> dict[str, Column]:
    """What each rule of ``RULES`` says of a measured row, true if it fails."""
    n = F.col("n_words")
    return {
        "short": n < 20,
        "repetitive": 100 * F.col("n_repeat_words") > 30 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
        "lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


def _either(parts: list[Column]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | part
    return out


def prior_of(counts: DataFrame, names: tuple[str, ...]) -> dict[str, tuple[float, float]]:
    """(mean, strength) of the beta prior of each rule, from (docs, one failure count per name) of every host.

    The moment estimator of the correlation within hosts; one row of sums comes to the driver.
    """
    n = F.col("docs").cast("double")
    total = counts.agg(F.sum("docs").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    if not total["n"]:
        return {c: (0.5, STRONGEST) for c in names}
    mean = {c: total[c] / total["n"] for c in names}
    spread = counts.agg(F.count("*").alias("hosts"), F.sum(n * n).alias("squares"),
                        *[F.sum(n * (F.col(c) / n - mean[c]) * (F.col(c) / n - mean[c])).alias(c) for c in names]).first()
    out = {}
    for c in names:
        chance = mean[c] * (1 - mean[c])
        free = spread["hosts"] - 1
        room = chance * (total["n"] - spread["squares"] / total["n"] - free)
        within = (spread[c] - chance * free) / room if room > 0 else 0.0
        out[c] = mean[c], min(max(1 / within - 1, 1.0), STRONGEST) if within > 0 else STRONGEST
    return out


def verdicts(rows: DataFrame) -> DataFrame:
    """(host, host_docs, host_rate, rejected, strict) of every host; ``strict`` lists rules.

    ``rows`` holds (host, one boolean per rule); only counts by host are shuffled.
    """
    names = (*RULES, "any")
    one = lambda c: F.sum(F.col(c).cast("bigint")).alias(c)
    counts = stored(rows.withColumn("any", _either([F.col(c) for c in RULES])).groupBy("host").agg(
        F.count("*").alias("docs"), *[one(c) for c in names]))
    prior = prior_of(counts, names)

    def rate(c: str) -> Column:
        mean, strength = prior[c]
        return (F.col(c) + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength))

    def least(c: str) -> Column:
        return rate(c) - SURE * F.sqrt(rate(c) * (1 - rate(c)) / (F.col("docs") + F.lit(prior[c][1] + 1)))

    strict = [F.when(least(c) > max(STRICT, 2 * prior[c][0]), F.lit(c)) for c in RULES]
    return counts.select("host", F.col("docs").alias("host_docs"), rate("any").alias("host_rate"),
                         (least("any") > REJECT).alias("rejected"), F.array_compact(F.array(*strict)).alias("strict"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures of every row, the rules it fails, its host's rate and verdict, and whether it is kept."""
    prepared(docs.sparkSession)
    rows = stored(measured(docs, id_col, text_col, host_col))
    rows = rows.withColumns(failures())
    # one row per host on the other side; hosts with a large share of all rows stay out of the shuffle
    joined = hot_split_join(rows, verdicts(rows), ["host"])
    base = _either([F.col(c) for c in BASE])
    failed = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in RULES]))
    against = _either([F.col(c) & F.array_contains("strict", c) for c in RULES])
    return joined.select("id", F.when(F.col("host") != "n", F.substring("host", 2, 1 << 30)).alias("host_name"), "n_words", "word_chars", "n_symbols", "n_lines",
                         "n_dup_lines", "n_repeat_words", failed.alias("failed"), "host_docs", "host_rate", "rejected", "strict",
                         base.alias("base_failed"), (~base & ~F.col("rejected") & ~against).alias("kept"))
