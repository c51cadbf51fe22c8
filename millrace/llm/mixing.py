"""Source mixing by entropy balancing.

Every document gets a rate between 0 and ``MOST`` copies that is an exponential tilt of rate 1,
``MOST / (1 + (MOST - 1) exp(-lambda z))`` with ``z`` the document's size over its source's mean: the
rates of least relative entropy for which the expected words of each source meet its target.
Their convex dual has one multiplier per source; damped Newton steps, each an aggregation over
all sources at once, solve it. Rates are then rounded into whole copies so that the words taken
stay near the target of each source.

Documents count once per row. Sources are ordered by code point with null last and weigh
1, 2, 3, 1, ...; a source's target is its share by weight of all words, at most ``MOST`` times its
own words, the excess shared anew. Null and empty texts have size 0 and are taken once. Repeated
rows are ranked like others; which of identical rows is taken makes no difference. Without rows
there are none. Everything is DataFrame operations; sources, sizes and multipliers stay in
tables. Sizes are first counted per (source, size), so a source with a third of all rows is
worked on as its distinct sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.shared import prepared, stored

MOST = 3
STEPS = 40
STEPS_PER_TABLE = 4
CLOSE = 1e-7
"""Newton stops when every source's expected words are this near its target, relatively."""
FAR = 60.0
"""Largest multiplier: rates are then 0 or MOST but for the smallest documents."""
PASSES = 4
CELL = 2_000
"""Documents of one (source, size) that are ranked together."""


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def targets(cells: DataFrame) -> DataFrame:
    """(key, source_size, mean, target) from (key, size, n)."""
    sizes = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    order = Window.orderBy(F.col("key") == "n", "key")
    weighed = sizes.withColumn("weight", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("double"))
    # sources reach their limit in the order of limit / weight: those before a point are full,
    # the others share what is left by weight
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.lit(float(MOST)) * F.col("source_size")
    level = weighed.withColumn("total", F.sum("source_size").over(everything).cast("double")).withColumn(
        "full", F.coalesce(F.sum(limit).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn(
        "open", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))).withColumn(
        "level", (F.col("total") - F.col("full")) / F.col("open"))
    level = level.withColumn("fits", F.col("level") * F.col("weight") <= limit)
    shared = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), F.col("key"), F.col("level"))))
    level = level.withColumn("water", shared.over(everything)["level"])
    return level.select("key", "source_size", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)).alias("mean"),
                        F.least(limit, F.coalesce(F.col("water") * F.col("weight"), limit)).alias("target"))


def _rate(multiplier: Column, z: Column) -> Column:
    return F.lit(float(MOST)) / (1.0 + (MOST - 1.0) * F.exp(-multiplier * z))


def balance(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, multiplier, ...): Newton steps on the dual, kept inside a shrinking bracket.

    The bracket makes the steps safe: where a Newton step leaves it, its middle is taken. It
    grows with the mean size, as the least z of a source is 1 / mean.
    """
    wide = F.lit(FAR) * F.greatest("mean", F.lit(1.0))
    state = stored(wanted.where("source_size > 0").select(
        "key", "mean", "target", F.lit(0.0).alias("multiplier"),
        F.when(F.col("target") < F.col("source_size"), -wide).otherwise(0.0).alias("low"),
        F.when(F.col("target") > F.col("source_size"), wide).otherwise(0.0).alias("high"), F.lit(1.0).alias("off")))
    sizes = stored(cells.where("size > 0"))
    for _ in range(STEPS // STEPS_PER_TABLE):
        for _ in range(STEPS_PER_TABLE):
            z = F.col("size") / F.col("mean")
            rate = _rate(F.col("multiplier"), z)
            words = F.col("n") * F.col("size")
            step = sizes.join(state, "key").groupBy("key").agg(
                *[F.first(c).alias(c) for c in ("mean", "target", "multiplier", "low", "high")],
                (F.sum(words * rate) - F.first("target")).alias("miss"),
                F.sum(words * z * rate * (1.0 - rate / MOST)).alias("slope"))
            step = step.select(
                "key", "mean", "target", "multiplier", "miss",
                F.when(F.col("miss") < 0, F.greatest("low", "multiplier")).otherwise(F.col("low")).alias("low"),
                F.when(F.col("miss") > 0, F.least("high", "multiplier")).otherwise(F.col("high")).alias("high"),
                F.try_divide("miss", "slope").alias("move"))
            new = F.col("multiplier") - F.col("move")
            inside = (new > F.col("low")) & (new < F.col("high"))
            done = (F.abs("miss") <= CLOSE * F.col("target")) | (F.col("low") >= F.col("high"))
            state = step.select("key", "mean", "target",
                                F.when(done, F.col("multiplier")).when(inside, new).otherwise((F.col("low") + F.col("high")) / 2).alias("multiplier"),
                                "low", "high", F.when(done, 0.0).otherwise(F.abs("miss") / F.greatest("target", F.lit(1.0))).alias("off"))
        state = stored(state)
        if state.where(F.col("off") > CLOSE).isEmpty():
            break
    return wanted.join(state.select("key", "multiplier"), "key", "left").withColumn("multiplier", F.coalesce("multiplier", F.lit(0.0)))


def _round(cells: DataFrame, solved: DataFrame) -> DataFrame:
    """(key, size, n, total): copies of each (source, size) together, at most MOST * n."""
    joined = cells.join(solved, "key")
    full = F.col("target") >= F.col("source_size") * F.lit(float(MOST))
    none = F.col("target") <= 0
    rate = F.when(F.col("size") == 0, 1.0).when(full, float(MOST)).when(none, 0.0).otherwise(
        _rate(F.col("multiplier"), F.col("size") / F.col("mean")))
    order = Window.partitionBy("key").orderBy(F.desc("size"))
    running = joined.withColumn("rate", rate).withColumn("sum", F.sum(F.col("n") * F.col("rate")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # differences of the rounded running count: off by less than one copy anywhere in the order
    before = F.coalesce(F.lag("sum").over(order), F.lit(0.0))
    total = F.floor(F.col("sum") + 0.5) - F.floor(before + 0.5)
    out = running.withColumn("total", F.greatest(F.lit(0), F.least(total, F.col("n") * MOST)).cast("bigint"))
    # what is still missing or too much is put right with smaller and smaller documents
    whole = Window.partitionBy("key")
    for _ in range(PASSES):
        gap = F.sum(F.col("total") * F.col("size")).over(whole)
        out = out.withColumn("gap", F.col("target") - gap)
        room = F.when(F.col("gap") > 0, F.col("n") * MOST - F.col("total")).otherwise(F.col("total"))
        fit = (F.col("size") > 0) & (F.col("size") <= F.abs("gap"))
        out = out.withColumn("room", F.when(fit, room).otherwise(0))
        taken = F.coalesce(F.sum(F.col("room") * F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        move = F.greatest(F.lit(0), F.least(F.col("room"), F.floor((F.abs("gap") - taken) / F.greatest("size", F.lit(1)))))
        out = out.withColumn("total", (F.col("total") + F.signum("gap") * move).cast("bigint")).drop("gap", "room")
    return out.select("key", "size", "n", "total", "rate", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, rate, copies, taken) of every row."""
    prepared(docs.sparkSession)
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                              size_of(F.col(text_col).cast("string")).alias("size")).withColumn("key", _key(F.col("source"))))
    cells = stored(rows.groupBy("key", "size").agg(F.count("*").alias("n")))
    solved = balance(cells, stored(targets(cells)))
    rounded = stored(_round(cells, solved))
    # documents of one source and size share its copies evenly; who gets one more goes by hash
    placed = rows.join(rounded, ["key", "size"]).withColumn("draw", F.xxhash64(F.col("id"), F.lit(17))).withColumn(
        "part", F.pmod(F.col("draw"), F.ceil(F.col("n") / CELL)).cast("int"))
    parts = placed.groupBy("key", "size", "part").agg(F.count("*").alias("m"))
    offset = parts.select(F.col("key").alias("k"), F.col("size").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("m").over(
        Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("draw", "id")))
    ranked = ranked.join(offset, (F.col("key") == F.col("k")) & (F.col("size") == F.col("s")) & (F.col("part") == F.col("p")))
    extra = F.when(F.col("rank") + F.col("offset") <= F.col("total") % F.col("n"), 1).otherwise(0)
    copies = (F.floor(F.col("total") / F.col("n")) + extra).cast("bigint")
    return ranked.select("id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows themselves: each row as often as it has copies, numbered by ``copy``.

    Rows that repeat an id, source and size share the sum of their copies, on one of them.
    """
    plan = mix(docs, id_col, text_col, source_col).groupBy("id", _key(F.col("source")).alias("key"), "size").agg(F.sum("copies").alias("copies"))
    keyed = docs.withColumns({"_key": _key(F.col(source_col)), "_size": size_of(F.col(text_col).cast("string"))})
    first = keyed.dropDuplicates([id_col, "_key", "_size"])
    joined = first.join(plan.where("copies > 0").select(F.col("id").alias("_id"), F.col("key").alias("_k"), F.col("size").alias("_s"), F.col("copies").alias("_copies")),
                        F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("_size") == F.col("_s")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
