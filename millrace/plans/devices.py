"""Event profiles of devices, the device dimension, and the training sets built from them."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, functions as F

from millrace.functions.scalars import concat_key, round_half_even
from millrace.operators import aggregates as A, encoding as E, ensembling as B, models as M, sparse as P
from millrace.operators import tuning as T
from millrace.operators.sampling import split_by_fraction, stratified_folds
from millrace.session import cut_lineage

HOURS = list(range(24))

# Hours of the six parts of the day.
DAY_PARTS = {
    "h_morning": [5, 6, 7, 8, 9],
    "h_midday": [10, 11, 12, 13],
    "h_afternoon": [14, 15, 16],
    "h_evening": [17, 18, 19, 20, 21],
    "h_night": [22, 23, 0],
    "h_nightowl": [1, 2, 3, 4],
}


def events_per_hour(events: DataFrame, device: str, time: str) -> DataFrame:
    """Counts h0 .. h23 and shares h0_n .. h23_n per device, one shuffle."""
    counts = A.counts_by_category(events, device, F.hour(time), HOURS, "h")
    names = [f"h{h}" for h in HOURS]
    return counts.select(device, *names, *A.normalise_row(names))


def events_day_spread(events: DataFrame, device: str, time: str) -> DataFrame:
    """Share of a device's events in each part of the day, two decimals, one shuffle."""
    hour = F.hour(time)
    counts = events.groupBy(device).agg(
        F.count("*").alias("_all"),
        *[F.count_if(hour.isin(hours)).alias(name) for name, hours in DAY_PARTS.items()])
    return counts.select(device, *[
        round_half_even(F.col(name) / F.col("_all"), 2).alias(name) for name in DAY_PARTS])


def profiles(events: DataFrame, device: str, time: str) -> DataFrame:
    """Hour shares and day-part shares together, from one pass and one shuffle."""
    counts = A.counts_by_category(events, device, F.hour(time), HOURS, "h")
    names = [f"h{h}" for h in HOURS]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return counts.select(
        device, *names, *A.normalise_row(names),
        *[round_half_even(sum((F.col(f"h{h}") for h in hours[1:]), F.col(f"h{hours[0]}")) / total, 2).alias(part)
          for part, hours in DAY_PARTS.items()])


def device_dimension(devices: DataFrame, brands: DataFrame, device: str, order: str,
                     brand: str, model: str) -> DataFrame:
    """One row per device with brand id, composite model id and the foreign flag.

    ``devices`` may repeat a device (the first row counts); ``brands`` is the hand-kept table
    (brand, is_foreign_brand).
    """
    first = A.keep_one(devices.select(device, order, brand, model), device, order, "first")
    keyed = first.withColumn("_model", concat_key(brand, model))
    coded = E.encode(keyed, E.sorted_levels(keyed, "_model"), "_model", "device_model_id")
    brand_ids = E.sorted_levels(brands, brand).withColumnRenamed("code", "phone_brand_id")
    return coded.join(brands.join(brand_ids, brand), brand).select(
        device, "phone_brand_id", "device_model_id", "is_foreign_brand")


def training_set(people: DataFrame, events: DataFrame, dimension: DataFrame, device: str,
                 time: str) -> DataFrame:
    """People with their event profile and device ids; 0 without events, -1 without a device."""
    profile = profiles(events, device, time).drop(*[f"h{h}" for h in HOURS])
    joined = people.join(profile, device, "left").na.fill(0.0, [c for c in profile.columns if c != device])
    with_device = joined.join(
        dimension.withColumn("is_foreign_brand", F.col("is_foreign_brand").cast("int")), device, "left")
    return with_device.na.fill(-1, ["phone_brand_id", "device_model_id", "is_foreign_brand"])


def device_tokens(people: DataFrame, events: DataFrame, event_apps: DataFrame, app_labels: DataFrame,
                  device: str, event: str, app: str, label: str, attributes: list[str]) -> DataFrame:
    """(device, tokens): distinct attribute values and the labels of all apps the device used.

    Each hop is made distinct before the next join: device-app pairs first, then labels.
    """
    device_apps = (
        event_apps.select(event, app).distinct()
        .join(events.select(event, device), event).select(device, app).distinct())
    labels = device_apps.join(app_labels.select(app, label).distinct(), app).select(
        device, F.concat(F.lit("label:"), F.col(label).cast("string")).alias("token")).distinct()
    own = people.select(device, F.explode(F.array(*[
        F.concat(F.lit(f"{a}:"), F.coalesce(F.col(a).cast("string"), F.lit("nan"))) for a in attributes]))
        .alias("token"))
    wanted = labels.join(people.select(device).distinct(), device, "left_semi")
    return A.distinct_tokens(own.unionByName(wanted), device, F.col("token"))


def sparse_blocks(people: DataFrame, events: DataFrame, event_apps: DataFrame, app_labels: DataFrame,
                  device: str, event: str, app: str, label: str, brand: str, model: str) -> DataFrame:
    """(device, block, col) of the brand, model, app and label blocks, side by side."""
    composite = people.select(device, F.col(brand).alias("_brand"), concat_key(brand, model).alias("_model"))
    # read by several blocks and their level tables, so computed once
    device_apps = cut_lineage(event_apps.select(event, app).distinct()
                              .join(events.select(event, device), event).select(device, app).distinct())
    used_labels = app_labels.select(app, label).distinct().join(
        device_apps.select(app).distinct(), app, "left_semi")
    device_labels = device_apps.join(used_labels, app).select(device, label).distinct()

    blocks = []
    for name, pairs, column, universe in [
            ("brand", composite, "_brand", composite), ("model", composite, "_model", composite),
            ("app", device_apps, app, device_apps), ("label", device_labels, label, used_labels)]:
        levels = E.sorted_levels(universe, column)
        wanted = pairs.select(device, column).join(people.select(device).distinct(), device, "left_semi")
        coded = wanted.where(F.col(column).isNotNull()).join(levels, column)
        blocks.append((name, coded.select(device, F.col("code").alias("col")), levels.count()))
    return P.offset_blocks(blocks, device)


def group_scores(train: DataFrame, test: DataFrame, device: str, group: str, candidates, folds: int = 3,
                 seed: int = 0) -> tuple[DataFrame, str, float]:
    """(device, one column per group), the method used and its loss.

    The best single model and the stacked blend are compared on the same held-out devices.
    """
    train, test = cut_lineage(train), cut_lineage(test)
    indexer = StringIndexer(inputCol=group, outputCol="label", stringOrderType="alphabetAsc").fit(train)
    columns = [c for c in train.columns if c not in (device, group)]
    rows = M.assemble(indexer.transform(train), columns, [device, "label"])
    fit_rows, held = split_by_fraction(rows, device, 0.6, f"{seed}-hold-out")
    unseen = M.assemble(test, columns, [device])
    with M.kept(fit_rows) as kept_fit, M.kept(held) as kept_held:
        loss = MulticlassClassificationEvaluator(metricName="logLoss")
        name, single_loss, single = T.compare(kept_fit, kept_held, candidates, loss)[0]
        stack = B.Stack(candidates, folds, iterations=20)
        stack.fit(stratified_folds(kept_fit, device, "label", folds, f"{seed}-folds"), device, "label", "fold")
        blend_loss = B.multiclass_loss(stack.transform(kept_held, [device, "label"]))
    method, lowest, scorer = B.choose_lower(
        (name, single_loss, lambda df: single.transform(df).select(device, "probability")),
        ("blend", blend_loss, lambda df: stack.transform(df, [device]).select(device, "probability")))
    return M.probability_columns(scorer(unseen), list(indexer.labels)), method, lowest
