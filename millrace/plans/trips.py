"""Shopping trips: one row per visit with product or department counts, then a classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import zero_padded
from millrace.operators import aggregates as A, encoding as E, models as M, sparse as P

# Code of a missing product, digits of product and department names.
MISSING_PRODUCT = 999999
PRODUCT_DIGITS = 4
DEPARTMENT_DIGITS = 2
WEEKDAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]


def weekday_code(day: Column) -> Column:
    """0-based place of an English weekday name among the sorted names."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day) - 1


def product_triples(rows: DataFrame, visit: str, product: str) -> DataFrame:
    """(visit, feature, n): how often a visit has each product; the long form of the wide table."""
    code = F.coalesce(F.col(product).cast("bigint"), F.lit(MISSING_PRODUCT))
    return rows.groupBy(visit, zero_padded("Prod", code, PRODUCT_DIGITS).alias("feature")).agg(
        F.count("*").alias("n"))


def product_vectors(train: DataFrame, test: DataFrame, visit: str, product: str):
    """Sparse product counts of both tables over the products of either one."""
    long = [product_triples(df, visit, product) for df in (train, test)]
    levels = E.sorted_levels(long[0].select("feature").union(long[1].select("feature")), "feature")
    size = levels.count()
    named = levels.withColumnRenamed("code", "col")
    return [P.sparse_vectors(part.join(named, "feature"), visit, size) for part in long], size


def department_table(rows: DataFrame, visit: str, weekday: str, department: str, scans: str,
                     departments: Sequence[str], trip_type: str | None = None) -> DataFrame:
    """(visit, DoW, Dept00.., trip type): scans per department, returns counted as negative.

    ``departments`` lists the names in code order, so train and test get the same columns.
    """
    names = {d: f"Dept{i:0{DEPARTMENT_DIGITS}d}" for i, d in enumerate(departments)}
    keys = [visit, weekday] + ([trip_type] if trip_type else [])
    unknown = F.raise_error(F.concat(F.lit("unknown department: "), F.col(department))).cast("string")
    checked = rows.withColumn(department, F.when(F.col(department).isin(list(departments)), F.col(department))
                              .otherwise(unknown))
    wide = A.pivot_sum(checked, keys, department, names, scans)
    return wide.withColumn("DoW", weekday_code(F.col(weekday))).select(
        visit, "DoW", *names.values(), *([trip_type] if trip_type else [])).orderBy(visit)


def trip_scores(train: DataFrame, test: DataFrame, visit: str, trip_type: str, features: Sequence[str],
                trees: int = 50, depth: int = 10, seed: int = 0) -> DataFrame:
    """(visit, TripType_<class>...) probabilities of the test visits."""
    indexer = StringIndexer(inputCol=trip_type, outputCol="label", stringOrderType="alphabetAsc").fit(train)
    rows = M.assemble(indexer.transform(train), features, [visit, "label"])
    with M.kept(rows) as kept:
        model = M.random_forest(trees, depth, seed, bootstrap=False, minInstancesPerNode=3).fit(kept)
    scored = model.transform(M.assemble(test, features, [visit])).select(visit, "probability")
    return M.probability_columns(scored, [f"TripType_{label}" for label in indexer.labels])
