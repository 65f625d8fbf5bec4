"""Health of an idea log: ideas (id, account, name, facets) and their changes (id, idea_id, property, previous, value, changed_at)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def facet_stats(ideas: DataFrame) -> DataFrame:
    """``ideas`` with the number of facets, and of distinct ones, case and outer blanks aside."""
    tidy = F.transform("facets", lambda f: F.lower(F.trim(f)))
    return ideas.withColumn("n_facets", F.size("facets")).withColumn("n_distinct", F.size(F.array_distinct(tidy)))


def histogram(rows: DataFrame, value: Column) -> DataFrame:
    return rows.groupBy(value.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def shared_facets(ideas: DataFrame) -> DataFrame:
    """Facets that more than one idea has, with the number of ideas and of accounts."""
    one = ideas.select("id", "account", F.explode("facets").alias("facet")).withColumn("facet", F.lower(F.trim("facet"))).filter("facet <> ''")
    return one.groupBy("facet").agg(F.countDistinct("id").alias("ideas"), F.countDistinct("account").alias("accounts")).filter("ideas > 1")


def births_and_rewrites(ideas: DataFrame, changes: DataFrame) -> DataFrame:
    """Per idea the number of births (changes without a previous value) and of rewrites, zero where there is none."""
    per_idea = changes.groupBy("idea_id").agg(F.count_if(F.col("previous").isNull()).alias("births"), F.count_if(F.col("previous").isNotNull()).alias("rewrites"))
    return ideas.join(per_idea, F.col("id") == F.col("idea_id"), "left").select("id", F.coalesce("births", F.lit(0)).alias("births"), F.coalesce("rewrites", F.lit(0)).alias("rewrites"))


def last_change(ideas: DataFrame, changes: DataFrame) -> DataFrame:
    """Ideas with their latest change, null where there is none: the lateral top-1 as one aggregation and one join."""
    rest = [c for c in changes.columns if c != "idea_id"]
    top = changes.groupBy("idea_id").agg(F.max_by(F.struct(*rest), F.struct("changed_at", "id")).alias("top")).select("idea_id", *(F.col(f"top.{c}").alias(f"last_{c}") for c in rest))
    return ideas.join(top, F.col("id") == F.col("idea_id"), "left").drop("idea_id")
