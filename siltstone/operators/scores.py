"""Scores against gold labels, and totals over calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def ratio(a: Column, b: Column) -> Column:
    """Null where the denominator is 0."""
    return a / F.nullif(b, F.lit(0))


def confusion(pairs: DataFrame, gold: str, predicted: str) -> DataFrame:
    return pairs.groupBy(F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def prf1(pairs: DataFrame, gold: Column, predicted: Column, *keys: Column) -> DataFrame:
    """Precision, recall and F1 of boolean columns; null on a zero denominator."""
    counts = pairs.groupBy(*keys).agg(F.count_if(gold & predicted).alias("tp"), F.count_if(~gold & predicted).alias("fp"), F.count_if(gold & ~predicted).alias("fn"))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return counts.withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn)).withColumn("f1", ratio(2 * tp, 2 * tp + fp + fn))


def token_totals(calls: DataFrame) -> DataFrame:
    return calls.groupBy("tag").agg(F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("output_tokens").alias("output_tokens"))


def shares(parts: DataFrame, name: str, amount: str) -> DataFrame:
    """Sums per name and their share of all; the total is one row, joined to the few sums."""
    sums = parts.groupBy(name).agg(F.sum(amount).alias("amount"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("amount").alias("_all")))).select(name, "amount", ratio(F.col("amount"), F.col("_all")).alias("share"))


def compared(results: DataFrame, baseline: str) -> DataFrame:
    """Means per (kind, arm) and how often an arm's record agrees with the baseline's of the same (kind, record)."""
    base = results.filter(F.col("arm") == baseline).select("kind", "record", F.col("label").alias("base_label"), F.col("value").alias("base_value"))
    joined = results.join(base, ["kind", "record"], "left")
    return joined.groupBy("kind", "arm").agg(F.count(F.lit(1)).alias("records"), F.avg("value").alias("mean_value"), F.count_if(F.col("label") == F.col("base_label")).alias("agreed"), F.avg(F.col("value") - F.col("base_value")).alias("mean_difference"))


def keys_changed(records: DataFrame, baseline: DataFrame) -> DataFrame:
    """(id, lost, added): array elements that are in the baseline only, and in the record only."""
    base = baseline.select("id", F.col("keys").alias("was"))
    return records.join(base, "id").select("id", F.array_except("was", "keys").alias("lost"), F.array_except("keys", "was").alias("added"))


def merge_score(decisions: DataFrame) -> DataFrame:
    """Scores decisions (account, position, cluster, action, key) in their order, per account.

    A cluster has the key of the decision that last created it before; a merge is correct if its key is that one, false
    if it is another, and not scored if either is null. A creation is a miss if the account has a cluster of its key already.
    """
    creates = F.col("action").startswith("create")
    in_cluster = Window.partitionBy("account", "cluster").orderBy("position")
    own = F.last(F.when(creates, F.struct("key")), ignorenulls=True).over(in_cluster.rowsBetween(Window.unboundedPreceding, -1))
    earlier = F.sum(F.when(creates, 1).otherwise(0)).over(Window.partitionBy("account", "key").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    judged = decisions.withColumn("target", own["key"]).withColumn("earlier", F.coalesce(earlier, F.lit(0)))
    scored = ~creates & F.col("key").isNotNull() & F.col("target").isNotNull()
    counts = judged.groupBy("account").agg(
        F.count(F.lit(1)).alias("decisions"), F.count_if(scored & (F.col("key") == F.col("target"))).alias("correct"), F.count_if(scored & (F.col("key") != F.col("target"))).alias("false_merges"),
        F.count_if(~creates & ~scored).alias("unscored"), F.count_if(creates & F.col("key").isNotNull() & (F.col("earlier") > 0)).alias("missed"),
    )
    return counts.withColumn("false_merge_rate", ratio(F.col("false_merges"), F.col("correct") + F.col("false_merges")))


#: An example of prices, to be replaced: US dollars per million tokens (prompt, output) by model family.
PRICES = {"flash": (0.30, 2.50), "pro": (1.25, 10.00)}


def call_cost(family: Column, prompt: Column, output: Column, thoughts: Column) -> Column:
    """Dollars of a call; thoughts cost as output; an unknown family costs as the dearest."""
    dear = max(PRICES.values())
    price = lambda i: F.coalesce(*(F.when(family == k, v[i]) for k, v in PRICES.items()), F.lit(dear[i]))
    return (F.coalesce(prompt, F.lit(0)) * price(0) + (F.coalesce(output, F.lit(0)) + F.coalesce(thoughts, F.lit(0))) * price(1)) / 1e6


def worst_cost(family: Column, prompt: Column, most_output: Column) -> Column:
    """The most that a call can cost: a token for every three UTF-8 bytes of its prompt, and all the output it may give."""
    return call_cost(family, F.ceil(F.octet_length(prompt) / 3), most_output, F.lit(0))


def charge(family: Column, prompt: Column, output: Column, thoughts: Column, total: Column, worst: Column) -> Column:
    """What a finished call is charged: for output the larger of its parts and what the total leaves; unknown usage costs the worst."""
    rest = total - prompt
    unknown = prompt.isNull() | (output.isNull() & rest.isNull())
    parts = F.coalesce(output, F.lit(0)) + F.coalesce(thoughts, F.lit(0))
    return F.when(unknown, worst).otherwise(call_cost(family, prompt, F.greatest(parts, F.coalesce(rest, F.lit(0))), F.lit(0)))


def evenly_spaced(rows: DataFrame, n: int, order: str) -> DataFrame:
    """n rows at even distances in ``order``, of a list that fits into one window (an evaluation sample); all if fewer."""
    total = rows.count()
    if total <= n:
        return rows
    numbered = rows.withColumn("_at", F.row_number().over(Window.orderBy(order)) - 1)
    wanted = rows.sparkSession.range(n).select(F.floor(F.col("id") * total / n).alias("_at"))
    return numbered.join(wanted, "_at").drop("_at")
