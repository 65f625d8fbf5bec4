"""Logs, messages and codecs; tables are written through ``tablelog``."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def wipe_counts(tables: dict[str, DataFrame], column: str, account: str) -> DataFrame:
    """What a wipe of one account would delete, by table."""
    counts = None
    for name, rows in tables.items():
        one = rows.filter(F.col(column) == account).agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


class Mailer(Protocol):
    def send(self, to: str, subject: str, body: str) -> None: ...


class ConsoleMailer:
    """The default: messages go to the executor's log."""

    def send(self, to: str, subject: str, body: str) -> None:
        print(json.dumps({"to": to, "subject": subject, "body": body}))


def digests(proposals: DataFrame) -> DataFrame:
    """One message per reviewer: numbers of proposals by kind and of entity groups."""
    kinds = ("field_change", "additional_update", "new_entity")
    counts = proposals.filter("reviewer_email IS NOT NULL").groupBy("reviewer_email").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds), F.countDistinct(F.when(F.col("kind") == "new_entity", F.col("group_id"))).alias("groups"))
    body = F.concat_ws("\n", *(F.when(F.col(k) > 0, F.concat(F.col(k).cast("string"), F.lit(f" {k.replace('_', ' ')}"))) for k in kinds))
    return counts.select(F.col("reviewer_email").alias("to"), F.lit("Changes to review").alias("subject"), body.alias("body"), *kinds, "groups")


def send_all(messages: DataFrame, mailer: Mailer) -> None:
    def each(rows):
        for r in rows:
            mailer.send(r["to"], r["subject"], r["body"])

    messages.select("to", "subject", "body").foreachPartition(each)


def encode_days(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Day buckets as two tables: each file once, and for each day the ids of its files in order."""
    return files.drop("day").dropDuplicates(["file_id"]), files.groupBy("day").agg(F.array_sort(F.collect_set("file_id")).alias("ids"))


def decode_days(files: DataFrame, days: DataFrame) -> DataFrame | None:
    """The day buckets again; None, a cache miss, if a day names a file that is not there."""
    named = days.select(F.col("day"), F.explode("ids").alias("named"))
    own = files.withColumnRenamed("file_id", "own")
    if not named.join(own, F.col("named") == F.col("own"), "left_anti").isEmpty():
        return None
    return named.join(own, F.col("named") == F.col("own")).withColumnRenamed("named", "file_id").drop("own")
