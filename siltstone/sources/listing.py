"""File-store listings. Connectors sit behind ``Store``; the offline one reads Parquet."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.sources.scratch import Scratch

FOLDER = "folder"


class Store(Protocol):
    """What a connector has to give: one table of entries (id, name, mime_type, parent_id, created_time, modified_time, size, trashed, position)."""

    def entries(self, spark: SparkSession) -> DataFrame: ...


class ListingRefused(Exception):
    """The store does not give a flat sweep; walk the folders instead."""


class ParquetStore:
    def __init__(self, path: str):
        self.path = path

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def children(entries: DataFrame, folder: str) -> DataFrame:
    """Entries right below a folder, trashed ones left out; both filters reach the scan."""
    return entries.filter((F.col("parent_id") == folder) & ~F.col("trashed"))


def subfolders(entries: DataFrame, folder: str) -> DataFrame:
    return children(entries, folder).filter(F.col("mime_type") == FOLDER).select("id", "name")


def all_folders(entries: DataFrame) -> DataFrame:
    return entries.filter((F.col("mime_type") == FOLDER) & ~F.col("trashed")).select("id", "name", "parent_id", "position")


def files_below(entries: DataFrame, folders: DataFrame, keep: Column | None = None) -> DataFrame:
    """Files in any of ``folders`` (id) that ``keep`` accepts; of an id that is listed twice the first."""
    files = entries.filter((F.col("mime_type") != FOLDER) & ~F.col("trashed"))
    files = files if keep is None else files.filter(keep)
    inside = files.join(folders.select(F.col("id").alias("folder_id")), F.col("parent_id") == F.col("folder_id"), "left_semi")
    rest = [c for c in inside.columns if c != "id"]
    first = inside.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("position", "parent_id")).alias("_one"))
    return first.select("id", *(F.col(f"_one.{c}").alias(c) for c in rest))


def oldest_files(entries: DataFrame, most: int) -> DataFrame:
    """The first files by creation, unknown times first; the path of such a flat listing is the name."""
    files = entries.filter((F.col("mime_type") != FOLDER) & ~F.col("trashed")).withColumn("path", F.col("name"))
    return files.orderBy(F.col("created_time").asc_nulls_first(), "position", "id").limit(most)


def by_ids(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """Entries of the given ids; ids that are gone drop out."""
    return entries.join(ids.select("id").distinct(), "id", "left_semi")


def root_kind(folder_id: Column, drive_id: Column) -> Column:
    return F.when(folder_id == drive_id, "drive_root").when(drive_id.isNotNull(), "inside_drive").otherwise("personal")


class ChangeTokenExpired(Exception):
    """The change feed no longer reaches back to the token; list anew."""


def changes_since(feed: DataFrame, token: int, oldest: int) -> tuple[DataFrame, int]:
    """Changes (sequence, file_id, ...) after ``token`` and the token to go on from."""
    if token < oldest:
        raise ChangeTokenExpired(token)
    new = feed.filter(F.col("sequence") > token)
    last = new.agg(F.max("sequence")).first()[0]
    return new, token if last is None else last


def gathered(store: Store, spark: SparkSession, root: str, unreadable: DataFrame | None = None, on_refusal: Callable[[Exception], None] | None = None, on_folder_error: Callable[[DataFrame], None] | None = None, on_depth_cap: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The tree below ``root`` out of one flat sweep, or, if the store refuses that, level by level; any other error is raised.

    The walk skips what lies below folders that cannot be listed (``unreadable``: id) and hands those to ``on_folder_error``;
    ``on_depth_cap`` gets the folders at the cap, whose contents are left out.
    """
    try:
        found = listed_tree(store, spark, root)
    except ListingRefused as refusal:
        if on_refusal:
            on_refusal(refusal)
        found = listed_tree(store, spark, root, flat_allowed=False)
        if unreadable is not None:
            bad = unreadable.select(F.col("id").alias("_bad")).distinct()
            if on_folder_error:
                on_folder_error(found.join(bad, F.col("id") == F.col("_bad"), "left_semi"))
            from siltstone.operators.hierarchy import resolve

            # the subtree of a bad folder is cut off where its listing failed
            left = found.select("id", "name", F.when(F.col("parent_id") == root, root).otherwise(F.col("parent_id")).alias("parent_id")).join(bad, F.col("parent_id") == F.col("_bad"), "left_anti")
            found = resolve(left, root).filter("reach = 'in' AND depth IS NOT NULL").select("id", "name", "parent_id", "depth")
    if on_depth_cap:
        on_depth_cap(found.filter(F.col("depth") > 100))
    return found


def inside_root(ids: DataFrame, tree: DataFrame, root: str) -> DataFrame:
    """``ids`` (id) with ``inside``: whether it is the root or lies below it."""
    within = tree.filter("reach = 'in'").select(F.col("id").alias("_id"))
    return ids.join(within, F.col("id") == F.col("_id"), "left").select(*ids.columns, ((F.col("id") == root) | F.col("_id").isNotNull()).alias("inside"))


def listed_tree(store: Store, spark: SparkSession, root: str, flat_allowed: bool = True, most_levels: int = 101) -> DataFrame:
    """Folders below ``root``: out of one flat sweep where the store allows it, else level by level. Both give the same rows."""
    from siltstone.operators.hierarchy import resolve

    folders = all_folders(store.entries(spark))
    if flat_allowed:
        return resolve(folders, root).filter("reach = 'in' AND depth IS NOT NULL").select("id", "name", "parent_id", "depth")
    scratch = Scratch(spark)
    found = level = folders.filter(F.col("parent_id") == root).select("id", "name", "parent_id").withColumn("depth", F.lit(1))
    for depth in range(2, most_levels + 1):
        above = level.select(F.col("id").alias("_up"))
        level = folders.join(above, F.col("parent_id") == F.col("_up")).select("id", "name", "parent_id").withColumn("depth", F.lit(depth))
        level = scratch.save(level, f"level-{depth}")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found
