"""Listings and change feeds as Spark data sources: ``siltstone_listing`` for batches, ``siltstone_changes`` for both.

A connector is a ``Client``, named by the option ``client`` (``module:factory``), whose factory gets the options; the offline
one reads Parquet. A listing's partitions are ranges of its pages, so pages are fetched by all tasks, and filters on
``parent_id``, ``mime_type``, ``trashed`` and ``id`` are pushed to the client. The offsets of a stream are change tokens: a batch
is the changes after one token up to another, dealt into ranges of tokens. A token that the store no longer reaches
back to is expired; the batch that starts from it lists all entries anew, as rows of kind ``listed``, and goes on from there.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition

ENTRY = "id string, name string, mime_type string, parent_id string, trashed boolean, size long, position long"
CHANGE = "sequence long, kind string, id string, name string, mime_type string, parent_id string, trashed boolean, size long, position long"
#: The same columns in Arrow.
ENTRY_FIELDS = pa.schema([("id", pa.string()), ("name", pa.string()), ("mime_type", pa.string()), ("parent_id", pa.string()), ("trashed", pa.bool_()), ("size", pa.int64()), ("position", pa.int64())])
CHANGE_FIELDS = pa.schema([("sequence", pa.int64()), ("kind", pa.string()), *ENTRY_FIELDS])
#: Columns on which a client filters.
FILTERED = ("id", "parent_id", "mime_type", "trashed")


class Client(Protocol):
    """What a connector has to give. ``wanted`` maps columns to the values that are asked for; other entries may be left out."""

    def pages(self) -> list[str]: ...

    def entries(self, page: str, wanted: dict[str, list]) -> Iterator[pa.RecordBatch]: ...

    def tokens(self) -> tuple[int, int]:
        """The oldest token from which the feed can be followed, and the newest."""
        ...

    def changes(self, after: int, upto: int) -> Iterator[pa.RecordBatch]: ...


#: How row groups are read: no further ones meanwhile, in batches of some thousand rows.
ONE_BY_ONE = {"batch_size": 8192, "batch_readahead": 0, "fragment_readahead": 0, "use_threads": False}
#: Bytes of a row group of files that are written for the client.
GROUP_BYTES = 4 << 20


def write_ordered(rows: DataFrame, key: str, path: str) -> None:
    """Parquet in the order of ``key`` and in small row groups, so tokens or pages are found by statistics and read by little memory."""
    rows.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(path)


class ParquetClient:
    """Entries under ``path``/entries and changes under ``path``/changes; a page is a row group."""

    def __init__(self, options: dict[str, str]):
        self.path, self.oldest = options["path"].rstrip("/"), int(options.get("oldest", 0))

    def _table(self, name: str) -> ds.Dataset:
        at = urlsplit(f"{self.path}/{name}")
        files, where = (fs.LocalFileSystem(), at.path) if at.scheme in ("", "file") else fs.FileSystem.from_uri(at.geturl())
        return ds.dataset(where, filesystem=files, format="parquet")

    def pages(self) -> list[str]:
        own = enumerate(self._table("entries").get_fragments())
        return [f"{i}:{g.id}" for i, f in own for g in f.row_groups]

    def entries(self, page: str, wanted: dict[str, list]) -> Iterator[pa.RecordBatch]:
        i, group = map(int, page.split(":"))
        fragment = list(self._table("entries").get_fragments())[i].subset(row_group_ids=[group])
        asked = None
        for column, values in wanted.items():
            one = ds.field(column).isin(values)
            asked = one if asked is None else asked & one
        yield from fragment.to_batches(columns=ENTRY_FIELDS.names, filter=asked, **ONE_BY_ONE)

    def tokens(self) -> tuple[int, int]:
        newest = 0
        for fragment in self._table("changes").get_fragments():
            for group in fragment.row_groups:
                if (known := (group.statistics or {}).get("sequence")) and known.get("max") is not None:
                    newest = max(newest, known["max"])
                elif group.num_rows:
                    batches = fragment.subset(row_group_ids=[group.id]).to_batches(columns=["sequence"], **ONE_BY_ONE)
                    newest = max([newest, *(n for b in batches if (n := pc.max(b.column("sequence")).as_py()) is not None)])
        return self.oldest, newest

    def changes(self, after: int, upto: int) -> Iterator[pa.RecordBatch]:
        at = ds.field("sequence")
        asked = (at > after) & (at <= upto)
        for fragment in self._table("changes").get_fragments():
            # row groups whose statistics exclude the tokens are not read, the others one at a time
            for group in fragment.subset(filter=asked, schema=CHANGE_FIELDS).row_groups:
                yield from fragment.subset(row_group_ids=[group.id]).to_batches(columns=CHANGE_FIELDS.names, filter=asked, **ONE_BY_ONE)


def client_of(options: dict[str, str]) -> Client:
    module, _, name = options.get("client", f"{__name__}:ParquetClient").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Pages(InputPartition):
    refs: list[str]


@dataclass
class Tokens(InputPartition):
    after: int
    upto: int


@dataclass
class Relisted(InputPartition):
    """Pages of a listing that stands in for changes up to a token."""

    refs: list[str]
    upto: int


def dealt(refs: list[str], size: int) -> list[list[str]]:
    return [refs[at : at + size] for at in range(0, len(refs), size)]


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.wanted = options, {}

    def pushFilters(self, filters):
        """Takes equalities and lists of values on the columns that clients filter by; Spark keeps the rest."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in FILTERED or name in self.wanted or not isinstance(f, (EqualTo, In)):
                yield f
                continue
            self.wanted[name] = [f.value] if isinstance(f, EqualTo) else list(f.value)

    def partitions(self):
        return [Pages(p) for p in dealt(client_of(self.options).pages(), int(self.options.get("pages_per_partition", 1)))]

    def read(self, partition):
        client = client_of(self.options)
        for page in partition.refs:
            for batch in client.entries(page, self.wanted):
                yield batch.select(ENTRY_FIELDS.names).cast(ENTRY_FIELDS)


class ListingSource(DataSource):
    @classmethod
    def name(cls):
        return "siltstone_listing"

    def schema(self):
        return ENTRY

    def reader(self, schema):
        return ListingReader(dict(self.options))


class Changes:
    """What batches and streams of changes share."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def split(self, after: int, upto: int) -> list[InputPartition]:
        client = client_of(self.options)
        if after < client.tokens()[0]:
            return [Relisted(p, upto) for p in dealt(client.pages(), int(self.options.get("pages_per_partition", 1)))]
        size = int(self.options.get("tokens_per_partition", 100_000))
        return [Tokens(at, min(at + size, upto)) for at in range(after, upto, size)]

    def read(self, partition):
        client = client_of(self.options)
        if isinstance(partition, Tokens):
            for batch in client.changes(partition.after, partition.upto):
                yield batch.select(CHANGE_FIELDS.names).cast(CHANGE_FIELDS)
        else:
            for page in partition.refs:
                for batch in client.entries(page, {}):
                    own = [pa.array([partition.upto] * len(batch), pa.int64()), pa.array(["listed"] * len(batch), pa.string())]
                    yield pa.RecordBatch.from_arrays([*own, *(batch.column(c).cast(t) for c, t in zip(ENTRY_FIELDS.names, ENTRY_FIELDS.types))], schema=CHANGE_FIELDS)


class ChangeReader(Changes, DataSourceReader):
    def partitions(self):
        return self.split(int(self.options.get("after", 0)), client_of(self.options).tokens()[1])


class ChangeStreamReader(Changes, DataSourceStreamReader):
    def initialOffset(self):
        return {"token": int(self.options.get("after", 0))}

    def latestOffset(self):
        return {"token": client_of(self.options).tokens()[1]}

    def partitions(self, start, end):
        return self.split(start["token"], end["token"])

    def commit(self, end):
        """The token is Spark's to keep, in the checkpoint."""


class ChangeSource(DataSource):
    @classmethod
    def name(cls):
        return "siltstone_changes"

    def schema(self):
        return CHANGE

    def reader(self, schema):
        return ChangeReader(dict(self.options))

    def streamReader(self, schema):
        return ChangeStreamReader(dict(self.options))


def register(spark: SparkSession) -> SparkSession:
    """Makes both sources known to the session, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (ListingSource, ChangeSource):
        spark.dataSource.register(source)
    return spark
