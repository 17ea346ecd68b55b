"""Tables kept in versions, each a list of layers of which the newest says what is true of a key.

Layout below ``root``::

    <table>/data/<layer>/rows     rows of a layer; the first layer is the whole table
    <table>/data/<layer>/keys     the keys a later layer speaks for: their older rows are no longer true
    <table>/data/<layer>/<aside>  small tables that belong to the layer
    <table>/versions/<number>     what a version consists of; written when its layers are complete

Data folders get a name nobody has used and are never changed, so nothing is renamed or copied on an object
store, and a frame stays readable while later versions are made: its layers stay until ``expire``.  A
version is there when its file is; a job that breaks off before leaves the older version as the newest, and
a folder nobody refers to, which ``expire`` removes.  Two writers of one number: the second one fails.

Reading joins older layers with the keys of newer ones (an anti join that Spark broadcasts where they are
few), so a change costs what the change is, and ``compact`` makes one layer of them when they are many.  Rows
whose key is null belong to the first layer for ever.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- files ------------------------------------------------------------------------------

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        place, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def _file(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/versions/{version:012d}"

    def _publish(self, table: str, info: dict) -> int:
        """The switch: from here on the version is the newest."""
        version = info["version"]
        draft, fs = self._at(f"{self.root}/{table}/drafts/{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(info), "utf-8"))
        finally:
            stream.close()
        final, _ = self._at(self._file(table, version))
        fs.mkdirs(final.getParent())
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {table} was made by somebody else meanwhile")
        return version

    # --- versions ---------------------------------------------------------------------------

    def tables(self) -> list[str]:
        return [name for name in self._names(self.root) if self.versions(name)]

    def versions(self, table: str) -> list[int]:
        return [int(name) for name in self._names(f"{self.root}/{table}/versions") if name.isdigit()]

    def info(self, table: str, version: int | None = None) -> dict:
        """What a version (the newest) consists of: keys, schema, layers, as_of."""
        known = self.versions(table)
        if not known or version is not None and version not in known:
            raise KeyError(f"no version {'' if version is None else version} of {table} in {self.root}")
        place, fs = self._at(self._file(table, known[-1] if version is None else version))
        stream = fs.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A version's rows; the frame stays with it whatever is published later."""
        info = self.info(table, version)
        schema = T.StructType.fromJson(info["schema"])
        keys = T.StructType([schema[k] for k in info["keys"]])
        rows = None
        for layer in info["layers"]:
            folder = f"{self.root}/{table}/data/{layer}"
            own = self.spark.read.schema(schema).parquet(f"{folder}/rows")
            if rows is None:
                rows = own
            else:
                spoken_for = self.spark.read.schema(keys).parquet(f"{folder}/keys")
                rows = rows.join(spoken_for, info["keys"], "left_anti").select(*schema.names).union(own)
        return rows

    def aside(self, table: str, name: str, version: int | None = None) -> DataFrame:
        """A small table of the newest layer that has it."""
        info = self.info(table, version)
        for layer in reversed(info["layers"]):
            if name in self._names(f"{self.root}/{table}/data/{layer}"):
                return self.spark.read.parquet(f"{self.root}/{table}/data/{layer}/{name}")
        raise KeyError(f"{table} has no {name}")

    def put(
        self, table: str, rows: DataFrame, keys: list[str], sort: list[str] | None = None, as_of: str | None = None,
        aside: Mapping[str, DataFrame] | None = None, partitions: int | None = None,
    ) -> int:
        """The whole table anew, clustered by ``sort`` (the keys), so that reads by key skip row groups.

        Sort keys that tell rows apart let the rows of one hot first key lie in several files.
        """
        sort = sort or keys
        layer = uuid.uuid4().hex
        split = [partitions, *sort] if partitions else sort
        folder = f"{self.root}/{table}/data/{layer}"
        rows.repartitionByRange(*split).sortWithinPartitions(*sort).write.parquet(f"{folder}/rows")
        self._beside(folder, aside)
        version = (self.versions(table) or [0])[-1] + 1
        return self._publish(table, {"version": version, "keys": keys, "sort": sort, "schema": rows.schema.jsonValue(), "layers": [layer], "as_of": as_of})

    def change(self, table: str, rows: DataFrame, keys: DataFrame, as_of: str | None = None, aside: Mapping[str, DataFrame] | None = None) -> int:
        """A version in which ``keys`` have ``rows``, which may be none, and all others what they had."""
        info = self.info(table)
        schema = T.StructType.fromJson(info["schema"])
        layer = uuid.uuid4().hex
        folder = f"{self.root}/{table}/data/{layer}"
        keys.select(*info["keys"]).distinct().write.parquet(f"{folder}/keys")
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        typed.sortWithinPartitions(*info["sort"]).write.parquet(f"{folder}/rows")
        self._beside(folder, aside)
        return self._publish(table, {**info, "version": info["version"] + 1, "layers": [*info["layers"], layer], "as_of": as_of or info["as_of"]})

    def _beside(self, folder: str, aside: Mapping[str, DataFrame] | None) -> None:
        for name, frame in (aside or {}).items():
            frame.coalesce(1).write.parquet(f"{folder}/{name}")

    def compact(self, table: str) -> int:
        """The newest version as one layer."""
        info = self.info(table)
        names = {n for layer in info["layers"] for n in self._names(f"{self.root}/{table}/data/{layer}")} - {"rows", "keys"}
        return self.put(table, self.read(table), info["keys"], info["sort"], info["as_of"], {n: self.aside(table, n) for n in names})

    def expire(self, table: str, keep: int = 1) -> None:
        """Forgets all but the last ``keep`` versions and what none of these refers to.

        For times when no reader holds an older version and nobody writes.
        """
        known = self.versions(table)
        for version in known[:-keep]:
            place, fs = self._at(self._file(table, version))
            fs.delete(place, False)
        used = {layer for version in known[-keep:] for layer in self.info(table, version)["layers"]}
        unused = [f"data/{layer}" for layer in self._names(f"{self.root}/{table}/data") if layer not in used]
        for path in [*unused, "drafts"]:
            place, fs = self._at(f"{self.root}/{table}/{path}")
            fs.delete(place, True)
