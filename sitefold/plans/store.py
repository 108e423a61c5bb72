"""Tables in versions: data folders that never change, and a manifest for each version that names them.

A commit writes its folders first and then creates the next version's manifest, which fails if there is one already; so
of two writers that start from one version one wins, and the other is told. A reader takes the newest whole manifest
and keeps reading its folders, whatever is committed meanwhile. Only vacuum() deletes folders.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


class Conflict(RuntimeError):
    """Another writer has committed a version in between."""


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    @property
    def versioned(self) -> bool:
        return self._exists("_versions")

    def _versions(self) -> list[int]:
        if not self.versioned:
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("_versions"))]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d{8})\.json", n)))

    def manifest(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """(version, folder of each part): the newest whole one, or that asked for; (0, {}) for a new table."""
        for v in [version] if version is not None else reversed(self._versions()):
            stream = self._fs.open(self._at(f"_versions/{v:08}.json"))
            try:
                return v, json.loads(bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)))
            except ValueError:  # its writer has not finished it
                continue
            finally:
                stream.close()
        return 0, {}

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; None if nothing has been committed."""
        folders = self.manifest(version)[1].values()
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def write(self, rows: DataFrame, part: str | None = None, **options) -> dict[str, str]:
        """Writes rows to folders of their own, one for each value of the column part, and names them; no version has them yet.

        options: of the Parquet writer.
        """
        folder = f"data/{uuid.uuid4().hex}"
        if part is None:
            rows.write.options(**options).parquet(f"{self.path}/{folder}")
            return {"": folder}
        rows.withColumn("_part", F.col(part)).write.options(**options).partitionBy("_part").parquet(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]
        unescaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescaped(n.removeprefix("_part=")): f"{folder}/{n}" for n in names if n.startswith("_part=")}

    def commit(self, parts: dict[str, str], base: int, gone: set[str] = frozenset(), others: bool = True) -> int:
        """A version with these parts in place of base's, and without those gone; raises Conflict if base is not the newest.

        others: keep base's other parts.
        """
        newest, old = self.manifest()
        if newest != base:
            raise Conflict(f"{self.path}: version {newest} came after {base}")
        new = {k: v for k, v in old.items() if others and k not in gone} | parts
        at = self._at(f"_versions/{base + 1:08}.json")
        try:
            out = self._fs.create(at, False)
        except Exception as e:
            if self._fs.exists(at):
                raise Conflict(f"{self.path}: another writer has made version {base + 1}") from e
            raise
        out.write(bytearray(json.dumps(new), "utf-8"))
        out.close()
        return base + 1

    def log(self, version: int) -> str:
        """A folder for rows that are added to a version bit by bit, until they become a version of their own."""
        return f"{self.path}/_log/{version:08}"

    def read_log(self, version: int) -> DataFrame | None:
        return self.spark.read.parquet(self.log(version)) if self._exists(f"_log/{version:08}/_SUCCESS") else None

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all versions but the newest ones, the folders that only they name, and logs of earlier versions. For
        times without a writer: folders that no version has yet go as well."""
        versions = self._versions()
        held = {f.split("/")[1] for v in versions[-keep:] for f in self.manifest(v)[1].values()}
        for v in versions[:-keep]:
            self._fs.delete(self._at(f"_versions/{v:08}.json"), True)
        for folder, names in (("data", held), ("_log", {f"{v:08}" for v in versions[-1:]})):
            for s in self._fs.listStatus(self._at(folder)) if self._exists(folder) else []:
                if s.getPath().getName() not in names:
                    self._fs.delete(s.getPath(), True)
