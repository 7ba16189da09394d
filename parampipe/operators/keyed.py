"""Tables with keys: delete-then-insert that rewrites only the files it touches.

A table is a folder of Parquet files and a manifest of those that count. A change writes
new files and then a new manifest version; until that is complete readers see the old
one, and what a broken change left behind is in no manifest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.operators.sinks import case_files
from parampipe.session import delete_path, materialize, write_text
from parampipe.sources.files import read_or_empty

MANIFEST_SCHEMA = T.StructType([T.StructField("file", T.StringType())])
# A table of more files is refused: their names go through the driver.
MOST_FILES = 1_000_000


@dataclass(frozen=True)
class KeyedTable:
    """A table at `path` with the columns of `schema`, one row for each value of `keys`."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]

    def version(self) -> int:
        """Number of the newest complete manifest, 0 for a new table."""
        # a version counts once its mark stands beside the finished manifest
        marks = case_files(self.spark, f"{self.path}/done", ["version"])
        return marks.agg(F.max(F.col("version").cast("int"))).first()[0] or 0

    def files(self, version: int | None = None) -> list[str]:
        """The files that count, of the newest or a given version."""
        number = self.version() if version is None else version
        if not number:
            return []
        rows = read_or_empty(self.spark, f"{self.path}/manifest/version={number}", MANIFEST_SCHEMA)
        found = [r["file"] for r in rows.limit(MOST_FILES + 1).collect()]
        if len(found) > MOST_FILES:
            raise ValueError(f"more than {MOST_FILES} files")
        return found

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.files(version))

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def touched(self, changed: DataFrame) -> list[str]:
        """The files that hold a key of `changed`; reads the key columns only, and of
        these the row groups between the least and the greatest changed key."""
        files = self.files()
        if not files:
            return []
        ends = changed.agg(*[f(k).alias(f"{n}_{k}") for k in self.keys for n, f in (("lo", F.min), ("hi", F.max))]).first()
        rows = self._rows(files)
        for k in self.keys:
            if ends[f"lo_{k}"] is None:
                return []
            rows = rows.where(F.col(k).between(F.lit(ends[f"lo_{k}"]), F.lit(ends[f"hi_{k}"])))
        rows = rows.select(*self.keys, F.col("_metadata.file_path").alias("_file"))
        hit = rows.join(changed.select(*self.keys), list(self.keys), "left_semi")
        return [r["_file"] for r in hit.select("_file").distinct().collect()]

    def upsert(self, rows: DataFrame, gone: DataFrame | None = None) -> int:
        """Replace or add `rows` by key and remove the keys of `gone`; the new version's number.

        Null keys and a key that occurs twice in `rows` raise before anything is written.
        A key in both `rows` and `gone` is kept as in `rows`. Files without a changed key
        stay as they are and are not read for their rows.
        """
        keys = list(self.keys)
        rows = materialize(rows.select(*self.schema.fieldNames()), "rows")
        if not rows.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).isEmpty():
            raise ValueError("a key is null")
        if not rows.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError("a key occurs twice")
        changed = rows.select(*keys)
        if gone is not None:
            changed = materialize(changed.unionByName(gone.select(*keys)).distinct(), "changed")
        number, before = self.version(), self.files()
        touched = self.touched(changed)
        kept = self._rows(touched).join(changed, keys, "left_anti")
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        kept.unionByName(rows).write.parquet(folder)
        new = [r["_file"] for r in case_files(self.spark, folder, []).where(F.col("_file").endswith(".parquet")).collect()]
        self._switch(number + 1, sorted({*before} - {*touched}) + new)
        return number + 1

    def _switch(self, number: int, files: list[str]) -> None:
        place = f"{self.path}/manifest/version={number}"
        # what an unfinished change may have left under this number
        delete_path(self.spark, place)
        self.spark.createDataFrame([(f,) for f in files], MANIFEST_SCHEMA).coalesce(1).write.parquet(place)
        write_text(self.spark, f"{self.path}/done/version={number}/mark.txt", f"{len(files)}\n")

    def remove_old(self, keep: int) -> int:
        """Remove the manifests before the newest `keep`, and the files in no kept one; how many files.

        Safe to repeat: manifests go first, and a file goes only if no manifest names it.
        """
        newest = self.version()
        kept = range(max(1, newest - keep + 1), newest + 1)
        numbers = case_files(self.spark, f"{self.path}/manifest", ["version"]).select("version").distinct()
        for row in numbers.toLocalIterator():
            if int(row["version"]) < kept.start:
                for name in ("done", "manifest"):
                    delete_path(self.spark, f"{self.path}/{name}/version={row['version']}")
        live = {f for number in kept for f in self.files(number)}
        data = case_files(self.spark, f"{self.path}/data", []).where(F.col("_file").endswith(".parquet"))
        gone = [r["_file"] for r in data.toLocalIterator() if r["_file"] not in live]
        for file in gone:
            delete_path(self.spark, file)
        return len(gone)
