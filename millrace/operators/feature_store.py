"""Versioned feature sets: one Parquet folder and one metadata document per version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.profile import statistics
from millrace.operators.sketches import merged_profile, sketch

CATALOG_SCHEMA = (
    "name string, version int, description string, tags array<string>, created_at string, "
    "num_rows bigint, num_columns int, columns array<string>"
)


class FeatureStore:
    """Layout `<root>/<name>/v<version>/{<write id>/features.parquet,metadata.json}` on any Hadoop
    file system. The metadata is written last, names the data and alone makes a version: what has
    none is not listed. The data of a replaced version stays for those who read it; `vacuum` deletes it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{int(version)}"

    def _features(self, name: str, version: int) -> str:
        return f"{self._folder(name, version)}/{self.get_metadata(name, version)['data']}"

    def _metadata(self, name: str, version: int) -> str:
        return f"{self._folder(name, version)}/metadata.json"

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        fs, where = self._hadoop(path)
        return fs.exists(where)

    def save(
        self,
        name: str,
        df: DataFrame,
        version: int,
        description: str = "",
        tags: Sequence[str] | None = None,
        partition_by: Sequence[str] = (),
        sketches: bool = False,
    ) -> str:
        """Write one version (an equal version is replaced) and return the path of its data.

        Rows are counted while they are written; the statistics read the written columns. With `sketches` the version can
        take part in `profile`.
        """
        data = f"{uuid.uuid4().hex}/features.parquet"
        path, metadata = f"{self._folder(name, version)}/{data}", self._metadata(name, version)
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
        writer = counted.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        document = {
            "name": name,
            "version": int(version),
            "data": data,
            "description": description,
            "tags": list(tags or []),
            "created_at": datetime.now(timezone.utc).isoformat(),
            "num_rows": seen.get["n"],
            "num_columns": len(df.columns),
            "columns": df.columns,
            "dtypes": dict(df.dtypes),
            "statistics": statistics(self.spark.read.schema(df.schema).parquet(path)),
        }
        if sketches:
            written = sketch(self.spark.read.schema(df.schema).parquet(path))
            written.write.parquet(f"{path.rsplit('/', 1)[0]}/sketches.parquet")
        staged = f"{path.rsplit('/', 1)[0]}/metadata.json"
        self.spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(staged)
        self._replace(staged, metadata)
        return path

    def _replace(self, staged: str, final: str) -> None:
        """Put the one text file of `staged` in the place of `final` by one rename, so that a reader finds the old or the new
        document at any time."""
        fs, pattern = self._hadoop(f"{staged}/part-*")
        place = self._hadoop(final)[1]
        if fs.exists(place) and fs.getFileStatus(place).isDirectory():  # of an earlier layout
            fs.delete(place, True)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        overwrite = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        overwrite[0] = hadoop.Options.Rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fs.globStatus(pattern)[0].getPath(), fs.makeQualified(place), overwrite)

    def profile(self, name: str, versions: Sequence[int] | None = None, top: int = 5) -> DataFrame:
        """Profile over the rows of several versions (all complete ones by default), from the sketches saved with them."""
        wanted = self.list_versions(name) if versions is None else versions
        if not wanted:
            raise FileNotFoundError(f"No complete version of {name} in {self.root}")
        paths = [self._features(name, v).rsplit("/", 1)[0] + "/sketches.parquet" for v in wanted]
        return merged_profile([self.spark.read.parquet(p) for p in paths], top)

    def vacuum(self, name: str, version: int) -> None:
        """Delete data of a version that its metadata does not name: replaced or never finished."""
        kept = {self.get_metadata(name, version)["data"].split("/")[0], "metadata.json"}
        fs, where = self._hadoop(self._folder(name, version))
        for found in fs.listStatus(where):
            if found.getPath().getName() not in kept:
                fs.delete(found.getPath(), True)

    def load(self, name: str, version: int | None = None) -> DataFrame:
        """One version, the latest by default."""
        wanted = self.latest_version(name) if version is None else version
        if wanted is None:
            raise FileNotFoundError(f"No complete version of {name} in {self.root}")
        return self.spark.read.parquet(self._features(name, wanted))

    def get_metadata(self, name: str, version: int) -> dict:
        path = self._metadata(name, version)
        if not self._exists(path):
            raise FileNotFoundError(f"No complete version {version} of {name} in {self.root}")
        return json.loads(self.spark.read.text(path).first()["value"])

    def list_versions(self, name: str) -> list[int]:
        """Ascending numbers of complete versions; other entries of the folder are passed over."""
        folder = f"{self.root}/{name}"
        if not self._exists(folder):
            return []
        fs, where = self._hadoop(folder)
        found = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        numbers = sorted(int(n[1:]) for n in found if n[:1] == "v" and n[1:].isdecimal())
        return [n for n in numbers if self._exists(self._metadata(name, n))]

    def latest_version(self, name: str) -> int | None:
        return max(self.list_versions(name), default=None)

    def catalog(self) -> DataFrame:
        """Metadata of every version of every feature set; no rows in an empty store."""
        fs, pattern = self._hadoop(f"{self.root}/*/v*/metadata.json")
        if not fs.globStatus(pattern):
            return self.spark.createDataFrame([], CATALOG_SCHEMA)
        return self.spark.read.schema(CATALOG_SCHEMA).json(f"{self.root}/*/v*/metadata.json")

    def find(self, tag: str | None = None, text: str | None = None) -> DataFrame:
        """Versions that carry a tag, or whose description holds a text."""
        found = self.catalog()
        if tag is not None:
            found = found.where(F.array_contains("tags", tag))
        if text is not None:
            found = found.where(F.lower("description").contains(text.lower()))
        return found
