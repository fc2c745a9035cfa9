"""Named, versioned views with a manifest."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marketmill.functions.windows import first_per_key

_LOG = (
    "name string, version bigint, deleted boolean, kind string, exports array<string>, expr_hash string, "
    "sources array<string>, freshness map<string,string>, built_at timestamp, columns array<string>"
)


@dataclass
class Manifest:
    name: str
    kind: str
    expr_hash: str
    exports: list[str] = field(default_factory=list)
    sources: list[str] = field(default_factory=list)
    freshness: dict[str, str] = field(default_factory=dict)


class Views:
    """Views under a root folder.

    Every publish writes a new version folder and then one row in the manifest
    log; the newest row per name decides. Readers so never see half a view, and
    a rebuild replaces instead of appending.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], _LOG)

    def _append(self, m: Manifest, version: int, deleted: bool, columns: list[str]) -> None:
        row = (m.name, version, deleted, m.kind, m.exports, m.expr_hash, m.sources, m.freshness, None, columns)
        line = self.spark.createDataFrame([row], _LOG).withColumn("built_at", F.current_timestamp())
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def manifests(self) -> DataFrame:
        """Current manifests, sorted by name."""
        live = first_per_key(self._log(), ["name"], [F.desc("version")]).filter(~F.col("deleted"))
        return live.drop("deleted").orderBy("name")

    def manifest(self, name: str):
        rows = self.manifests().filter(F.col("name") == name).collect()
        return rows[0] if rows else None

    def publish(self, df: DataFrame, manifest: Manifest) -> None:
        version = time.time_ns()
        df.write.parquet(f"{self.root}/frames/{manifest.name}/{version}")
        self._append(manifest, version, False, df.columns)

    def read(self, name: str) -> DataFrame | None:
        m = self.manifest(name)
        return None if m is None else self.spark.read.parquet(f"{self.root}/frames/{name}/{m['version']}")

    def names(self) -> list[str]:
        return [r["name"] for r in self.manifests().select("name").collect()]

    def drop(self, name: str) -> bool:
        """Remove a view; tells whether it existed."""
        m = self.manifest(name)
        if m is None:
            return False
        self._append(Manifest(name, m["kind"], m["expr_hash"]), time.time_ns(), True, [])
        return True

    def purge(self) -> list[str]:
        """Remove the frames that no current view reads: old versions, dropped views, and publishes that broke off.

        Returns their folders. Not to be run while a view is being published or read.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/frames")
        store = root.getFileSystem(conf)
        if not store.exists(root):
            return []
        live = {f"{r['name']}/{r['version']}" for r in self.manifests().select("name", "version").collect()}
        out = []
        for view in store.listStatus(root):
            for version in store.listStatus(view.getPath()):
                name = f"{view.getPath().getName()}/{version.getPath().getName()}"
                if name not in live:
                    store.delete(version.getPath(), True)
                    out.append(f"{self.root}/frames/{name}")
        return sorted(out)
