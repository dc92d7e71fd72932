"""A season-partitioned dataset that is kept up to date season by season.

``SeasonStore(spark, path)`` holds versions of seasons and manifests:

    path/version=<id>/season=<s>/*.parquet     rows, written once and never changed
    path/manifest/<number>-<id>                one row per season: fingerprint and version

``refresh(df)`` compares each season's fingerprint (row count, and the sum and the
exclusive or of 64-bit row hashes, so the order of rows does not matter) with the
latest manifest.  It writes the seasons that are new or changed into a new version,
then a manifest that names for each season the version that holds it.  An unchanged
table writes nothing, whatever application asks.

A manifest counts once Spark has committed it, and versions never change.  So a
reader sees one state of all seasons, and a refresh that dies leaves the state
before.  Two refreshes at once each leave a whole state; the manifest that sorts last holds.

Costs: one aggregate over the source (partial per task; one row per task and
season is shuffled) and a write of the changed seasons.  The driver holds one row
per season, as many as the dataset has folders.

Edge cases: an empty table gives a manifest without seasons; a null season is kept
(and is in no range); a season that is gone from the source is no longer read; a
change that keeps count, sum and exclusive or of the hashes would pass unseen (odds of
about 2**-64 for a changed row).  Versions that no manifest needs are not removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlab.sources.plays import PLAYS_SCHEMA, write_partitioned

_PRINT = ("rows", "total", "mixed")
_MANIFEST = "season int, rows long, total decimal(38,0), mixed long, version string"


def fingerprints(df: DataFrame, season: str = "season") -> DataFrame:
    """One row per season: count, sum and exclusive or of the row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    # a null column does not change the hash, so the places of nulls are hashed too
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in sorted(df.columns)])
    h = F.xxhash64(h, nulls)
    return (df.select(F.col(season).cast("int").alias("season"), h.alias("h")).groupBy("season")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"),
                 F.bit_xor("h").alias("mixed")))


class SeasonStore:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = PLAYS_SCHEMA):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folders(self, path: str) -> list[str]:
        """Names of the committed outputs below ``path``, in order."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        found = [s.getPath() for s in fs.listStatus(folder)]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in found if fs.exists(done(p, "_SUCCESS")))

    def manifest(self) -> dict:
        """Latest state: season -> (rows, total, mixed, version)."""
        names = self._folders(f"{self.path}/manifest")
        if not names:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/{names[-1]}").collect()
        return {r.season: (*[r[c] for c in _PRINT], r.version) for r in rows}

    def refresh(self, df: DataFrame) -> list:
        """Bring the store to the state of ``df``; returns the seasons that were written."""
        df = df.select(*self.schema.fieldNames())
        now = {r.season: tuple(r[c] for c in _PRINT) for r in fingerprints(df).collect()}
        held = self.manifest()
        changed = [s for s, p in now.items() if s not in held or held[s][:3] != p]
        names = self._folders(f"{self.path}/manifest")
        if not changed and len(held) == len(now) and names:
            return []
        version = uuid.uuid4().hex
        if changed:
            wanted = F.col("season").isin([s for s in changed if s is not None])
            if None in changed:
                wanted = F.coalesce(wanted, F.lit(True)) if len(changed) > 1 else F.col("season").isNull()
            write_partitioned(df.where(wanted), f"{self.path}/version={version}", mode="errorifexists")
        state = [(s, *p, version if s in changed else held[s][3]) for s, p in now.items()]
        number = 1 + int(names[-1].split("-")[0]) if names else 0
        (self.spark.createDataFrame(state, _MANIFEST).coalesce(1)
         .write.parquet(f"{self.path}/manifest/{number:012d}-{version}"))
        return sorted(changed, key=lambda s: (s is not None, s))

    def scan(self, start: int | None = None, end: int | None = None, columns=None) -> DataFrame:
        """Rows of the seasons ``start`` <= season < ``end``; no other folder is listed or read."""
        def inside(s):
            if start is None and end is None:
                return True
            return s is not None and (start is None or s >= start) and (end is None or s < end)

        folders = [f"{self.path}/version={held[3]}/season={'__HIVE_DEFAULT_PARTITION__' if s is None else s}"
                   for s, held in self.manifest().items() if inside(s)]
        if not folders:
            df = self.spark.createDataFrame([], self.schema)
        else:
            df = (self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("version", T.StringType())]))
                  .option("basePath", self.path).parquet(*folders).select(*self.schema.fieldNames()))
        return df.select(*columns) if columns else df
