"""Event rows by output and date: a folder per micro-batch, compacted into larger ones.

    root/data/part=batch-7/output=silver/event_date=2024-01-10/...
    root/data/part=compacted-0-6/output=silver/event_date=2024-01-10/...
    root/manifest/00000000000000000001.json

A batch's folder is overwritten when the batch is replayed, which makes the outputs
exactly-once. Compaction rewrites the folders of committed batches, which are never
replayed, and then publishes a manifest that names the part in their place.
Readers take the newest manifest's parts and the batches behind it, so they see
every row once at any time; both layouts prune by output and date.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.session import create_text, delete_dir, list_dir, path_exists, read_text

#: Partition columns of a row's place.
PLACE = ["output", "event_date"]
_PLACE_TYPES = [T.StructField("output", T.StringType()), T.StructField("event_date", T.DateType())]


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last micro-batch that a stream has finished for good; -1 without any."""
    done = [int(n) for n in list_dir(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(done, default=-1)


class EventStore:
    """One writer of batches, one compaction at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    @staticmethod
    def is_store(spark: SparkSession, path: str) -> bool:
        return path_exists(spark, f"{path}/data")

    def write(self, rows: DataFrame, batch_id: int) -> str:
        """Put a batch (with the columns of ``PLACE``) in its folder, in one pass."""
        return self._save(rows, f"batch-{batch_id}")

    def _save(self, rows: DataFrame, part: str) -> str:
        folder = f"{self.root}/data/part={part}"
        options = {"ignoreNullFields": "false"} if self.fmt == "json" else {}
        # A rebalance gives each date few files; unlike a repartition by date
        # it splits a date that is too large for one.
        (
            rows.hint("rebalance", *PLACE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .options(**options)
            .partitionBy(*PLACE)
            .format(self.fmt)
            .save(folder)
        )
        return folder

    def manifest(self) -> dict:
        """The newest manifest: its version, the last batch it covers, the parts that hold these."""
        names = [n for n in list_dir(self.spark, f"{self.root}/manifest") if n.endswith(".json")]
        if not names:
            return {"version": 0, "upto": -1, "parts": []}
        return json.loads(read_text(self.spark, f"{self.root}/manifest/{max(names)}"))

    def batches(self) -> list[int]:
        """Numbers of the batches that have a folder."""
        return sorted(int(p.removeprefix("batch-")) for p in self._stored() if p.startswith("batch-"))

    def _stored(self) -> list[str]:
        return [n.removeprefix("part=") for n in list_dir(self.spark, f"{self.root}/data")]

    def parts(self) -> list[str]:
        """Parts that hold every row once."""
        known = self.manifest()
        return [*known["parts"], *(f"batch-{b}" for b in self.batches() if b > known["upto"])]

    def read(self, schema: T.StructType, output: str | None = None, dates: list[str] | None = None) -> DataFrame:
        """Rows of an output (of the given dates); ``schema`` is that of the files."""
        return self._load(self.parts(), schema, output, dates)

    def read_batch(self, batch_id: int, schema: T.StructType) -> DataFrame:
        return self._load([f"batch-{batch_id}"], schema)

    def _load(
        self, parts: list[str], schema: T.StructType, output: str | None = None, dates: list[str] | None = None
    ) -> DataFrame:
        fields = [f for f in schema.fields if f.name not in PLACE]
        whole = T.StructType([*fields, T.StructField("part", T.StringType()), *_PLACE_TYPES])
        folders = [f for f in (f"{self.root}/data/part={p}" for p in parts) if self._holds_rows(f)]
        if folders:
            base = f"{self.root}/data"
            rows = self.spark.read.schema(whole).option("basePath", base).format(self.fmt).load(folders)
        else:
            rows = self.spark.createDataFrame([], whole)
        rows = rows.drop("part")
        if output is not None:
            rows = rows.where(F.col("output") == output)
        if dates:
            rows = rows.where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
        return rows

    def _holds_rows(self, folder: str) -> bool:
        """A batch without rows has a folder without partitions."""
        return any(n.startswith("output=") for n in list_dir(self.spark, folder))

    def compact(self, committed: int, schema: T.StructType, most: int = 16) -> bool:
        """Rewrite the batches up to ``committed`` into one part; false if there is none to rewrite.

        With ``most`` compacted parts or more these are merged as well. A run that
        fails leaves a folder that no manifest names, and the next one overwrites it.
        """
        known = self.manifest()
        fresh = [b for b in self.batches() if known["upto"] < b <= committed]
        if not fresh:
            return False
        merged = known["parts"] if len(known["parts"]) >= most else []
        first = 0 if merged or not known["parts"] else known["upto"] + 1
        target = f"compacted-{first}-{fresh[-1]}"
        self._save(self._load([*merged, *(f"batch-{b}" for b in fresh)], schema), target)
        parts = [target] if merged else [*known["parts"], target]
        version = known["version"] + 1
        text = json.dumps({"version": version, "upto": fresh[-1], "parts": parts})
        create_text(self.spark, f"{self.root}/manifest/{version:020d}.json", text)
        return True

    def vacuum(self) -> None:
        """Delete parts that the newest manifest replaces; no reader of an older one and no compaction may be at work."""
        known = self.manifest()
        for part in set(self._stored()) - set(self.parts()):
            delete_dir(self.spark, f"{self.root}/data/part={part}")
