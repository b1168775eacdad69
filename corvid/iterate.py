"""Tables of iterative jobs: written to the shared folder, dropped when done; and
journals, from which a job goes on after its driver is lost."""

from __future__ import annotations

import gc
import json

from pyspark.sql import DataFrame, SparkSession

from corvid.session import scratch_folders, scratch_path


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in (held := scratch_folders(spark)):
        held.remove(path)


def release(spark: SparkSession, keep: DataFrame | None = None, since: int = 0) -> None:
    """Drop the scratch tables of this application (from the ``since``-th on, as
    ``len(scratch_folders(spark))`` told it before), but for those that ``keep`` reads.
    Frames that were not written and read others can no longer be computed."""
    reads = {part for f in (keep.inputFiles() if keep is not None else []) for part in f.split("/")}
    for path in scratch_folders(spark)[since:]:
        if path.rsplit("/", 1)[1] not in reads:
            drop_folder(spark, path)


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files of frames that nothing holds any more: Spark removes them when its
    driver collects garbage, which a loop of small plans hardly ever makes it do."""
    gc.collect()
    spark._jvm.System.gc()


class Steps:
    """Cuts the lineage of each step by writing its tables as Parquet under the
    checkpoint directory, and deletes the tables of a step once the next one is
    written: storage does not grow with the number of steps."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.folders = spark, name, []

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        self.folders.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_last(self, n: int) -> None:
        """Delete all but the ``n`` tables written last."""
        old, self.folders = self.folders[:len(self.folders) - n], self.folders[len(self.folders) - n:]
        for path in old:
            drop_folder(self.spark, path)


class Journal:
    """Committed steps of one job under ``path``: the tables of a step are written to
    a folder of its own, then a manifest (step, scalars) is put there under a
    temporary name and renamed. A step without manifest never happened. ``job`` names
    what is trained: a journal of another job is an error."""

    def __init__(self, spark: SparkSession, path: str, job: dict):
        self.spark, self.path, self.job = spark, path.rstrip("/"), json.loads(json.dumps(job))
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._Path(path))

    def _steps(self) -> list[int]:
        names = [x.getPath().getName() for x in self.fs.listStatus(self._Path(self.path))]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def commit(self, step: int, tables: dict[str, DataFrame], scalars: dict) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/step-{step}/{name}")
        old, draft = self._steps(), self._Path(f"{self.path}/manifest-{step}.draft")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps({"job": self.job, "tables": sorted(tables), "scalars": scalars}).encode()))
        out.close()
        if not self.fs.rename(draft, self._Path(f"{self.path}/manifest-{step}.json")):
            raise RuntimeError(f"step {step} was not committed")
        for k in old[:-1]:  # the step before stays
            self.fs.delete(self._Path(f"{self.path}/manifest-{k}.json"), False)
            drop_folder(self.spark, f"{self.path}/step-{k}")

    def last(self) -> tuple[int, dict[str, DataFrame], dict] | None:
        """(step, tables, scalars) of the last committed step."""
        steps = self._steps()
        if not steps:
            return None
        lines = self.spark.read.text(f"{self.path}/manifest-{steps[-1]}.json", wholetext=True).first()["value"]
        told = json.loads(lines)
        if told["job"] != self.job:
            raise ValueError(f"{self.path} is a journal of {told['job']}, not of {self.job}")
        return steps[-1], {n: self.spark.read.parquet(f"{self.path}/step-{steps[-1]}/{n}") for n in told["tables"]}, told["scalars"]
