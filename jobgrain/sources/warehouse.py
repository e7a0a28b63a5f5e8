"""Tables on shared storage: full refresh, append per run, publication."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.schemas import NORM, RAW, STAR
from jobgrain.sources.commits import Commit, CommitLog

SCHEMAS = {
    **{f"raw.{k}": v for k, v in RAW.items()},
    **{f"norm.{k}": v for k, v in NORM.items()},
    **{f"star.{k}": v for k, v in STAR.items()},
}
PARTITIONS = {"star.fact_job_postings": ["year", "month"]}


def _part_of(name: str) -> Column:
    """A row's partition as one text."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in PARTITIONS[name]])


class Warehouse:
    """Parquet tables under one root, each partitioned by the run that added the
    rows. A run's rows are visible to readers only after its commit, one file in a
    log, so readers see a load as a whole or not at all, and a failed run may be
    repeated. A published run may not: later runs refer to the ids it gave. Nor can
    a run be published if another one was since it began. The raw tables are those
    of the last published run alone.

    Tables of PARTITIONS (the fact) are kept up by partition: a run writes the
    partitions that it touches anew and whole, the commit names them, and readers
    take each partition from the last run that wrote it. So rows that later data
    contradict leave, while earlier readers keep the files they began with."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = run_id
        self.log = CommitLog(spark, self.root)
        self._commits: list[Commit] | None = None
        self._replaced: dict[str, list[str]] = {}
        if run_id is not None and run_id in self.committed():
            raise ValueError(f"run {run_id!r} is published already; take a new run id")
        self._frames: dict[tuple[str, bool], DataFrame] = {}

    # -- commits --------------------------------------------------------------

    def commits(self) -> list[Commit]:
        """Published runs, oldest first. They are read once, so all reads through one
        object see the same state."""
        if self._commits is None:
            self._commits = self.log.read()
        return self._commits

    def committed(self) -> list[str]:
        """Ids of published runs, oldest first."""
        return [c.run_id for c in self.commits()]

    def commit(self) -> None:
        """Publish this run, then drop the raw rows of earlier ones. Raises
        CommitConflict, and publishes nothing, if another run came first."""
        earlier = self.commits()
        number = earlier[-1].number + 1 if earlier else 1
        self.log.publish(Commit(number, self.run_id, self._replaced))
        for name in RAW:
            for commit in earlier:
                self._drop(f"{self.root}/raw.{name}/run_id={commit.run_id}")

    def vacuum(self) -> None:
        """Drop partitions that a later run wrote anew. Readers that began before the
        last commit may still need them."""
        for name, columns in PARTITIONS.items():
            kept = self._owners(name, self.committed())
            for commit in self.commits():
                for part in set(commit.replaced.get(name, ())) - set(kept.get(commit.run_id, ())):
                    folders = "/".join(f"{c}={v}" for c, v in zip(columns, part.split("/")))
                    self._drop(f"{self.root}/{name}/run_id={commit.run_id}/{folders}")

    def _drop(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    # -- reading ----------------------------------------------------------------

    def existing(self, name: str) -> DataFrame:
        """Rows of published runs."""
        return self._frame(name, with_own=False)

    def table(self, name: str) -> DataFrame:
        """Rows of published runs and of this run."""
        return self._frame(name, with_own=True)

    def added(self, name: str) -> DataFrame:
        """Rows of this run only; of a table kept up by partition, all rows of the
        partitions that this run wrote."""
        return self._visible(name, [self.run_id])

    def untouched(self, name: str) -> DataFrame:
        """Rows of published runs that stay as they are: all of them, or, of a table kept
        up by partition, those of partitions that this run did not write."""
        known = self.existing(name)
        if name not in PARTITIONS:
            return known
        return known.where(~_part_of(name).isin(self._replaced.get(name, [])))

    def register_views(self) -> None:
        """Make every star and norm table a temporary view, for SQL."""
        for name in SCHEMAS:
            self.table(name).createOrReplaceTempView(name.replace(".", "_"))

    def _frame(self, name: str, with_own: bool) -> DataFrame:
        """Files are listed once per table, and again after this run wrote to it."""
        key = (name, with_own)
        if key not in self._frames:
            own = [self.run_id] if with_own and self.run_id else []
            runs = self.committed() + own
            if name.startswith("raw."):  # a refresh: the newest rows that there are
                runs = own if own and self._has(name, own[0]) else self.committed()[-1:]
            self._frames[key] = self._visible(name, runs)
        return self._frames[key]

    def _has(self, name: str, run: str) -> bool:
        return self._read(f"{self.root}/{name}/run_id={run}", SCHEMAS[name]) is not None

    def _owners(self, name: str, runs: list[str]) -> dict[str, list[str]]:
        """Run to the partitions of a table that are read from it: those that no later
        one of the runs wrote."""
        written = {c.run_id: c.replaced.get(name, []) for c in self.commits()}
        if self.run_id is not None:
            written[self.run_id] = self._replaced.get(name, [])
        last = {part: run for run in runs for part in written.get(run, [])}
        return {run: sorted(p for p, owner in last.items() if owner == run) for run in runs}

    def _visible(self, name: str, runs: list[str]) -> DataFrame:
        schema = SCHEMAS[name]
        found = self._read(f"{self.root}/{name}", f"{schema}, run_id STRING")
        if found is None:
            return self.spark.createDataFrame([], schema)
        if name not in PARTITIONS:
            return found.where(F.col("run_id").isin(runs)).drop("run_id")
        wanted = F.lit(False)  # of partition columns only, so other partitions are not read
        for run, parts in self._owners(name, runs).items():
            if parts:
                wanted = wanted | ((F.col("run_id") == run) & _part_of(name).isin(parts))
        return found.where(wanted).drop("run_id")

    def _read(self, path: str, schema: str) -> DataFrame | None:
        reader = self.spark.read.schema(schema)
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    # -- writing ------------------------------------------------------------------

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """Write this run's rows and return the table as the run sees it. Reading
        back what was written also cuts the lineage for the next step."""
        if name in PARTITIONS:
            return self.replace(name, rows, [])
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/run_id={self.run_id}")
        self._frames.pop((name, True), None)
        return self.table(name)

    def replace(self, name: str, rows: DataFrame, parts: list[tuple]) -> DataFrame:
        """Write partitions of a table anew: those that the rows are in, and `parts`,
        which are left empty without rows. Rows are first brought together by
        partition, so that there are few files; Spark splits a partition that is too
        large for one task. A run that is repeated overwrites what it wrote."""
        columns = PARTITIONS[name]
        path = f"{self.root}/{name}/run_id={self.run_id}"
        rows.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)
        written = self.spark.read.schema(SCHEMAS[name]).parquet(path).select(*columns).distinct()
        every = {"/".join(map(str, part)) for part in [*written.collect(), *parts]}
        self._replaced[name] = sorted(every)
        self._frames.pop((name, True), None)
        return self.table(name)

    def append_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Append to several tables that do not need each other, as jobs that share
        the cluster."""
        self.committed()
        for name in tables:
            self.existing(name)
        with ThreadPoolExecutor(len(tables)) as pool:
            written = pool.map(lambda item: self.append(*item), tables.items())
            return dict(zip(tables, written))

    def refresh_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Full refresh of several raw tables: once this run is published, its rows
        are all there are."""
        self.append_all(tables)
        return {name: self.added(name) for name in tables}

    def quarantine(self, dataset: str, rows: DataFrame) -> None:
        """Store rows that this run sets aside."""
        rows.write.mode("overwrite").parquet(f"{self.root}/quarantine/{dataset}/run_id={self.run_id}")

    def quarantined(self, dataset: str) -> DataFrame:
        """Rows that this run has set aside."""
        return self.spark.read.parquet(f"{self.root}/quarantine/{dataset}/run_id={self.run_id}")


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows to a plain Parquet table."""
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Replace a plain Parquet table."""
    df.write.mode("overwrite").parquet(path)
