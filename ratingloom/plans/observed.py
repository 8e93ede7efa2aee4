"""Metrics of a run, observed in the one pass that reads the raw rows and writes the curated table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.cleaning import clean_rows, content_order, first_per_key

RAW_COLUMNS = ("release_date", "price", "genres", "publisher")


def raw_metrics(raw: DataFrame, key: str) -> list[Column]:
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in RAW_COLUMNS if c in raw.columns]
    return [F.count("*").alias("raw_rows"), F.count_if(F.col(key).isNull()).alias("without_key"), *missing]


def bad_metrics(raw: DataFrame) -> list[Column]:
    """Bad cells by column, of rows from ``readers.read_audited``."""
    columns = [f.name for f in raw.schema if not f.name.startswith("_")] + ["*"]
    one = lambda name: F.exists("_bad", lambda cell: cell["column"] == name)
    return [F.count_if(F.coalesce(one(name), F.lit(False))).alias(f"bad:{name}") for name in columns]


def clean_metrics() -> list[Column]:
    return [
        F.count("*").alias("clean_rows"),
        F.count_if(F.col("release_date").isNull()).alias("missing_release_date_after"),
        F.count_if(F.col("price").isNull()).alias("missing_price_after"),
        F.count_if(F.col("total_reviews") == 0).alias("zero_review_games"),
        F.sum("positive_ratings").alias("positive_ratings"),
        F.sum("negative_ratings").alias("negative_ratings"),
        F.sum("total_reviews").alias("total_reviews"),
    ]


class CuratedPass:
    """Cleaning with its metrics: ``rows`` is what clean_catalog gives, counted on the way.

    Raw rows are counted at the scan, keys where one row per key is left. A key whose rows
    all lack a name gets as far as that, so the keys need no count of their own.
    """

    def __init__(
        self, raw: DataFrame, *, key: str = "appid", name: str = "name", order: Sequence[Column | str] | None = None, **options
    ) -> None:
        self.raw, self.key, self.clean = raw, key, Observation()
        self.bad_cells: dict[str, int] = {}
        self._raw, self._keys = Observation(), Observation()
        # Named rows first: they win over nameless copies, as if those had been left out before.
        order = [F.col(name).isNull(), *(order or content_order(raw, [key, "_file", "_line", "_bad"]))]
        self.measures = raw_metrics(raw, key)
        if "_bad" in raw.columns:
            self.measures += bad_metrics(raw)
        seen = raw.observe(self._raw, *self.measures).drop("_file", "_line", "_bad").where(F.col(key).isNotNull())
        firsts = first_per_key(seen, (key,), order).observe(self._keys, F.count("*").alias("keys"))
        self.rows = clean_rows(firsts.where(F.col(name).isNotNull()), **options)

    def metrics(self, exact: bool = True) -> dict[str, int]:
        """All metrics after the write. ``exact=False``: tasks ran twice, so count the raw rows by themselves.

        Spark adds what a task observed once per attempt that ended. Stages before a shuffle
        are run again when an executor is lost, and would count rows twice.
        """
        if exact:
            found = self._raw.get | self._keys.get | self.clean.get
        else:
            keys = F.count_distinct(self.key).alias("keys")
            found = self.raw.agg(*self.measures, keys).first().asDict() | self.clean.get
        # Rows without a key count as copies of one another.
        self.bad_cells = {name[4:]: n for name, n in found.items() if name.startswith("bad:") and n}
        found = {name: n for name, n in found.items() if not name.startswith("bad:")}
        copies = found["raw_rows"] - found["keys"] - min(1, found["without_key"])
        return found | {"duplicate_appids_removed": copies}


@contextmanager
def attempts(spark: SparkSession) -> Iterator["Attempts"]:
    """The jobs that start inside, in this thread, under a job group of their own."""
    context = spark.sparkContext
    names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {name: context.getLocalProperty(name) for name in names}
    group = f"observed-{uuid.uuid4().hex}"
    context.setJobGroup(group, "curated pass")
    try:
        yield Attempts(spark, group)
    finally:
        for name, value in before.items():
            context.setLocalProperty(name, value)


class Attempts:
    def __init__(self, spark: SparkSession, group: str) -> None:
        self.tracker, self.group = spark.sparkContext.statusTracker(), group

    def single(self) -> bool:
        """Whether every task of the jobs ended once, and none failed or ran again."""
        for job in self.tracker.getJobIdsForGroup(self.group):
            info = self.tracker.getJobInfo(job)
            for stage in map(self.tracker.getStageInfo, info.stageIds if info else ()):
                if stage and (
                    stage.currentAttemptId or stage.numFailedTasks or stage.numCompletedTasks > stage.numTasks
                ):
                    return False
        return True
