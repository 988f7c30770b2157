"""Cleaning rules: which columns and rows of a raw table are kept."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.missing import is_missing
from starloom.names import col
from starloom.operators.columns import drop_columns
from starloom.operators.dedup import dedup, distinct_values
from starloom.operators.rows import (
    drop_empty_rows,
    drop_incomplete_rows,
    is_complete,
    missing_cells,
)
from starloom.scratch import materialise


@dataclass(frozen=True)
class Counted:
    """Cleaned rows whose counts are observed while something else is computed from them.

    The counts are those of the first job that computes ``table`` in full, so that job
    must not stop early and must not compute the table twice (a sort does, to find its
    ranges). Tasks that run again, after a failure or a lost executor, may be counted
    again; so :meth:`report` takes the observed counts only if the caller vouches that
    no task did (:func:`ran_once`), and otherwise counts with a query.
    """

    rule: Cleaning
    raw: DataFrame
    table: DataFrame
    first: Observation
    last: Observation

    def report(self, trusted: bool) -> DataFrame:
        """One row like :meth:`Cleaning.report`, without a scan where the counts are ``trusted``."""
        if not trusted:
            return self.rule.report(self.raw)
        seen, out = self.first.get, self.last.get["rows_out"]
        if self.rule.unique_by or out == seen["kept"]:
            counts = (seen["rows_in"], seen["rows_in"] - seen["kept"], seen["kept"] - out, out)
            kinds = "rows_in long, dropped_missing long, dropped_duplicates long, rows_out long"
            return self.raw.sparkSession.createDataFrame([counts], kinds)
        return self.rule.report(self.raw)


def ran_once(spark: SparkSession, tag: str) -> bool:
    """True if every stage of the jobs with this tag ended in one attempt without a failed task.

    Also false where Spark no longer knows one of them, or knows no such job.
    """
    tracker = spark._jsc.sc().statusTracker()
    jobs = list(tracker.getJobIdsForTag(tag))
    if not jobs:
        return False
    for job in jobs:
        info = tracker.getJobInfo(job)
        if info.isEmpty():
            return False
        for stage in info.get().stageIds():
            found = tracker.getStageInfo(stage)
            if found.isEmpty():
                return False
            # Skipped stages have no attempt and no tasks that ran.
            if found.get().numFailedTasks() or found.get().currentAttemptId() > 0:
                return False
    return True


@dataclass(frozen=True)
class Cleaning:
    """Applied in field order: drop columns, empty rows, incomplete rows, duplicates.

    Of rows with equal ``unique_by`` the first by ``order_by`` stays.
    """

    columns: tuple[str, ...] = ()
    empty_rows: bool = False
    required: tuple[str, ...] = ()
    unique_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        df = drop_columns(df, self.columns)
        if self.empty_rows:
            df = drop_empty_rows(df)
        if self.required:
            df = drop_incomplete_rows(df, self.required)
        if self.unique_by:
            df = dedup(df, self.unique_by, self.order_by)
        return df

    def distinct_column(self, df: DataFrame, name: str) -> DataFrame:
        """Distinct values of one column over the kept rows, with less reading.

        A row that has this column is not empty, so its values come from a scan of
        it alone. Whether any kept row misses it, which all columns decide, is asked
        as a test for emptiness: that stops at the first such row.
        """
        if self.required or self.unique_by:
            return distinct_values(self.apply(df), name)
        field = df.schema[name]
        missing = is_missing(field, text_nan=False)
        values = df.where(~missing).select(col(name)).distinct()
        kinds = [col(name).isNull()]
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            kinds.append(F.isnan(col(name)))
        for kind in kinds:
            if not (lost := self.apply(df.where(kind)).select(col(name)).limit(1)).isEmpty():
                values = values.unionByName(materialise(lost, "missing-member"))
        return values

    def report(self, df: DataFrame) -> DataFrame:
        """One row: ``rows_in, dropped_missing, dropped_duplicates, rows_out``.

        One scan of the columns the rule looks at. Rows are combined per key
        before the shuffle, and the counts are those of a query, so a retried
        task is not counted twice.
        """
        df = drop_columns(df, self.columns)
        kept = F.count_if(self._kept(df))
        if self.unique_by:
            groups = df.groupBy(*[col(k) for k in self.unique_by])
            out = F.col("kept").cast("boolean").cast("long")
        else:
            groups, out = df, F.col("kept")
        counts = groups.agg(F.count(F.lit(1)).alias("rows"), kept.alias("kept"))
        totals = counts.agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).alias(n)
                for c, n in ((F.col("rows"), "rows_in"), (F.col("kept"), "kept"), (out, "rows_out"))
            ]
        )
        return totals.select(
            "rows_in",
            (F.col("rows_in") - F.col("kept")).alias("dropped_missing"),
            (F.col("kept") - F.col("rows_out")).alias("dropped_duplicates"),
            "rows_out",
        )

    def counted(self, df: DataFrame) -> Counted:
        """:meth:`apply`, with the report's counts taken by whatever first runs it in full."""
        raw = drop_columns(df, self.columns)
        first, last = (Observation(f"cleaning-{uuid4().hex}") for _ in range(2))
        seen = raw.observe(
            first, F.count(F.lit(1)).alias("rows_in"), F.count_if(self._kept(raw)).alias("kept")
        )
        table = self.apply(seen).observe(last, F.count(F.lit(1)).alias("rows_out"))
        return Counted(self, df, table, first, last)

    def _kept(self, df: DataFrame) -> Column:
        kept = F.lit(True)
        if self.empty_rows:
            kept = kept & (missing_cells(df) < len(df.columns))
        if self.required:
            kept = kept & is_complete(df, self.required)
        return kept


# The columns each raw table's cleaning looks at.
IMMIGRATION = Cleaning(columns=("occup", "entdepu", "insnum"), empty_rows=True)
IMMIGRATION_RECORDS = Cleaning(
    columns=("occup", "entdepu", "insnum"), required=("cicid",), unique_by=("cicid",)
)
# A city measured at several places keeps the readings of one of them throughout.
TEMPERATURE = Cleaning(
    required=("AverageTemperature",),
    unique_by=("dt", "City", "Country"),
    order_by=("Latitude", "Longitude"),
)
DEMOGRAPHICS = Cleaning(
    required=(
        "Male Population",
        "Female Population",
        "Number of Veterans",
        "Foreign-born",
        "Average Household Size",
    ),
    unique_by=("City", "State", "State Code", "Race"),
)
