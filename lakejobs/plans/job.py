"""The course every job takes: extract, transform, validate, load, report."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession

from lakejobs.config import JobConfig
from lakejobs.operators.quality import missing_columns, quality_base
from lakejobs.session import scratch, session, stage
from lakejobs.sinks.reports import REPORT_TABLE, append_report, run_report
from lakejobs.sinks.tables import show_preview, table_name, write_table


class LakeJob:
    """Base of the jobs. Subclasses say where data comes from, what becomes of it and what it must hold.

    What `extract` gives is used three times: for a look whether there is any row, for the quality gate,
    which needs a few columns, and for the write. The jobs here stage their parsed input, so that these read
    columns instead of parsing again. The count of written rows is taken while writing. One run time is
    fixed per run. A job given a session leaves it running.
    """

    entity = ""
    layer = ""
    required_columns: list[str] = []
    preview_rows = 10
    preview_options: dict = {}

    def __init__(
        self,
        config: JobConfig,
        spark: SparkSession | None = None,
        table_format: str = "parquet",
        table_path: str | None = None,
        report_table: str = REPORT_TABLE,
        report_path: str | None = None,
        run_time: datetime | None = None,
    ) -> None:
        self.config = config
        self.spark, self._owns_session = (spark, False) if spark is not None else session(config.job_name)
        self.table_format = table_format
        self.table_path = table_path
        self.report_table = report_table
        self.report_path = report_path
        self.run_time = run_time or datetime.now(timezone.utc)
        self.logger = logging.getLogger(f"lakejobs.{config.job_name}")
        self.logger.setLevel(config.log_level)
        self.quality: Row | None = None
        self.rejected: DataFrame | None = None

    def extract(self) -> DataFrame | None:
        """The input, or None when there is nothing to do."""
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def gate(self, df: DataFrame) -> DataFrame:
        """One row of quality measures with `total` and `passed`."""
        return quality_base(df, self.required_columns)

    @property
    def table(self) -> str:
        return table_name(self.config.env, self.entity, self.layer)

    @property
    def quarantine_table(self) -> str:
        return table_name(self.config.env, self.entity, "quarantine")

    def validate(self, df: DataFrame | None) -> bool:
        """No table, an empty one, one without a required column, or a failed gate: False."""
        if df is None:
            return False
        missing = missing_columns(df, self.required_columns)
        if missing:
            self.logger.error("missing required columns: %s", missing)
            return False
        self.quality = self.gate(df).first()
        self.logger.info("quality: %s", self.quality.asDict())
        return self.quality["total"] > 0 and self.quality["passed"]

    def load(self, df: DataFrame) -> int:
        """Show the rows in the local environment, else write the table; returns the number of rows."""
        if self.config.env == "local":
            show_preview(df, self.preview_rows, **self.preview_options)
            rows = self.quality["total"] if self.quality else df.count()
            self.logger.info("would write %s rows to %s", rows, self.table)
            return rows
        return write_table(df, self.table, table_format=self.table_format, path=self.table_path)

    def quarantine(self) -> int:
        """Replace the quarantine table by the rows that `extract` has set aside in `rejected`; their number."""
        if self.rejected is None:
            return 0
        if self.config.env == "local":
            rows = self.rejected.count()
        else:
            path = f"{self.table_path}-quarantine" if self.table_path else None
            rows = write_table(self.rejected, self.quarantine_table, table_format=self.table_format, path=path)
        if rows:
            self.logger.warning("%s rows do not fit the declared types, see %s", rows, self.quarantine_table)
        return rows

    def run(self) -> bool:
        try:
            with scratch(self.spark):
                return self._run()
        except Exception as error:
            self.logger.error("job failed: %s", error)
            self._report(error=f"{type(error).__name__}: {error}")
            raise
        finally:
            if self._owns_session:
                self.spark.stop()

    def _run(self) -> bool:
        raw = self.extract()
        set_aside = self.quarantine()
        if raw is None or raw.isEmpty():
            if set_aside:
                raise RuntimeError("no row fits the declared types")
            self.logger.warning("no data extracted, nothing to do")
            return True
        missing = missing_columns(raw, self.required_columns)
        if missing:
            raise RuntimeError(f"required columns are missing: {missing}")
        result = self.transform(raw)
        if not self.validate(result):
            raise RuntimeError("the quality gate turned the rows down")
        rows = self.load(result)
        self._report(records=rows, output_paths=[] if self.config.env == "local" else [self.table])
        return True

    def run_batch(self, rows: DataFrame, path: str) -> int:
        """Transform, validate and write the rows of one micro-batch, replacing what `path` holds; their number.

        The rows are parsed once. Raises if the gate turns them down, so that the micro-batch is not taken as done.
        Rows set aside go to a folder beside the others, `<parent>-quarantine/<name>`.
        """
        with scratch(self.spark):
            kept = self.prepare(stage(rows, self.entity))
            if self.rejected is not None:
                parent, _, name = path.rpartition("/")
                self.rejected.write.mode("overwrite").parquet(f"{parent}-quarantine/{name}")
            if kept.isEmpty():
                if self.rejected is not None and not self.rejected.isEmpty():
                    raise RuntimeError("no row fits the declared types")
                return 0
            result = self.transform(kept)
            if not self.validate(result):
                raise RuntimeError("the quality gate turned the rows down")
            result.write.mode("overwrite").parquet(path)
            written = self.quality["total"]
        self._report(records=written, output_paths=[path])
        return written

    def prepare(self, staged: DataFrame) -> DataFrame:
        """What of the parsed rows goes on; jobs may set rows aside in `rejected`."""
        return staged

    def _report(self, **outcome) -> None:
        """A report that cannot be written does not fail the job."""
        if not self.config.enable_report:
            return
        try:
            report = run_report(self.spark, self.config, **outcome)
            if self.config.env == "local":
                self.logger.info("report: %s", report.first().asDict())
            else:
                append_report(report, self.report_table, self.report_path)
        except Exception as error:
            self.logger.warning("report not written: %s", error)
