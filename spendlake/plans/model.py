"""The whole model as lazy DataFrames: exports -> raw -> staged ->
categorised -> marts -> report frame.  Nothing runs until an action."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from spendlake import fixed_values as FV
from spendlake.operators import filters, ingest, marts
from spendlake.operators.categorise import categorise
from spendlake.operators.staging import stage
from spendlake.plans.star import report_frame_same_run
from spendlake.sources import adapters
from spendlake.sources.rules import FIXTURE_RULES, rules_frame


class Model:
    """Lazy model over a source of export rows.

    ``source`` is ``"events"`` (correctness adapter), ``"lineitem"`` (bench
    adapter) or a DataFrame of export rows (e.g. ``read_exports``)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, source="events",
                 rules=None, method: str = "auto", calendar=(FV.CALENDAR_START, FV.CALENDAR_END),
                 with_load_time: bool = False, with_position: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.source = source
        self._rules = FIXTURE_RULES if rules is None else rules
        self.method = method
        self.calendar = calendar
        self.with_load_time = with_load_time
        self.with_position = with_position

    @cached_property
    def export_rows(self) -> DataFrame:
        if isinstance(self.source, DataFrame):
            return self.source
        if self.source == "events":
            return adapters.events_export_rows(self.spark, self.sf_dir)
        if self.source == "lineitem":
            return adapters.lineitem_export_rows(self.spark, self.sf_dir)
        raise ValueError(f"unknown source {self.source!r}")

    @cached_property
    def rules(self) -> DataFrame:
        return self._rules if isinstance(self._rules, DataFrame) else rules_frame(self.spark, self._rules)

    @cached_property
    def typed(self) -> DataFrame:
        return ingest.typed_rows(self.export_rows)

    @cached_property
    def kept(self) -> DataFrame:
        return ingest.newest_file_wins(ingest.posted(self.typed))

    @cached_property
    def raw(self) -> DataFrame:
        out = ingest.dedupe_by_key(self.kept, self.with_position)
        if self.with_load_time:
            from pyspark.sql import functions as F
            out = out.withColumn("loaded_at", F.current_timestamp())
        return out

    @cached_property
    def staged(self) -> DataFrame:
        return stage(self.raw)

    @cached_property
    def categorised(self) -> DataFrame:
        return categorise(self.staged, self.rules, self.method)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_transactions(self.categorised)

    @cached_property
    def dim_account(self) -> DataFrame:
        return marts.dim_account(self.staged)

    @cached_property
    def dim_category(self) -> DataFrame:
        return marts.dim_category(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, *self.calendar)

    @cached_property
    def frame(self) -> DataFrame:
        # dim_account is built here from the same staging as the fact, so its
        # attributes follow from the key (see report_frame_same_run).
        return report_frame_same_run(self.fact, self.dim_date, self.dim_category)

    @cached_property
    def filtered(self) -> DataFrame:
        """The dashboard's default view: last 90 days, all categories, both types."""
        return filters.dashboard(self.frame)
