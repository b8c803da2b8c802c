"""The whole study as a chain of DataFrames.

``ExperimentPipeline`` exposes every step of the study as a property that
returns a DataFrame.  Tables that several later steps read are stage tables:
on first use each is computed once, written as parquet and read back, which
cuts the lineage there (a lost executor recomputes from that table), lets
later reads prune columns, and leaves nothing cached.  The sizes of broadcast
sides are summed when a step is built, so building a step can run small jobs.

With ``out`` every persisted table of the study is such a stage table at its
final place ``out/<name>``: each fact is computed once for the whole run.
Without it only the tables read more than once are staged, in a folder of this
run under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.operators import kpis, orders, questions, relational, sessions, setups, stats, zone_cover
from abspark.session import ensure_checkpoint_dir
from abspark.sources import versions
from abspark.sources.tables import SourceTables

TEST = ("entity_id", "test_id")
# Setups beyond this part of what may be broadcast are reduced first: a zone's cover has up to 64 rows.
SETUP_PARTS = 64


class ExperimentPipeline:
    # The study's persisted tables.
    STAGE_TABLES = (
        "valid_experiments", "target_groups", "experiment_zones", "variant_schemes", "variant_scheme_concat",
        "zone_geography", "experiment_orders", "order_profit", "clean_orders", "experiment_sessions_stg",
        "experiment_sessions", "session_treatment_flag", "sessions_with_flag", "users_per_test", "kpis_per_user",
        "treatment_order_share", "significance_combined",
    )
    # Tables that more than one later step reads.
    REUSED = ("target_groups", "variant_schemes", "zone_geography", "order_zones", "ordered_geography", "zone_grid", "zone_cover",
              "ordered_groups", "ordered_schemes", "session_tests", "visited_groups", "visited_schemes", "visited_geography",
              "clean_orders", "experiment_sessions", "sessions_with_flag", "kpis_per_user", "treatment_order_share", "kpi_histogram", "significance_combined",
              "ts_exp_comparison")
    # Session-grain tables are laid out by date, so date filters prune files on read.
    BY_DATE = ("experiment_sessions_stg", "experiment_sessions", "sessions_with_flag")
    # Big tables are clustered in the order in which the study sorts them: rows of
    # one test share row groups, so a filter on a test skips the others.
    CLUSTERED = {
        **dict.fromkeys(("experiment_orders", "order_profit", "clean_orders"), ("entity_id", "country_code", "experiment_id")),
        **dict.fromkeys(("experiment_sessions_stg", "experiment_sessions", "session_treatment_flag", "sessions_with_flag",
                         "users_per_test"), ("entity_id", "country_code", "test_id")),
        "kpis_per_user": ("entity_id", "country_code", "test_id", "perseus_client_id", "variant", "target_group"),
    }
    # The result table has a few rows per test: sorted as a whole, one file.
    SORTED = {"significance_combined": (*stats.SIG_KEYS, "granularity")}

    def __init__(self, src: SourceTables, cfg: PipelineConfig | None = None, out: str | None = None,
                 stage: bool = True):
        self.src = src
        self.cfg = cfg or PipelineConfig()
        self.out = out.rstrip("/") if out else None
        self.stage = stage
        self._scratch: str | None = None

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        final = self.out is not None and name in self.STAGE_TABLES
        if not self.stage or not (final or name in self.REUSED):
            return df
        spark = df.sparkSession
        if final:
            written, by = df, ()
            if name == "kpis_per_user":
                written = df.withColumn("data_pull_timestamp", F.current_timestamp())
            if name in self.BY_DATE:
                # One date's rows meet in as many tasks as their size needs, not in every task.
                written, by = written.hint("rebalance", "created_date"), ("created_date",)
            if name in self.CLUSTERED:
                written = written.sortWithinPartitions(*by, *[c for c in self.CLUSTERED[name] if c in df.columns])
            if name in self.SORTED:
                written = written.orderBy(*self.SORTED[name]).coalesce(1)
            return versions.replace(written, f"{self.out}/{name}", by).select(*df.columns)
        else:
            if self._scratch is None:
                self._scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/abspark-{uuid.uuid4().hex}"
            path = f"{self._scratch}/{name}"
            df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)

    # ---- experiment setups (S1-S5) ------------------------------------
    @cached_property
    def valid_experiments(self) -> DataFrame:
        return self._stage(setups.valid_experiments(self.src.experiment_setups, self.cfg), "valid_experiments")

    @cached_property
    def target_groups(self) -> DataFrame:
        return self._stage(setups.target_groups(self.src.experiment_setups, self.src.vendors, self.cfg), "target_groups")

    @cached_property
    def experiment_zones(self) -> DataFrame:
        return self._stage(setups.experiment_zones(self.src.experiment_setups, self.cfg), "experiment_zones")

    @cached_property
    def variant_schemes(self) -> DataFrame:
        return self._stage(setups.variant_schemes(self.src.experiment_setups, self.cfg), "variant_schemes")

    @cached_property
    def variant_scheme_concat(self) -> DataFrame:
        return self._stage(setups.variant_scheme_concat(self.variant_schemes), "variant_scheme_concat")

    @cached_property
    def zone_geography(self) -> DataFrame:
        return self._stage(setups.zone_geography(self.src.countries, self.experiment_zones), "zone_geography")

    # ---- setups that a fact refers to -------------------------------------
    @cached_property
    def many_setups(self) -> bool:
        """Are the setups so large that a fact's own keys are worth a look before the setups meet it?"""
        limit = relational.BROADCAST_MAX_BYTES // SETUP_PARTS
        return relational.measured_bytes(self.zone_geography) + relational.measured_bytes(self.target_groups) > limit

    @cached_property
    def order_zones(self) -> DataFrame:
        """The zones and tests that orders name: one map-side aggregate over four columns."""
        keys = self.src.orders_sessions.select("entity_id", "country_code", "zone_id", F.col("experiment_id").alias("test_id"))
        return self._stage(keys.distinct(), "order_zones")

    @cached_property
    def session_tests(self) -> DataFrame:
        """The tests that sessions name."""
        keys = self.src.ga_sessions.select("entity_id", F.col("sessions.experiment_id").alias("test_id"))
        return self._stage(keys.distinct(), "session_tests")

    def _named_by(self, fact_keys: str, df: DataFrame, on: Sequence[str], name: str | None = None) -> DataFrame:
        """``df`` without the setups that the fact never names, if the setups are many.

        Such rows meet nothing.  Without them a key set or lookup stays small
        enough to be broadcast as long as the fact names few, and the fact is not
        shuffled by its few tests and zones.
        """
        if not self.many_setups:
            return df
        named = relational.key_semi_join(df, getattr(self, fact_keys).select(*on).distinct(), [(c, c) for c in on])
        return self._stage(named, name) if name else named

    @cached_property
    def ordered_geography(self) -> DataFrame:
        return self._named_by("order_zones", self.zone_geography, zone_cover.ZONE_KEY, "ordered_geography")

    @cached_property
    def ordered_groups(self) -> DataFrame:
        return self._named_by("order_zones", self.target_groups, TEST, "ordered_groups")

    @cached_property
    def ordered_schemes(self) -> DataFrame:
        return self._named_by("order_zones", self.variant_schemes, TEST, "ordered_schemes")

    @cached_property
    def visited_geography(self) -> DataFrame:
        keys = self.zone_geography.select(*zone_cover.ZONE_KEY)
        return self._named_by("session_tests", keys, TEST, "visited_geography")

    @cached_property
    def visited_groups(self) -> DataFrame:
        return self._named_by("session_tests", self.target_groups, TEST, "visited_groups")

    @cached_property
    def visited_schemes(self) -> DataFrame:
        return self._named_by("session_tests", self.variant_schemes, TEST, "visited_schemes")

    @cached_property
    def zone_grid(self) -> DataFrame:
        return self._stage(zone_cover.zone_grid(self.ordered_geography, self.cfg.geodesic), "zone_grid")

    @cached_property
    def zone_cover(self) -> DataFrame:
        return self._stage(zone_cover.zone_cover(self.ordered_geography, self.cfg.geodesic), "zone_cover")

    # ---- orders (S6-S8) -------------------------------------------------
    @cached_property
    def delivery_costs(self) -> DataFrame:
        return orders.delivery_costs(self.src.courier_timings, self.src.logistics_orders, self.cfg)

    @cached_property
    def order_costs(self) -> DataFrame:
        """The delivery costs of the entities whose orders can reach the result."""
        known = orders.order_entities(self.src.entities, self.ordered_schemes)
        return orders.delivery_costs(relational.key_semi_join(self.src.courier_timings, known, [("entity_id", "entity_id")]),
                                     relational.key_semi_join(self.src.logistics_orders, known, [("entity.id", "entity_id")]), self.cfg)

    def _experiment_orders(self, of_test_parents: bool = False) -> DataFrame:
        return orders.experiment_orders(
            self.src, self.ordered_groups, self.ordered_schemes, self._named_by("order_zones", self.variant_scheme_concat, TEST),
            self.zone_grid, self.zone_cover, self._named_by("order_zones", self.experiment_zones, TEST),
            self.order_costs, self.cfg, of_test_parents)

    @cached_property
    def experiment_orders(self) -> DataFrame:
        return self._stage(self._experiment_orders(), "experiment_orders")

    @cached_property
    def order_profit(self) -> DataFrame:
        # Where the orders are no table of their own, those that the profit step leaves out are never joined.
        found = self.experiment_orders if self.out and self.stage else self._experiment_orders(of_test_parents=True)
        return self._stage(orders.with_profit(found, self.ordered_groups, self.cfg), "order_profit")

    @cached_property
    def clean_orders(self) -> DataFrame:
        return self._stage(orders.clean_orders(self.order_profit), "clean_orders")

    # ---- sessions (S9-S10) ---------------------------------------------
    @cached_property
    def experiment_sessions_stg(self) -> DataFrame:
        return self._stage(sessions.session_events(
            self.src.ga_sessions, self.visited_geography, self.visited_groups, self.visited_schemes, self.cfg),
            "experiment_sessions_stg")

    @cached_property
    def experiment_sessions(self) -> DataFrame:
        return self._stage(sessions.parent_vertical_filter(self.experiment_sessions_stg, self.visited_groups),
                           "experiment_sessions")

    @cached_property
    def session_treatment_flag(self) -> DataFrame:
        return self._stage(sessions.session_treatment_flag(self.experiment_sessions), "session_treatment_flag")

    @cached_property
    def sessions_with_flag(self) -> DataFrame:
        return self._stage(sessions.with_session_flag(self.experiment_sessions), "sessions_with_flag")

    # ---- users and KPIs (S11-S12) ----------------------------------------
    @cached_property
    def users_per_test(self) -> DataFrame:
        return self._stage(kpis.users_per_test(self.sessions_with_flag, self.visited_groups), "users_per_test")

    @cached_property
    def kpis_per_user(self) -> DataFrame:
        return self._stage(kpis.kpis_per_user(self.users_per_test, self.clean_orders), "kpis_per_user")

    @cached_property
    def treatment_order_share(self) -> DataFrame:
        return self._stage(kpis.treatment_order_share(self.clean_orders, self.cfg), "treatment_order_share")

    # ---- significance -------------------------------------------------------
    @cached_property
    def gated_kpis_exp(self) -> DataFrame:
        return kpis.gate_by_share(self.kpis_per_user, self.treatment_order_share)

    @cached_property
    def gated_kpis_ts(self) -> DataFrame:
        return self.gated_kpis_exp.where("session_in_treatment_flag = 'Y'")

    @cached_property
    def variant_means(self) -> DataFrame:
        return stats.variant_means(self.gated_kpis_exp)

    @cached_property
    def mann_whitney(self) -> DataFrame:
        return stats.mann_whitney(self.gated_kpis_exp, "profit_per_user", self.cfg)

    @cached_property
    def kpi_histogram(self) -> DataFrame:
        """The statistics' only pass over the KPI table."""
        return self._stage(stats.kpi_histogram(self.gated_kpis_exp), "kpi_histogram")

    @cached_property
    def significance_both(self) -> DataFrame:
        """exp and ts statistics."""
        return stats.significance_both(self.kpi_histogram, self.cfg)

    @cached_property
    def significance_exp(self) -> DataFrame:
        return self.significance_both.where(F.col("granularity") == "exp")

    @cached_property
    def significance_ts(self) -> DataFrame:
        return self.significance_both.where(F.col("granularity") == "ts")

    @cached_property
    def significance_combined(self) -> DataFrame:
        return self._stage(stats.combine(self.significance_both, self.treatment_order_share, self.cfg),
                                  "significance_combined")

    # ---- questions on the result ----------------------------------------------
    @cached_property
    def analysis(self) -> DataFrame:
        return questions.analysis_rows(self.significance_combined)

    @cached_property
    def ts_exp_comparison(self) -> DataFrame:
        return self._stage(questions.ts_exp_comparison(self), "ts_exp_comparison")

    def question(self, name: str) -> DataFrame:
        staged = {"ts_exp_comparison": lambda: self.ts_exp_comparison}
        return staged.get(name, lambda: getattr(questions, name)(self))()

    # ---- sinks ---------------------------------------------------------------
    def write(self, tables: tuple[str, ...] | None = None) -> None:
        """Compute the stage tables (the study's persisted tables) into ``out``, each once, in order.

        Each replaces what its folder held (the study's CREATE OR REPLACE /
        WRITE_TRUNCATE) at once: readers (:func:`abspark.sources.versions.read`)
        see the old table until the new one is whole.
        """
        if self.out is None or not self.stage:
            raise ValueError("give the pipeline a folder: ExperimentPipeline(..., out=...)")
        for name in tables or self.STAGE_TABLES:
            getattr(self, name)
