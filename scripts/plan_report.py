"""Summarise the physical plans of the pipeline stages (after execution, AQE final plans).

usage: python scripts/plan_report.py [sf_dir] [--no-auto-broadcast]  -> markdown on stdout

--no-auto-broadcast turns Spark's size-based broadcasts off, so only the
pipeline's own size-checked hints remain: the plan shape a cluster run on
big inputs gets.

For each stage: shuffles, join strategies, windows, Python nodes, and the
filters pushed into the scans of the facts.  Sources are written to parquet
first so that scans and pushdown look as they would on a cluster.
"""

from __future__ import annotations

import collections
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from abspark.config import FIXTURE_CONFIG  # noqa: E402
from abspark.plans.pipeline import ExperimentPipeline  # noqa: E402
from abspark.session import local_session  # noqa: E402
from abspark.sources.tables import derive_from_star_schema, from_parquet_dir, write_sources  # noqa: E402

NODES = r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|" \
        r"Exchange hashpartitioning|Exchange SinglePartition|BroadcastExchange|Window|ArrowEvalPython|" \
        r"BatchEvalPython|InMemoryTableScan)"


REPORTED = ("target_groups", "experiment_orders", "order_profit", "clean_orders", "experiment_sessions_stg",
            "experiment_sessions", "sessions_with_flag", "kpis_per_user", "treatment_order_share", "kpi_histogram",
            "significance_combined")


class Reporting(ExperimentPipeline):
    """Runs each stage as a pipeline with ``out`` does, and keeps its final plan."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        self.plans: dict[str, str] = {}

    def _stage(self, df, name):
        if name in REPORTED:
            execution = df._jdf.queryExecution()
            execution.toRdd().count()  # rows are counted where they are; AQE settles the plan
            # AQE prints its final plan and then its initial plan: keep the final one
            self.plans[name] = execution.executedPlan().toString().split("== Initial Plan ==")[0]
        return super()._stage(df, name)


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    if "--no-auto-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    path = tempfile.mkdtemp(prefix="abspark-plans-")
    write_sources(derive_from_star_schema(spark, sf_dir), f"{path}/sources")
    p = Reporting(from_parquet_dir(spark, f"{path}/sources"), FIXTURE_CONFIG, out=f"{path}/out")
    p.write()
    mode = "automatic broadcasts off" if "--no-auto-broadcast" in sys.argv else "default broadcasts"
    print(f"# Plan report ({os.path.basename(sf_dir)}, AQE final plans, {mode})\n")
    print("Each stage is shown as a run with an output folder executes it: it reads the tables of earlier stages.\n")
    for stage in REPORTED:
        plan = p.plans[stage]
        counts = collections.Counter(re.findall(NODES, plan))
        print(f"## {stage}\n")
        print("| node | count |\n| --- | --- |")
        for k, v in sorted(counts.items()):
            print(f"| {k} | {v} |")
        for name in ("orders_sessions", "ga_sessions", "warehouse_orders", "courier_timings"):
            for line in plan.splitlines():
                if "FileScan parquet" in line and f"/{name}]" in line:
                    m = re.search(r"PushedFilters: (\[[^\]]*\]?)", line)
                    print(f"\nscan {name}: `PushedFilters: {m.group(1)[:300] if m else '[]'}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
