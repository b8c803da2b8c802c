"""Benchmark: the whole study end to end on one scale factor.

Derives the ten experiment sources from the star-schema tables in
$BENCH_SF_DIR (default /root/testdata/sf0.1), writes them as parquet to a
fresh scratch folder, then runs every pipeline stage on those tables on
local[$BENCH_CPUS].  Each stage is forced with the no-op sink (all rows are
produced, nothing is collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from abspark.config import FIXTURE_CONFIG  # noqa: E402
from abspark.plans.pipeline import ExperimentPipeline  # noqa: E402
from abspark.plans.run import QUESTIONS  # noqa: E402
from abspark.session import local_session  # noqa: E402
from abspark.sources.tables import derive_from_star_schema, from_parquet_dir, write_sources  # noqa: E402

def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="abspark-bench")
    scratch = tempfile.mkdtemp(prefix="abspark-bench-")
    times: dict[str, float] = {}

    t = time.time()
    write_sources(derive_from_star_schema(spark, sf_dir), os.path.join(scratch, "sources"))
    times["sources"] = time.time() - t

    p = ExperimentPipeline(from_parquet_dir(spark, os.path.join(scratch, "sources")), FIXTURE_CONFIG)
    stages = [
        ("target_groups", lambda: p.target_groups),
        ("zone_geography", lambda: p.zone_geography),
        ("clean_orders", lambda: p.clean_orders),
        ("sessions_with_flag", lambda: p.sessions_with_flag),
        ("kpis_per_user", lambda: p.kpis_per_user),
        ("treatment_order_share", lambda: p.treatment_order_share),
        ("significance_combined", lambda: p.significance_combined),
    ]
    for name, make in stages:
        t = time.time()
        run(make())
        times[name] = time.time() - t
    t = time.time()
    for q in QUESTIONS:
        run(p.question(q))
    times["questions"] = time.time() - t

    # The study itself: the jobs that size broadcast sides (they run while a stage is
    # built) and all questions count; deriving the test sources is reported beside it.
    total = sum(v for k, v in times.items() if k != "sources")
    print(json.dumps({
        "metric": "experiment_pipeline_end_to_end",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
