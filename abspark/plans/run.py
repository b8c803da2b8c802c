"""Command-line runner: the study end to end, tables in, tables out.

    python -m abspark.plans.run --sources PATH --out PATH [--all-verticals] [--start-floor 2021-01-01]
    python -m abspark.plans.run --star-schema DIR --out PATH      # derive the sources first (test data)

Writes every stage table (the study's persisted tables, each computed once)
and one folder per question under ``--out``/<variant>.  Sources and out are
any paths Spark reads and writes; the session is the one spark-submit gives,
with its ``spark.checkpoint.dir`` for what only this run reads.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from abspark.config import FIXTURE_CONFIG, PipelineConfig
from abspark.operators import questions
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources import versions
from abspark.sources.tables import derive_from_star_schema, from_catalog, from_parquet_dir, without_rejects

QUESTIONS = ("overview_stats", "tests_per_entity", "tests_per_entity_vertical", "ts_exp_comparison",
             "direction_agreement", "significance_agreement", "records_in_treatment",
             "records_in_treatment_summary", "records_in_treatment_bins", "treatment_share_summary",
             "treatment_share_bins", "significance_by_length", "significance_by_length_wide",
             "significance_by_share")


def variant_folder(out: str, cfg: PipelineConfig) -> str:
    """The study's two variants write to folders of their own."""
    return f"{out.rstrip('/')}/{'with' if cfg.sub_vertical_filter else 'without'}_sub_vertical_filter"


def run(spark: SparkSession, out: str, sources: str | None = None, star_schema: str | None = None,
        cfg: PipelineConfig | None = None, database: str | None = None, set_apart: bool = False) -> ExperimentPipeline:
    """Write the stage tables and question tables of one variant under ``variant_folder(out, cfg)``.

    ``set_apart``: source rows that break their contract's rules go to
    ``rejects/<source>`` there, with the rules they break, and not into the study.
    """
    if sum(x is not None for x in (sources, star_schema, database)) != 1:
        raise ValueError("give exactly one of sources / star_schema / database")
    # Dates are taken from timestamps: the study's warehouse works in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if star_schema is not None:
        src = derive_from_star_schema(spark, star_schema)
    else:
        src = from_parquet_dir(spark, sources) if sources is not None else from_catalog(spark, database)
    cfg = cfg or (FIXTURE_CONFIG if star_schema is not None else PipelineConfig())
    folder = variant_folder(out, cfg)
    if set_apart:
        src, rejects = without_rejects(src)
        for name, rows in rejects.items():
            versions.replace(rows, f"{folder}/rejects/{name}")
    p = ExperimentPipeline(src, cfg, out=f"{folder}/tables")
    p.write()
    for q in QUESTIONS:
        versions.replace(questions.presented(q, p.question(q)), f"{folder}/questions/{q}")
    return p


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sources", help="folder of source tables (one parquet folder per source)")
    ap.add_argument("--database", help="catalog database of the source tables")
    ap.add_argument("--star-schema", help="folder of the star-schema test tables to derive the sources from")
    ap.add_argument("--out", required=True)
    ap.add_argument("--all-verticals", action="store_true", help="turn the vertical-type filter off")
    ap.add_argument("--set-apart", action="store_true", help="write source rows that break their rules to rejects/ and leave them out")
    ap.add_argument("--start-floor", help="first test start date / fact date (default 2021-01-01)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("abspark").getOrCreate()
    cfg = FIXTURE_CONFIG if args.star_schema else PipelineConfig()
    if args.all_verticals:
        cfg = replace(cfg, sub_vertical_filter=False)
    if args.start_floor:
        cfg = replace(cfg, start_floor=args.start_floor)
    run(spark, args.out, args.sources, args.star_schema, cfg, args.database, args.set_apart)


if __name__ == "__main__":
    main()
