"""End-to-end jobs: Bronze gate (B5), Silver (N15), Gold (G13), pipeline (P1),
spark-submit arguments (P2) and the run date (P3).

    spark-submit -m hirelake.plans.pipeline --date 2026-05-20 \
        --bronze-root s3a://lake/bronze --silver-root s3a://lake/silver \
        --gold-root s3a://lake/gold [--sources adzuna jooble]

Each layer is one lazy plan ending in one write. Counts and quality figures
are observed on the write (``Observation``) instead of costing jobs of their
own; nothing is cached.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from hirelake.functions.time import to_date_path, to_dt
from hirelake.operators import bronze, gold, quality, quarantine, serve, states
from hirelake.operators.silver import SilverMetrics, silver_transform
from hirelake.schemas import SILVER_COLUMNS
from hirelake.plans import serving
from hirelake.sources import file_ranges, jdbc, lake, search_index, versions
from hirelake.sources.registry import SOURCES, source_spec

log = logging.getLogger("hirelake.pipeline")


def run_bronze(spark: SparkSession, source: str, dt: str, bronze_root: str,
               multi_line: bool = False):
    """Read one source and day with its fixed schema and run the gates.

    ``multi_line=False`` reads JSON Lines, many batches per file, which splits;
    ``True`` reads files of one batch document each, which may span lines.
    """
    df = lake.read_bronze(spark, bronze_root, source, dt, multi_line=multi_line)
    counts = bronze.check_bronze(df, raw_path=lake.bronze_path(bronze_root, source, dt),
                                 multi_line=multi_line)
    log.info("Bronze %s %s: %s", source, dt, counts)
    return df, counts


def build_source(spark: SparkSession, source: str, dt: str, bronze_root: str,
                 multi_line: bool = False, gate: Observation | None = None):
    """Scan -> explode -> normalize for one source (no action). ``gate`` observes
    on this scan what the Bronze gates and the quarantine need to know."""
    df = lake.read_bronze(spark, bronze_root, source, dt, multi_line=multi_line,
                          with_corrupt=gate is not None)
    if gate is not None:
        df = df.observe(gate, *bronze.gate_aggregates(df), F.count("record_count").alias("counted"),
                        F.count(quarantine.CORRUPT).alias("corrupt"))
    return source_spec(source).normalizer(bronze.explode_records(df), to_date_path(dt))


def quarantine_source(spark: SparkSession, source: str, dt: str, bronze_root: str, path: str,
                      multi_line: bool = False) -> dict:
    """Write every value of a day that did not fit to ``path``: how many documents and
    values, and the merged schema of these documents."""
    df = lake.read_bronze(spark, bronze_root, source, dt, multi_line=multi_line, with_corrupt=True)
    corrupt = quarantine.corrupt_documents(df)
    lost = Observation(f"quarantine_{source}")
    quarantine.quarantined(corrupt, source, source_spec(source).record_schema).observe(
        lost, F.count(F.lit(1)).alias("values")).write.mode("overwrite").parquet(path)
    return {"documents": corrupt.count(), "values": lost.get["values"],
            "schema": quarantine.merged_schema(corrupt).first()["schema"]}


def run_silver(spark: SparkSession, sources: list[str], dt: str, bronze_root: str,
               silver_root: str, severities: dict | None = None,
               fail_on: str | None = quality.CRITICAL, offenders: bool = True,
               multi_line: bool = False, show_offenders: int = 20) -> dict:
    """Build, check and write one day of Silver.

    The day is written to a version folder of its own and takes the place of the stored
    one only after the quality checks have passed (Q8): a critical failure leaves the
    old day as it was. The rows of each source and the removed-row counts are observed on
    the write, and so are the counts of the Bronze gates (B1-B4), which are judged before
    anything else: Bronze is parsed once. Documents with values that do not fit are opened
    again, they alone, and every lost value is stored under ``<silver_root>_quarantine/``.
    The checks (Q1, Q3-Q5) are counted by bucket over five columns of the
    written files, so that a later merge adds them up without reading the other buckets.
    Offender lists (Q6) are read back from the written day, two columns of it, only when
    a domain check failed; they are stored whole under ``<silver_root>_offenders/<column>``,
    and ``show_offenders`` rows of each go into the result and the log.
    """
    frames, per_source, gates = [], {}, {}
    for s in sources:
        per_source[s], gates[s] = Observation(f"silver_source_{s}"), Observation(f"bronze_gate_{s}")
        frames.append(build_source(spark, s, dt, bronze_root, multi_line, gates[s]).observe(
            per_source[s], F.count(F.lit(1)).alias("rows")))
    metrics = SilverMetrics()
    staged = lake.stage_silver(silver_transform(frames, metrics, keep_lineage=True, bounded=True),
                               silver_root, dt, dealt=True)
    result = {"metrics": metrics.as_dict(), "bronze": {}, "quarantine": {},
              "sources": {s: o.get["rows"] for s, o in per_source.items()}}
    try:
        for s in sources:
            seen = dict(gates[s].get)
            seen.pop("counted")
            corrupt = seen.pop("corrupt")
            if corrupt:
                where = f"{silver_root.rstrip('/')}_quarantine/source={s}/dt={to_dt(dt)}"
                result["quarantine"][s] = quarantine_source(spark, s, dt, bronze_root, where, multi_line)
                log.warning("Bronze %s %s: %d documents with values that do not fit, see %s",
                            s, dt, corrupt, where)
            day = lake.read_bronze(spark, bronze_root, s, dt, multi_line=multi_line)
            result["bronze"][s] = bronze.judge_bronze(
                seen, day, lake.bronze_path(bronze_root, s, dt), multi_line=multi_line)
    except BaseException:
        staged.discard()
        raise
    return _checked(spark, staged, dt, silver_root, result, severities, fail_on, offenders,
                    show_offenders)


def merge_batch(spark: SparkSession, frames: list, dt: str, silver_root: str,
                severities: dict | None = None, fail_on: str | None = quality.CRITICAL,
                offenders: bool = True, show_offenders: int = 20) -> dict:
    """N9/N15 incrementally: normalised rows of new batches merged into the stored day.

    Only the Silver buckets that hold one of their jobs are rewritten; the checks cover
    the whole day, those of other buckets from the day's log. Frames are scans of Bronze.
    """
    metrics = SilverMetrics()
    staged = lake.merge_silver(silver_transform(frames, metrics, keep_lineage=True, bounded=True),
                               silver_root, dt, dealt=True)
    return _checked(spark, staged, dt, silver_root, {"metrics": metrics.as_dict()}, severities,
                    fail_on, offenders, show_offenders)


def _checked(spark: SparkSession, staged: lake.Staged, dt: str, silver_root: str, result: dict,
             severities: dict | None, fail_on: str | None, offenders: bool,
             show_offenders: int) -> dict:
    """Q1-Q8 over a staged day, then publish it, or discard it and raise."""
    try:
        day = staged.rows()
        got = staged.measure(quality.check_aggregates(day))
        rows = []
        for name, value in got.items():
            if name == "rows":
                continue
            check, column = name.split(":", 1)
            rows.append({"check": check, "column": column, "failed": value,
                         "severity": (severities or {}).get(check, quality.WARNING)})
        result |= {"quality": rows, "rows": got.get("rows", 0), "columns": len(SILVER_COLUMNS)}
        for r in rows if offenders else []:
            if r["check"].endswith("_domain") and r["failed"]:
                path = f"{silver_root.rstrip('/')}_offenders/{r['column']}/dt={to_dt(dt)}"
                quality.offenders(day, r["column"]).write.mode("overwrite").parquet(path)
                shown = spark.read.parquet(path).orderBy(
                    F.desc("count"), F.asc_nulls_last(r["column"])).limit(show_offenders)
                result.setdefault("offenders", {})[r["column"]] = [tuple(x) for x in shown.collect()]
        quality.enforce(rows, fail_on)
    except BaseException:
        staged.discard()
        raise
    staged.publish()
    log.info("Silver %s: %s", dt, result["metrics"])
    return result


def fresh_states(spark: SparkSession, dt: str, silver_root: str, root: str, build):
    """The states (``operators/states.py``) of a Silver day, stored by bucket under
    ``root``: those of buckets that changed since are built anew, the others carried over."""
    silver, before = versions.current(spark, silver_root, dt), versions.current(spark, root, dt)
    if silver is None:
        raise FileNotFoundError(f"no stored day {dt} under {silver_root}")
    known = before.facts if before and before.buckets == silver.buckets else {}
    changed = [b for b, p in silver.paths.items() if known.get(b, {}).get("silver") != p]
    run, paths = versions.new_run(dt), {b: before.paths[b] for b in silver.paths if b not in changed}
    if changed:
        parts = [f"{silver_root.rstrip('/')}/{silver.paths[b]}" for b in changed]
        schema = StructType.fromJson(json.loads(silver.schema)).add("bucket", IntegerType())
        rows = spark.read.schema(schema).option("basePath", silver_root).parquet(*parts)
        state = build(rows)
        state.write.partitionBy("bucket").parquet(f"{root.rstrip('/')}/{run}")
        paths |= {b: f"{run}/bucket={b}" for b in changed}
        versions.publish(spark, root, dt, before, state.drop("bucket").schema.json(), paths,
                         silver.buckets, {b: {"silver": p} for b, p in silver.paths.items()})
        versions.expire(spark, root, dt)
    return versions.read(spark, root, dt).drop("dt"), changed


def run_gold(spark: SparkSession, dt: str, silver_root: str, gold_root: str,
             exact_median: bool = True, salary_by_date: bool = False,
             search_signatures: bool = False, keep_states: bool = False,
             ranges: bool = False) -> dict:
    """The three Gold tables of one day, written in the reference's order, and the
    dashboard's facets (D1).

    Each table reads only its columns from the Silver day (pruned Parquet
    scans), which is cheaper than caching all twenty columns. With
    ``salary_by_date`` the salary table keeps ``ingestion_date`` as a key, so
    days stay apart when several are read or loaded together; ``search_signatures``
    adds the files' signatures for keyword search. With ``keep_states`` the two
    aggregates come from stored states by Silver bucket, of which only those of changed
    buckets are built.
    """
    s = lake.read_silver(spark, silver_root, dt)
    tables = {
        "jobs_summary": lambda: gold.jobs_summary(s, exact_median),
        "salary_analysis": lambda: gold.salary_analysis(s, exact_median, by_date=salary_by_date),
        "jobs_detail": lambda: gold.jobs_detail(s),
        lake.FACETS: lambda: serve.facet_table(s),
    }
    if keep_states and exact_median and not salary_by_date:
        def kept(name, build):
            return fresh_states(spark, dt, silver_root, f"{gold_root.rstrip('/')}_states/{name}", build)[0]
        tables["jobs_summary"] = lambda: states.summary_of(kept("jobs_summary", states.summary_state))
        tables["salary_analysis"] = lambda: states.salary_of(kept("salary_analysis", states.salary_state))
    counts = {}
    for name, table in tables.items():
        obs, df = Observation(f"gold_{name}"), table()
        lake.write_gold(df.observe(obs, F.count(F.lit(1)).alias("rows")), gold_root, name, dt)
        counts[name] = obs.get["rows"]
    if search_signatures:
        search_index.index_search(spark, gold_root, dt)
    if ranges:
        file_ranges.index_ranges(spark, gold_root, dt)
    log.info("Gold %s: %s", dt, counts)
    return counts


def run_pipeline(spark: SparkSession, sources: list[str], dt: str, bronze_root: str,
                 silver_root: str, gold_root: str, exact_median: bool = True,
                 salary_by_date: bool = False, search_signatures: bool = False,
                 ranges: bool = False, **silver_options) -> dict:
    """Silver with the Bronze gates on its scan, then Gold."""
    dt = to_dt(dt)
    silver_result = run_silver(spark, sources, dt, bronze_root, silver_root, **silver_options)
    gold_counts = run_gold(spark, dt, silver_root, gold_root, exact_median, salary_by_date,
                           search_signatures, ranges=ranges)
    return {"bronze": silver_result["bronze"], "silver": silver_result, "gold": gold_counts}


def parse_args(argv=None) -> argparse.Namespace:
    """Required --date, --sources limited to the registry."""
    p = argparse.ArgumentParser(prog="hirelake-pipeline")
    p.add_argument("--date", required=True, type=to_dt,
                   help="run date, YYYY-MM-DD (YYYY/MM/DD accepted)")
    p.add_argument("--sources", nargs="+", default=list(SOURCES), choices=list(SOURCES))
    p.add_argument("--stage", default="all", choices=["all", "bronze", "silver", "gold", "load", "export"],
                   help="one stage alone; load copies Gold into the serving database, "
                        "export writes the dashboard's views over all days as CSV")
    p.add_argument("--bronze-root")
    p.add_argument("--silver-root")
    p.add_argument("--gold-root")
    p.add_argument("--master", default=None)
    p.add_argument("--document-files", action="store_true",
                   help="each Bronze file is one JSON document, on one or many lines")
    p.add_argument("--severity", nargs="*", default=[], metavar="CHECK=LEVEL",
                   help="severity of a quality check, such as salary_order=critical")
    p.add_argument("--fail-on", default=quality.CRITICAL, choices=["none", *quality.LEVELS],
                   help="stop, and keep the stored day, on checks of this level or above")
    p.add_argument("--salary-by-date", action="store_true")
    p.add_argument("--search-signatures", action="store_true",
                   help="write the signatures by which keyword searches skip files")
    p.add_argument("--file-ranges", action="store_true",
                   help="write the ranges by which bounds and first jobs skip files")
    p.add_argument("--export-root", help="folder of the CSV views, for --stage export")
    for name in ("dates", "categories", "contract-times", "job-sources"):
        p.add_argument(f"--{name}", nargs="*", default=None,
                       help="the dashboard's filter: all known values unless given, none if empty")
    p.add_argument("--keyword", help="the explorer's keyword, for --stage export")
    p.add_argument("--jdbc-url", help="serving database, for --stage load")
    p.add_argument("--load-mode", default="append", choices=["append", "refresh"])
    p.add_argument("--approx-median", dest="exact_median", action="store_false",
                   help="percentile_approx in place of the exact lower median")
    args = p.parse_args(argv)
    needs = {"all": ["bronze_root", "silver_root", "gold_root"], "bronze": ["bronze_root"],
             "silver": ["bronze_root", "silver_root"], "gold": ["silver_root", "gold_root"],
             "load": ["gold_root", "jdbc_url"], "export": ["gold_root", "export_root"]}[args.stage]
    missing = [f"--{n.replace('_', '-')}" for n in needs if not getattr(args, n)]
    bad = [s for s in args.severity if s.partition("=")[2] not in quality.LEVELS]
    if missing or bad:
        p.error(f"needed for --stage {args.stage}: {missing}" if missing else f"severity: {bad}")
    return args


def run_stage(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The stage that the arguments name, or the whole pipeline."""
    multi_line = args.document_files
    checks = {"severities": dict(s.split("=", 1) for s in args.severity),
              "fail_on": None if args.fail_on == "none" else args.fail_on}
    if args.stage == "bronze":
        return {s: run_bronze(spark, s, args.date, args.bronze_root, multi_line)[1]
                for s in args.sources}
    if args.stage == "silver":
        return run_silver(spark, args.sources, args.date, args.bronze_root, args.silver_root,
                          multi_line=multi_line, **checks)
    if args.stage == "gold":
        return run_gold(spark, args.date, args.silver_root, args.gold_root, args.exact_median,
                        args.salary_by_date, args.search_signatures, ranges=args.file_ranges)
    if args.stage == "load":
        return jdbc.load_serving(spark, args.gold_root, args.date, args.jdbc_url,
                                 mode=args.load_mode)
    if args.stage == "export":
        return serving.export_dashboard(
            spark, args.gold_root, args.export_root, dates=args.dates, categories=args.categories,
            contract_times=args.contract_times, sources=args.job_sources, keyword=args.keyword)
    return run_pipeline(spark, args.sources, args.date, args.bronze_root, args.silver_root,
                        args.gold_root, exact_median=args.exact_median, multi_line=multi_line,
                        salary_by_date=args.salary_by_date,
                        search_signatures=args.search_signatures, ranges=args.file_ranges,
                        **checks)


def main(argv=None) -> dict:
    from hirelake.session import build_session
    args = parse_args(argv)
    spark = build_session(args.master, app_name="hirelake-pipeline")
    try:
        return run_stage(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
