"""Job runner: ``python -m airloom <job> ...`` (or ``spark-submit -m``-style).

    curate     raw landings -> curated table (all dates, or --date ...)
    stream     new raw landings since the last run -> re-curated dates (checkpointed)
    views      curated table -> metric views written as Parquet
    backfill   landed measurement pages + location details -> backfill landing
    ingest     landed latest-readings pages + details + station cache -> run landing
    find       landed location catalogue -> matching stations (CSV)

Inputs are landed files; nothing is fetched over HTTP. Settings come from
the Spark session (``spark.checkpoint.dir``, shuffle partitions, ...).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from airloom.operators import metrics as M
from airloom.operators import search as S
from airloom.options import (
    BACKFILL_DAYS,
    FlattenOptions,
    MetricOptions,
    QualityRules,
)
from airloom.plans import jobs as J
from airloom.schema import LOCATION_PAGE, LOCATION_RESULT, MEASUREMENT_PAGE, RESULT_TEXTS
from airloom.session import build_session
from airloom.sinks.dimension import read_dimension
from airloom.sources.curated import read_curated
from airloom.sources.pages import read_landed_pages
from airloom.streaming.incremental import curate_incremental


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="airloom", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="job", required=True)

    c = sub.add_parser("curate")
    c.add_argument("--raw", nargs="+", required=True, help="landing root(s)")
    c.add_argument("--out", required=True)
    c.add_argument("--date", nargs="*", help="YYYY-MM-DD (default: all dates)")
    c.add_argument("--layout", choices=["array", "lines", "auto"], default="auto")
    c.add_argument("--profile", choices=["canonical", "deployed"], default="canonical")
    c.add_argument("--dedup-scope", choices=["partition", "global"], default="partition")
    c.add_argument("--versioned", action="store_true", help="publish the run as one version")

    st = sub.add_parser("stream")
    st.add_argument("--raw", nargs="+", required=True, help="landing root(s)")
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True, help="stream checkpoint (shared storage)")
    st.add_argument("--layout", choices=["array", "lines", "auto"], default="auto")
    st.add_argument("--max-files", type=int, default=None)

    v = sub.add_parser("views")
    v.add_argument("--curated", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--profile", choices=["athena", "warehouse"], default="athena")
    v.add_argument("--as-of", help="reference day of the athena window (default today)")

    b = sub.add_parser("backfill")
    b.add_argument("--measurements", required=True, help="pages: sensor_id, page, results")
    b.add_argument("--details", required=True, help="pages: location_id, results")
    b.add_argument("--out", required=True, help="backfill landing root")
    b.add_argument("--days", type=int, default=BACKFILL_DAYS, help="last days up to --as-of")
    b.add_argument("--as-of", help="YYYY-MM-DD (default: today, UTC)")
    b.add_argument("--stations", nargs="*", type=int, help="station ids (default: all landed)")

    i = sub.add_parser("ingest")
    i.add_argument("--pages", required=True, help="pages: page, results")
    i.add_argument("--details", required=True, help="pages: location_id, results")
    i.add_argument("--dimension", required=True, help="versioned station cache root")
    i.add_argument("--raw", required=True, help="run landing root")
    i.add_argument("--run-id", help="landing it again on a day replaces it (default: the time)")
    i.add_argument("--limit", type=int, default=None, help="readings (default: all)")
    i.add_argument("--layout", choices=["lines", "array"], default="lines", help="of the landing")

    f = sub.add_parser("find")
    f.add_argument("--catalogue", required=True, help="JSON lines of location results")
    f.add_argument("--country", required=True)
    f.add_argument("--search")
    f.add_argument("--limit", type=int, default=None, help="stations found (default: all)")
    f.add_argument("--out", required=True)

    args = ap.parse_args(argv)
    started_here = SparkSession.getActiveSession() is None
    # The master and resources come from spark-submit (or local[*] when run directly).
    spark = build_session(master=None)

    if args.job == "curate":
        counts = J.curate(
            spark, args.raw, args.out, dates=args.date or None, layout=args.layout,
            rules=QualityRules(dedup_scope=args.dedup_scope),
            flatten=FlattenOptions(profile=args.profile), versioned=args.versioned,
        )
        print(json.dumps(counts, default=str))
    elif args.job == "stream":
        dates = curate_incremental(spark, args.raw, args.out, args.checkpoint,
                                   max_files=args.max_files, layout=args.layout)
        print(json.dumps({"dates": dates}))
    elif args.job == "views":
        opts = (MetricOptions.athena(as_of=args.as_of) if args.profile == "athena"
                else MetricOptions.warehouse())
        cur = read_curated(spark, args.curated)
        for name in M.publish_views(spark, cur, opts):
            spark.table(name).write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.job == "backfill":
        meas = read_landed_pages(spark, args.measurements, MEASUREMENT_PAGE,
                      [("sensor_id", T.LongType()), ("page", T.LongType())])
        details = read_landed_pages(spark, args.details, LOCATION_PAGE,
                                    [("location_id", T.LongType())])
        stations = None
        if args.stations is not None:
            stations = spark.createDataFrame([(s,) for s in args.stations], "location_id long")
        rows = J.backfill_rows(meas, details, days=args.days, as_of=args.as_of, stations=stations)
        counts = J.backfill_job(rows, args.out)
        print(json.dumps({"station_days": counts.count()}))
    elif args.job == "ingest":
        now = dt.datetime.now(dt.timezone.utc)
        pages = read_landed_pages(spark, args.pages, RESULT_TEXTS, [("page", T.LongType())])
        details = read_landed_pages(spark, args.details, LOCATION_PAGE,
                                    [("location_id", T.LongType())])
        cache = read_dimension(spark, args.dimension)
        run_id = args.run_id or f"run_{now:%H%M%S}"
        dim = J.enrich_job(pages, details, cache, args.raw, run_id, f"{now:%Y-%m-%d}",
                           args.dimension, limit=args.limit, layout=args.layout)
        print(json.dumps({"run_id": run_id, "dimension_changed": dim is not cache}))
    elif args.job == "find":
        cat = spark.read.schema(LOCATION_RESULT).json(args.catalogue)
        found = S.find_locations(cat, args.country, args.search, args.limit)
        found.write.mode("overwrite").option("header", True).csv(args.out)
    if started_here:
        spark.stop()


if __name__ == "__main__":
    main()
