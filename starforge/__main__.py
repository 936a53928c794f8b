"""Command line: run the medallion steps as separate jobs.

    python -m starforge land   --sf /root/testdata/sf0.1 --root /lake
    python -m starforge silver --root /lake [entity ...]
    python -m starforge gold   --root /lake [table ...]
    python -m starforge all    --sf /root/testdata/sf0.1 --root /lake

JDBC publishing takes ``--jdbc-url`` plus ``--jdbc-prop key=value``
options (user, password, driver ...); nothing is hard-wired.
"""

from __future__ import annotations

import argparse
import json
import sys

from starforge.plans import pipeline
from starforge.session import get_session
from starforge.sinks import run_step
from starforge.sources import Layers


def _jdbc(args):
    if not args.jdbc_url:
        return None
    props = dict(p.split("=", 1) for p in args.jdbc_prop)
    return pipeline.JdbcConnection(args.jdbc_url, props, args.jdbc_dim_mode, args.jdbc_fact_mode,
                                   args.jdbc_partitions)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starforge")
    ap.add_argument("step", choices=["land", "silver", "gold", "all"])
    ap.add_argument("names", nargs="*", help="silver entities or gold tables (default: all)")
    ap.add_argument("--root", required=True, help="lake root (any Hadoop URI)")
    ap.add_argument("--sf", help="test-table directory (land / all)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--jdbc-url", default=None)
    ap.add_argument("--jdbc-prop", action="append", default=[])
    ap.add_argument("--jdbc-dim-mode", choices=["overwrite", "append"], default="overwrite")
    ap.add_argument("--jdbc-fact-mode", choices=["overwrite", "append"], default="overwrite")
    ap.add_argument("--jdbc-partitions", type=int, default=None,
                    help="most connections open at once per table")
    ap.add_argument("--dim-mode", choices=["overwrite", "append"], default="overwrite",
                    help="how the Parquet dimensions are written")
    ap.add_argument("--parallel", type=int, default=4,
                    help="independent jobs submitted at once (silver; dims; facts)")
    ap.add_argument("--calendar-all-dates", action="store_true",
                    help="calendar also covers survey and ticket-update dates")
    args = ap.parse_intermixed_args(argv)

    spark = get_session(args.master)
    layers = Layers(args.root)
    jdbc = _jdbc(args)
    reports = []
    if args.step in ("land", "all"):
        if not args.sf:
            ap.error("--sf is required for land/all")
        run_step("land", lambda: pipeline.land_bronze(spark, args.sf, layers))
    if args.step in ("silver", "all"):
        reports += pipeline.run_silver(spark, layers, args.names or None, args.parallel)
    if args.step in ("gold", "all"):
        tables = args.names or list(pipeline.DIM_BUILDERS) + [
            "fato_contratacoes", "fato_tickets", "fato_nps"]
        dim_steps = [(f"gold:{t}", lambda t=t: pipeline.dim_job(
            spark, layers, t, jdbc, args.calendar_all_dates, args.dim_mode))
            for t in tables if t in pipeline.DIM_BUILDERS]
        fact_steps = [(f"gold:{t}", lambda t=t: pipeline.fact_job(spark, layers, t, jdbc))
                      for t in tables if t not in pipeline.DIM_BUILDERS]
        reports += pipeline.run_concurrently(dim_steps, args.parallel)
        reports += pipeline.run_concurrently(fact_steps, args.parallel)
    for r in reports:
        print(json.dumps({"step": r.step, "seconds": round(r.seconds, 3), "rows": r.rows,
                          "input_rows": r.input_rows, "dropped": r.dropped, "unread": r.unread,
                          "sinks": [vars(x) for x in r.sinks]}))
    spark.stop()
    return 0 if all(x.ok for r in reports for x in r.sinks) else 1


if __name__ == "__main__":
    sys.exit(main())
