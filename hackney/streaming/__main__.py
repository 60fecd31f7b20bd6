"""Run one streaming service:  python -m hackney.streaming <service> [options]

Services: refine_trips, refine_fares, merge_trip_fares, materialise_merged,
merge_trip_fares_windowed, trending_grid, trending_grid_accounted, payment_statements,
payment_summary, driver_payments, index_trips, index_fares, replay.

Topics live on Kafka (``--kafka host:port``) or in JSON folders
(``--root path``).  ``--available-now`` processes what is there and stops;
otherwise the service runs until stopped.  Checkpoints go under
``spark.checkpoint.dir`` (or ``--checkpoints``), one stable folder per
service, so a restart resumes.
"""

from __future__ import annotations

import argparse
import sys

from hackney.session import get_session
from hackney.streaming import services as svc

SERVICES = ["refine_trips", "refine_fares", "merge_trip_fares", "materialise_merged",
            "merge_trip_fares_windowed", "trending_grid", "trending_grid_accounted", "payment_statements", "payment_summary", "driver_payments",
            "index_trips", "index_fares", "replay"]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m hackney.streaming")
    ap.add_argument("service", choices=SERVICES)
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--kafka", help="bootstrap servers")
    where.add_argument("--root", help="folder holding one JSON folder per topic")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--checkpoints", help="checkpoint root (default: spark.checkpoint.dir/services)")
    ap.add_argument("--lateness", help="state bound for windows and joins, e.g. '1 day'")
    ap.add_argument("--time-col", choices=["ts", "pickup_ts"],
                    help="windows: record time (ts, the default) or pickup time (for a replay)")
    ap.add_argument("--max-per-trigger", type=int,
                    help="records (Kafka) or files (folders) per micro-batch")
    ap.add_argument("--path", help="replay: text files to read")
    ap.add_argument("--kind", choices=["trip", "fare"], help="replay: line kind")
    ap.add_argument("--target", help="index_*: index name or output folder; materialise_merged,"
                                     " trending_grid_accounted: folder of the table or gate")
    ap.add_argument("--ttl", type=int, help="merge_trip_fares: seconds until an idle key's state goes")
    ap.add_argument("--format", default="json", help="index_*: writer format")
    ap.add_argument("--master", help="Spark master (default: from spark-submit)")
    a = ap.parse_args(argv)

    spark = get_session(a.master, app_name=f"hackney-{a.service}")
    topics = svc.Topics(fmt="kafka" if a.kafka else "json", servers=a.kafka, root=a.root,
                        trigger={"availableNow": True} if a.available_now else None,
                        checkpoint_root=a.checkpoints, max_per_trigger=a.max_per_trigger)
    late = {"lateness": a.lateness} if a.lateness else {}
    timed = {**late, "time_col": a.time_col} if a.time_col else late
    s = a.service
    if s == "replay":
        if not (a.path and a.kind):
            ap.error("replay needs --path and --kind")
        queries = [svc.replay_lines(spark, a.path, a.kind, topics)]
    elif s in ("index_trips", "index_fares"):
        queries = [getattr(svc, s)(spark, topics, fmt=a.format, target=a.target)]
    elif s == "driver_payments":
        queries = svc.driver_payments(spark, topics, **timed)
    elif s in ("trending_grid", "payment_summary"):
        queries = [getattr(svc, s)(spark, topics, **timed)]
    elif s == "merge_trip_fares":
        queries = [svc.merge_trip_fares(spark, topics, ttl_seconds=a.ttl, **late)]
    elif s == "merge_trip_fares_windowed":
        queries = [svc.merge_trip_fares_windowed(spark, topics, **timed)]
    elif s in ("materialise_merged", "trending_grid_accounted"):
        if not a.target:
            ap.error(f"{s} needs --target")
        queries = ([svc.materialise_merged(spark, topics, a.target)] if s == "materialise_merged"
                   else svc.trending_grid_accounted(spark, topics, a.target, **timed))
    else:
        queries = [getattr(svc, s)(spark, topics)]
    if not a.available_now:      # services run until one of them ends
        spark.streams.awaitAnyTermination()
    for q in queries:
        if a.available_now or not q.isActive:
            q.awaitTermination()
    failed = [q for q in queries if q.exception() is not None]
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
