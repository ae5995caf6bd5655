"""Command line: the three steps of a feed refresh as Spark jobs.

    python -m strata.cli files --pages PAGES.parquet --out FILES [--load-type FUL|INC]
    python -m strata.cli land  --archives DIR --landing DIR
    python -m strata.cli load  --landing DIR --tables DIR --load-type FUL|INC
                               --as-of YYYY-MM-DD [--feeds a,b]

``files`` turns stored index pages into the routed download list; ``land``
expands downloaded archives into ``feed=/load=`` folders; ``load`` runs, per
feed, the FULL replace (``FUL`` only) and then the ADD/CHANGE merge.  The
session comes from ``spark-submit``/the environment; nothing here sets
cluster resources.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .session import ensure_checkpoint_dir, get_spark
from .specs import FEED_ORDER


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("files", help="routed download list from stored index pages")
    f.add_argument("--pages", required=True, help="parquet with page_id, html")
    f.add_argument("--out", required=True)
    f.add_argument("--load-type", default="FUL", choices=["FUL", "INC"])
    f.add_argument("--rule", default="table", choices=["table", "anchors"])
    la = sub.add_parser("land", help="expand archives into feed=/load= folders")
    la.add_argument("--archives", required=True)
    la.add_argument("--landing", required=True)
    lo = sub.add_parser("load", help="FULL replace and/or ADD+CHANGE merge per feed")
    lo.add_argument("--landing", required=True)
    lo.add_argument("--tables", required=True)
    lo.add_argument("--load-type", default="INC", choices=["FUL", "INC"])
    lo.add_argument("--as-of", default=dt.date.today().isoformat())
    lo.add_argument("--feeds", default=",".join(FEED_ORDER))
    lo.add_argument("--encoding", default=None, help="of text landed by others, if not UTF-8")
    la.add_argument("--encoding", default="utf-8", help="of the archives' text")
    lo.add_argument("--staging", default=None,
                    help="write ADD/CHANGE staging tables here; dropped after the merge")
    lo.add_argument("--widths", default=None, choices=["fail", "null"],
                    help="what becomes of a value over its declared width, in all loads")
    lo.add_argument("--rejects", default=None, help="write lines that do not fit their layout here")
    lo.add_argument("--drop-rejects", action="store_true", help="leave those lines out of the load")
    lo.add_argument("--vacuum-keep", type=int, default=0,
                    help="after the run, delete open sets older than this many versions")
    args = ap.parse_args(argv)
    if args.cmd == "load" and args.drop_rejects and not args.rejects:
        ap.error("--drop-rejects needs --rejects")

    spark = get_spark()
    ensure_checkpoint_dir(spark)
    from .plans import jobs
    if args.cmd == "files":
        from .sources.links import anchor_links, table_links
        pages = spark.read.parquet(args.pages)
        links = table_links(pages) if args.rule == "table" else anchor_links(pages)
        jobs.published_files(links, args.load_type).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "land":
        jobs.land_archives(spark, args.archives, args.landing, encoding=args.encoding)
    else:
        from .sources.rejects import RejectChannel
        channel = RejectChannel(args.rejects, args.drop_rejects) if args.rejects else None
        out = jobs.multi_feed_run(spark, args.landing, args.tables, args.as_of,
                                  full=args.load_type == "FUL",
                                  feeds=[x for x in args.feeds.split(",") if x],
                                  staging_root=args.staging, enforce=args.widths, encoding=args.encoding,
                                  rejects=channel)
        if args.vacuum_keep > 0:
            from .plans import snapshot
            for name in out:
                snapshot.vacuum(spark, f"{args.tables.rstrip('/')}/{name}", args.vacuum_keep)
        lines = {f"{feed} {load}": n for (feed, load), n in channel.counts.items()} if channel else None
        print(json.dumps({k: vars(v) for k, v in out.items()} | ({"rejects": lines} if channel else {})))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
