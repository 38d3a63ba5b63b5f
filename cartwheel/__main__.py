"""Command line: the three stages of the original scripts, on Spark.

    python -m cartwheel land       --daily DIR --actions TABLE
    python -m cartwheel grain      --daily DIR --actions TABLE --grain TABLE
    python -m cartwheel candidates --actions TABLE --items TSV --out DIR [--config INI]
    python -m cartwheel features   --actions TABLE --items TSV --out DIR [--config INI]
    python -m cartwheel scoring    --actions TABLE --out DIR [--config INI]
    python -m cartwheel all        --actions TABLE --items TSV --out DIR [--config INI]

``land`` turns the ``data_YYYYMMDD.txt`` shards into a ``dt``-partitioned
Parquet table once; the other commands read that table. Parameters come from
an INI file of the original layout (``--config``) with ``--set key=value``
overrides. Run it with ``spark-submit`` on a cluster; the session's own
settings (including ``spark.checkpoint.dir``) are used as they are.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from cartwheel.plans import stages
from cartwheel.plans.params import Params
from cartwheel.session import get_spark
from cartwheel.sources.daily_logs import land_daily_shards, read_actions
from cartwheel.sources.items import read_item_subset
from cartwheel.streaming.daily_grain import land_daily_grain_stream, read_daily_grain


def _params(args) -> Params:
    p = Params.from_ini(args.config) if args.config else Params()
    names = {f.name for f in fields(Params)}
    for item in args.set or []:
        key, _, value = item.partition("=")
        if key not in names:
            raise SystemExit(f"unknown parameter {key!r}")
        p.set_text(key, value)
    return p


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cartwheel")
    ap.add_argument("command", choices=["land", "grain", "candidates", "features", "scoring", "all"])
    ap.add_argument("--daily", help="folder of data_YYYYMMDD.txt shards (land)")
    ap.add_argument("--actions", required=True, help="dt-partitioned Parquet table of the log")
    ap.add_argument("--items", help="item subset TSV (item_id, geohash, category)")
    ap.add_argument("--out", help="output folder for stage tables and the submission")
    ap.add_argument("--grain", help="day-partial grain table (written by 'grain', read by features)")
    ap.add_argument("--config", help="INI file with the original sections")
    ap.add_argument("--set", action="append", help="override a parameter: key=value")
    args = ap.parse_args(argv)

    spark = get_spark()
    if args.command == "land":
        if not args.daily:
            raise SystemExit("land needs --daily")
        land_daily_shards(spark, args.daily, args.actions)
        return 0
    if args.command == "grain":
        if not (args.daily and args.grain):
            raise SystemExit("grain needs --daily and --grain")
        land_daily_grain_stream(spark, args.daily, args.grain).awaitTermination()
        return 0
    p = _params(args)
    actions = read_actions(spark, args.actions)
    items = read_item_subset(spark, args.items) if args.items else None
    grain = read_daily_grain(spark, args.grain) if args.grain else None
    if args.command in ("candidates", "features", "all") and items is None:
        raise SystemExit(f"{args.command} needs --items")
    if args.command == "candidates":
        report = stages.stage_candidates(spark, actions, items, p, args.out)
    elif args.command == "features":
        report = stages.stage_features(spark, actions, items, p, args.out, grain=grain)
    elif args.command == "scoring":
        report = stages.stage_scoring(spark, actions, p, args.out)
    else:
        report = stages.run_all(spark, actions, items, p, args.out, grain=grain)
    print(json.dumps(report, default=str, indent=1))
    return 0


if __name__ == "__main__":
    sys.exit(main())
