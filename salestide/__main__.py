"""Command line: the three long-running roles of the original setup.

  python -m salestide batch    --customers P --products P --orders P --order-items P --out DIR
  python -m salestide ingest   --bootstrap HOST:PORT --topic T=relation ... --out DIR --checkpoint DIR
  python -m salestide refresh  --tables DIR --out DIR --checkpoint DIR [--every "10 minutes"]
                               [--versioned] [--pre-aggregates DIR]
  python -m salestide compact  --pre-aggregates DIR

``batch`` computes the ten KPI outputs once; ``ingest`` streams the topics
into one Parquet table per relation (one query per topic); ``refresh``
recomputes the outputs whenever new orders land (replacing cron); with
``--pre-aggregates`` it also maintains the shared pre-aggregates
incrementally and derives the outputs they cover from them; ``compact``
folds their partials into a new base.
"""

from __future__ import annotations

import argparse
import sys


def _ingest(args) -> None:
    from salestide.schemas import RELATIONS
    from salestide.session import build_session
    from salestide.sources.stream import kafka_messages
    from salestide.streaming.common import late_rows
    from salestide.streaming.ingest import start_ingest
    spark = build_session(large_state=bool(args.dedup))
    topics = dict(t.split("=", 1) for t in args.topic)
    dedup = None
    if args.dedup:
        # copies follow each other in the broker's time, in which no old order is
        # late; ``collapse`` needs a time that copies share, the order's own
        collapse = {"orders"} if args.dedup_strategy == "collapse" else set()
        dedup = {relation: (RELATIONS[relation][1], "order_date" if relation in collapse else "timestamp",
                            args.dedup_delay, "collapse" if relation in collapse else "first_seen")
                 for relation in topics.values()}
    keep = ("timestamp",) if args.keep_broker_time or args.dedup else ()
    queries = start_ingest(
        lambda t: kafka_messages(spark, args.bootstrap, [t], maxOffsetsPerTrigger=args.max_messages),
        args.out, args.checkpoint, topics, fmt=args.format, trigger=args.trigger, dedup=dedup,
        keep=keep, quarantine=not args.no_quarantine)
    for q in queries:
        q.awaitTermination()
        if late_rows(q):
            print(f"{q.name or q.id}: {late_rows(q)} rows of its last batches came after the watermark "
                  "and were dropped (see streaming/late.py)", file=sys.stderr)


def _refresh(args) -> None:
    from salestide.plans.job import load_relations
    from salestide.session import build_session
    from salestide.sources.files import read_relation
    from salestide.streaming.refresh import start_refresh
    spark = build_session()
    root = args.tables.rstrip("/")
    names = ("customers", "products", "orders", "order_items")

    def load():
        return load_relations(spark, {n: f"{root}/{n}" for n in names}, fmt="parquet")

    def stream_of(name):
        schema = read_relation(spark, f"{root}/{name}", name, fmt="parquet").schema
        return (spark.readStream.schema(schema).option("maxBytesPerTrigger", args.max_bytes)
                .parquet(f"{root}/{name}"))

    if args.pre_aggregates:
        from salestide.streaming.incremental import start_partials
        partials = start_partials(stream_of("orders"), stream_of("order_items"),
                                  args.pre_aggregates, f"{args.checkpoint}/partials",
                                  trigger=args.every)
        if args.every in ("availableNow", "once"):  # one-shot run: partials first
            for q in partials:
                q.awaitTermination()
    q = start_refresh(stream_of("orders"), load, args.out, f"{args.checkpoint}/refresh",
                      as_of=args.as_of, trigger=args.every, versioned=args.versioned,
                      pre_aggregates_root=args.pre_aggregates)
    q.awaitTermination()


def main(argv=None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    if not argv or argv[0] not in ("batch", "ingest", "refresh", "compact"):
        print(__doc__)
        raise SystemExit(2)
    cmd, rest = argv[0], argv[1:]
    if cmd == "batch":
        from salestide.plans.job import main as batch_main
        batch_main(rest)
        return
    if cmd == "compact":
        ap = argparse.ArgumentParser(prog="salestide compact")
        ap.add_argument("--pre-aggregates", required=True)
        args = ap.parse_args(rest)
        from salestide.session import build_session
        from salestide.streaming.incremental import AGGREGATES, compact
        spark = build_session()
        for name in AGGREGATES:
            compact(spark, args.pre_aggregates, name)
        return
    ap = argparse.ArgumentParser(prog=f"salestide {cmd}")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    if cmd == "ingest":
        ap.add_argument("--bootstrap", required=True)
        ap.add_argument("--topic", action="append", required=True,
                        help="topic=relation (customers, products, orders, order_items)")
        ap.add_argument("--format", default="parquet")
        ap.add_argument("--trigger", default=None)
        ap.add_argument("--max-messages", type=int, default=5_000_000,
                        help="messages per topic and micro-batch, at most")
        ap.add_argument("--no-quarantine", action="store_true",
                        help="do not write messages that fail to decode to <out>/_rejected")
        ap.add_argument("--dedup", action="store_true", help="drop redelivered messages of every topic")
        ap.add_argument("--dedup-delay", default="1 hour")
        ap.add_argument("--dedup-strategy", default="first_seen",
                        choices=["first_seen", "collapse"])
        ap.add_argument("--keep-broker-time", action="store_true",
                        help="store the message timestamp (event time of item messages)")
        _ingest(ap.parse_args(rest))
    else:
        ap.add_argument("--tables", required=True, help="root of the ingested Parquet tables")
        ap.add_argument("--every", default="10 minutes")
        ap.add_argument("--max-bytes", type=int, default=64 << 30,
                        help="bytes of new files per micro-batch, at most (a first run over a long "
                             "history is cut into batches of this size)")
        ap.add_argument("--as-of", default=None)
        ap.add_argument("--versioned", action="store_true",
                        help="write each refresh to run=<id> folders and publish it when complete")
        ap.add_argument("--pre-aggregates", default=None,
                        help="folder of incrementally maintained pre-aggregates")
        _refresh(ap.parse_args(rest))


if __name__ == "__main__":
    main()
