"""Archive tools: python -m blockflow COMMAND ... (verify, info, compare, export, import, prune, replay, follow, bootstrap, consume)."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from blockflow import config as options
from blockflow.operators.integrity import prune_from
from blockflow.sources import segments, sinks
from blockflow.sources.live import HttpClient
from blockflow.streaming import follow


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blockflow", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *roots: str, bounds: bool = False, **more: int) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for r in roots:
            c.add_argument(r)
        if bounds:
            c.add_argument("--from", dest="start", type=int)
            c.add_argument("--to", dest="end", type=int)
        for k, v in more.items():
            c.add_argument(f"--{k.replace('_', '-')}", type=int, default=v)
        return c

    add("verify", "root", bounds=True)
    add("info", "root")
    add("compare", "a", "b", bounds=True)
    add("export", "source", "target", bounds=True, segment_size=segments.SEGMENT_SIZE)
    add("import", "source", "target", segment_size=segments.SEGMENT_SIZE)
    add("prune", "root", keep=0, segment_size=segments.SEGMENT_SIZE)
    c = add("consume", "root", bounds=True)
    c.add_argument("--cursor", default="")
    for c in (add("replay", "root", bounds=True, batch=10_000), add("follow", "endpoint", until=-1), add("bootstrap", "root", "endpoint", until=-1)):
        c.add_argument("--parquet", default="")
        c.add_argument("--archive", default="")
        c.add_argument("--token", default="")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"blockflow-{a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run(spark, a)
    except (segments.ArchiveError, ValueError) as e:
        print(f"{a.command}: {e}", file=sys.stderr)
        return 1


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    ok = True
    if a.command == "verify":
        report = segments.verify_archive(spark, a.root, a.start, a.end).first().asDict()
        ok = report["ok"]
        print(segments.format_report(report))
    elif a.command == "info":
        print(json.dumps(segments.archive_info(a.root)))
    elif a.command == "compare":
        report = segments.compare_archives(spark, a.a, a.b, a.start or 0, segments.read_checkpoint(a.a) or 0 if a.end is None else a.end).first().asDict()
        ok = report["ok"]
        print(json.dumps(report))
    elif a.command == "export":
        cp = segments.read_checkpoint(a.source)
        print(segments.export_archive(spark, a.source, a.target, a.start or 0, cp if a.end is None else a.end, a.segment_size))
    elif a.command == "import":
        print(segments.import_archive(spark, a.source, a.target, a.segment_size))
    elif a.command == "prune":
        first = prune_from(segments.read_checkpoint(a.root) or 0, a.keep)
        print("nothing to prune" if first is None or not segments.prune_archive(spark, a.root, first, a.segment_size) else f"pruned before {first}")
    elif a.command == "replay":
        first = segments.read_archive(spark, a.root, raw=False).agg({"round": "min"}).first()[0]
        cp = segments.read_checkpoint(a.root)
        print(sinks.replay(spark, a.root, sinks.build_sinks(spark, a.parquet, a.archive), first if a.start is None else a.start, cp if a.end is None else a.end, a.batch))
    elif a.command == "consume":
        print(follow.consume(spark, a.root, lambda b: print(b["round"], b["block_hash"]), segments.CursorFile(a.cursor), a.start or 0, a.end or 0))
    else:
        c = options.load({"endpoint": a.endpoint, "token": a.token, "parquet_root": a.parquet, "archive_root": a.archive})
        sink = sinks.build_sinks(spark, c.parquet_root, c.archive_root, c.segment_size)
        if a.command == "bootstrap":
            client = HttpClient(c.endpoint, c.token)
            print(follow.bootstrap(spark, a.root, lambda: HttpClient(c.endpoint, c.token), sink, c, client.last_round() if a.until < 0 else a.until))
            return 0
        print(follow.follow_live(spark, lambda: HttpClient(c.endpoint, c.token), sink, c, None if a.until < 0 else a.until))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
