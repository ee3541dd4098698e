"""Command line: status, search, enumerate, fetch, parallel-fetch, analyze, report and dedup over a store of cases."""

from __future__ import annotations

import argparse
import datetime
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docketspark.operators import citations, dedup, report, stats
from docketspark.sources import connectors
from docketspark.sources.batches import DAILY, fetch_batch
from docketspark.sources.store import CaseStore


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docketspark", description=__doc__)
    top.add_argument("--store", default="data", help="folder of the store")
    top.add_argument("--connector", default=connectors.SampleConnector.name)
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("status")
    search = commands.add_parser("search")
    search.add_argument("query")
    search.add_argument("--limit", type=int, default=10)
    search.add_argument("--output", help="folder for all results as JSON")
    for name in ("enumerate", "fetch", "parallel-fetch"):
        command = commands.add_parser(name)
        command.add_argument("--year", type=int)
        command.add_argument("--limit", type=int, default=0)
        if name == "enumerate":
            continue
        command.add_argument("--to", type=int, help="last year, if more than one")
        command.add_argument("--id")
        command.add_argument("--budget", type=int, default=DAILY, help="requests a day, of all tasks and runs")
        command.add_argument("--again", action="store_true", help="fetch what the store has as well")
        if name == "parallel-fetch":
            command.add_argument("--workers", type=int, default=5, help="tasks that fetch at a time")
    analyze = commands.add_parser("analyze")
    analyze.add_argument("kind", choices=("stats", "citations"))
    quality = commands.add_parser("report")
    quality.add_argument("--output")
    quality.add_argument("--folder", help="a folder of JSON documents instead of the store")
    near = commands.add_parser("dedup")
    near.add_argument("--threshold", type=float, default=0.85)
    near.add_argument("--output", help="folder for all pairs as JSON lines; without it the first 100 are printed")
    return top


def _fetch(spark: SparkSession, store: CaseStore, args) -> dict:
    """Saves the cases asked for, those that the store has left out unless asked for again, until --limit are saved or the day's budget is used."""
    if not args.id and not args.year:
        raise ValueError("fetch needs --id or --year")
    if args.id:
        asked = spark.createDataFrame([(args.id,)], "id string")
    else:
        asked = connectors.enumerate_years(spark, args.connector, args.year, args.to or args.year).select("id")
    workers = getattr(args, "workers", None)
    fetch = lambda ids: connectors.fetched(ids.repartition(workers) if workers else ids, args.connector)
    left = args.budget - store.requests(_today())
    found = fetch_batch(store, asked, fetch, args.limit, left, skip_existing=not args.again)
    return {"saved": found["fetched"], "requests": found["requests"], "exhausted": found["exhausted"], **store.stats()}


def _today() -> datetime.date:
    return datetime.datetime.now(datetime.UTC).date()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("docketspark").getOrCreate()
    store = CaseStore(spark, args.store)
    if args.command == "status":
        used = store.requests(_today())
        out: object = {"connector": args.connector, "requests_today": used, "daily_limit": DAILY, "remaining": DAILY - used, **store.stats()}
    elif args.command == "search":
        hits = spark.createDataFrame(list(connectors.connector(args.connector).search(args.query)), connectors.LISTED)
        if args.output:
            hits.write.mode("overwrite").json(args.output)
        out = [r.asDict() for r in hits.orderBy("id").limit(args.limit).collect()]
    elif args.command == "enumerate":
        if not args.year:
            raise ValueError("enumerate needs --year")
        out = [r.id for r in connectors.enumerate_years(spark, args.connector, args.year, args.year).orderBy("id").limit(args.limit or 10).collect()]
    elif args.command in ("fetch", "parallel-fetch"):
        out = _fetch(spark, store, args)
    elif args.command == "report" and args.folder:
        print(report.as_text(report.report_folder(spark, args.folder, args.output)))
        return 0
    else:
        cases = store.cases()
        if cases is None:
            out = {"error": "No cases found"}
        elif args.command == "analyze" and args.kind == "stats":
            out = stats.corpus_stats(cases)
        elif args.command == "analyze":
            out = {**citations.citation_summary(cases).first().asDict(), "most_cited": [list(r) for r in citations.most_cited(cases).collect()]}
        elif args.command == "report":
            out = report.report(cases)
            if args.output:
                report.save(out, args.output)
            print(report.as_text(out))
            return 0
        else:
            pairs = dedup.rendered(dedup.find_duplicates(cases, args.threshold)).orderBy(F.desc("similarity"), "id_a", "id_b")
            if args.output:
                pairs.write.mode("overwrite").json(args.output)
                out = {"pairs": spark.read.json(args.output, schema="line string").count(), "output": args.output}
            else:
                out = [r.line for r in pairs.limit(100).collect()]
    print(json.dumps(out, indent=2, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
