"""Command line: list and run queries, run the stages of the extraction, and read or write an annotation queue."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from leafmill.plans import catalogue, runner


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="leafmill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    one = commands.add_parser("run", help="run a query and write its rows as Parquet")
    one.add_argument("query", choices=sorted(catalogue.QUERIES))
    stages = commands.add_parser("stages", help="run the stages of the extraction")
    stages.add_argument("--start-stage", type=int, default=1)
    stages.add_argument("--end-stage", type=int)
    stages.add_argument("--fresh", action="store_true")
    stages.add_argument("--list-stages", action="store_true")
    status = commands.add_parser("status", help="progress of an annotation queue")
    status.add_argument("queue")
    export = commands.add_parser("export", help="truth rows of an annotation queue")
    export.add_argument("queue")
    for p in (one, stages):
        p.add_argument("--data", required=p is one, help="folder of the source tables")
    for p in (one, stages, export):
        p.add_argument("--out", required=p is not stages, help="folder to write to")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    if args.command == "stages" and args.list_stages:
        print("\n".join(runner.listed()))
        return 0
    if args.command == "stages" and not (args.data and args.out):
        parser.error("stages need --data and --out")
    spark = SparkSession.builder.appName("leafmill").getOrCreate()
    if args.command == "run":
        catalogue.QUERIES[args.query](spark, args.data).write.mode("overwrite").parquet(args.out)
    elif args.command == "stages":
        runner.run_stages(spark, args.data, args.out, args.start_stage, args.end_stage, args.fresh)
    else:
        from leafmill.operators import identity

        queue = spark.read.parquet(args.queue)
        if args.command == "status":
            identity.progress(queue).show(truncate=False)
        else:
            identity.exported(queue).orderBy(F.col("sample_id")).write.mode("overwrite").option("header", True).csv(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
