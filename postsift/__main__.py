"""Command line: ``python -m postsift <run-batch|merge|evaluate> ...`` (or via spark-submit).

The session comes from the launcher (``getOrCreate``); inputs are read with
the format given by their extension (parquet, csv with header, json lines).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .functions.rules import load_rules
from .plans import entrypoints as ep
from .session import ensure_checkpoint_dir


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv") or "/csv" in path:
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if path.endswith(".json") or path.endswith(".jsonl"):
        return spark.read.json(path)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="postsift")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rb = sub.add_parser("run-batch", help="score postings and write leads and reports for one batch")
    rb.add_argument("--rules", required=True)
    rb.add_argument("--postings", required=True, help="postings with seq, company, title, description, ... columns")
    rb.add_argument("--attempts", required=True, help="search attempts (seq, ts, run_id, search_term, site, success, ...)")
    rb.add_argument("--out", required=True)
    rb.add_argument("--run-id", required=True)
    rb.add_argument("--run-date", required=True)
    rb.add_argument("--batch", type=int)
    mg = sub.add_parser("merge", help="merge the reports of all batches of a run")
    mg.add_argument("--out", required=True)
    mg.add_argument("--run-id", required=True)
    mg.add_argument("--write", help="folder for the merged reports (JSON); printed when omitted")
    ev = sub.add_parser("evaluate", help="precision / recall / f1 on labelled items")
    ev.add_argument("--rules", required=True)
    ev.add_argument("--labelled", required=True)
    ev.add_argument("--json-lines", action="store_true")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("postsift").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "run-batch":
        paths = ep.run_batch(spark, _read(spark, args.postings), _read(spark, args.attempts), load_rules(args.rules),
                             args.out, args.run_id, args.run_date, args.batch)
        print(json.dumps(paths, indent=2))
    elif args.cmd == "merge":
        reports = ep.merge_batches(spark, args.out, args.run_id)
        for name, df in reports.items():
            if args.write:
                df.write.mode("overwrite").json(f"{args.write.rstrip('/')}/{name}")
            else:
                print(f"== {name}")
                df.show(20, truncate=False)
    else:
        m = ep.evaluate(spark, args.labelled, load_rules(args.rules), json_lines=args.json_lines).first()
        print(json.dumps(m.asDict(), indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
