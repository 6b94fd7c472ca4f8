"""Command-line jobs: ``python -m cdclake <job> --root <lake folder> [options]``
(or ``spark-submit`` with this module's file as the application).

Jobs: ``load-source`` (CSV files of one table), ``entities``, ``seeds``, ``land-bronze``,
``silver-dims``, ``silver-fact``, ``silver-stream``, ``colocate``, ``gold``, ``serve``, ``run-all``. A failed table
makes the job fail (non-zero exit).
The lake root (bronze, silver, gold, serving folders) must be a shared file
system path on a cluster; the session's ``spark.checkpoint.dir`` must be set
there too.
"""

from __future__ import annotations

import argparse
import json

from cdclake.plans.jobs import (
    Layout,
    build_entities,
    build_gold_job,
    build_silver_dimensions,
    build_silver_transaction,
    colocate_silver,
    export_and_serve,
    load_seeds,
    load_source_table,
    require_ok,
    run_all,
    stream_silver,
)
from cdclake.schemas import DIMENSION_TABLES, TABLES
from cdclake.session import build_session, drop_scratch, scale_conf
from cdclake.sinks.snapshots import SnapshotTable
from cdclake.sources.csv import LINES
from cdclake.streaming.bronze import change_stream, land_bronze, to_bronze

JOBS = ("load-source", "entities", "seeds", "land-bronze", "silver-dims", "silver-fact", "silver-stream", "colocate", "gold", "serve", "run-all")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cdclake")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--root", required=True, help="lake root folder")
    p.add_argument("--table", help="load-source: the table to load")
    p.add_argument("--files", nargs="*", default=[], help="load-source: its CSV files")
    p.add_argument("--quarantine", help="load-source: folder for rows that cannot be loaded")
    p.add_argument("--csv-lines", choices=LINES, default="auto",
                   help="load-source: split files larger than a split (auto) or all files; read each in one task (whole); or files without line breaks in fields (single)")
    p.add_argument("--kafka", help="bootstrap servers of the change stream")
    p.add_argument("--records", help="folder of parquet change records (instead of Kafka)")
    p.add_argument("--max-per-trigger", type=int, default=None, help="offsets or files per micro-batch (default: no limit)")
    p.add_argument("--schema", choices=["declared", "infer", "variant"], default="declared", help="silver-dims: where row schemas come from")
    p.add_argument("--decode-decimals", nargs="*", default=[], metavar="TABLE.COLUMN", help="silver-dims: NUMERIC columns to decode")
    p.add_argument("--deletes", choices=["ignore", "apply"], default="ignore", help="silver jobs: what a delete event does")
    p.add_argument("--tables", nargs="*", default=list(DIMENSION_TABLES), help="silver-stream: the tables to keep up to date")
    p.add_argument("--allow-missing", action="store_true", help="gold: tables never written stand in as empty")
    p.add_argument("--buckets", type=int, default=None, help="colocate: buckets of the copies (default: the session's shuffle partitions)")
    p.add_argument("--colocated", action="store_true", help="gold: read the copies that colocate made last")
    p.add_argument("--gold-files", type=int, default=None, help="fixed gold file count (default: AQE sized)")
    p.add_argument("--shuffle-bytes", type=int, help="expected shuffle volume; with --cores sizes the session")
    p.add_argument("--cores", type=int, help="cores of the cluster")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it otherwise")
    args = p.parse_args(argv)

    sizes = scale_conf(args.shuffle_bytes, args.cores) if args.shuffle_bytes and args.cores else None
    spark = build_session(master=args.master, app_name=f"cdclake-{args.job}", conf=sizes)
    layout = Layout(args.root.rstrip("/"))

    def land() -> None:
        raw = change_stream(spark, bootstrap_servers=args.kafka, files_dir=args.records,
                            max_per_trigger=args.max_per_trigger)
        land_bronze(to_bronze(raw), layout.bronze, layout.bronze_checkpoint)

    result: dict = {"job": args.job}
    try:
        if args.job == "load-source":
            if not args.table or not args.files:
                p.error("load-source needs --table and --files")
            target = SnapshotTable(spark, layout.source(args.table))
            counts = load_source_table(spark, args.table, args.files, TABLES[args.table].schema, target, args.quarantine, args.csv_lines)
            result.update(counts.first().asDict())
        elif args.job == "entities":
            result["rows_written"] = build_entities(spark, layout)
        elif args.job == "seeds":
            result["buckets"] = load_seeds(spark, layout)
        elif args.job == "land-bronze":
            land()
        elif args.job == "silver-dims":
            decode: dict[str, list[str]] = {}
            for name in args.decode_decimals:
                table, _, column = name.partition(".")
                decode.setdefault(table, []).append(column)
            result["dimensions"] = build_silver_dimensions(spark, layout, schema=args.schema, decode_decimals=decode, deletes=args.deletes)
            require_ok(result["dimensions"])
        elif args.job == "silver-fact":
            result["buckets"] = build_silver_transaction(spark, layout, args.deletes)
        elif args.job == "silver-stream":
            stream_silver(spark, layout, args.tables, deletes=args.deletes, max_per_trigger=args.max_per_trigger)
        elif args.job == "colocate":
            colocate_silver(spark, layout, args.buckets)
        elif args.job == "gold":
            build_gold_job(spark, layout, num_files=args.gold_files, allow_missing=args.allow_missing, colocated=args.colocated)
        elif args.job == "serve":
            result["rows"] = export_and_serve(spark, layout)
        else:
            result.update(run_all(spark, layout, land=land if (args.kafka or args.records) else None,
                                  allow_missing=args.allow_missing))
        print(json.dumps(result, default=str))
    finally:
        drop_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
