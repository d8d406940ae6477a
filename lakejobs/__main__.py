"""Run a job: `spark-submit ... -m lakejobs customers --JOB_NAME x --env dev --base_path s3://lake/bronze/customers`."""

from __future__ import annotations

import argparse
import importlib
import logging
import sys

from lakejobs.config import BATCH_SIZE, DATE_FILTERS, ExportRequest, JobConfig
from lakejobs.plans.customers import CustomersJob
from lakejobs.plans.export import export_table
from lakejobs.plans.products import ProductsJob
from lakejobs.session import session


def _customers(argv: list[str]) -> bool:
    parser = argparse.ArgumentParser(prog="lakejobs customers", allow_abbrev=False)
    parser.add_argument("--base_path", required=True)
    types = parser.add_mutually_exclusive_group()
    types.add_argument("--schema", help="columns of the files' header with their types, like 'customer_id bigint, email string'")
    types.add_argument("--infer", action="store_true", help="infer the types of all columns, which reads all files once more")
    options, _ = parser.parse_known_args(argv)
    return CustomersJob(
        JobConfig.from_args(argv), base_path=options.base_path, schema=options.schema, infer=options.infer
    ).run()


def _products(argv: list[str]) -> bool:
    parser = argparse.ArgumentParser(prog="lakejobs products", allow_abbrev=False)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--pages_table", help="catalog table with the columns page and response")
    source.add_argument("--documents", help="file or folder of whole responses, local environment only")
    options, _ = parser.parse_known_args(argv)
    job = ProductsJob(JobConfig.from_args(argv), documents=options.documents)
    if options.pages_table:
        job.pages = lambda: job.spark.table(options.pages_table)
    return job.run()


def _export(argv: list[str]) -> bool:
    parser = argparse.ArgumentParser(prog="lakejobs export", allow_abbrev=False)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--table")
    source.add_argument("--object_key", help="key of a file that has landed; names the table, and today's rows go")
    parser.add_argument("--env", default="dev", help="environment of the table that --object_key names")
    parser.add_argument("--on_demand", action="store_true", help="yesterday's rows, up to --limit if there is one")
    parser.add_argument("--order_by", required=True, help="columns, comma-separated, the last one unique")
    parser.add_argument("--send", required=True, help="module:function that takes one payload text")
    parser.add_argument("--date_filter", choices=DATE_FILTERS, default="yesterday")
    parser.add_argument("--where")
    parser.add_argument("--as_of")
    parser.add_argument("--limit", type=int, help="deliver the first rows only")
    parser.add_argument("--max_records", type=int, help="a second limit; the smaller one counts")
    parser.add_argument("--batch_size", type=int, default=BATCH_SIZE)
    parser.add_argument("--columns", help="columns to deliver, comma-separated")
    options = parser.parse_args(argv)
    module, _, function = options.send.partition(":")
    send = getattr(importlib.import_module(module), function)
    rest = {name: getattr(options, name) for name in ("where", "as_of", "limit", "max_records", "batch_size")}
    if options.object_key:
        request = ExportRequest.object_event(options.object_key, options.env, **rest)
    elif options.on_demand:
        request = ExportRequest.on_demand(options.table, **rest)
    else:
        request = ExportRequest.scheduled(options.table, options.date_filter, **rest)
    columns = options.columns.split(",") if options.columns else None
    spark, owned = session("export")
    try:
        result = export_table(spark, request, send, options.order_by.split(","), columns)
        print(result)
        return True
    finally:
        if owned:
            spark.stop()


COMMANDS = {"customers": _customers, "products": _products, "export": _export}


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in COMMANDS:
        print(f"usage: python -m lakejobs {{{','.join(COMMANDS)}}} ...", file=sys.stderr)
        return 2
    logging.basicConfig(format="%(asctime)s %(levelname)s %(name)s %(message)s")
    return 0 if COMMANDS[argv[0]](argv[1:]) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
