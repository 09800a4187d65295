"""Commands: load, copy, tables, ddl, status, value."""

from __future__ import annotations

import argparse
from pathlib import Path

from docrel.plans.ddl import script
from docrel.plans.schema import parse_schema


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docrel")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("tables", "ddl"):
        p = commands.add_parser(name, help=f"{name} of a collection")
        p.add_argument("schema", type=Path)
        p.add_argument("--prefix", default="")
    p = commands.add_parser("load", help="flatten a collection into files")
    p.add_argument("schema", type=Path)
    p.add_argument("documents")
    p.add_argument("folder")
    p.add_argument("--format", default="parquet", choices=["parquet", "tsv", "json", "orc"])
    p.add_argument("--filter", default="{}", help="a filter in the document store's dialect")
    p = commands.add_parser("copy", help="text files into catalog tables")
    p.add_argument("schema", type=Path)
    p.add_argument("folder")
    p.add_argument("--database", default="default")
    p = commands.add_parser("status", help="state of the initial load, as the exit code")
    p.add_argument("log")
    p = commands.add_parser("value", help="a value of a settings file")
    p.add_argument("config", type=Path)
    p.add_argument("path")
    a = parser.parse_args(args)
    if a.command == "value":
        from docrel.sources import config

        print(config.value(config.read(a.config.read_text()), a.path))
        return 0
    if a.command in ("tables", "ddl"):
        plan = parse_schema(a.schema.read_text(), a.schema.stem)
        print("\n".join(plan.table_names()) if a.command == "tables" else script(plan, prefix=a.prefix))
        return 0
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "status":
        from docrel.operators.status import RunLog

        state = RunLog(spark, a.log).load_state()
        print(state.name)
        return int(state)
    plan = parse_schema(a.schema.read_text(), a.schema.stem)
    if a.command == "load":
        import json

        from docrel.operators.load import init_load
        from docrel.sources.readers import find_documents, read_documents

        docs = find_documents(read_documents(spark, a.documents), json.loads(a.filter))
        for name, n in init_load(docs.select(F.to_json("doc").alias("doc")), plan, a.folder, file_format=a.format).items():
            print(name, n)
        return 0
    from docrel.operators.load import load_table
    from docrel.sources.readers import read_tsv

    for name in plan.tables:
        load_table(read_tsv(spark, f"{a.folder}/{name}", plan.struct(name)), f"{a.database}.{name}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
