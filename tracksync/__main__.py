"""Command line: run the sync and the exports over a folder of parquet tables.

  python -m tracksync sync       --config FILE --tables DIR --out ROOT [--run-id ID] [--restart]
  python -m tracksync export-all --config FILE --out ROOT --dest PATH [--format csv|parquet]
  python -m tracksync save-items --pages DIR --dest PATH
  python -m tracksync export-filtered (--pages DIR | --items PATH) --filters JSON --labels JSON --dest PATH

``sync`` goes on from the items, values and relations of the last run published under ROOT; the first run
(or one with ``--restart``) takes them from DIR.  It reads DIR/<name> for items, values, fields, projects, relations,
state_days, history, registry, element, conduct, md, points and area_<label>
(edge tables with area_id, one per area layer), runs the twenty steps and publishes items,
values and relations (with the field dictionary it used) as one run under ROOT.
``export-all`` widens the custom fields of the last published run;
``save-items`` turns saved API pages into a table of items whose members are columns of the file;
``export-filtered`` reads saved API pages, or the members it needs of such a table.
The session comes from ``SparkSession.builder`` (spark-submit supplies the cluster).
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import SyncConfig
from .operators import export
from .plans.publish import current_parts, current_run, publish, read_current
from .plans.sync import SyncInputs, run_sync
from .sources.item_table import read_items, save_items
from .sources.pages import read_pages

TABLES = ["items", "values", "fields", "projects", "relations", "state_days", "history", "registry", "element",
          "conduct", "md", "points"]


def load_inputs(spark: SparkSession, tables_dir: str, cfg: SyncConfig) -> SyncInputs:
    t = {n: spark.read.parquet(os.path.join(tables_dir, n)) for n in TABLES}
    layers = [(label, spark.read.parquet(os.path.join(tables_dir, f"area_{label}")))
              for label in cfg.registry_area_labels]
    return SyncInputs(area_layers=layers, **t)


def cmd_sync(spark: SparkSession, tables: str, out: str, run_id: str | None, cfg: SyncConfig, restart: bool = False) -> str:
    inputs = load_inputs(spark, tables, cfg)
    if not restart and current_run(spark, out) is not None:
        inputs = replace(inputs, items=read_current(spark, out, "items"), relations=read_current(spark, out, "relations"),
                         values=current_parts(spark, out, "values") or read_current(spark, out, "values"))
    result = run_sync(inputs, cfg, store=os.path.join(out, "_values"))
    # the dictionary the run resolved labels with is published with it, for the exports
    return publish(spark, {**result, "fields": inputs.fields}, out, run_id)


def cmd_export_all(spark: SparkSession, out: str, dest: str, fmt: str, cfg: SyncConfig) -> None:
    items, values = read_current(spark, out, "items"), read_current(spark, out, "values")
    fields = read_current(spark, out, "fields")
    export.write_table(export.export_all(items, values, fields, cfg.entity_type), dest, fmt)


def cmd_save_items(spark: SparkSession, pages: str, dest: str, page_size: int) -> None:
    save_items(read_pages(spark, pages, page_size, multi_line=True).select("item"), dest, mode="overwrite")


def cmd_export_filtered(spark: SparkSession, pages: str | None, filters: str, labels: str, dest: str, fmt: str,
                        page_size: int, items_path: str | None = None) -> None:
    items = read_items(spark, items_path) if items_path else read_pages(spark, pages, page_size, multi_line=True)
    lab = {int(k): v for k, v in json.loads(labels).items()}
    out = export.require_rows(export.export_filtered(items, json.loads(filters), lab))
    export.write_table(out, dest, fmt)


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tracksync")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("sync")
    s.add_argument("--config", required=True, help="JSON file of SyncConfig")
    s.add_argument("--tables", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--run-id")
    s.add_argument("--restart", action="store_true", help="take items, values and relations from --tables again")
    a = sub.add_parser("export-all")
    a.add_argument("--config", required=True, help="JSON file of SyncConfig")
    a.add_argument("--out", required=True)
    a.add_argument("--dest", required=True)
    a.add_argument("--format", default="csv")
    i = sub.add_parser("save-items")
    i.add_argument("--pages", required=True)
    i.add_argument("--dest", required=True)
    i.add_argument("--page-size", type=int, default=1000)
    f = sub.add_parser("export-filtered")
    given = f.add_mutually_exclusive_group(required=True)
    given.add_argument("--pages")
    given.add_argument("--items", help="items written by save-items")
    f.add_argument("--filters", required=True, help='JSON object {"field": ["value", ...]}')
    f.add_argument("--labels", required=True, help='JSON object {"1": "label", ...}')
    f.add_argument("--dest", required=True)
    f.add_argument("--format", default="csv")
    f.add_argument("--page-size", type=int, default=1000)
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tracksync-{args.cmd}").getOrCreate()
    cfg = SyncConfig.from_file(args.config) if "config" in args else None
    if args.cmd == "sync":
        print(cmd_sync(spark, args.tables, args.out, args.run_id, cfg, args.restart))
    elif args.cmd == "export-all":
        cmd_export_all(spark, args.out, args.dest, args.format, cfg)
    elif args.cmd == "save-items":
        cmd_save_items(spark, args.pages, args.dest, args.page_size)
    else:
        cmd_export_filtered(spark, args.pages, args.filters, args.labels, args.dest, args.format, args.page_size, args.items)


if __name__ == "__main__":
    main()
