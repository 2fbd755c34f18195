"""Command line: load the raw feeds, bring in more of them, then show a dashboard.

    python -m shelfwise load RAW_FOLDER TABLES_FOLDER
    python -m shelfwise add RAW_FOLDER TABLES_FOLDER LOAD_NAME [--merge] [--lateness DAYS]
    python -m shelfwise masters RAW_FOLDER TABLES_FOLDER LOAD_NAME
    python -m shelfwise fit TABLES_FOLDER MODEL_TABLE [--client C]... [--city C]... [--brand B]...
    python -m shelfwise show TABLES_FOLDER [--year 2019 | --month 2019-06 | --latest-month]
                             [--client C]... [--city C]... [--brand B]... [--no-forecast | --model MODEL_TABLE]

With ``--by-name``, ``load``, ``add`` and ``masters`` take feeds whose columns stand in another order, and with ``--renamed
OLD=NEW`` under other names.
"""

from __future__ import annotations

import argparse

from . import session
from .functions import report
from .operators.context import Period, apply_context
from .operators.forecast import fit_forecast
from .operators.trees import LEAVES, leaf_table
from .plans.build import build_gold, load_increment, load_masters, read_daily
from .plans.dashboard import dashboard
from .sources.feeds import read_feeds


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfwise", description="Retail sell-out analytics on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="full refresh from Sales.csv, Items.csv, Store.csv and Client.csv")
    add = commands.add_parser("add", help="new sales, of whole days unless --merge is given")
    masters = commands.add_parser("masters", help="changed items, stores and clients, also in old sales")
    for command in (load, add, masters):
        command.add_argument("raw")
        command.add_argument("tables")
        command.add_argument("--input-bytes", type=int, help="size of the sales feed, from which shuffles are sized")
        command.add_argument("--by-name", action="store_true", help="find the columns of each file by its own header")
        command.add_argument("--renamed", action="append", default=[], metavar="OLD=NEW", help="a sales column's other name")
    for command in (add, masters):
        command.add_argument("name", help="a run repeated under its name replaces its own lines")
    for command in (load, add):
        command.add_argument("--lenient-dates", action="store_true", help="keep lines with a malformed date, without one")
    add.add_argument("--merge", action="store_true", help="add all lines that are not stored yet, whatever their date")
    add.add_argument("--lateness", type=int, metavar="DAYS", help="lines that much older than the last day go to quarantine")
    fit = commands.add_parser("fit", help="fit the forecast of a filter context and store its trees as a table")
    fit.add_argument("tables")
    fit.add_argument("model")
    show = commands.add_parser("show", help="print all result tables of a filter context")
    show.add_argument("tables")
    period = show.add_mutually_exclusive_group()
    period.add_argument("--year", type=int)
    period.add_argument("--month")
    period.add_argument("--latest-month", action="store_true")
    for name in ("client", "city", "brand"):
        for command in (fit, show):
            command.add_argument(f"--{name}", action="append")
    show.add_argument("--no-forecast", action="store_true")
    show.add_argument("--model", help="a model stored for the same filter context, instead of fitting one")
    return parser.parse_args()


def main() -> None:
    arguments = _arguments()
    spark = session(input_bytes=getattr(arguments, "input_bytes", None))

    def feeds() -> dict:
        by_name = arguments.by_name or bool(arguments.renamed)
        renamed = dict(pair.split("=", 1) for pair in arguments.renamed)
        return read_feeds(spark, arguments.raw, by_name, {"Sales": renamed})

    if arguments.command == "load":
        build_gold(spark, feeds(), arguments.tables, lenient_dates=arguments.lenient_dates)
        return
    if arguments.command == "add":
        load_increment(
            spark, feeds(), arguments.tables, arguments.name, whole_days=not arguments.merge,
            merge=arguments.merge, lateness=arguments.lateness, lenient_dates=arguments.lenient_dates,
        )
        return
    if arguments.command == "masters":
        months = load_masters(spark, feeds(), arguments.tables, arguments.name)
        print(f"{len(months)} months written again")
        return
    if arguments.command == "fit":
        chosen = apply_context(read_daily(spark, arguments.tables), arguments.client, arguments.city, arguments.brand)
        model = fit_forecast(chosen)
        leaf_table(spark, model).coalesce(1).write.mode("overwrite").parquet(arguments.model)
        return
    period = Period()
    if arguments.year is not None:
        period = Period.of_year(arguments.year)
    elif arguments.month or arguments.latest_month:
        period = Period.of_month(arguments.month)
    results = dashboard(
        read_daily(spark, arguments.tables), period, clients=arguments.client, cities=arguments.city,
        brands=arguments.brand, with_forecast=not arguments.no_forecast,
        model=spark.read.schema(LEAVES).parquet(arguments.model) if arguments.model else None,
    )
    for name, table in results.items():
        print(name)
        report(table).show(truncate=False)


if __name__ == "__main__":
    main()
