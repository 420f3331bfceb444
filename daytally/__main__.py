"""Command line: generate, stream, final, tables, compact, query."""

from __future__ import annotations

import argparse

from daytally import app
from daytally.operators.generator import MAX_PER_DAY
from daytally.session import build_session


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daytally")
    commands = parser.add_subparsers(dest="command", required=True)

    generate = commands.add_parser("generate", help="make synthetic records")
    generate.add_argument("--sample", required=True, help="CSV of sample sales")
    generate.add_argument("--places", required=True, help="CSV of country, city, latitude, longitude")
    generate.add_argument("--topic", required=True, help="topic name with --servers, else a folder to add messages to")
    generate.add_argument("--servers", help="topic servers; needs the connector package")
    generate.add_argument("--export", required=True, help="folder of daily files")
    generate.add_argument("--seed", type=int, default=0)
    generate.add_argument("--max-per-day", type=int, default=MAX_PER_DAY)

    stream = commands.add_parser("stream", help="records to raw table and changelogs")
    final = commands.add_parser("final", help="day totals, each written once when the day is over")
    final.add_argument("--delay", default="1 day", help="how long after a day's end its records may come")
    for each in (stream, final):
        each.add_argument("--topic", required=True, help="topic name with --servers, else a folder")
        each.add_argument("--fail-on-data-loss", action="store_true", help="end when the servers no longer have messages that are to be read")
    tables = commands.add_parser("tables", help="changelogs to report tables")
    stream.add_argument("--changelogs", help="with --servers: prefix of topics to send changes to")
    tables.add_argument("--changelogs", default="", help="with --servers: prefix of topics to read changes from")
    tables.add_argument("--database", help="JDBC address of a database to upsert the reports into; needs its driver package")
    tables.add_argument("--user", default="", help="user of the database")
    tables.add_argument("--password-variable", default="", help="environment variable that holds the password")
    tables.add_argument("--table-prefix", default="", help="of the tables' names in the database, such as a schema and a point")
    tables.add_argument("--fill", action="store_true", help="first send the database all rows that the tables hold")
    for each in (stream, final, tables):
        each.add_argument("--servers", help="topic servers; needs the connector package")
        each.add_argument("--once", action="store_true", help="stop when all there is has been read")
    for each in (stream, tables):
        each.add_argument("--run", type=int, default=0, help="higher than before after a lost checkpoint")

    compact = commands.add_parser("compact", help="snapshot the report tables")
    query = commands.add_parser("query", help="SQL over the reports")
    query.add_argument("sql")
    for each in (stream, final, tables, compact, query):
        each.add_argument("--root", required=True, help="folder of all tables and checkpoints")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = vars(parse(argv))
    command = args.pop("command")
    spark = build_session(f"daytally-{command}")
    if command == "query":
        app.query(spark, **args).show(truncate=False)
    else:
        jobs = {"generate": app.generate, "stream": app.stream, "final": app.final, "tables": app.tables, "compact": app.compact_all}
        jobs[command](spark, **args)


if __name__ == "__main__":
    main()
