"""python -m lexigraph COMMAND …: the engine from a shell.

validate ROOT [--strict]        findings of a data root; exit code 1 on hard ones, with --strict on soft ones too
diff BEFORE AFTER               changes between two manifests; exit code 1 if there are any
report ROOT                     records, bytes and tokens of each part
render LESSONS FOLDER [NAME …]  documents of a JSON-lines file (id, tree) as <FOLDER>/<id>/<document>.html
smoke                           every query on the smallest tables that --tables names

Exit code 2: the command could not be carried out."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import diff, lessons, quality
from .plans import validate
from .session import session, staged
from .sources import nested_json, snapshots


def _print(rows: DataFrame) -> None:
    for r in rows.toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in r))


def run(command: str, given: argparse.Namespace) -> int:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    if command == "validate":
        found = staged(validate.validate(spark, given.root), "findings")
        _print(quality.ordered(found))
        return quality.exit_code(found, given.strict)
    if command == "diff":
        fields = ("nor", "kundmachungsorgan", "ausserkrafttretensdatum", "pdf_sha256", "xml_sha256")
        changes = staged(diff.classified(diff.field_changes(*(snapshots.manifest(spark, p) for p in (given.before, given.after)), "document", *fields), "document", ["nor", "kundmachungsorgan"], ["pdf_sha256", "xml_sha256"]), "changes")
        _print(diff.ordered(changes, "document", "field"))
        return int(changes.limit(1).count() > 0)
    if command == "report":
        _print(validate.build_report(nested_json.parts(spark, given.root).where("_corrupt_record is null")).orderBy("shard", "datei"))
    if command == "render":
        rows = lessons.render(spark.read.schema("id string, tree string").json(given.lessons), "id", "tree", given.names or None)
        snapshots.write_documents(rows.select(F.concat("id", F.lit("/"), "document", F.lit(".html")).alias("file"), F.col("html").alias("value")), given.folder)
    if command == "smoke":
        from .queries import QUERIES

        for name, query in QUERIES.items():
            print(name, query(spark, given.tables).count())
    return 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("lexigraph")
    add = parser.add_subparsers(dest="command", required=True).add_parser
    one = add("validate")
    one.add_argument("root"), one.add_argument("--strict", action="store_true")
    one = add("diff")
    one.add_argument("before"), one.add_argument("after")
    add("report").add_argument("root")
    one = add("render")
    one.add_argument("lessons"), one.add_argument("folder"), one.add_argument("names", nargs="*")
    add("smoke").add_argument("--tables", required=True)
    given = parser.parse_args(arguments)
    try:
        return run(given.command, given)
    except Exception as wrong:  # whatever stopped it, the caller learns that there is no answer
        print(wrong, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
