"""python -m lectern build | prepare | verify | script | edition"""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from lectern.plans import corpus, quality
from lectern.session import session
from lectern.shared import scratch
from lectern.sources import json_files, sqlite


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lectern")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="compile the configured sources into one SQLite file")
    build.add_argument("--config", default="config/sources.yaml")
    build.add_argument("--output")
    build.add_argument("--parquet", help="compile into a folder of Parquet tables instead")
    mode = build.add_mutually_exclusive_group()
    mode.add_argument("--no-graft", action="store_const", dest="graft", const="none", default="needed")
    mode.add_argument("--full-graft", action="store_const", dest="graft", const="full")
    prepare = commands.add_parser("prepare", help="derive the divisions of each verse from raw files")
    prepare.add_argument("--sources", default="sources")
    for name, default in (("words", "words.db"), ("layout", "layout.db"), ("juz", "juz.sqlite"), ("hizb", "hizb.sqlite"), ("rub", "rub.sqlite"), ("ruku", "ruku.sqlite"), ("sajda", "sajda.sqlite"), ("out-structure", "structure.sqlite")):
        prepare.add_argument(f"--{name}", default=default)
    verify = commands.add_parser("verify", help="check a compiled file; exit code 1 if a check fails")
    verify.add_argument("--db", required=True)
    verify.add_argument("--font", help="also shape the second script with this font, if a shaping library is present")
    for name, text in (("script", "normalise a second-script snapshot"), ("edition", "flatten an edition payload, a file or a URL that is saved beside the output first")):
        one = commands.add_parser(name, help=text)
        one.add_argument("input")
        one.add_argument("output")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.WARNING, format="%(message)s")
    logging.getLogger("lectern").setLevel(logging.INFO)
    spark = session()
    with scratch(spark):  # what a command writes on its way goes with it
        return run(spark, args)


def run(spark, args: argparse.Namespace) -> int:
    if args.command == "build":
        config = corpus.load_config(args.config)
        print(corpus.write_parquet(spark, config, args.parquet, args.graft) if args.parquet else corpus.build(spark, config, args.output, args.graft))
    elif args.command == "prepare":
        at = lambda name: str(Path(args.sources) / name)
        divisions = {"juz_number": (at(args.juz), "juz", "juz_number"), "hizb_number": (at(args.hizb), "hizbs", "hizb_number"), "rub_el_hizb": (at(args.rub), "rub", "rub_number"), "ruku_number": (at(args.ruku), "ruku", "ruku_number")}
        rows = corpus.prepare(spark, at(args.words), at(args.layout), divisions, at(args.sajda))
        ddl = f"CREATE TABLE ayah_meta ({', '.join(f'{c} INT' for c in rows.columns)});"
        sqlite.export({"ayah_meta": rows}, at(args.out_structure), ddl, {"ayah_meta": corpus.POSITION})
        for row in quality.structure_report(rows).collect():
            print(row["severity"], row["message"])
    elif args.command == "verify":
        findings = quality.report(corpus_tables(spark, args.db), font=args.font).cache()
        for row in findings.orderBy("severity", "check_name", "subject").collect():
            print(f"{row['severity']}: {row['check_name']} {row['subject']}: {row['message']}")
        return quality.exit_code(findings)
    else:
        if args.command == "edition" and args.input.startswith(("http://", "https://")):
            args.input = json_files.download(args.input, f"{args.output}.json")
        rows, ddl = (corpus.normalised_script(spark, args.input), "CREATE TABLE arabic_text (sura INTEGER, ayah INTEGER, text TEXT, PRIMARY KEY (sura, ayah));") if args.command == "script" else (corpus.edition_from_payload(spark, args.input), "CREATE TABLE translation (sura INTEGER, ayah INTEGER, ayah_key TEXT, text TEXT);")
        name = ddl.split()[2]
        sqlite.export({name: rows}, args.output, ddl, {name: ["sura", "ayah"]})
    return 0


def corpus_tables(spark, path: str) -> dict:
    """The tables of a compiled file, with numbers as numbers."""
    whole = {"surahs": ["id", "total_ayahs"], "ayahs": ["id", "surah_id", "ayah_number", *corpus.DIVISIONS, "sajda"], "resources": ["id"], "translations": ["id", "ayah_id", "resource_id"], "db_meta": []}
    frames = {}
    for name, numbers in whole.items():
        df = sqlite.read_table(spark, path, name).drop("_rowid")
        frames[name] = df.select(*(df[c].cast("int").alias(c) if c in numbers else df[c] for c in df.columns))
    return frames


if __name__ == "__main__":
    sys.exit(main())
