"""Nightly jobs from the command line: ``python -m lakemill <step> ...`` or through spark-submit.

    set-up   --feed retail_a --ods ods --dwd dwd [--ods-path P --dwd-path P]
    extract  --feed retail_a --ods ods --url jdbc:... --run-day 20240131 --run-ts "2024-01-31 02:30:00" [--keyed]
    clean    --feed retail_a --ods ods --dwd dwd --run-day 20240131 --run-ts "2024-01-31 02:30:00"
    measure  --feed retail_b --dwd dwd --results dws [--name topten ...] [--set year=2021 target=77 ...]
    measure  --feed retail_b --dwd dwd --url jdbc:... [--mode truncate|append] [--connections 8] ...
    rebuild  --feed retail_b --dwd dwd [--table fact_order_master ...]

``extract --split customer_inf=customer_id:16`` reads a source table in ranges of about as many rows; ``--inclusive order_master``
takes rows at the stored high-water again, less those already stored.
"""

from __future__ import annotations

import argparse
import dataclasses
import inspect

from lakemill.plans import feeds, jobs, measures
from lakemill.session import build_session
from lakemill.sinks.layers import create_layer
from lakemill.sinks.relational import truncate_load, write_table
from lakemill.sinks.tables import publish
from lakemill.sources.relational import Connection, Split, read_table

FEEDS = {"retail_a": feeds.RETAIL_A, "retail_b": feeds.RETAIL_B, "manufacturing": feeds.MANUFACTURING}
MEASURES = {"retail_a": measures.RETAIL_A, "retail_b": measures.RETAIL_B}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakemill")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name, *options):
        p = steps.add_parser(name)
        p.add_argument("--feed", choices=FEEDS if name != "measure" else MEASURES, required=True)
        for option in options:
            p.add_argument(f"--{option}", required=True)
        return p

    layout = step("set-up", "ods", "dwd")
    layout.add_argument("--ods-path")
    layout.add_argument("--dwd-path")
    extract = step("extract", "ods", "url", "run-day", "run-ts")
    extract.add_argument("--driver")
    extract.add_argument("--keyed", action="store_true")
    extract.add_argument("--split", nargs="*", default=[], metavar="TABLE=COLUMN:PARTS")
    extract.add_argument("--inclusive", nargs="*", default=[], metavar="TABLE")
    step("clean", "ods", "dwd", "run-day", "run-ts")
    measure = step("measure", "dwd")
    target = measure.add_mutually_exclusive_group(required=True)
    target.add_argument("--results", help="database of the result tables")
    target.add_argument("--url", help="relational store whose tables of the same names take the results")
    measure.add_argument("--driver")
    measure.add_argument("--mode", choices=("truncate", "append"), default="truncate")
    measure.add_argument("--connections", type=int, help="how many tasks write to the store at once")
    measure.add_argument("--name", nargs="*")
    measure.add_argument("--set", nargs="*", default=[], metavar="PARAMETER=VALUE")
    step("rebuild", "dwd").add_argument("--table", nargs="*")
    return parser


def parameters(names: list[str], known: dict, given: list[str]) -> dict[str, dict]:
    """Per measure the given parameters it takes, as values of its defaults' types; one that none takes is an error."""
    texts = dict(g.split("=", 1) for g in given)
    found: dict[str, dict] = {}
    for name in names:
        takes = {p.name: p.default for p in inspect.signature(known[name]).parameters.values() if p.default is not p.empty}
        found[name] = {k: _typed(takes[k], v) for k, v in texts.items() if k in takes}
    unknown = set(texts) - {k for f in found.values() for k in f}
    if unknown:
        raise SystemExit(f"no measure asked for takes {', '.join(sorted(unknown))}")
    return found


def _typed(default, text: str):
    if isinstance(default, bool):
        if text.lower() not in ("true", "false"):
            raise SystemExit(f"{text!r} is neither true nor false")
        return text.lower() == "true"
    return type(default)(text)


def adjusted(specs: tuple[feeds.TableSpec, ...], splits: list[str], inclusive: list[str]) -> tuple[feeds.TableSpec, ...]:
    """A feed whose named tables are read in ranges, or from the high-water on."""
    cuts = {t: Split(c.rsplit(":", 1)[0], int(c.rsplit(":", 1)[1])) for t, c in (s.split("=", 1) for s in splits)}
    unknown = ({*cuts, *inclusive}) - {s.source for s in specs}
    if unknown:
        raise SystemExit(f"the feed has no table {', '.join(sorted(unknown))}")
    return tuple(dataclasses.replace(s, split=cuts.get(s.source, s.split), inclusive=s.inclusive or s.source in inclusive) for s in specs)


def deliver(result, name: str, args) -> None:
    """A result into its table of the result layer, or of a relational store."""
    if args.results:
        publish(result, f"{args.results}.{name}")
    elif args.mode == "truncate":
        truncate_load(result, Connection(args.url, args.driver), name, args.connections)
    else:
        write_table(result, Connection(args.url, args.driver), name, "append", args.connections)


def run(spark, args) -> None:
    specs = FEEDS[args.feed]
    if args.step == "set-up":
        create_layer(spark, args.ods, args.ods_path)
        create_layer(spark, args.dwd, args.dwd_path)
        jobs.set_up(spark, specs, args.ods, args.dwd, cleaned=args.feed != "manufacturing")
    elif args.step == "extract":
        conn = Connection(args.url, args.driver)
        specs = adjusted(specs, args.split, args.inclusive)
        splits = {s.source: s.split for s in specs}
        jobs.extract_feed(
            spark, specs, lambda name: read_table(spark, conn, name, splits[name]), args.ods, args.run_day, args.run_ts, args.keyed)
    elif args.step == "clean":
        jobs.clean_feed(spark, specs, args.ods, args.dwd, args.run_day, args.run_ts)
    elif args.step == "rebuild":
        for spec in specs:
            if not args.table or spec.target in args.table:
                jobs.rebuild_kept(spark, spec, args.dwd)
    else:
        known, names = MEASURES[args.feed], args.name or list(MEASURES[args.feed])
        given = parameters(names, known, args.set)
        if args.results:
            create_layer(spark, args.results)
        for name in names:
            deliver(known[name](spark, args.dwd, **given[name]), name, args)


def main() -> None:
    args = arguments().parse_args()
    spark = build_session(f"lakemill-{args.step}")
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
