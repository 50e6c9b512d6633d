"""Settle a folder of entries as a job of its own.

    python -m adsettle month /data/2024-06 /data/out --kind csv --choose 广点通-北:main=a.xlsx
"""

from __future__ import annotations

import argparse

from adsettle.plans.batch import run_batch
from adsettle.session import get_session


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="adsettle", description="Settle a folder of entries.")
    parser.add_argument("calendar", choices=["week", "month"])
    parser.add_argument("base", help="folder of entries, with the account list beside them")
    parser.add_argument("out", help="folder for results and reports")
    parser.add_argument("--account", help="file name of the account list")
    parser.add_argument("--kind", choices=["xlsx", "csv", "parquet"], default="xlsx")
    parser.add_argument("--lenient", action="store_true", help="bad amounts become missing")
    parser.add_argument("--parallel", type=int, default=1, help="entries at a time")
    parser.add_argument(
        "--choose", action="append", default=[], metavar="ENTRY:ROLE=FILE", help="pick a file"
    )
    options = parser.parse_args(arguments)
    chosen: dict[str, dict[str, str]] = {}
    for choice in options.choose:
        where, equals, name = choice.partition("=")
        entry, colon, role = where.rpartition(":")
        if not equals or not colon:
            parser.error(f"--choose wants ENTRY:ROLE=FILE, not {choice}")
        chosen.setdefault(entry, {})[role] = name
    options.chosen = chosen
    return options


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    run_batch(
        get_session(),
        options.base,
        options.out,
        options.calendar,
        options.chosen,
        options.account,
        options.kind,
        options.lenient,
        options.parallel,
    ).show(truncate=False)


if __name__ == "__main__":
    main()
