"""Runs one report over raw input files: ``python -m sparktally REPORT INPUT OUTPUT``.

Under ``spark-submit`` the master and resources come from its own arguments.
"""

from __future__ import annotations

import argparse
from inspect import signature

from sparktally.plans.programs import FOLDER_PROGRAMS, PROGRAMS
from sparktally.session import build_session
from sparktally.sources.published import publish
from sparktally.sources.writers import run_folder, write_parquet, write_tab_separated

def yes_or_no(text: str) -> bool:
    if text not in ("yes", "no"):
        raise argparse.ArgumentTypeError("yes or no")
    return text == "yes"


REPORTS = {**PROGRAMS, **FOLDER_PROGRAMS}
# Published results are text with a manifest, in place only when they are whole.
WRITERS = {"text": write_tab_separated, "parquet": write_parquet, "published": publish}

PARAMETERS = {
    "k": int,
    "min_length": int,
    "min_count": int,
    "stop": str,
    "room_type": str,
    "zones": str,
    "files": str,
    "keep_zero": yes_or_no,
    "multi_line": yes_or_no,
    "tasks": int,
}


def main(arguments: list[str] | None = None) -> str:
    """Runs the report and returns the folder of its result."""
    parser = argparse.ArgumentParser(prog="sparktally", description=__doc__)
    parser.add_argument("report", choices=sorted(REPORTS))
    parser.add_argument("input", help="input folder")
    parser.add_argument("output", help="folder that gets a fresh folder for this run")
    parser.add_argument("--format", choices=sorted(WRITERS), default="text")
    for name, kind in PARAMETERS.items():
        parser.add_argument(f"--{name}", type=kind)
    options = vars(parser.parse_args(arguments))

    given = {name: options[name] for name in PARAMETERS if options[name] is not None}
    known = signature(REPORTS[options["report"]]).parameters
    for name in given.keys() - known.keys():
        parser.error(f"{options['report']} has no --{name}")
    for name, parameter in list(known.items())[2:]:
        if parameter.default is parameter.empty and name not in given:
            parser.error(f"{options['report']} needs --{name}")
    spark = build_session(f"sparktally {options['report']}")
    rows = REPORTS[options["report"]](spark, options["input"], **given)
    folder = run_folder(options["output"], options["report"])
    WRITERS[options["format"]](rows, folder)
    return folder


def run() -> None:
    print(main())


if __name__ == "__main__":
    run()
