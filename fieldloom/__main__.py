"""Command line: `python -m fieldloom run|project|list|profile`. Settings are given by their names, as in --max-categorical-levels 20."""

from __future__ import annotations

import argparse
import os
import sys

from .config import DEFAULTS
from .plans.pipelines import known, resolved
from .plans.project import PROFILE, Version, launch, read_profile, write_profile

#: Other names by which settings are known.
ALIASES = {"use_variable_label_as_definition": "use_label_as_definition"}
_LISTS = ("excel_sheets", "r_objects", "tags")


def flag(text: str) -> bool:
    low = text.strip().lower()
    if low not in ("true", "t", "1", "yes", "y", "on", "false", "f", "0", "no", "n", "off"):
        raise argparse.ArgumentTypeError(f"{text!r} is neither true nor false")
    return low in ("true", "t", "1", "yes", "y", "on")


def parts(values: list[str]) -> list[str]:
    """Repeated and comma-separated values; a path that exists is taken whole."""
    return [p.strip() for v in values for p in ([v] if os.path.exists(v) else v.split(",")) if p.strip()]


def _settings(p: argparse.ArgumentParser) -> None:
    for section, own in DEFAULTS.items():
        for key, default in own.items():
            kind = flag if isinstance(default, bool) else int if isinstance(default, int) or key == "n_max" else float if isinstance(default, float) else str
            if isinstance(default, list) and key not in _LISTS:
                continue
            names = [f"--{n.replace('_', '-')}" for n in (key, *(a for a, k in ALIASES.items() if k == key))]
            more = {"action": "append"} if key in _LISTS else {"type": kind, "nargs": "?", "const": True} if kind is flag else {"type": kind}
            p.add_argument(*names, dest=f"{section}.{key}", default=None, help=argparse.SUPPRESS, **more)


def overrides(args: argparse.Namespace) -> dict:
    """Only the settings that were given, by section."""
    out: dict = {}
    for name, value in vars(args).items():
        section, dot, key = name.partition(".")
        if dot and value is not None:
            if key in _LISTS:
                value = parts(value)
                value = "all" if key != "tags" and [v.lower() for v in value] == ["all"] else value
            out.setdefault(section, {})[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("fieldloom", description=__doc__, allow_abbrev=False)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="pipelines").add_argument("--registry", help="YAML file that lists further pipelines")
    one = sub.add_parser("run", help="files to artifacts in a folder", allow_abbrev=False)
    many = sub.add_parser("project", help="a dated version of a project", allow_abbrev=False)
    for q in (one, many):
        q.add_argument("--pipeline", default="data_dictionary")
        q.add_argument("--registry", help="YAML file that lists further pipelines")
        q.add_argument("--input", action="append", required=True)
        q.add_argument("--config")
        _settings(q)
    one.add_argument("--output", default=os.path.join("outputs", "data_dictionary"))
    many.add_argument("--project", required=True)
    many.add_argument("--output-root", default="outputs")
    many.add_argument("--mode", default="version", choices=("version", "replace"))
    many.add_argument("--comment", default="")
    many.add_argument("--dry-run", action="store_true")
    kept = sub.add_parser("profile", help="read or write a project's saved metadata")
    kept.add_argument("action", choices=("read", "read-json", "write"))
    kept.add_argument("path")
    for name in ("project_name", *PROFILE):
        kept.add_argument(f"--{name.replace('_', '-')}", default="")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "list":
        print("\n".join(f"{k}: {p.description or p.title}{'' if p.enabled else ' (switched off)'}" for k, p in known(args.registry).items()))
        return 0
    if args.command == "profile":
        if args.action == "write":
            write_profile(args.path, args.project_name, {k: getattr(args, k) for k in PROFILE})
            print(os.path.abspath(args.path))
        else:
            found = read_profile(args.path, args.action == "read-json")
            print(found if isinstance(found, str) else "\n".join(found.values()))
        return 0
    given, inputs, entry = overrides(args), parts(args.input), resolved(args.pipeline, args.registry).load()

    def job(output: str, saved: str | None) -> None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("fieldloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        entry(spark, inputs, output, args.config or saved, given)

    if args.command == "run":
        job(args.output, None)
        print(os.path.abspath(args.output))
        return 0
    version = Version(args.project, args.output_root, args.mode, args.comment)
    given["metadata"] = {"project_name": args.project} | ({"run_comment": args.comment} if args.comment else {}) | given.get("metadata", {})
    if args.dry_run:
        print(f"would write {version.path} from {', '.join(inputs)}; nothing was changed")
        return 0
    current = launch(version, job)
    print(f"{version.path} ({'current' if current else 'the current version is unchanged'})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
