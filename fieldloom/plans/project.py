"""Projects: dated versions of runs, the current one, a history, and a saved metadata profile."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import shutil
from collections.abc import Callable
from dataclasses import dataclass

from ..functions.columns import slugify

#: What a finished run must have written; columns of the history; fields of the saved profile.
REQUIRED = ("data_dictionary.xlsx", "data_dictionary.json", "metadata.xlsx", "metadata.json", "metadata_report.html", "open_science_metadata_report.html", "artifact_manifest.csv")
HISTORY = ("run_id", "completed_utc", "project_name", "project_slug", "mode", "comment", "version_directory", "became_current")
PROFILE = ("project_description", "author", "license", "access_classification", "access_permissions", "tags")


@dataclass
class Version:
    project: str
    root: str
    mode: str = "version"
    comment: str = ""

    def __post_init__(self) -> None:
        if self.mode not in ("version", "replace"):
            raise ValueError("mode must be version or replace")
        self.slug = slugify(self.project, "project", "-")
        self.folder = os.path.join(os.path.abspath(os.path.expanduser(self.root)), self.slug)
        stamp, k = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H%M%SZ"), 0
        self.run_id = stamp
        while os.path.lexists(self.path):
            k += 1
            self.run_id = f"{stamp}-{k:02d}"

    @property
    def path(self) -> str:
        return os.path.join(self.folder, "versions", self.run_id)

    @property
    def profile(self) -> str:
        return os.path.join(self.folder, "project_metadata.yml")

    def promoted(self) -> bool:
        """Points `current` here if there is none yet or the mode asks for it; earlier versions stay."""
        link, pointer = os.path.join(self.folder, "current"), os.path.join(self.folder, "current.txt")
        if (os.path.lexists(link) or os.path.exists(pointer)) and self.mode != "replace":
            return False
        if os.path.lexists(link) and not os.path.islink(link):
            raise FileExistsError(f"{link} isn't a link; it is left alone")
        target = f"versions/{self.run_id}"
        os.symlink(target, link + ".new")
        os.replace(link + ".new", link)
        with open(pointer, "w", encoding="utf-8") as f:
            f.write(target + "\n")
        return True

    def recorded(self, current: bool) -> None:
        path = os.path.join(self.folder, "run_history.csv")
        fresh = not os.path.exists(path)
        done = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        with open(path, "a", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\n")
            if fresh:
                out.writerow(HISTORY)
            out.writerow((self.run_id, done, self.project, self.slug, self.mode, self.comment, self.path, str(current).lower()))


def launch(version: Version, job: Callable[[str, str | None], object]) -> bool:
    """Runs job(output folder, saved profile or None), checks its artifacts, promotes and records it; whether it became current."""
    os.makedirs(os.path.dirname(version.path), exist_ok=True)
    job(version.path, version.profile if os.path.exists(version.profile) else None)
    absent = [name for name in REQUIRED if not os.path.isfile(p := os.path.join(version.path, name)) or not os.path.getsize(p)]
    if absent:
        raise FileNotFoundError(f"missing or empty: {', '.join(absent)}; what was written stays in {version.path}")
    current = version.promoted()
    version.recorded(current)
    return current


def _scalar(x: object) -> str:
    text = "" if x is None else str(x).strip()
    return "" if text.upper() == "NA" else text


def read_profile(path: str, as_json: bool = False) -> dict[str, str] | str:
    """The saved metadata, empty texts for what is absent; tags joined by commas."""
    import yaml

    saved: dict = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            saved = (yaml.safe_load(f) or {}).get("metadata") or {}
    tags = saved.get("tags") or []
    out = {k: _scalar(saved.get(k)) for k in PROFILE[:-1]} | {"tags": ", ".join(map(_scalar, [tags] if isinstance(tags, str) else tags))}
    return json.dumps(out, ensure_ascii=False) if as_json else out


def write_profile(path: str, project_name: str, values: dict[str, str]) -> None:
    """Replaces the metadata in the profile, in one step; the former file is kept as .previous."""
    import yaml

    saved: dict = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            saved = yaml.safe_load(f) or {}
    tags = [t for t in dict.fromkeys(map(_scalar, values.get("tags", "").split(","))) if t]
    own = {"project_name": _scalar(project_name)} | {k: _scalar(values.get(k)) for k in PROFILE[:-1]} | {"tags": tags}
    saved["metadata"] = (saved.get("metadata") or {}) | own
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path + ".new", "w", encoding="utf-8") as f:
        yaml.safe_dump(saved, f, sort_keys=False, allow_unicode=True)
    if os.path.exists(path):
        base, ext = os.path.splitext(path)
        shutil.copy2(path, f"{base}.previous{ext}" if ext.lower() in (".yml", ".yaml") else path + ".previous")
    os.replace(path + ".new", path)
