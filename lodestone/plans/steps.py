"""A runner of steps that skips what hasn't changed.

A step names its inputs, its code and its outputs. It is skipped when the fingerprint of inputs
and code is the one of its last run and its outputs still have the bytes they had then.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from ..sources.sinks import fingerprint, write_if_changed


@dataclass
class Step:
    name: str
    run: Callable[[], list[Path]]
    inputs: list[Path] = field(default_factory=list)
    code: list[Path] = field(default_factory=list)
    default: bool = True


class Manifest:
    def __init__(self, path: Path):
        self.path = Path(path)
        self.seen: dict = json.loads(self.path.read_text()) if self.path.is_file() else {}

    def fresh(self, step: Step) -> bool:
        """Is the last run of the step still good?"""
        last = self.seen.get(step.name)
        outputs = [Path(p) for p in last["outputs"]] if last else []
        return bool(last) and last["inputs"] == fingerprint(step.inputs + step.code) and all(p.is_file() for p in outputs) and last["result"] == fingerprint(outputs)

    def note(self, step: Step, outputs: list[Path]) -> None:
        self.seen[step.name] = {"inputs": fingerprint(step.inputs + step.code), "outputs": sorted(map(str, outputs)), "result": fingerprint(outputs)}
        write_if_changed(self.path, json.dumps(self.seen, sort_keys=True, indent=1).encode())


def chosen(steps: list[Step], only: list[str] | None = None, start: str | None = None, skip: list[str] | None = None) -> list[Step]:
    """Steps to run, in order; those that aren't default run only when named."""
    names = [s.name for s in steps]
    for n in [*(only or []), *(skip or []), *([start] if start else [])]:
        if n not in names:
            raise ValueError(f"no step {n}; there are {', '.join(names)}")
    picked = [s for s in steps if s.name in only] if only else [s for s in steps if s.default]
    if start:
        picked = [s for s in picked if names.index(s.name) >= names.index(start)]
    return [s for s in picked if s.name not in (skip or [])]


def run(steps: list[Step], manifest: Manifest, fresh: bool = False, dry: bool = False) -> list[tuple[str, str, float]]:
    """(step, "ran", "skipped", "planned" or "failed", seconds); stops at the first failure."""
    report = []
    for step in steps:
        began = time.monotonic()
        if dry:
            report.append((step.name, "planned", 0.0))
            continue
        if not fresh and manifest.fresh(step):
            report.append((step.name, "skipped", time.monotonic() - began))
            continue
        try:
            manifest.note(step, step.run())
        except Exception:
            report.append((step.name, "failed", time.monotonic() - began))
            raise
        report.append((step.name, "ran", time.monotonic() - began))
    return report


def main(steps: list[Step], manifest: Path, args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--only", nargs="*")
    p.add_argument("--from", dest="start")
    p.add_argument("--skip", nargs="*")
    p.add_argument("--fresh", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--list", action="store_true")
    a = p.parse_args(args)
    if a.list:
        print("\n".join(s.name for s in steps))
        return 0
    for name, how, seconds in run(chosen(steps, a.only, a.start, a.skip), Manifest(manifest), a.fresh, a.dry_run):
        print(f"{name}: {how} ({seconds:.1f} s)")
    return 0
