"""Stage runner: stages that are done are skipped, failures recorded, state saved after each stage."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path


def run_id(**fields) -> str:
    return hashlib.sha256(json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


@dataclass
class Stage:
    name: str
    status: str = "pending"
    config_sha256: str = ""
    error: str | None = None
    started_at: str | None = None
    finished_at: str | None = None
    outputs: list[str] = field(default_factory=list)


@dataclass
class Run:
    run_id: str
    stages: dict[str, Stage] = field(default_factory=dict)

    def save(self, folder: Path) -> None:
        folder.mkdir(parents=True, exist_ok=True)
        fresh = folder / "run.json.new"
        fresh.write_text(json.dumps(asdict(self), ensure_ascii=False, indent=1))
        fresh.replace(folder / "run.json")


def load_run(folder: Path) -> Run | None:
    path = folder / "run.json"
    if not path.exists():
        return None
    data = json.loads(path.read_text())
    return Run(data["run_id"], {k: Stage(**v) for k, v in data["stages"].items()})


def execute(folder: Path, name: str, stages: list[tuple[str, Callable[[], list[str]], str]], *, force: bool = False) -> Run:
    """Runs (name, function, config hash) in turn. A run of another id starts afresh; a failed stage is raised again."""
    run = load_run(folder)
    if run is None or run.run_id != name:
        run = Run(name)
    now = lambda: datetime.now(UTC).isoformat()
    for stage, work, config in stages:
        state = run.stages.setdefault(stage, Stage(stage))
        if state.status == "done" and not force:
            continue
        run.stages[stage] = state = Stage(stage, "running", config, started_at=now())
        run.save(folder)
        try:
            state.outputs = work()
            state.status = "done"
        except Exception as e:
            state.status, state.error = "failed", f"{type(e).__name__}: {e}"
            raise
        finally:
            state.finished_at = now()
            run.save(folder)
    return run
