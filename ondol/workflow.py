"""Runs workflows: tasks in order with retries and time limits, one run at a time, a history of JSON lines, a notification.

A task is a command; state passes between tasks through tables only. Exit codes: 0 done, 75 another run holds the lock, 124 a
time limit, 143 interrupted, else that of the task that failed.
"""

from __future__ import annotations

import fcntl
import json
import os
import signal
import smtplib
import subprocess
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from email.message import EmailMessage
from pathlib import Path

LOCKED, TIMED_OUT, INTERRUPTED = 75, 124, 143


@dataclass(frozen=True)
class Task:
    name: str
    command: tuple[str, ...]


@dataclass(frozen=True)
class Workflow:
    name: str
    tasks: tuple[Task, ...]
    retries: int = 1
    retry_delay: float = 300.0
    task_limit: float = 14_400.0
    run_limit: float = 18_000.0


def _cli(*words: str) -> tuple[str, ...]:
    return sys.executable, "-m", "ondol.cli", *words


WORKFLOWS = {
    w.name: w
    for w in (
        Workflow("full", (Task("transform", _cli("transform")), Task("load", _cli("load")), Task("validate", _cli("validate")))),
        Workflow("cleanup", (Task("mark-stale", _cli("cleanup", "mark-stale")), Task("purge-pages", _cli("cleanup", "purge-pages"))), retries=2),
    )
}


class History:
    """Two records a run, when it starts and when it ends, as lines of JSON."""

    def __init__(self, path: str | Path):
        self.path = Path(path)

    def record(self, **values: object) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        with self.path.open("a", encoding="utf-8") as f:
            f.write(json.dumps(values, default=str) + "\n")

    def last(self, n: int = 20) -> list[dict]:
        """The last n lines, oldest first."""
        return [json.loads(x) for x in self.path.read_text(encoding="utf-8").splitlines()[-n:]] if self.path.exists() else []

    def status(self, name: str) -> dict | None:
        """The last record of a workflow."""
        return next((r for r in reversed(self.last(1 << 30)) if r.get("dag_id") == name), None)


def mail(subject: str, text: str) -> bool:
    """Sends a message if both a receiver and a host are set (ONDOL_MAIL_TO, ONDOL_MAIL_HOST); says whether it did."""
    to, host = os.environ.get("ONDOL_MAIL_TO"), os.environ.get("ONDOL_MAIL_HOST")
    if not to or not host:
        return False
    m = EmailMessage()
    m["Subject"], m["To"], m["From"] = subject, to, os.environ.get("ONDOL_MAIL_FROM", to)
    m.set_content(text)
    with smtplib.SMTP(host, int(os.environ.get("ONDOL_MAIL_PORT", "25"))) as s:
        s.send_message(m)
    return True


def _attempt(task: Task, log: Path, limit: float) -> int:
    with log.open("ab") as out:
        p = subprocess.Popen(task.command, stdout=out, stderr=subprocess.STDOUT, start_new_session=True)
        try:
            return p.wait(timeout=max(0.0, limit))
        except subprocess.TimeoutExpired:
            code = TIMED_OUT
        except KeyboardInterrupt:
            code = INTERRUPTED
        os.killpg(p.pid, signal.SIGTERM)
        try:
            p.wait(timeout=10)
        except subprocess.TimeoutExpired:
            os.killpg(p.pid, signal.SIGKILL)
            p.wait()
        return code


@dataclass
class Runner:
    root: Path
    notify: Callable[[str, str], object] = mail
    sleep: Callable[[float], None] = time.sleep
    attempts: list[dict] = field(default_factory=list)

    def run(self, workflow: Workflow) -> int:
        """Runs the tasks until one fails for good; each task has a log file."""
        self.root.mkdir(parents=True, exist_ok=True)
        with (self.root / f"{workflow.name}.lock").open("w") as lock:
            try:
                fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError:
                return LOCKED
            return self._locked(workflow)

    def _locked(self, workflow: Workflow) -> int:
        history, began = History(self.root / "history.jsonl"), datetime.now(UTC)
        run_id = f"scheduled__{began.isoformat()}"
        logs = self.root / "logs" / workflow.name / began.strftime("%Y%m%dT%H%M%S%f")
        logs.mkdir(parents=True)
        known = {"dag_id": workflow.name, "run_id": run_id, "started_at": began.isoformat(), "log_path": str(logs)}
        history.record(**known, status="running", tasks=[])
        self.attempts, code, ends = [], 0, time.monotonic() + workflow.run_limit
        for task in workflow.tasks:
            for n in range(1, workflow.retries + 2):
                left = ends - time.monotonic()
                code = _attempt(task, logs / f"{task.name}.log", min(workflow.task_limit, left)) if left > 0 else TIMED_OUT
                self.attempts.append({"name": task.name, "attempt": n, "exit_code": code})
                if code == 0 or code == INTERRUPTED or ends <= time.monotonic() or n > workflow.retries:
                    break
                self.sleep(workflow.retry_delay)
            if code:
                break
        status = "success" if code == 0 else "failed"
        history.record(**known, status=status, finished_at=datetime.now(UTC).isoformat(), tasks=self.attempts)
        if code:
            self.notify(f"{workflow.name} {status}", json.dumps(self.attempts))
        return code
