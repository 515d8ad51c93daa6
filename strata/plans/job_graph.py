"""Jobs of a run in the order of their inputs.

A job is submitted as soon as the jobs it reads from are done; Spark runs what
is submitted together.  A job whose input failed is not run: it is ``blocked``
and names the input, so that no table is built from one of an earlier run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

Name = tuple[str, str]  # layer, table

#: Statuses after which jobs that read from a table may run.
READABLE = ("ok", "skipped_empty")


@dataclass(frozen=True)
class Job:
    layer: str
    table: str
    run: Callable[[], dict]
    inputs: tuple[Name, ...] = field(default=())

    @property
    def name(self) -> Name:
        return self.layer, self.table


def status_row(layer: str, table: str, status: str, rows: int | None = None, seconds: float = 0.0, error: str | None = None) -> dict:
    return {"layer": layer, "table": table, "status": status, "rows": rows, "seconds": seconds, "error": error}


def _tried(job: Job) -> dict:
    t0 = time.perf_counter()
    try:
        return job.run()
    except Exception as e:  # noqa: BLE001 - one failure does not stop the run
        return status_row(job.layer, job.table, "failed", seconds=time.perf_counter() - t0, error=f"{type(e).__name__}: {e}")


def run_jobs(jobs: Iterable[Job], workers: int = 1, done: Mapping[Name, dict] | None = None) -> list[dict]:
    """Run the jobs, ``workers`` at a time, each after its inputs; one status row a job, in the given order.

    ``done`` holds rows of an earlier run: a job with a readable one is taken
    over unless an input of it runs anew.  Inputs that are neither jobs nor
    done are taken to exist.  A circle of inputs is an error.
    """
    jobs = list(jobs)
    by_name = {j.name: j for j in jobs}
    rows: dict[Name, dict] = {}
    waiting = dict(by_name)
    kept = {n: r for n, r in (done or {}).items() if n in by_name and r["status"] in READABLE}
    while True:  # what reads from a job that runs anew runs anew
        stale = [n for n in kept if any(i in by_name and i not in kept for i in by_name[n].inputs)]
        if not stale:
            break
        for n in stale:
            del kept[n]
    for n, r in kept.items():
        rows[n] = r
        del waiting[n]
    running: dict[Future, Name] = {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        while waiting or running:
            before = len(waiting)
            for n, job in list(waiting.items()):
                known = [rows.get(i) for i in job.inputs if i in by_name]
                bad = next((r for r in known if r is not None and r["status"] not in READABLE), None)
                if bad is not None:
                    rows[n] = status_row(*n, "blocked", error=f"input {bad['layer']}/{bad['table']} is {bad['status']}")
                elif all(r is not None for r in known):
                    running[pool.submit(_tried, job)] = n
                else:
                    continue
                del waiting[n]
            if running:
                finished, _ = wait(running, return_when=FIRST_COMPLETED)
                for f in finished:
                    rows[running.pop(f)] = f.result()
            elif len(waiting) == before and waiting:
                raise ValueError(f"inputs in a circle: {sorted(waiting)}")
    return [rows[j.name] for j in jobs]
