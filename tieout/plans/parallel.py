"""Submit independent Spark jobs concurrently from a small thread pool.

Spark schedules jobs from several driver threads at once; independent marts
and checks then overlap instead of queueing, the way a model DAG runs with
several threads. Each callable runs its own job(s); results come back keyed
by name, with the wall time each took.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any


def run_concurrently(tasks: Mapping[str, Callable[[], Any]], threads: int = 8) -> tuple[dict[str, Any], dict[str, float]]:
    results: dict[str, Any] = {}
    seconds: dict[str, float] = {}

    def timed(name: str, fn: Callable[[], Any]):
        t0 = time.time()
        out = fn()
        return name, out, time.time() - t0

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = [pool.submit(timed, n, f) for n, f in tasks.items()]
        for fut in futures:
            name, out, sec = fut.result()
            results[name] = out
            seconds[name] = round(sec, 3)
    return results, seconds
