"""Steps that depend on each other, run as soon as they can be, several at a time."""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass


@dataclass(frozen=True)
class Step:
    run: Callable[[], object]
    after: tuple[str, ...] = ()


def run_steps(steps: Mapping[str, Step], parallel: int = 4) -> dict[str, object]:
    """What each step returned. A step starts when all it comes after have ended.

    When a step fails, no other is begun; those that run are waited for, and then its error is raised. Each
    step is a thread that plans and starts Spark jobs; Spark shares the cluster between them.
    """
    if unknown := {name for step in steps.values() for name in step.after} - set(steps):
        raise ValueError(f"steps to wait for that don't exist: {sorted(unknown)}")
    done: dict[str, object] = {}
    running: dict[Future, str] = {}
    waiting = dict(steps)
    error: BaseException | None = None
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while waiting or running:
            if error is None:
                for name in [n for n, step in waiting.items() if all(a in done for a in step.after)]:
                    # Scratch scopes and the like are the caller's.
                    running[pool.submit(contextvars.copy_context().run, waiting.pop(name).run)] = name
            if not running:
                break
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(ended)
                if ended.exception():
                    error = error or ended.exception()
                else:
                    done[name] = ended.result()
    if error:
        raise error
    if waiting:
        raise ValueError(f"steps that wait for each other: {sorted(waiting)}")
    return done
