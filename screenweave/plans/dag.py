"""A graph of steps: order, what follows from a step, and runs in sequence or side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Step:
    name: str
    work: Callable[[], object]
    needs: tuple[str, ...] = ()
    done: Callable[[], bool] = field(default=lambda: False)


class Graph:
    """Steps by name in the order of registration. Needs that aren't registered count as met."""

    def __init__(self, steps: Iterable[Step] = ()):
        self.steps: dict[str, Step] = {}
        for s in steps:
            self.add(s)

    def add(self, step: Step) -> None:
        if step.name in self.steps:
            raise ValueError(f"{step.name} is there already")
        self.steps[step.name] = step

    def needs(self, name: str) -> list[str]:
        return [n for n in self.steps[name].needs if n in self.steps]

    def order(self, names: Iterable[str] | None = None) -> list[str]:
        """Every step after what it needs; of those that are free, the one registered first."""
        left = [n for n in self.steps if names is None or n in set(names)]
        out: list[str] = []
        while left:
            free = next((n for n in left if not any(m in left for m in self.needs(n))), None)
            if free is None:
                raise ValueError(f"the steps need each other: {', '.join(left)}")
            left.remove(free)
            out.append(free)
        return out

    def downstream(self, *names: str) -> list[str]:
        """These steps and all that need them, directly or not, in order."""
        found = set(names)
        while more := {n for n in self.steps if n not in found and found & set(self.needs(n))}:
            found |= more
        return self.order(found)

    def run(self, names: Iterable[str] | None = None, force: bool = False, workers: int = 1) -> dict[str, str]:
        """done, skipped, failed or blocked by step. Steps whose outputs are complete are skipped; those after a failed one are blocked."""
        todo, state = self.order(names), {}
        running: dict[Future, str] = {}
        with ThreadPoolExecutor(max(1, workers)) as pool:
            while todo or running:
                for n in list(todo):
                    before = [state.get(m) for m in self.needs(n) if m in todo or m in state or m in running.values()]
                    if any(s in ("failed", "blocked") for s in before):
                        todo.remove(n)
                        state[n] = "blocked"
                    elif all(s in ("done", "skipped") for s in before) and len(running) < workers:
                        todo.remove(n)
                        if not force and self.steps[n].done():
                            state[n] = "skipped"
                        else:
                            running[pool.submit(self.steps[n].work)] = n
                if running:
                    for f in wait(running, return_when=FIRST_COMPLETED).done:
                        state[running.pop(f)] = "failed" if f.exception() else "done"
        return state
