"""What a stage needs of a model: the protocol of a client, its errors, the choice among models and their windows."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

# What answers say when they are blocked, out of quota, or refuse a temperature.
BLOCKED = ("content blocked", "sensitive contain")
QUOTA = ("insufficient_quota", "quota", "配额")
NO_TEMPERATURE = ("temperature",)


class ModelError(RuntimeError):
    """A call that failed; ``again`` tells whether another try or model may help."""

    again = True


class Blocked(ModelError):
    again = False


class Quota(ModelError):
    pass


class BadOutput(ModelError):
    pass


class Congested(ModelError):
    """Too many calls; ``wait`` are the seconds that were asked for, if any."""

    def __init__(self, text: str, wait: float | None = None):
        super().__init__(text)
        self.wait = wait


def error_of(status: int, body: str, wait: float | None = None) -> ModelError:
    """The error that an answer's status and body mean."""
    low = body.lower()
    if any(b in low for b in BLOCKED):
        return Blocked("content blocked")
    if any(q in low for q in QUOTA):
        return Quota(body)
    if status in (429, 502, 503, 504):
        return Congested(f"{status}: {body}", wait)
    return ModelError(f"{status}: {body}")


def rejects_temperature(status: int, body: str) -> bool:
    return status == 400 and any(t in body.lower() for t in NO_TEMPERATURE)


@dataclass(frozen=True)
class Answer:
    text: str
    truncated: bool = False
    prompt_tokens: int = 0
    completion_tokens: int = 0
    model: str = ""


class Client(Protocol):
    """Made in each worker by a factory that Spark can send there."""

    def complete(self, prompt: str, max_tokens: int) -> Answer: ...


class Window:
    """Calls in flight of one model: doubled by each success up to the first congestion, then one more for each full window, halved by congestion."""

    def __init__(self, limit: int, start: int = 1):
        self.limit, self.size, self.flying, self.slow_start = max(1, limit), float(max(1, start)), 0, True
        self._free = threading.Condition()

    @property
    def headroom(self) -> int:
        return int(self.size) - self.flying

    def __enter__(self):
        with self._free:
            self._free.wait_for(lambda: self.headroom > 0)
            self.flying += 1
        return self

    def __exit__(self, kind, error, trace):
        with self._free:
            self.flying -= 1
            if kind is None:
                self.size = min(self.limit, self.size + (1 if self.slow_start else 1 / self.size))
            elif isinstance(error, Congested):
                self.size, self.slow_start = max(1.0, self.size / 2), False
            self._free.notify_all()

    def stats(self) -> dict[str, int]:
        return {"in_flight": self.flying, "limit": int(self.size)}


def retry_delay(attempt: int, asked: float | None = None, chance: Callable[[], float] = random.random) -> float:
    return min(max(asked, 0.0), 30.0) if asked is not None else min(2.0**attempt, 10.0) * (0.75 + 0.5 * chance())


class Chain:
    """Models in order of preference: each call goes to the one with most room, the first of equals; a quota ends a model's turn for good."""

    def __init__(self, models: dict[str, Client], limit: int = 4, retries: int = 3, sleep: Callable[[float], None] = time.sleep):
        self.models, self.retries, self.sleep = dict(models), retries, sleep
        self.windows = {m: Window(limit) for m in models}
        self.spent: set[str] = set()
        self.total = threading.BoundedSemaphore(limit)  # for all models together

    def complete(self, prompt: str, max_tokens: int) -> Answer:
        tried: set[str] = set()
        last: ModelError = ModelError("no model left")
        for attempt in range(self.retries + len(self.models)):
            left = [m for m in self.models if m not in self.spent and m not in tried] or [m for m in self.models if m not in self.spent]
            if not left:
                break
            name = max(left, key=lambda m: self.windows[m].headroom)
            try:
                with self.total, self.windows[name]:
                    return self.models[name].complete(prompt, max_tokens)
            except Quota as e:
                self.spent.add(name)
                last = e
            except ModelError as e:
                last = e
                if not e.again:
                    break
                tried.add(name)
                if not [m for m in self.models if m not in self.spent and m not in tried]:
                    tried.clear()
                    self.sleep(retry_delay(attempt, getattr(e, "wait", None)))
        raise last

    def stats(self) -> dict[str, int]:
        every = [w.stats() for w in self.windows.values()]
        return {k: sum(s[k] for s in every) for k in ("in_flight", "limit")}


def first_of(names: Sequence[str], spent: set[str]) -> str | None:
    return next((n for n in names if n not in spent), None)
