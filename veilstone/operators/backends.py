"""Calls of models and other back-ends that may fail or hang: an error costs the rows concerned, never the job."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from typing import Any

log = logging.getLogger("veilstone")


def within(seconds: float | None, call: Callable[..., Any], *args: Any, **more: Any) -> Any:
    """call(*args, **more); TimeoutError if it takes longer. The call then goes on in a thread nobody waits for."""
    if not seconds:
        return call(*args, **more)
    got: list[Any] = []
    failed: list[BaseException] = []

    def run() -> None:
        try:
            got.append(call(*args, **more))
        except BaseException as e:  # noqa: BLE001 - handed to the caller
            failed.append(e)

    t = threading.Thread(target=run, daemon=True)
    t.start()
    t.join(seconds)
    if failed:
        raise failed[0]
    if t.is_alive():
        raise TimeoutError(f"no answer in {seconds} s")
    return got[0]


def each_or_none(call: Callable[[list], list], items: list) -> list:
    """call(items); where that fails, every item by itself, None for those that fail again."""
    if not items:
        return []
    try:
        out = list(call(items))
        if len(out) == len(items):
            return out
        raise ValueError(f"{len(items)} items in, {len(out)} out")
    except Exception as e:  # noqa: BLE001
        log.warning("back-end failed on %d items: %s", len(items), e)
    if len(items) == 1:
        return [None]
    return [x for i in items for x in each_or_none(call, [i])]
