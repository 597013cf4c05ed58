"""Waiting for streaming queries, and surfacing their failures."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


POLL_SECONDS = 0.2


def _raise_failure(query: StreamingQuery) -> None:
    exc = query.exception()
    if exc is not None:
        raise exc


def run_stream(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Block until ``query`` ends (or ``timeout`` seconds pass); re-raise its failure.

    Returns True when the query has ended.
    """
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    ended = True if ended is None else ended
    _raise_failure(query)
    return bool(ended)


def run_streams(
    spark: SparkSession,
    queries: Sequence[StreamingQuery],
    timeout: float | None = None,
    until: str = "all",
) -> bool:
    """Wait for several queries of one session.

    ``until='all'`` waits for every query (a failure of any is raised at once);
    ``until='any'`` returns as soon as one of ``queries`` ends (queries of
    the session that are not listed do not count).  A failed query is re-raised
    and the others are stopped.
    """
    try:
        if until == "any":
            # Watch only these queries: the session-wide awaitAnyTermination
            # also returns for any query of the session that ended earlier.
            deadline = None if timeout is None else time.monotonic() + timeout
            while True:
                for q in queries:
                    if not q.isActive:
                        _raise_failure(q)
                        return True
                if deadline is not None and time.monotonic() >= deadline:
                    return False
                queries[0].awaitTermination(POLL_SECONDS)
        if until != "all":
            raise ValueError("until must be 'all' or 'any'")
        deadline = None if timeout is None else time.monotonic() + timeout
        while True:
            for q in queries:  # a failure counts at once, whatever the order
                if not q.isActive:
                    _raise_failure(q)
            active = [q for q in queries if q.isActive]
            if not active:
                for q in queries:
                    _raise_failure(q)
                return True
            if deadline is not None and time.monotonic() >= deadline:
                return False
            active[0].awaitTermination(POLL_SECONDS)
    except Exception:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


@dataclass(frozen=True)
class Part:
    """One query of several that run at once: its name, how it is started, and the parts that read what it writes."""

    name: str
    start: Callable[[], StreamingQuery]
    feeds: tuple[str, ...] = ()


def upstream_first(parts: Sequence[Part]) -> list[Part]:
    """The parts, each before those that it feeds; raises for unknown names, repeated names and circles."""
    by_name = {p.name: p for p in parts}
    unknown = {f for p in parts for f in p.feeds} - by_name.keys()
    if len(by_name) < len(parts) or unknown:
        raise ValueError(f"parts need names of their own, and feed listed ones only{f', not {sorted(unknown)}' if unknown else ''}")
    order: list[Part] = []
    while len(order) < len(parts):
        done = {p.name for p in order}
        free = [p for p in parts if p.name not in done and not any(p.name in q.feeds for q in parts if q.name not in done)]
        if not free:
            raise ValueError("parts feed each other in a circle")
        order += free
    return order


def _first_failure(queries: dict[str, StreamingQuery]) -> None:
    for name, q in queries.items():
        exc = None if q.isActive else q.exception()
        if exc is not None:
            exc.add_note(f"query {name!r} failed; the queries that ran beside it were stopped")
            raise exc


def _drain(name: str, queries: dict[str, StreamingQuery], deadline: float | None) -> None:
    """Wait until a query has written all that its sources hold, with an eye on the others."""
    waiting = threading.Thread(target=_until_idle, args=(queries[name],), daemon=True)
    waiting.start()
    while waiting.is_alive():
        _first_failure(queries)
        if deadline is not None and time.monotonic() >= deadline:
            raise TimeoutError(f"query {name!r} still has input")
        waiting.join(POLL_SECONDS)
    _first_failure(queries)


def _until_idle(query: StreamingQuery) -> None:
    try:
        query.processAllAvailable()
    except Exception:  # noqa: BLE001  the query keeps it, and _first_failure raises it
        return


def run_parts(parts: Sequence[Part], drain: bool = True, timeout: float | None = None) -> dict[str, StreamingQuery]:
    """Run several queries of one session at once, until they have nothing left or one fails.

    Readers are started before the queries that feed them, so that they miss no message.  ``drain``: a query that feeds others is waited
    for first, until it has written all that its sources hold; then its readers, whose input is whole by then.  Without it the queries run until
    they end, or for ``timeout`` seconds.  The first failure of any query (also one while starting) is raised with its name.  In each case no query
    is left running: they are stopped upstream first.  Draining longer than ``timeout`` raises TimeoutError.  Returns the
    queries by name, for their progress.
    """
    order = upstream_first(parts)
    deadline = None if timeout is None else time.monotonic() + timeout
    queries: dict[str, StreamingQuery] = {}
    try:
        for part in reversed(order):
            queries[part.name] = part.start()
            _first_failure(queries)
        if drain:
            for part in order:
                _drain(part.name, queries, deadline)
        while not drain and any(q.isActive for q in queries.values()):
            _first_failure(queries)
            if deadline is not None and time.monotonic() >= deadline:
                break
            time.sleep(POLL_SECONDS)
        _first_failure(queries)
    finally:
        for part in order:
            if part.name in queries:
                queries[part.name].stop()
    return queries
