"""Calls to a service that may refuse for a while."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from ..functions.scores import backoff

#: () -> (HTTP status, seconds of its Retry-After header or None, body); raises OSError where the network fails.
Send = Callable[[], tuple[int, float | None, object]]


class Refused(RuntimeError):
    """The service won't take this call however often it is made: a bad key (401) or a bad request (400)."""


def with_retries(
    send: Send, attempts: int = 5, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random,
    notify: Callable[[str], None] | None = None,
) -> object | None:
    """The body of an answer 200; None after ``attempts`` tries that were overload, server or network errors.

    These are tried again after ``backoff``'s wait. 400 and 401 raise ``Refused`` at once; any other answer is None at
    once. ``notify`` gets a line on every failure.
    """
    say = notify or (lambda _: None)
    for n in range(attempts):
        try:
            status, after, body = send()
        except OSError as error:
            status, after, body = None, None, str(error)
        if status == 200:
            return body
        say(f"attempt {n + 1} of {attempts}: {status or 'network'} {str(body or '')[:200]}".rstrip())
        if status in (400, 401):
            raise Refused(f"answer {status}: {str(body or '')[:200]}")
        if status is not None and status != 429 and status < 500:
            return None
        if n + 1 < attempts:
            sleep(backoff(n, status, after, jitter()))
    return None
