"""A lease queue as stateful streaming: claims, outcomes and lease ends by task, under a fence."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

#: Requests: enqueue; claim (token, lease end); finish (token, status). Answers: accepted or the reason of refusal.
REQUEST = "task_key string, seq long, at double, action string, token string, lease_until double, status string"
ANSWER = "task_key string, seq long, action string, answer string, status string, attempts int"
STATE = "status string, token string, lease_until double, attempts int"


def apply(state: tuple, request) -> tuple[tuple, str]:
    """(state after, answer) of one request; a lease that has ended counts for nothing."""
    status, token, until, attempts = state
    if status == "running" and until <= request.at:
        status, token, until = "retry", None, 0.0
    held = status == "running" and token == request.token
    match request.action:
        case "enqueue":
            return ((status or "pending", token, until, attempts), "accepted" if status is None else "known")
        case "claim" if status in ("pending", "retry"):
            return (("running", request.token, float(request.lease_until), attempts + 1), "accepted")
        case "finish" if held:
            return ((request.status, None, 0.0, attempts), "accepted")
        case "requeue" if status in ("blocked", "partial"):
            return (("pending", None, 0.0, attempts), "accepted")
    return (status, token, until, attempts), "fenced" if request.action == "finish" else "refused"


def _fold(key, frames, state) -> Iterator:
    import pandas as pd

    now = state.get if state.exists else (None, None, 0.0, 0)
    out = []
    requests = pd.concat([*frames]).sort_values("seq")
    for r in requests.itertuples():
        now, answer = apply(now, r)
        out.append((key[0], r.seq, r.action, answer, now[0], now[3]))
    state.update(now)
    yield pd.DataFrame(out, columns=["task_key", "seq", "action", "answer", "status", "attempts"])


def answers(requests: DataFrame) -> DataFrame:
    """The answer to each request (REQUEST columns) of a stream; a task's requests of a batch are taken by seq."""
    return requests.groupBy("task_key").applyInPandasWithState(_fold, ANSWER, STATE, "append", "NoTimeout")
