"""The seam to a model: a completion, its cost, and what is read from its answer. The model itself is a function the caller gives."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What an answer says that was refused for its rate.
RATE_MARKS = ["rate limit", "rate_limit", "rate-limit", "ratelimit", "overloaded", "temporarily limiting", "429", "too many requests", "limiting requests"]


_CHOICE = re.compile(r"(same-as|contradicts)(?:-([0-9]+))?")


@dataclass
class Completion:
    text: str
    model: str = ""
    cost_usd: float | None = None
    input_tokens: int = 0
    output_tokens: int = 0


Completer = Callable[[str, str], Completion]


def cost_of(c: Completion, per_input: float = 0.0, per_output: float = 0.0) -> float:
    """The reported cost, else tokens times price."""
    return c.cost_usd if c.cost_usd is not None else c.input_tokens * per_input + c.output_tokens * per_output


def json_object(text: str) -> dict | None:
    """The outermost object of an answer, fence or not; None where there is none."""
    low, high = text.find("{"), text.rfind("}")
    try:
        found = json.loads(text[low : high + 1]) if 0 <= low < high else None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def verdict(answer: dict | None, shown: int) -> tuple[str, int]:
    """(same-as | contradicts | none, n): everything but a choice among the `shown` candidates is none.

    The choice stands in the verdict (`same-as-2`) or beside it (`{"verdict": "same-as", "candidate": 2}`)."""
    answer = answer if isinstance(answer, dict) else {}
    said, beside = answer.get("verdict"), answer.get("candidate")
    found = _CHOICE.fullmatch(said.strip().lower()) if isinstance(said, str) else None
    if not found:
        return "none", 0
    number = int(found[2]) if found[2] else beside if type(beside) is int else 0
    return (found[1], number) if 1 <= number <= shown else ("none", 0)


def rate_limited(text: str) -> bool:
    return any(m in text.lower() for m in RATE_MARKS)


def patient(completer: Completer, retries: int = 2, rate_retries: int = 6, backoff: float = 2.0, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Completer:
    """`completer` with a second chance: a refusal for its rate waits twice as long each time, up to `longest` seconds and
    `rate_retries` times; any other error is tried `retries` times more, the wait growing by `backoff`."""

    def call(system: str, prompt: str) -> Completion:
        plain = slow = 0
        while True:
            try:
                return completer(system, prompt)
            except Exception as e:
                if rate_limited(str(e)):
                    if slow >= rate_retries:
                        raise
                    sleep(min(longest, backoff * 2**slow))
                    slow += 1
                else:
                    if plain >= retries:
                        raise
                    plain += 1
                    sleep(backoff * plain)

    return call


def complete(df: DataFrame, key: str, system: str, prompt: str, completer: Completer, tasks: int = 4) -> DataFrame:
    """(key, answer, cost_usd, error): a call for each row, at most `tasks` at once; an error stays with its row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, p in zip(batch[key], batch["_prompt"]):
                try:
                    c = completer(system, p)
                    rows.append((k, c.text, cost_of(c), None))
                except Exception as e:
                    rows.append((k, None, 0.0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "answer", "cost_usd", "error"])

    return df.select(key, F.col(prompt).alias("_prompt")).coalesce(tasks).mapInPandas(run, f"{key} {kind}, answer string, cost_usd double, error string")
