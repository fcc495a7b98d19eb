"""From windows of text to events, and from claims to prose, through an injected model.

A window is shown to the model with its lines numbered; the answer names lines, never words, so that the quote of an
event is what the lines hold, byte for byte. Everything a model returns is coerced: what cannot be read is left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marl.functions.seam import Completer, cost_of, json_object

MARKERS = ("surprise", "insight", "research")
#: What an event row has, in order.
FIELDS = ("cleaned_hash", "chunk_start", "chunk_end", "id", "summary", "quote", "span", "markers", "confidence")


def numbered(text: str) -> str:
    return "\n".join(f"{i}: {line}" for i, line in enumerate(text.split("\n"), 1))


def prompt_of(text: str, notes: list[str] = (), mode: str = "transcript") -> str:
    """The message for one window: its mode, what is known beforehand, and its numbered lines."""
    known = "".join(f"- {n}\n" for n in notes)
    return f"MODE {mode}\n" + (f"KNOWN\n{known}" if known else "") + f"LINES\n{numbered(text)}"


def score(value, default: float = 0.0) -> float:
    """A number in [0, 1] of whatever stands there."""
    if isinstance(value, bool):
        return default
    try:
        x = float(value)
    except (TypeError, ValueError):
        return default
    return min(max(x, 0.0), 1.0) if x == x and abs(x) != float("inf") else default


def lines_of(choice, count: int) -> tuple[int, int] | None:
    """First and last line of a choice: a number, a pair, or text such as `3-5`; swapped if reversed, kept within the lines there are."""
    if isinstance(choice, str):
        choice = [int(p) for p in choice.replace("L", "").split("-") if p.strip().isdigit()]
    if isinstance(choice, int) and not isinstance(choice, bool):
        choice = [choice]
    if not isinstance(choice, list) or not 1 <= len(choice) <= 2 or not all(isinstance(n, int) and not isinstance(n, bool) for n in choice) or not count:
        return None
    inside = sorted(min(max(n, 1), count) for n in choice)
    return inside[0], inside[-1]


def candidates(answer: str) -> list[dict]:
    """The event objects of an answer: the list under `events` of its object, or a list by itself."""
    found = json_object(answer)
    listed = found.get("events") if found else None
    if listed is None:
        low, high = answer.find("["), answer.rfind("]")
        try:
            listed = json.loads(answer[low : high + 1]) if 0 <= low < high else []
        except ValueError:
            listed = []
    return [e for e in listed if isinstance(e, dict)] if isinstance(listed, list) else []


def events_of(name: str, start: int, text: str, answer: str) -> list[tuple]:
    """Rows of FIELDS of one window's answer; an event without a summary, without lines, or with a blank quote is left out."""
    lines = text.split("\n")
    at = [start]
    for line in lines:
        at.append(at[-1] + len(line.encode()) + 1)
    out, seen = [], set()
    for e in candidates(answer):
        summary, chosen = e.get("summary"), lines_of(e.get("lines"), len(lines))
        if not isinstance(summary, str) or not summary.strip() or chosen is None:
            continue
        low, high = at[chosen[0] - 1], at[chosen[1]] - 1
        quote = "\n".join(lines[chosen[0] - 1 : chosen[1]])
        marks = e.get("markers") if isinstance(e.get("markers"), dict) else {}
        id_ = hashlib.sha256(f"{name}:{low}:{high}:{summary.strip()}".encode()).hexdigest()[:12]
        if quote.strip() and id_ not in seen:
            seen.add(id_)
            out.append((name, start, start + len(text.encode()), id_, summary.strip(), quote, {"byte_start": low, "byte_end": high}, {m: score(marks.get(m)) for m in MARKERS}, score(e.get("confidence"), 0.5)))
    return out


def extract(windows: DataFrame, completer: Completer, system: str, mode: Column | None = None) -> DataFrame:
    """(cleaned_hash, byte_start, text, cost_usd, error) of windows (cleaned_hash, byte_start, text): one row an event, its JSON as text, or one
    row without text for a window that gave none; an error stays with its window. The shape is that of `run_loop`."""
    rows = windows.select("cleaned_hash", "byte_start", "text", (mode if mode is not None else F.lit("transcript")).alias("mode"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, start, text, kind in batch.itertuples(index=False):
                try:
                    c = completer(system, prompt_of(text or "", mode=kind))
                    found = events_of(name, int(start), text or "", c.text)
                    cost = cost_of(c)
                    told = [json.dumps(dict(zip(FIELDS, e)), ensure_ascii=False) for e in found]
                    out += [(name, start, t, cost if not i else 0.0, None) for i, t in enumerate(told or [None])]
                except Exception as e:
                    out.append((name, start, None, 0.0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["cleaned_hash", "byte_start", "text", "cost_usd", "error"])

    return rows.mapInPandas(run, "cleaned_hash string, byte_start bigint, text string, cost_usd double, error string")


def prose(claims: DataFrame, completer: Completer, system: str) -> DataFrame:
    """(claim_id, why, kind, cost_usd, error) of claims (claim_id, title, quotes): the reason and the kind a model gives; an answer without a reason is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, title, quotes in batch.itertuples(index=False):
                try:
                    listed = "".join(f'- """{q}"""\n' for q in quotes)
                    c = completer(system, f"CLAIM {title}\nEVIDENCE\n{listed}")
                    said = json_object(c.text) or {}
                    why = said.get("why")
                    if not isinstance(why, str) or not why.strip():
                        raise ValueError("no reason in the answer")
                    kind = said.get("kind")
                    out.append((id_, why.strip(), kind if isinstance(kind, str) else None, cost_of(c), None))
                except Exception as e:
                    out.append((id_, None, None, 0.0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["claim_id", "why", "kind", "cost_usd", "error"])

    quotes = F.coalesce(F.array_compact("quotes"), F.array().cast("array<string>"))
    return claims.select("claim_id", "title", quotes.alias("quotes")).mapInPandas(run, "claim_id string, why string, kind string, cost_usd double, error string")
