"""The list of registered sources, a small JSON file: files, pages and feeds under unique handles."""

from __future__ import annotations

import json
import os

KINDS = ("file", "url", "feed")


def load(path: str) -> list[dict]:
    """Entries of the file; a bare list is read too, what is no entry is left out, and a missing file is empty."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except FileNotFoundError:
        return []
    entries = found.get("sources", []) if isinstance(found, dict) else found
    return [e for e in entries if isinstance(e, dict) and e.get("kind") in KINDS and isinstance(e.get("handle"), str)]


def _save(path: str, entries: list[dict]) -> None:
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        json.dump({"sources": entries}, f, ensure_ascii=False, indent=2)
    os.replace(f"{path}.new", path)


def add(path: str, kind: str, value: str) -> dict:
    """Register a source; a file's handle is its absolute path. A handle in use, of any kind, is refused."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    entry = {"kind": kind, "handle": os.path.abspath(os.path.expanduser(value)) if kind == "file" else value}
    entries = load(path)
    if any(e["handle"] == entry["handle"] for e in entries):
        raise ValueError(f"{entry['handle']} is registered already")
    _save(path, [*entries, entry])
    return entry


def remove(path: str, handle: str) -> dict:
    """Take a source off the list; an unknown handle is refused."""
    entries = load(path)
    names = {handle, os.path.abspath(os.path.expanduser(handle))}
    gone = [e for e in entries if e["handle"] in names]
    if not gone:
        raise ValueError(f"{handle} is not registered")
    _save(path, [e for e in entries if e not in gone])
    return gone[0]
