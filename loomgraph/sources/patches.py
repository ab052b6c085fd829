"""Differences of JSON documents and their application: swaps of values, and copies, swaps and patches of lists.

What a patch doesn't mention is copied. Lists are compared element by element: equal runs are copied, runs of
equal length patched element by element, others swapped. A swap fails with Conflict where the document isn't
as it was; a ForceValue doesn't ask. DataFrames of documents go through Arrow batches, as a structure without
a schema has no expression.
"""

from __future__ import annotations

import json
from difflib import SequenceMatcher
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import Conflict

KEEP = {"@op": "KeepList"}


def diff(before: Any, after: Any, copy_value: bool = False) -> Any:
    """The patch from one value to the other; None if they are the same. copy_value: copies say what they copy."""
    if before == after and type(before) is type(after):
        return None
    if isinstance(before, dict) and isinstance(after, dict):
        out = {k: d for k in [*before, *(k for k in after if k not in before)] if (d := diff(before.get(k), after.get(k), copy_value)) is not None}
        return {**({"@id": before["@id"]} if before.get("@id") is not None and "@id" not in out else {}), **out}
    if isinstance(before, list) and isinstance(after, list):
        return _lists(before, after, copy_value)
    return {"@op": "SwapValue", "@before": before, "@after": after}


def _lists(before: list, after: list, copy_value: bool) -> dict:
    text = lambda xs: [json.dumps(x, sort_keys=True) for x in xs]
    steps = SequenceMatcher(None, text(before), text(after), autojunk=False).get_opcodes()
    out = dict(KEEP)
    for k, (kind, a, b, c, d) in reversed(list(enumerate(steps))):
        if kind == "equal":
            if k < len(steps) - 1:  # an equal tail is kept
                out = {"@op": "CopyList", "@to": b - a, **({"@value": before[a:b]} if copy_value else {}), "@rest": out}
        elif b - a == d - c:
            out = {"@op": "PatchList", "@patch": [diff(x, y, copy_value) for x, y in zip(before[a:b], after[c:d], strict=True)], "@rest": out}
        else:
            out = {"@op": "SwapList", "@before": before[a:b], "@after": after[c:d], "@rest": out}
    return out


def apply(patch: Any, value: Any) -> Any:
    """The value after a patch."""
    if patch is None:
        return value
    op = patch.get("@op") if isinstance(patch, dict) else None
    if op == "SwapValue":
        if value != patch.get("@before"):
            raise Conflict(f"{json.dumps(value)[:100]} isn't {json.dumps(patch.get('@before'))[:100]}")
        return patch.get("@after")
    if op == "ForceValue":
        return patch.get("@after")
    if op in ("KeepList", "CopyList", "SwapList", "PatchList"):
        if not isinstance(value, list):
            raise Conflict(f"{json.dumps(value)[:100]} is no list")
        return _apply_list(patch, value)
    if isinstance(patch, dict):
        if not isinstance(value, dict):
            raise Conflict(f"{json.dumps(value)[:100]} is no document")
        out = dict(value)
        for k, p in patch.items():
            if k == "@id" and not isinstance(p, dict):
                if value.get("@id", p) != p:
                    raise Conflict(f"{value.get('@id')} isn't {p}")
                continue
            new = apply(p, value.get(k))
            if new is None:
                out.pop(k, None)
            else:
                out[k] = new
        return out
    raise ValueError(f"no patch: {json.dumps(patch)[:100]}")


def _apply_list(patch: dict, xs: list) -> list:
    out, at = [], 0
    while patch["@op"] != "KeepList":
        if patch["@op"] == "CopyList":
            if at + patch["@to"] > len(xs):
                raise Conflict("the list is shorter than what is copied")
            out += xs[at : at + patch["@to"]]
            at += patch["@to"]
        elif patch["@op"] == "SwapList":
            if xs[at : at + len(patch["@before"])] != patch["@before"]:
                raise Conflict(f"{json.dumps(xs[at:])[:100]} doesn't begin with {json.dumps(patch['@before'])[:100]}")
            out += patch["@after"]
            at += len(patch["@before"])
        else:
            if at + len(patch["@patch"]) > len(xs):
                raise Conflict("the list is shorter than its patch")
            out += [apply(p, x) for p, x in zip(patch["@patch"], xs[at:], strict=False)]
            at += len(patch["@patch"])
        patch = patch.get("@rest", KEEP)
    return out + xs[at:]


def _pairs(a: DataFrame, b: DataFrame, how: str, make: Any, name: str) -> DataFrame:
    """id and one text column made from two of the same id; rows without a text go."""
    both = a.select("id", F.col(a.columns[1]).alias("a")).join(b.select("id", F.col(b.columns[1]).alias("b")), "id", how)

    def run(batches):
        for batch in batches:
            made = [make(x, y) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.string())], names=["id", name])

    return both.mapInArrow(run, f"id string, {name} string").filter(F.col(name).isNotNull())


def diff_documents(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id, document) of two versions -> id, patch; a whole document that is new or gone is a swap with null."""

    def make(a, b):
        p = diff(None if a is None else json.loads(a), None if b is None else json.loads(b))
        return None if p is None else json.dumps(p, ensure_ascii=False)

    return _pairs(before, after, "full", make, "patch")


def patch_documents(documents: DataFrame, patches: DataFrame) -> DataFrame:
    """(id, document) and (id, patch) -> id, document; documents that a patch takes away go."""

    def make(a, p):
        new = apply(None if p is None else json.loads(p), None if a is None else json.loads(a))
        return None if new is None else json.dumps(new, ensure_ascii=False)

    return _pairs(documents, patches, "full", make, "document")
