"""The algebra as JSON, both ways: to send, keep and log queries.

Every operator is an object whose @type names it; values are objects with one of variable, node, data, list
or dictionary. Absent optional fields are left out, and a null field that is read counts as absent (a null
graph as the instance graph).
"""

from __future__ import annotations

import datetime
import decimal
import json
from dataclasses import fields
from typing import Any

from . import algebra as A

# Names of operators and fields where the JSON form has others than the algebra.
TYPES = {"TrueGoal": "True", "Optional": "WoqlOptional", "Add": "Plus", "Mul": "Times"}
PATTERNS = {"Pred": "PathPredicate", "Inverse": "InversePathPredicate", "Seq": "PathSequence", "Alt": "PathOr", "Plus": "PathPlus", "Star": "PathStar", "Times": "PathTimes"}
FIELDS = {
    "And": {"goals": "and"}, "Or": {"goals": "or"}, "If": {"otherwise": "else"}, "GroupBy": {"keys": "group_by"},
    "SetUnion": {"a": "list_a", "b": "list_b"}, "SetIntersection": {"a": "list_a", "b": "list_b"}, "SetDifference": {"a": "list_a", "b": "list_b"},
    "Get": {"path": "resource", "header": "has_header"},
}
PATTERN_FIELDS = {"Pred": {"name": "predicate"}, "Inverse": {"name": "predicate"}, "Seq": {"parts": "sequence"}, "Alt": {"parts": "or"}, "Plus": {"part": "plus"}, "Star": {"part": "star"}, "Times": {"part": "times", "low": "from", "high": "to"}}
NODES = set("subject predicate element child parent uri identifier type".split())
TEXTS = {"collection", "graph", "name", "resource", "parameters"}
NUMBERS = {"limit", "start", "depth"}

_TYPES_BACK = {v: k for k, v in TYPES.items()}
_PATTERNS_BACK = {v: k for k, v in PATTERNS.items()}


class JsonError(ValueError):
    """JSON that is no query."""


def to_json(node: Any) -> dict:
    """The JSON object of an operator, path pattern or expression."""
    kind = type(node).__name__
    if isinstance(node, A.Pattern):
        names = PATTERN_FIELDS[kind]
        out: dict = {"@type": PATTERNS[kind]}
        for f in fields(node):
            x = getattr(node, f.name)
            if x is not None:
                out[names[f.name]] = [to_json(p) for p in x] if isinstance(x, (list, tuple)) else to_json(x) if isinstance(x, A.Pattern) else x
        return out
    if not isinstance(node, (A.Node, A.Expression)) or not hasattr(A, kind):
        raise JsonError(f"{kind} is no operator")
    out = {"@type": TYPES.get(kind, kind)}
    for f in fields(node):
        x, name = getattr(node, f.name), FIELDS.get(kind, {}).get(f.name, f.name)
        if x is None and name == "graph":
            out[name] = "instance"
        elif x is not None:
            out[name] = _field(node, kind, f.name, x)
    return out


def _field(node: Any, kind: str, name: str, x: Any) -> Any:
    if isinstance(x, (A.Node, A.Pattern)) and not isinstance(x, A.Dict):
        return to_json(x)
    if name == "goals":
        return [to_json(g) for g in x]
    if name == "variables" or (kind == "GroupBy" and name == "keys"):
        return [v.name for v in x]
    if name == "ordering":
        return [{"@type": "OrderTemplate", "variable": v.name, "order": way} for v, way in x]
    if name == "columns":
        return [{"@type": "Column", "indicator": {"@type": "Indicator", **({"index": c} if isinstance(c, int) else {"name": c})}, "variable": v.name, **({"type": t} if t else {})} for c, v, t in x]
    if kind == "Get" and name == "path":
        return {"@type": "QueryResource", "source": {"@type": "Source", "file": x}, "format": "csv"}
    if kind == "Path" and name == "pattern":
        from ..operators.paths import parse

        return to_json(parse(x) if isinstance(x, str) else x)
    if isinstance(x, A.Expression):
        return to_json(x)
    if isinstance(node, A.Expression) or (kind == "Eval" and name == "expression"):
        return value(x, "ArithmeticValue")
    if name == "arguments" or name == "key_list":
        return [value(y) for y in x]
    if name in TEXTS and isinstance(x, (str, list, tuple)):
        return [p.name if isinstance(p, A.Var) else p for p in x] if isinstance(x, (list, tuple)) else x
    if name in NUMBERS and kind in ("Limit", "Start", "ReadDocument"):
        return x
    if name == "header":
        return bool(x)
    if name in NODES and kind != "Call":
        return value(A.Iri(x) if isinstance(x, str) else x, "NodeValue")
    return value(x)


def value(x: Any, kind: str = "Value") -> dict:
    """The JSON object of a value."""
    if isinstance(x, A.Var):
        return {"@type": kind, "variable": x.name}
    if isinstance(x, A.Iri):
        return {"@type": kind, "node": x.text}
    if isinstance(x, A.Dict) or isinstance(x, dict):
        pairs = x.fields if isinstance(x, A.Dict) else x.items()
        return {"@type": kind, "dictionary": {"@type": "DictionaryTemplate", "data": [{"@type": "FieldValuePair", "field": n, "value": value(y)} for n, y in pairs]}}
    if isinstance(x, (list, tuple)):
        return {"@type": kind, "list": [value(y) for y in x]}
    for t, xsd in ((bool, "boolean"), (int, "integer"), (float, "double"), (decimal.Decimal, "decimal"), (datetime.datetime, "dateTime"), (datetime.date, "date"), (str, "string")):
        if isinstance(x, t):
            plain = x if t in (bool, int, float, str) else x.isoformat() if hasattr(x, "isoformat") else str(x)
            return {"@type": kind, "data": {"@type": f"xsd:{xsd}", "@value": plain}}
    raise JsonError(f"no value: {x!r}")


def _read_value(j: Any) -> Any:
    if not isinstance(j, dict):
        return j
    if "variable" in j:
        return A.Var(j["variable"])
    if "node" in j:
        return A.Iri(j["node"])
    if "list" in j:
        return [_read_value(y) for y in j["list"]]
    if "dictionary" in j:
        return A.Dict([(p["field"], _read_value(p["value"])) for p in j["dictionary"]["data"]])
    if "data" in j:
        kind, x = j["data"].get("@type", "xsd:string").partition(":")[2], j["data"].get("@value")
        if kind in ("decimal",):
            return decimal.Decimal(str(x))
        if kind in ("dateTime", "dateTimeStamp"):
            return datetime.datetime.fromisoformat(x)
        if kind == "date":
            return datetime.date.fromisoformat(x)
        if kind in ("double", "float"):
            return float(x)
        return x
    raise JsonError(f"no value: {json.dumps(j)[:200]}")


def from_json(j: dict | str) -> Any:
    """The operator, path pattern or expression of a JSON object (or text)."""
    if isinstance(j, str):
        j = json.loads(j)
    if not isinstance(j, dict) or "@type" not in j:
        raise JsonError("a query is an object with an @type")
    name = j["@type"]
    if name in _PATTERNS_BACK and hasattr(A, _PATTERNS_BACK[name]):
        kind = _PATTERNS_BACK[name]
        back = {v: k for k, v in PATTERN_FIELDS[kind].items()}
        given = {back[k]: [from_json(p) for p in x] if isinstance(x, list) else from_json(x) if isinstance(x, dict) else x for k, x in j.items() if k in back and x is not None}
        return getattr(A, kind)(**given)
    kind = _TYPES_BACK.get(name, name)
    cls = getattr(A, kind, None)
    if not (isinstance(cls, type) and issubclass(cls, (A.Node, A.Expression))):
        raise JsonError(f"no operator {name}")
    back = {v: k for k, v in FIELDS.get(kind, {}).items()}
    if kind in ("And", "Or"):
        return cls(*[from_json(g) for g in j[kind.lower()] or []])
    given = {}
    known = {f.name for f in fields(cls)}
    for key, x in j.items():
        field = back.get(key, key)
        if key.startswith("@") or x is None:
            continue
        if field not in known:
            raise JsonError(f"{name} has no field {key}")
        given[field] = _read_field(kind, field, x)
    if given.get("graph") == "instance" and kind not in ("From", "Into"):
        given["graph"] = None
    missing = [f.name for f in fields(cls) if f.name not in given and f.default is not None]
    if missing:
        raise JsonError(f"{name} needs {', '.join(missing)}")
    return cls(**given)


def _read_field(kind: str, name: str, x: Any) -> Any:
    if name == "variables" or (kind == "GroupBy" and name == "keys"):
        return [A.Var(v) for v in x]
    if name == "ordering":
        return [(A.Var(o["variable"]), o["order"]) for o in x]
    if name == "columns":
        return [(c["indicator"].get("name", c["indicator"].get("index")), A.Var(c["variable"]), c.get("type")) for c in x]
    if kind == "Get" and name == "path":
        return next(v for k, v in x["source"].items() if not k.startswith("@")) if isinstance(x, dict) else x
    if isinstance(x, list):
        return [_read_value(y) for y in x] if name in ("arguments", "key_list") else x
    if isinstance(x, dict):
        t = x.get("@type", "")
        if t.endswith("Value") or not t:
            got = _read_value(x)
            # predicates and classes are plain names in the algebra
            return got.text if isinstance(got, A.Iri) and name in ("predicate", "type", "parent", "child") else got
        return from_json(x)
    return x


def dumps(node: Any, **how: Any) -> str:
    return json.dumps(to_json(node), ensure_ascii=False, **how)
