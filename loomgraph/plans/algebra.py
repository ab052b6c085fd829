"""The algebra: one immutable node for each operator, without behaviour; plans.lower gives them meaning.

An argument is a Var, an Iri, a Python literal, a Column of the incoming frame is never one. Lists are
Python lists; a Dict node is a template of fields.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, is_dataclass
from typing import Any


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Iri:
    text: str


def v(names: str) -> Any:
    """v("a") is one variable, v("a b") two."""
    out = [Var(n) for n in names.split()]
    return out[0] if len(out) == 1 else out


class Node:
    """Base of all operators."""


def _node(name: str, spec: str, doc: str, base: type = Node) -> type:
    """A frozen dataclass; a field that ends in ? is optional."""
    import dataclasses

    names = [(n.rstrip("?"), Any, dataclasses.field(default=None)) if n.endswith("?") else (n, Any) for n in spec.split()]
    out = dataclasses.make_dataclass(name, names, bases=(base,), frozen=True)
    out.__doc__, out.__module__ = doc, __name__
    return out


# control
@dataclass(frozen=True, init=False)
class And(Node):
    """All goals hold; shared variables unify; bag semantics."""

    goals: tuple

    def __init__(self, *goals):
        object.__setattr__(self, "goals", tuple(goals))


@dataclass(frozen=True, init=False)
class Or(Node):
    """Solutions of every branch, duplicates kept; what a branch doesn't bind stays unbound."""

    goals: tuple

    def __init__(self, *goals):
        object.__setattr__(self, "goals", tuple(goals))


Not = _node("Not", "query", "Keeps the rows for which the query has no solution; binds nothing.")
TrueGoal = _node("TrueGoal", "", "One empty solution.")
Select = _node("Select", "variables query", "Projects variables; others inside are hidden from outside.")
Distinct = _node("Distinct", "variables query", "One solution for each value of the variables.")
Optional = _node("Optional", "query", "Keeps the row, unbound, where the query has no solution.")
If = _node("If", "test then otherwise", "For solutions of test run then; rows without any run otherwise.")
Once = _node("Once", "query", "One solution, for each outer row where they share variables.")
Immediately = _node("Immediately", "query", "Runs side effects at once.")
Pin = _node("Pin", "query", "Keeps the query from being reordered.")
Using = _node("Using", "collection query", "Reads another collection: branch/<name> or commit/<id>.")
From = _node("From", "graph query", "Reads the instance or the schema graph.")
Into = _node("Into", "graph query", "Writes to the instance or the schema graph.")
Comment = _node("Comment", "comment query?", "A note; the wrapped query doesn't run.")
NamedQuery = _node("NamedQuery", "name query", "A query under a name.")
NamedParametricQuery = _node("NamedParametricQuery", "name parameters query", "A query with parameters.")
Call = _node("Call", "name arguments", "Runs a named parametric query; recursion is allowed.")

# sources
Triple = _node("Triple", "subject predicate object graph?", "An edge pattern; any place may be a variable.")
Link = _node("Link", "subject predicate object graph?", "An edge to a node.")
Data = _node("Data", "subject predicate object graph?", "An edge to a literal.")
TripleSlice = _node("TripleSlice", "subject predicate object low high graph?", "Edges with low <= object < high; an unbound end is open.")
TripleSliceRev = _node("TripleSliceRev", "subject predicate object low high graph?", "The same, in descending order of the object.")
TripleNext = _node("TripleNext", "subject predicate object next graph?", "The smallest object after this one, for subject and predicate.")
TriplePrevious = _node("TriplePrevious", "subject predicate object previous graph?", "The largest object before this one.")
AddedTriple = _node("AddedTriple", "subject predicate object graph?", "An edge that this commit added.")
DeletedTriple = _node("DeletedTriple", "subject predicate object graph?", "An edge that this commit removed.")
AddedLink = _node("AddedLink", "subject predicate object graph?", "A link that this commit added.")
AddedData = _node("AddedData", "subject predicate object graph?", "A literal that this commit added.")
DeletedLink = _node("DeletedLink", "subject predicate object graph?", "A link that this commit removed.")
DeletedData = _node("DeletedData", "subject predicate object graph?", "A literal that this commit removed.")
Get = _node("Get", "columns path header?", "Reads CSV: (column name or index, variable, type or None) each.")
Size = _node("Size", "resource size", "Bytes of a resource's files.")
TripleCount = _node("TripleCount", "resource count", "Number of edges of a resource.")

# sinks
AddTriple = _node("AddTriple", "subject predicate object graph?", "Adds an edge.")
DeleteTriple = _node("DeleteTriple", "subject predicate object graph?", "Removes an edge.")
AddLink = _node("AddLink", "subject predicate object graph?", "Adds a link.")
AddData = _node("AddData", "subject predicate object graph?", "Adds a literal.")
DeleteLink = _node("DeleteLink", "subject predicate object graph?", "Removes a link.")
DeleteData = _node("DeleteData", "subject predicate object graph?", "Removes a literal.")
ReadDocument = _node("ReadDocument", "identifier document depth?", "The whole document of an IRI as JSON; links unfold to a depth.")
InsertDocument = _node("InsertDocument", "document identifier?", "Adds a document.")
UpdateDocument = _node("UpdateDocument", "document identifier?", "Replaces a document.")
DeleteDocument = _node("DeleteDocument", "identifier", "Removes a document and its subdocuments.")


# paths
class Pattern:
    """Base of path patterns."""


Path = _node("Path", "subject pattern object path?", "A regular path; with `path` one row a path, else one a pair.")
Pred = _node("Pred", "name?", "An edge; without a name any edge.", Pattern)
Inverse = _node("Inverse", "name?", "An edge backwards.", Pattern)
Seq = _node("Seq", "parts", "Patterns in order.", Pattern)
Alt = _node("Alt", "parts", "Any of the patterns.", Pattern)
Plus = _node("Plus", "part", "Once or more.", Pattern)
Star = _node("Star", "part", "Any number of times.", Pattern)
Times = _node("Times", "part low high", "From low to high times.", Pattern)

# comparison and types
Equals = _node("Equals", "left right", "Unification.")
Less = _node("Less", "left right", "left < right")
Greater = _node("Greater", "left right", "left > right")
Lte = _node("Lte", "left right", "left <= right")
Gte = _node("Gte", "left right", "left >= right")
InRange = _node("InRange", "value start end", "start <= value < end")
Subsumption = _node("Subsumption", "child parent", "A class inherits from another (or is it).")
IsA = _node("IsA", "element type", "An element is of a class.")
TypeOf = _node("TypeOf", "value type", "The datatype of a value.")
Typecast = _node("Typecast", "value type result", "A cast; rows whose value can't be cast go.")


# arithmetic
class Expression:
    """Base of arithmetic expressions."""


Eval = _node("Eval", "expression result", "Evaluates an arithmetic expression.")
Add = _node("Add", "left right", "Sum.", Expression)
Minus = _node("Minus", "left right", "Difference.", Expression)
Mul = _node("Mul", "left right", "Product.", Expression)
Divide = _node("Divide", "left right", "Quotient: 20 digits for exact numbers.", Expression)
Div = _node("Div", "left right", "Integer quotient, towards zero.", Expression)
Exp = _node("Exp", "left right", "Power.", Expression)
Floor = _node("Floor", "argument", "Floor.", Expression)

# aggregation and order
Count = _node("Count", "query count", "Number of solutions, for each outer row where they share variables.")
GroupBy = _node("GroupBy", "template keys grouped query", "Collects a template for each value of the keys.")
Collect = _node("Collect", "template into query", "Collects a template over all solutions.")
Sum = _node("Sum", "list result", "Sum of a list.")
Length = _node("Length", "list length", "Length of a list.")
RangeMin = _node("RangeMin", "list result", "Least element; none for an empty list.")
RangeMax = _node("RangeMax", "list result", "Largest element; none for an empty list.")
OrderBy = _node("OrderBy", "ordering query", "Sorts by (variable, 'asc' or 'desc') each.")
Limit = _node("Limit", "limit query", "At most so many solutions.")
Start = _node("Start", "start query", "Without the first so many solutions.")

CountBound = _node("CountBound", "counted keys count query", "Number of solutions that bind a variable (of all without one), for each value of the keys.")
FirstDistinct = _node("FirstDistinct", "variables ordering query", "One solution for each value of the variables, in the order of the first ones.")

# lists
Member = _node("Member", "member list", "Each element, or a test.")
Dot = _node("Dot", "document field value", "A field of a document, struct or map.")
Slice = _node("Slice", "list start end result", "Elements from start to before end; negative ones count from the end.")
ListToSet = _node("ListToSet", "list set", "Sorted, without repeats.")
SetUnion = _node("SetUnion", "a b result", "Union of lists as a set.")
SetIntersection = _node("SetIntersection", "a b result", "Intersection of lists as a set.")
SetDifference = _node("SetDifference", "a b result", "Difference of lists as a set.")
SetMember = _node("SetMember", "element set", "Each element of a set, or a test.")
Sequence = _node("Sequence", "value start end step? count?", "Numbers, dates, times or year-months from start to before end.")
Dict = _node("Dict", "fields", "A template: (name, value) each.")

# strings and keys
Trim = _node("Trim", "untrimmed trimmed", "Without white space at the ends.")
Lower = _node("Lower", "mixed lower", "Lower case.")
Upper = _node("Upper", "mixed upper", "Upper case.")
Pad = _node("Pad", "string char times result", "Filled up on the right to a length; never cut.")
Split = _node("Split", "string pattern list", "Parts between a separator.")
Join = _node("Join", "list separator result", "A list joined by a separator.")
Concatenate = _node("Concatenate", "list result", "A list of strings joined.")
Substring = _node("Substring", "string before length after substring", "Relates a string to a part and what is around it.")
Regexp = _node("Regexp", "pattern string result?", "A match; result is the list of whole match and groups.")
Like = _node("Like", "left right similarity", "Likeness from -1 to 1 by edit distance.")
LexicalKey = _node("LexicalKey", "base key_list uri", "base and URL-encoded values.")
HashKey = _node("HashKey", "base key_list uri", "base and a SHA-256 of the values.")
RandomKey = _node("RandomKey", "base uri", "base and a random id.")

# dates
Interval = _node("Interval", "start end interval", "Half-open interval of two ends.")
IntervalStartDuration = _node("IntervalStartDuration", "start duration interval", "Interval of a start and a duration.")
IntervalDurationEnd = _node("IntervalDurationEnd", "duration end interval", "Interval of a duration and an end.")
IntervalRelation = _node("IntervalRelation", "relation x_start x_end y_start y_end", "Allen's relation of two intervals.")
IntervalRelationTyped = _node("IntervalRelationTyped", "relation x y", "Allen's relation of interval values.")
DateDuration = _node("DateDuration", "start duration end", "Any two give the third; ends of months stay ends.")
DayAfter = _node("DayAfter", "date next", "The next day.")
DayBefore = _node("DayBefore", "date previous", "The day before.")
IsoWeek = _node("IsoWeek", "date week year", "ISO week and its year.")
Weekday = _node("Weekday", "date weekday", "Monday is 1.")
WeekdaySundayStart = _node("WeekdaySundayStart", "date weekday", "Sunday is 1.")
MonthStartDate = _node("MonthStartDate", "year_month date", "First day of a year-month.")
MonthEndDate = _node("MonthEndDate", "year_month date", "Last day of a year-month.")
MonthStartDates = _node("MonthStartDates", "date start end", "First days of months in [start, end).")
MonthEndDates = _node("MonthEndDates", "date start end", "Last days of months in [start, end).")


# sugar
def Between(x, low, high) -> And:
    return And(Gte(x, low), Lte(x, high))


def NotEquals(a, b) -> Not:
    return Not(Equals(a, b))


def StartsWith(s, text: str) -> Regexp:
    import re

    return Regexp("^" + re.escape(text), s)


def EndsWith(s, text: str) -> Regexp:
    import re

    return Regexp(re.escape(text) + "$", s)


def Contains(s, text: str) -> Regexp:
    import re

    return Regexp(re.escape(text), s)


def TripleFirst(s, p, o, low=None, high=None) -> Once:
    return Once(OrderBy([(o, "asc")], TripleSlice(s, p, o, low, high)))


def TripleLast(s, p, o, low=None, high=None) -> Once:
    return Once(OrderBy([(o, "desc")], TripleSlice(s, p, o, low, high)))


def IntervalInclusive(start, end, interval, after: Var) -> And:
    """An interval whose end is its last day; `after` is bound to the day behind it."""
    return And(DayAfter(end, after), Interval(start, after, interval))


def hops(start: Var, *steps: tuple[str, str, Var]) -> And:
    """(direction '>' or '<', property, variable) each: a chain of links."""
    out, at = [], start
    for way, prop, to in steps:
        out.append(Link(at, prop, to) if way == ">" else Link(to, prop, at))
        at = to
    return And(*out)


def unpaged(node: Node) -> Node:
    """Without the outer limits and offsets, to count all rows."""
    while isinstance(node, (Limit, Start)):
        node = node.query
    return node


def variables(x: Any) -> set[str]:
    """Variables that a node mentions and lets out."""
    if isinstance(x, Var):
        return {x.name}
    if isinstance(x, Select):
        return {a.name for a in x.variables}
    if isinstance(x, (Not, Comment)):
        return set()
    if isinstance(x, CountBound):
        return {k.name for k in x.keys} | variables(x.count)
    if isinstance(x, FirstDistinct):
        return {a.name for a in x.variables}
    if isinstance(x, (GroupBy, Collect)):
        keys = {k.name for k in x.keys} if isinstance(x, GroupBy) else set()
        return keys | variables(x.grouped if isinstance(x, GroupBy) else x.into)
    if isinstance(x, (list, tuple)):
        return set().union(*map(variables, x)) if x else set()
    if is_dataclass(x) and not isinstance(x, type):
        return set().union(*(variables(getattr(x, f.name)) for f in fields(x))) if fields(x) else set()
    return set()


def mentioned(x: Any) -> set[str]:
    """All variables in a node, hidden ones too."""
    if isinstance(x, Var):
        return {x.name}
    if isinstance(x, (list, tuple)):
        return set().union(*map(mentioned, x)) if x else set()
    if is_dataclass(x) and not isinstance(x, type) and fields(x):
        return set().union(*(mentioned(getattr(x, f.name)) for f in fields(x)))
    return set()


def renamed(x: Any, names: dict[str, Any]) -> Any:
    """x with variables replaced (by variables or values)."""
    if isinstance(x, Var):
        return names.get(x.name, x)
    if isinstance(x, (And, Or)):
        return type(x)(*(renamed(g, names) for g in x.goals))
    if isinstance(x, list):
        return [renamed(y, names) for y in x]
    if isinstance(x, tuple):
        return tuple(renamed(y, names) for y in x)
    if is_dataclass(x) and not isinstance(x, (Iri, type)):
        return type(x)(**{f.name: renamed(getattr(x, f.name), names) for f in fields(x)})
    return x


def text_of(x: Any, depth: int = 0) -> str:
    """A readable form of a query."""
    if isinstance(x, Var):
        return f"?{x.name}"
    if isinstance(x, Iri):
        return f"<{x.text}>"
    if is_dataclass(x) and not isinstance(x, type):
        inner = [text_of(getattr(x, f.name), depth + 1) for f in fields(x) if getattr(x, f.name) is not None]
        if isinstance(x, (And, Or)):
            pad = "  " * (depth + 1)
            return f"{type(x).__name__.lower()}(\n" + ",\n".join(pad + text_of(g, depth + 1) for g in x.goals) + f"\n{'  ' * depth})"
        return f"{type(x).__name__}({', '.join(inner)})"
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(text_of(y, depth) for y in x) + "]"
    return repr(x)
