"""Setting top-level fields of a JSON object in its own text: everything else stays as it was written.

A parser would give the fields back in another order, or 1.50 as 1.5, and would lose what a schema
does not name. Here one pass over the text finds where the values of the wanted keys stand; only
these are replaced, and keys that are not there are added at the end.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A JSON string, a mark of structure, or what stands between them (a number or a word).
_PART = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s"{}\[\],:]+', re.S)
_OPEN, _CLOSE = frozenset("{["), frozenset("}]")


def top_level(text: str) -> Iterator[tuple[str, int, int]]:
    """(key, start, end of its value) of each field of the object; raises ValueError for other text."""
    depth, key, start, end, before = 0, None, -1, -1, ""
    for m in _PART.finditer(text):
        part = m.group()
        if depth == 0 and (part != "{" or before):
            raise ValueError("not one JSON object")
        if depth == 1:
            if part == ":":
                key, start = json.loads(before), -1
            elif part in (",", "}"):
                if key is not None:
                    yield key, start, end
                elif before not in ("{", ",") or (part == "," and before == "{"):
                    raise ValueError("a field without a value")
                key = None
            elif key is not None and start < 0:
                start = m.start()
        if part in _OPEN:
            depth += 1
        elif part in _CLOSE:
            depth -= 1
        end, before = m.end(), part
    if depth or before != "}":
        raise ValueError("not one JSON object")


def set_fields(text: str, values: Mapping[str, str | None], keep: frozenset[str] = frozenset()) -> str:
    """text with the fields set to values in JSON; a value of None leaves a field out or as it is.

    Fields in `keep` stay as they are unless they are missing or null. A key that stands there more
    than once is set at each place, as readers differ in which one they take.
    """
    out, at, there = [], 0, set()
    n = 0
    for key, start, end in top_level(text):
        n += 1
        value = values.get(key)
        there.add(key)
        if value is None or (key in keep and text[start:end] != "null"):
            continue
        out += [text[at:start], value]
        at = end
    close = text.rindex("}")
    new = [f"{json.dumps(k, ensure_ascii=False)}: {v}" for k, v in values.items() if v is not None and k not in there]
    if not new:
        return "".join([*out, text[at:]])
    body = text[at:close]
    kept = body.rstrip()
    return "".join([*out, kept, ", " if n else "", ", ".join(new), body[len(kept) :], text[close:]])


def with_fields(raw: Column, values: Mapping[str, Column], keep: frozenset[str] | set[str] = frozenset()) -> Column:
    """raw, a column of JSON objects, with fields set to columns that hold JSON; a null raw is an empty object.

    Only the JSON text and the new values go to Python. Text that is no object raises.
    """
    names, kept = list(values), frozenset(keep)

    def run(lines: pa.Array, *columns: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in columns), strict=True) if columns else [()] * len(lines)
        return pa.array([set_fields(line or "{}", dict(zip(names, row, strict=True)), kept) for line, row in zip(lines.to_pylist(), rows, strict=True)], pa.string())

    return F.arrow_udf(run, "string")(raw, *[c.cast("string") for c in values.values()])


def json_array(column: Column) -> Column:
    """An array column as JSON."""
    return F.to_json(column)
