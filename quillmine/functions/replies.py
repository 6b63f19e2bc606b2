"""JSON out of model replies (F32-F34). A truncated array has no built-in reader, so these run as pandas UDFs on replies only."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = re.compile(r"(?m)^```(?:json)?\s*|\s*```$")
_THINK = re.compile(r"(?s)<think>.*?</think>")
_DECODER = json.JSONDecoder()


def without_thoughts(reply: Column) -> Column:
    return F.trim(F.regexp_replace(reply, r"(?s)<think>.*?</think>", ""))


def bare(reply: str | None) -> str:
    return _FENCE.sub("", _THINK.sub("", reply or "").strip())


def _decoded(reply: str, at: int):
    try:
        return _DECODER.raw_decode(reply, at)
    except ValueError:
        return None


def whole_value(reply: str | None):
    """The reply as JSON, or the first object in it, or the first array; None if there is neither.

    The object has precedence wherever it stands, so an array after some prose gives its first object.
    """
    reply = bare(reply)
    try:
        return json.loads(reply)
    except ValueError:
        pass
    for opening in "{[":
        at = reply.find(opening)
        if at >= 0 and (found := _decoded(reply, at)):
            return found[0]
    return None


def complete_objects(reply: str | None) -> list[dict]:
    """The objects of the reply's first array that are complete and valid, also if the array breaks off."""
    reply = bare(reply)
    at, out = reply.find("["), []
    while at >= 0:
        at = _next_object(reply, at + 1)
        if at < 0:
            break
        if found := _decoded(reply, at):
            out.append(found[0])
            at = found[1] - 1
        elif (end := _closing(reply, at)) >= 0:
            at = end  # closed, but not valid: passed over
        else:
            break
    return out


def _scan(reply: str, at: int):
    """(place, character) outside strings."""
    quoted = escaped = False
    for i in range(at, len(reply)):
        c = reply[i]
        if quoted:
            quoted = escaped or c != '"'
            escaped = c == "\\" and not escaped
        elif c == '"':
            quoted, escaped = True, False
        else:
            yield i, c


def _next_object(reply: str, at: int) -> int:
    for i, c in _scan(reply, at):
        if c == "{":
            return i
        if c == "]":
            return -1
    return -1


def _closing(reply: str, at: int) -> int:
    depth = 0
    for i, c in _scan(reply, at):
        depth += (c == "{") - (c == "}")
        if not depth:
            return i
    return -1


@F.pandas_udf(T.StringType())
def extract_json(reply: pd.Series) -> pd.Series:
    """:func:`whole_value` as JSON text; null if there is none."""
    found = reply.map(whole_value)
    return found.map(lambda v: None if v is None else json.dumps(v, ensure_ascii=False))


@F.pandas_udf(T.ArrayType(T.StringType()))
def extract_objects(reply: pd.Series) -> pd.Series:
    """:func:`complete_objects`, each as JSON text."""
    return reply.map(lambda r: [json.dumps(v, ensure_ascii=False) for v in complete_objects(r)])
