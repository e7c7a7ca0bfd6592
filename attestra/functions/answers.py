"""Clean-up of model answers and recovery of JSON from free text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, text_of
from attestra.functions.text import split_lines, strip_space

# The tag names models wrap their reasoning in.
REASONING_TAGS = ("think", "thinking", "reasoning", "redacted_reasoning", "thought")
END_MARKS = ("</think>", "</thinking>", "</reasoning>", "</thought>")


def clean_answer(answer, after_last_mark: bool = False) -> Column:
    """Answer without code fences and reasoning blocks, closed or not; optionally only the text after the last end mark."""
    t = strip_space(text_of(answer))
    if after_last_mark:
        for mark in END_MARKS:
            t = F.when(F.contains(F.lower(t), F.lit(mark)), strip_space(F.regexp_extract(t, rf"(?is)\A.*{mark}(.*)\z", 1))).otherwise(t)
    fenced = F.regexp_extract(t, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)
    t = F.when(t.rlike(r"(?is)```(?:json)?\s*.*?\s*```"), strip_space(fenced)).otherwise(t)
    for tag in REASONING_TAGS:
        t = strip_space(F.regexp_replace(t, rf"(?s)<{tag}>.*?</{tag}>", ""))
        t = strip_space(F.regexp_replace(t, rf"(?s)<{tag}>.*", ""))
    return t


_DECODER = json.JSONDecoder()


def _value_at(text: str, at: int):
    """The JSON value that begins at a place and where it ends; None and the place itself where none does."""
    try:
        return _DECODER.raw_decode(text, at)
    except ValueError:
        return None, at


def _whole_members(text: str, at: int) -> list:
    """Members of a cut-off list up to its last whole object."""
    members, end = [], at
    while end < len(text):
        at = end
        while at < len(text) and text[at] in " \t\r\n,":
            at += 1
        value, end = _value_at(text, at)
        if end == at:
            break
        members.append(value)
    last = max((i for i, m in enumerate(members) if isinstance(m, dict)), default=-1)
    return members[:last + 1]


def _recover(text: str, want_array: bool) -> str | None:
    """The whole answer, else the value at the first opener, else what stands between the first opener and the last closer, else a cut-off list."""
    kind, opener, closer = (list, "[", "]") if want_array else (dict, "{", "}")
    first, last = text.find(opener), text.rfind(closer)
    for start, end in ((0, len(text)), (first, None), (first, last + 1)):
        if start < 0 or end == 0:
            continue
        part = text[start:end].strip()
        value, stop = _value_at(part, 0)
        if isinstance(value, kind) and (end is None or stop == len(part)):
            return json.dumps(value, ensure_ascii=False)
    members = _whole_members(text, first + 1) if want_array and first >= 0 else []
    return json.dumps(members, ensure_ascii=False) if members else None


def recover_json(answer, kind: str = "object") -> Column:
    """JSON text of the first object or array an answer holds, null if none: whole, balanced, outermost, cut-off array closed.

    Whole answers that parse stay in the JVM result; the scan is an Arrow batch because it needs a string-aware counter.
    """
    want_array = kind == "array"

    @F.pandas_udf("string")
    def scan(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if not v else _recover(v, want_array))

    return F.coalesce(scan(clean_answer(answer)), scan(text_of(answer)))


def json_field(answer, field: str) -> Column:
    return F.get_json_object(recover_json(answer), f"$.{field}")


def parse_bullets(answer) -> Column:
    """Bullets of a summary: the JSON "bullets" list, else the filled lines without their dashes."""
    t = clean_answer(answer)
    listed = F.try_variant_get(F.try_parse_json(t), "$.bullets", "array<string>")
    lines = F.transform(F.filter(split_lines(t), lambda x: strip_space(x) != ""), lambda x: strip_space(F.ltrim(x, F.lit("- "))))
    none = F.array(F.lit("No summary produced for this topic group."))
    return F.when(F.size(listed) > 0, listed).when(F.size(lines) > 0, lines).otherwise(none)
