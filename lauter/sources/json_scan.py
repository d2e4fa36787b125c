"""JSON texts that are too large to be parsed as a whole, taken apart member by member.

Only such texts come here; a text is walked once, token by token, and checked in full.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# no text of fewer bytes is too large for a VARIANT
SURE_BYTES = 8 << 20
# a larger member of an oversize record is left out
MEMBER_BYTES = 1 << 20

_TOKEN = re.compile(
    r"[ \t\r\n]*+(?:([\[\]{},:])"
    r'|("[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+")'
    r"|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))"
)
_BLANK = re.compile(r"[ \t\r\n]*+")

Member = tuple[str | None, int, int]


class Malformed(ValueError):
    """The text is not one JSON value."""


def members(text: str) -> tuple[str, list[Member]]:
    """The first character of the value, and key (None in an array), begin and end of every
    direct member of an object or array; raises :class:`Malformed`."""
    stack: list[str] = []
    found: list[Member] = []
    first, key, begin, at = "", None, 0, 0
    # what may come: a value, a value or ], a key, a key or }, a colon, a comma or an end
    expect = "value"
    while expect != "nothing":
        token = _TOKEN.match(text, at)
        if token is None:
            raise Malformed(f"at {at}")
        mark, string, scalar = token.groups()
        start, at = token.start(token.lastindex), token.end()
        opens = mark in ("[", "{")
        if expect in ("value", "item") and (opens or string or scalar):
            first = first or text[start]
            if len(stack) == 1:
                begin = start
            if opens:
                stack.append(mark)
                expect = "item" if mark == "[" else "member"
                continue
        elif expect in ("key", "member") and string:
            if len(stack) == 1:
                key = json.loads(string)
            expect = "colon"
            continue
        elif expect == "colon" and mark == ":":
            expect = "value"
            continue
        elif expect == "next" and mark == ",":
            expect = "key" if stack[-1] == "{" else "value"
            continue
        elif (expect in ("next", "item") and mark == "]" and stack[-1] == "[") or (
            expect in ("next", "member") and mark == "}" and stack[-1] == "{"
        ):
            stack.pop()
        else:
            raise Malformed(f"at {start}")
        # a value has ended
        if len(stack) == 1:
            found.append((key, begin, at))
            key = None
        expect = "next" if stack else "nothing"
    if _BLANK.match(text, at).end() != len(text):
        raise Malformed(f"at {at}")
    return first, found


def reduced(text: str) -> tuple[str | None, str | None]:
    """``(object, problem)`` of a text: an oversize object without its largest members.

    Members above ``MEMBER_BYTES`` go, then the largest of the others until what stays
    fits; of a repeated key the last member counts. The problem is ``too_large`` if any
    went, ``malformed_json`` or ``not_an_object`` if there is no object.
    """
    try:
        first, found = members(text)
    except Malformed:
        return None, "malformed_json"
    if first != "{":
        return None, "not_an_object"
    last = {key: (begin, end) for key, begin, end in found}
    sizes = {key: 4 * (end - begin + len(key) + 4) for key, (begin, end) in last.items()}
    room, kept = SURE_BYTES, []
    for key in sorted(last, key=lambda k: sizes[k]):
        if sizes[key] > 4 * MEMBER_BYTES or sizes[key] > room:
            break
        room -= sizes[key]
        kept.append(key)
    order = [key for key in last if key in set(kept)]
    body = ",".join(f"{json.dumps(key)}:{text[last[key][0] : last[key][1]]}" for key in order)
    return "{" + body + "}", None if len(kept) == len(last) else "too_large"


_TEXT = T.StringType()
_REDUCED = T.StructType().add("record", _TEXT).add("problem", _TEXT)
_ITEM = T.StructType().add("text", _TEXT).add("small", _TEXT).add("problem", _TEXT)
_PAGE = T.StructType().add("problem", _TEXT).add("next_url", _TEXT).add("items", T.ArrayType(_ITEM))


@F.pandas_udf(_REDUCED)
def reduced_object(texts: pd.Series) -> pd.DataFrame:
    """:func:`reduced` of every text; NULL for NULL."""
    rows = [(None, None) if t is None else reduced(t) for t in texts]
    return pd.DataFrame(rows, columns=["record", "problem"])


def page_records(
    text: str, data_key: str | None, next_key: str | None
) -> tuple[str | None, str | None, list[tuple[str, str, str | None]]]:
    """``(problem, next link, records)`` of an oversize page.

    A record is its text, the text to be parsed (without members that are too large) and
    its problem. Items that are no objects give none.
    """
    try:
        first, found = members(text)
        link = None
        if first == "{":
            of_page = {key: text[begin:end] for key, begin, end in found}
            following = of_page.get(next_key) if data_key and next_key else None
            if following is not None and following[0] not in "[{":
                value = json.loads(following)
                link = value if isinstance(value, str) else None if value is None else following
            listed = of_page.get(data_key, "") if data_key else ""
            text, found = (listed, members(listed)[1]) if listed.startswith("[") else ("", [])
        elif first != "[":
            found = []
    except Malformed:
        return "malformed_json", None, []
    records = []
    for _, begin, end in found:
        item = text[begin:end]
        if not item.startswith("{"):
            continue
        if 4 * len(item) <= SURE_BYTES:
            records.append((item, item, None))
        else:
            small, problem = reduced(item)
            records.append((item, small, problem))
    return None, link or None, records


def page_udf(data_key: str | None, next_key: str | None):
    """:func:`page_records` as a column function."""

    @F.pandas_udf(_PAGE)
    def scanned(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            problem, link, records = (None, None, None) if page is None else page_records(page, data_key, next_key)
            if records is not None:
                records = [{"text": t, "small": s, "problem": p} for t, s, p in records]
            rows.append((problem, link, records))
        return pd.DataFrame(rows, columns=["problem", "next_url", "items"])

    return scanned
