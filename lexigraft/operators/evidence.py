"""Entity names and their evidence in the source text."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigraft.functions.text import strip_ws

GROUP_TYPE = "症状群"


def entity_name(name: Column, kind: Column) -> Column:
    """The stored form of a name: stripped; members of a symptom group are stripped one by one."""
    bare = strip_ws(name)
    members = F.array_join(F.transform(F.split(bare, r"\|"), strip_ws), "|")
    return F.when(kind == GROUP_TYPE, members).otherwise(bare)


def name_form(name: str, kind: str) -> str:
    """``entity_name`` for one value in Python."""
    bare = name.strip()
    return "|".join(m.strip() for m in bare.split("|")) if kind == GROUP_TYPE else bare


def comparable(text: str) -> str:
    """Compatibility-composed, without white space and format characters."""
    bare = "".join(unicodedata.normalize("NFKC", text).split())
    if not bare.isascii():  # there are no format characters in ASCII
        for c in set(bare):
            if unicodedata.category(c) == "Cf":
                bare = bare.replace(c, "")
    return bare


# fixed values: the messages callers see
ABSENT = "实体名称不在当前片段中"
TOO_FEW = "症状群必须使用“症状1|症状2”格式并包含至少两个症状"
EMPTY_MEMBER = "症状群名称包含空的症状成员"
SAME_MEMBER = "症状群不能包含重复的症状成员"
ABSENT_MEMBERS = "症状群成员不在当前片段中："


#: what may be wrong with the parts of a group, first fault first
_GROUP_FAULTS = ((TOO_FEW, lambda parts: len(parts) == 1), (EMPTY_MEMBER, lambda parts: not all(parts)), (SAME_MEMBER, lambda parts: len({*parts}) != len(parts)))


def evidence_error(name: str, kind: str, text: str) -> str | None:
    """Why a name is not supported by the text, or None if it is."""
    return support_error(name, kind, comparable(text))


def support_error(name: str, kind: str, body: str) -> str | None:
    """``evidence_error`` against a text that is ``comparable`` already, so one text serves all its names."""
    group = kind == GROUP_TYPE
    parts = name.split("|") if group else [name]
    forms = dict(zip(parts, map(comparable, parts)))
    missing = [p for p in parts if forms[p] not in body]
    if group:
        absent = f"{ABSENT_MEMBERS}{missing}" if missing else None
        return next((message for message, wrong in _GROUP_FAULTS if wrong(parts)), absent)
    return ABSENT if missing or not forms[name] else None


@F.pandas_udf(T.StringType())
def evidence_error_udf(name: pd.Series, kind: pd.Series, text: pd.Series) -> pd.Series:
    bodies = {t: comparable(t or "") for t in set(text)}  # each source once
    return pd.Series([support_error(n or "", k or "", bodies[t]) for n, k, t in zip(name, kind, text)], dtype=object)
