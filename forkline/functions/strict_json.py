"""Whether bytes are exactly one JSON document."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_document(raw: bytes | None) -> bool:
    """One document and nothing else but white space; repeated keys pass, constants such as NaN and numbers beyond a double don't."""
    if not raw:
        return False

    def refuse(name: str):
        raise ValueError(name)

    def number(text: str) -> float:
        x = float(text)
        if math.isinf(x):
            raise ValueError(text)
        return x

    try:
        json.loads(bytes(raw).decode("utf-8"), parse_constant=refuse, parse_float=number)
    except (ValueError, RecursionError):
        return False
    return True


def is_strict_json(payload: Column) -> Column:
    """is_document() over a binary column. try_parse_json accepts trailing text and huge numbers, so it can't decide this."""

    @F.pandas_udf("boolean")
    def f(raw: pd.Series) -> pd.Series:
        return raw.map(is_document)

    return f(payload)
