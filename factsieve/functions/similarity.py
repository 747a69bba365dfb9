"""Token, bigram and caption similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def tokens(col: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+)"), 1))


def bigrams(col: Column) -> Column:
    """Distinct pairs of neighbouring characters of the text without white space."""
    text = F.regexp_replace(F.lower(col), r"\s+", "")
    return F.when(F.length(text) > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: text.substr(i, F.lit(2))))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all members of two sets; 0 where both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


@pandas_udf(DoubleType())
def caption_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for equal captions, the ratio of lengths where the shorter (8 characters or more) stands in the longer, else the matching-block ratio."""
    out = []
    for x, y in zip(a, b):
        if not x or not y:
            out.append(0.0)
            continue
        x, y = "".join(ch for ch in x.lower() if ch.isalnum()), "".join(ch for ch in y.lower() if ch.isalnum())
        short, long = sorted((x, y), key=len)
        if x == y:
            out.append(1.0 if x else 0.0)
        elif len(short) >= 8 and short in long:
            out.append(len(short) / len(long))
        else:
            out.append(SequenceMatcher(None, x, y, autojunk=False).ratio())
    return pd.Series(out, dtype="float64")
