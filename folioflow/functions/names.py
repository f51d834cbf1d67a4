"""Unicode forms of names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FORMS = ("NFD", "NFC", "NFKD", "NFKC")


def _normal(form: str):
    @F.pandas_udf(StringType())
    def normal(names: pd.Series) -> pd.Series:
        return names.map(lambda n: None if n is None else unicodedata.normalize(form, n))

    return normal


nfc = _normal("NFC")


def normalize_name(column: Column | str, form: str = "NFC") -> Column:
    """Names that hold nothing but ASCII are the same in every form and stay in the JVM."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_normal(form)(c))


def variants(column: Column | str) -> Column:
    """The name and its four forms, distinct, in the order in which they are tried."""
    return F.array_distinct(F.array(column, *[normalize_name(column, f) for f in FORMS]))
