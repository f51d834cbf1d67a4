"""Tokenizers with offsets, so that any run of tokens can be cut out of its text."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, as Python and Unicode have it. What `\s` means differs between Java, Python and RE2.
WHITE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Words and single marks; the same count in Java, Python and RE2.
TOKEN_PATTERN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WHITE}]"
_PYTHON_TOKEN = re.compile(r"\w+|[^\w\s]")


class Tokenizer(Protocol):
    def spans(self, text: str) -> list[tuple[int, int]]: ...


class WordTokenizer:
    """Words and marks, as TOKEN_PATTERN has them. White space isn't counted."""

    def count(self, text: str) -> int:
        return len(_PYTHON_TOKEN.findall(text))

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in _PYTHON_TOKEN.finditer(text)]


class BpeTokenizer:
    """Byte-pair tokens of a vocabulary file; special strings are ordinary text."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer as Loaded

        self._loaded = Loaded.from_file(file)
        self._loaded.encode_special_tokens = True

    def spans(self, text: str) -> list[tuple[int, int]]:
        return list(self._loaded.encode(text, add_special_tokens=False).offsets)


@lru_cache(maxsize=4)
def tokenizer(file: str | None = None) -> Tokenizer:
    return BpeTokenizer(file) if file else WordTokenizer()


def count(text: str, file: str | None = None) -> int:
    known = tokenizer(file)
    return known.count(text) if isinstance(known, WordTokenizer) else len(known.spans(text))


def tail(text: str, n: int, file: str | None = None) -> str:
    """The text from its last n tokens on; all of it if it has no more."""
    if n <= 0:
        return ""
    spans = tokenizer(file).spans(text)
    return text if len(spans) <= n else text[spans[-n][0] :]


def count_tokens(column: Column | str) -> Column:
    """Word tokens, counted in the JVM."""
    return F.regexp_count(column, F.lit(TOKEN_PATTERN))


def count_bpe(column: Column | str, file: str) -> Column:
    @F.pandas_udf("int")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else count(t, file))

    return counted(column)
