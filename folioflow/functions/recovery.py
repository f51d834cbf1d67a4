"""Recovery of JSON objects from model output."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .tokens import WHITE

_OPEN_FENCE = re.compile(r"\A```(?:json)?[ \t]*\n?")
_CLOSE_FENCE = re.compile(r"\n?```\s*\Z")
_FENCED = re.compile(r"```(?:json)?\s*\n?(.*?)```", re.DOTALL)
_LOOSE_COMMA = re.compile(r",(\s*[}\]])")


#: Levels of objects and arrays; text that is nested deeper is no JSON, in the JVM's parser either.
DEPTH = 1_000
_NESTING = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\]]', re.DOTALL)


def too_deep(text: str) -> bool:
    """Whether brackets outside strings are nested deeper than DEPTH."""
    if text.count("{") + text.count("[") <= DEPTH:
        return False
    depth = 0
    for m in _NESTING.finditer(text):
        mark = m[0]
        if mark in "{[":
            depth += 1
            if depth > DEPTH:
                return True
        elif mark in "}]":
            depth -= 1
    return False


def _loads(text: str):
    """The parsed value, or None. Repeated keys keep the last value; NaN and infinities become null."""
    if too_deep(text):
        return None
    try:
        return json.loads(text, parse_constant=lambda _: None)
    except ValueError:
        return None


def unfence(text: str) -> str:
    """Without a leading and a trailing code fence."""
    text = text.strip()
    return _CLOSE_FENCE.sub("", _OPEN_FENCE.sub("", text)).strip() if text.startswith("```") else text


def balanced(text: str, compat: bool = False) -> Iterator[str]:
    """Brace-balanced parts at the top level; braces in strings don't count.

    A closing brace or a quote outside an object is skipped; compat lets it spoil what follows.
    """
    depth = start = 0
    inside = escaped = False
    for i, c in enumerate(text):
        if inside:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                inside = False
        elif c == '"':
            inside = compat or depth > 0
        elif c == "{":
            if depth == 0:
                start = i
            depth += 1
        elif c == "}" and (depth > 0 or compat):
            depth -= 1
            if depth == 0:
                yield text[start : i + 1]


def objects(text: str | None, compat: bool = False) -> list[dict]:
    """All JSON objects of a text: it as a whole, its elements, its balanced parts, or its repaired form."""
    body = unfence(text or "")
    if not body:
        return []
    value = _loads(body)
    if isinstance(value, dict):
        return [value]
    if isinstance(value, list):
        flat = [y for x in value for y in (x if isinstance(x, list) else [x])]
        return [x for x in flat if isinstance(x, dict)]
    found = [x for part in balanced(body, compat) if isinstance(x := _loads(part), dict)]
    if found:
        return found
    mended = _LOOSE_COMMA.sub(r"\1", body)
    value = _loads(mended[: mended.rfind("}") + 1])
    return [value] if isinstance(value, dict) else []


def repair(text: str) -> str:
    """Closes a cut text: its string, its trailing comma, its braces and its brackets, by plain counts."""
    if text.count('"') % 2:
        text += '"'
    text = text.rstrip().removesuffix(",")
    return text + "}" * (text.count("{") - text.count("}")) + "]" * (text.count("[") - text.count("]"))


def extract(text: str | None) -> str | None:
    """The JSON that a text holds: fenced, embedded in a fence, or bare and cut; else the text itself."""
    if text is None:
        return None
    body = unfence(text)
    for part in (body, *(m.strip() for m in _FENCED.findall(text))):
        if part[:1] in ("{", "["):
            if _loads(part) is not None:
                return part
            if _loads(repair(part)) is not None:
                return repair(part)
    return text


def canonical(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


@F.pandas_udf(ArrayType(StringType()))
def recover_json_objects(texts: pd.Series) -> pd.Series:
    """Canonical JSON of each object of a text."""
    return texts.map(lambda t: [canonical(x) for x in objects(t)])


@F.pandas_udf(ArrayType(StringType()))
def recover_json_objects_compat(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [canonical(x) for x in objects(t, compat=True)])


def unfenced(column: Column) -> Column:
    """unfence() in SQL functions."""
    strip = lambda c: F.regexp_replace(c, rf"\A[{WHITE}]+|[{WHITE}]+\z", "")
    c = strip(column)
    bare = F.regexp_replace(F.regexp_replace(c, r"\A```(?:json)?[ \t]*\n?", ""), rf"\n?```[{WHITE}]*\z", "")
    return F.when(F.startswith(c, F.lit("```")), strip(bare)).otherwise(c)


def balanced_parts(column: Column) -> Column:
    """balanced() in SQL functions: the text's marks (quotes, braces and escapes, and the runs between them) are gone through once,
    with the depth of braces, whether the place is in a string, and where the current object began."""
    marks = F.regexp_extract_all(column, F.lit(r'(?s)\\.|[{}"]|\\|[^{}"\\]+'), F.lit(0))
    cut = "array<struct<a:int,b:int>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(False).alias("inside"), F.lit(0).alias("begin"), F.array().cast(cut).alias("cuts"))

    def step(s: Column, mark: Column) -> Column:
        escaped = F.startswith(mark, F.lit("\\")) & (F.length(mark) == 2)
        # an escape counts in strings only; outside, its character is read as if it stood alone
        own, place = F.when(escaped, F.substring(mark, 2, 1)).otherwise(mark), s["at"] + escaped.cast("int")
        quote = (own == '"') & ~(s["inside"] & escaped)
        opens, closes = ~s["inside"] & (own == "{"), ~s["inside"] & (own == "}") & (s["depth"] > 0)
        depth = s["depth"] + opens.cast("int") - closes.cast("int")
        ends = closes & (depth == 0)
        return F.struct(
            (s["at"] + F.length(mark)).alias("at"), depth.alias("depth"), F.when(quote, ~s["inside"] & (s["depth"] > 0)).otherwise(s["inside"]).alias("inside"),
            F.when(opens & (s["depth"] == 0), place).otherwise(s["begin"]).alias("begin"),
            F.when(ends, F.array_append(s["cuts"], F.struct(s["begin"].alias("a"), (place + 1).alias("b")))).otherwise(s["cuts"]).cast(cut).alias("cuts"),
        )

    cuts = F.aggregate(marks, start, step)["cuts"]
    return F.transform(cuts, lambda c: F.substring(column, c["a"] + 1, c["b"] - c["a"]))


def recovered(rows: DataFrame, column: str, name: str, compat: bool = False) -> DataFrame:
    """rows with the array of objects in a text. Sound JSON, fenced or not, an object or an array of objects, is split in the JVM,
    and so are texts all of whose balanced parts are sound objects; Python sees only the others, which have to be mended."""
    clash = "_body"
    while clash in rows.columns:
        clash += "_"
    # a column of its own, so that its parts are not cut anew wherever they are named
    made = rows.withColumn(clash, unfenced(F.col(column)))
    body = F.col(clash)
    kind = F.schema_of_variant(F.try_parse_json(body))
    normal = lambda c: F.get(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>"), F.lit(0))
    sound = F.when(F.startswith(kind, F.lit("OBJECT<")), F.array(normal(body))).when(F.startswith(kind, F.lit("ARRAY<OBJECT<")), F.filter(F.from_json(body, "array<string>"), lambda x: x.isNotNull()))
    if not compat:
        parts = F.when(kind.isNull() & F.contains(body, F.lit("{")), balanced_parts(body))
        fine = (F.size("_parts") > 0) & F.forall("_parts", lambda p: F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json(p)), F.lit("OBJECT<")), F.lit(False)))
        made = made.withColumn("_parts", parts)
        sound = F.coalesce(sound, F.when(fine, F.transform("_parts", normal)))
    slow = (recover_json_objects_compat if compat else recover_json_objects).asNondeterministic()
    made = made.withColumn("_sound", sound)
    made = made.withColumn("_sound", F.when(F.forall("_sound", lambda x: x.isNotNull()), F.col("_sound")))
    made = made.withColumn("_other", slow(F.when(F.col("_sound").isNull(), F.col(column))))
    return made.withColumn(name, F.coalesce("_sound", "_other")).drop(clash, "_parts", "_sound", "_other")


@F.pandas_udf(StringType())
def extract_json(texts: pd.Series) -> pd.Series:
    return texts.map(extract)


def _count(c: Column, mark: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))


def repair_json(column: Column | str) -> Column:
    """repair() in SQL functions."""
    c = F.col(column) if isinstance(column, str) else column
    quoted = F.when(_count(c, '"') % 2 == 1, F.concat(c, F.lit('"'))).otherwise(c)
    bare = F.regexp_replace(F.regexp_replace(quoted, r"\s+$", ""), r",$", "")
    braces = F.greatest(F.lit(0), _count(bare, "{") - _count(bare, "}"))
    brackets = F.greatest(F.lit(0), _count(bare, "[") - _count(bare, "]"))
    return F.concat(bare, F.repeat(F.lit("}"), braces), F.repeat(F.lit("]"), brackets))


def diagnose_json(column: Column | str) -> Column:
    """What is odd about a text that should be JSON; an empty string if nothing is."""
    c = F.col(column) if isinstance(column, str) else column
    found = [
        F.when(F.length(c) > 10_000, F.lit("very long")),
        F.when(F.contains(c, F.lit("\\x")), F.lit("hexadecimal escape")),
        F.when(_count(c, "{") != _count(c, "}"), F.lit("unbalanced braces")),
        F.when(_count(c, "[") != _count(c, "]"), F.lit("unbalanced brackets")),
        F.when(F.endswith(F.rtrim(c), F.lit(",")) | F.endswith(F.rtrim(c), F.lit('"')), F.lit("cut at the end")),
        F.when(F.contains(c, F.lit("null,")), F.lit("null value")),
        F.when(F.contains(c, F.lit('""')), F.lit("empty string")),
    ]
    return F.array_join(F.array_compact(F.array(*found)), "; ")
