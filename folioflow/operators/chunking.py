"""Splitting long documents into chunks of a token budget that overlap.

Short documents become one chunk in the JVM. Only documents whose token count is over the
budget go through Python, one row in and an array of chunks out, so nothing is shuffled.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import tokens as T
from ..schemas import CHUNK

# Where sentences and paragraphs end.
_SENTENCE_END = r"(?<=[.?!…])\s+(?=[\"'«“¿¡]?[A-ZÁÉÍÓÚÑ0-9])"
_SENTENCE = re.compile(_SENTENCE_END)
_PARAGRAPH = re.compile(r"\n\s*\n")
# How a chunk's sections are named.
SOURCE = "document_intelligence_chunking"
WHOLE, UP_TO, SLICE = "Documento completo", "Hasta sección {}", "Sección {}"


def paragraphs(column: Column | str, pattern: str = r"\n\s*\n") -> Column:
    c = F.transform(F.split(column, pattern), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(c, lambda x: x != "")


def sentences(column: Column | str) -> Column:
    return F.filter(F.split(column, _SENTENCE_END), lambda x: F.trim(x) != "")


def sections(column: Column | str, patterns: tuple[str, ...]) -> Column:
    """Parts that begin at a separator and keep it; every separator splits."""
    c = F.transform(F.split(column, "(?=" + "|".join(patterns) + ")"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(c, lambda x: x != "")


def split_sections(text: str, patterns: tuple[str, ...], compat: bool = False) -> list[str]:
    """The same in Python. compat: pattern by pattern, each later part led by the first separator's text."""
    if not compat:
        cuts = [m.start() for m in re.finditer("(?=" + "|".join(patterns) + ")", text)]
        ends = [0, *[c for c in cuts if c], len(text)]
        return [p for a, b in zip(ends, ends[1:], strict=False) if (p := text[a:b].strip())]
    pieces = [text]
    for pattern in patterns:
        later = []
        for piece in pieces:
            lead = m[0] if (m := re.search(pattern, piece)) else ""
            later += [part if k == 0 else lead + part for k, part in enumerate(re.split(pattern, piece))]
        pieces = later
    return [p for x in pieces if (p := x.strip())]


class Packer:
    """Greedy packing of parts into chunks of max tokens, the next chunk led by the last one's tail."""

    def __init__(self, max_tokens: int, overlap: int, compat: bool = False, file: str | None = None):
        self.max, self.overlap, self.compat, self.file = max_tokens, overlap, compat, file

    def count(self, text: str) -> int:
        return T.count(text, self.file)

    def pack(self, parts: list[str]) -> list[dict]:
        out: list[dict] = []
        current, held, last = "", 0, ""  # last: what the seam to the next part is counted with

        def flush(last: int) -> None:
            if current.strip():
                out.append({"index": len(out), "content": current, "tokens": held, "sections_range": UP_TO.format(last)})

        for i, part in enumerate(parts):
            n = self.count(part)
            if n > self.max:
                flush(i)
                out += self.numbered(self.split_large(part), len(out))
                current, held = "", 0
                continue
            total = held + n + (self.seam(last, part, n) if current else 0)
            if total <= self.max:
                current, held, last = f"{current}\n\n{part}" if current else part, total, part
                continue
            flush(i - 1)
            lead = T.tail(current, min(self.overlap, max(0, self.max - n)), self.file)
            candidate = f"{lead}\n\n{part}" if lead.strip() else part
            n = self.count(candidate)
            if n > self.max:
                out += self.numbered(self.split_large(part), len(out))
                current, held = "", 0
            else:
                current, held, last = candidate, n, candidate
        flush(len(parts) - 1)
        return out

    def seam(self, last: str, part: str, n: int) -> int:
        """Tokens that joining two parts adds. Words end at white space, so they add up; byte pairs may differ
        around the blank line, which the part before it decides. compat doesn't count them."""
        if self.compat or self.file is None:
            return 0
        return self.count(f"{last}\n\n{part}") - self.count(last) - n

    def numbered(self, chunks: list[dict], first: int) -> list[dict]:
        """compat keeps the numbers that a nested split starts anew."""
        return chunks if self.compat else [{**c, "index": first + k} for k, c in enumerate(chunks)]

    def split_large(self, text: str) -> list[dict]:
        """By paragraphs, else by sentences, else by fixed slices."""
        for pattern in (_PARAGRAPH, _SENTENCE):
            parts = [p for x in pattern.split(text) if (p := x.strip())]
            if len(parts) > 1:
                return self.pack(parts)
        if self.compat:
            step = 3 * self.max
            cuts = [text[a : a + step] for a in range(0, len(text), step)]
        else:
            spans = T.tokenizer(self.file).spans(text)
            starts = [0, *[spans[k][0] for k in range(self.max, len(spans), self.max)], len(text)]
            cuts = [text[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        return [{"index": k, "content": c, "tokens": self.count(c), "sections_range": SLICE.format(k)} for k, c in enumerate(cuts) if c.strip()]


def chunk_text(text: str, cfg: EngineConfig, file: str | None = None) -> list[dict]:
    """Chunks of one text, as chunk() makes them."""
    n = T.count(text, file)
    if n <= cfg.max_tokens:
        return [{"index": 0, "content": text, "tokens": n, "sections_range": WHOLE}]
    return Packer(cfg.max_tokens, cfg.overlap_tokens, cfg.compat, file).pack(split_sections(text, cfg.section_patterns, cfg.compat))


def chunk(docs: DataFrame, cfg: EngineConfig, content: str = "content", file: str | None = None) -> DataFrame:
    """docs with total_tokens, requires_chunking, chunking_strategy and chunks (array)."""
    counted = docs.withColumn("total_tokens", T.count_bpe(content, file) if file else T.count_tokens(content))
    long = F.col("total_tokens") > cfg.max_tokens

    @F.pandas_udf(f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in CHUNK.split(','))}>>")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else chunk_text(t, cfg, file))

    one = F.array(F.struct(F.lit(0).alias("index"), F.col(content).alias("content"), F.col("total_tokens").cast("int").alias("tokens"), F.lit(WHOLE).alias("sections_range")))
    # a Python function runs for every row of its stage, so short texts are hidden from it; as
    # nondeterministic, the optimizer doesn't copy it into filters
    made = counted.withColumn("_long", packed.asNondeterministic()(F.when(long, F.col(content))))
    return made.select(*counted.columns, long.alias("requires_chunking"), F.when(long, "sections_with_overlap").otherwise("none").alias("chunking_strategy"), F.when(long, F.col("_long")).otherwise(one).alias("chunks"))


def stored_chunks(chunked: DataFrame) -> DataFrame:
    """One row per chunk, named {stem}_chunk_000."""
    each = chunked.select("*", F.explode("chunks").alias("c"))
    stem = F.regexp_replace("document_name", r"\.[^.]*$", "")
    return each.select("project_name", F.format_string("%s_chunk_%03d", stem, F.col("c.index")).alias("document_name"), F.col("c.index").alias("chunk_index"), "c.content", "c.tokens", "c.sections_range", F.col("document_name").alias("original_document"), F.size("chunks").alias("total_chunks"), "chunking_strategy")


def fixed_windows(column: Column | str, size: int) -> Column:
    """Slices of `size` characters, as array: what is left to do with a text without paragraphs and sentences. A text
    is cut up before its slices are exploded, so no slice carries the whole."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.ceil(F.length(c) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.substring(c, k * size + 1, F.lit(size)))
    return F.when(n > 0, cut).otherwise(F.array().cast("array<string>"))


def project_chunks(chunked: DataFrame) -> DataFrame:
    """Chunks of projects whose documents were joined first: named {project}_chunk_000, of {project}_concatenated."""
    each = chunked.select("*", F.explode("chunks").alias("c"))
    name = F.concat("project_name", F.lit("_concatenated"))
    return each.select("project_name", F.format_string("%s_chunk_%03d", "project_name", F.col("c.index")).alias("document_name"), F.col("c.index").alias("chunk_index"), "c.content", "c.tokens", "c.sections_range", name.alias("original_document"), F.size("chunks").alias("total_chunks"), "chunking_strategy")


def corpus_records(chunks: DataFrame, cfg: EngineConfig, stamp: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The twelve fields of a corpus record, after columns to keep."""
    return chunks.select(
        *keep,
        F.format_string("%s_chunk_%03d", "project_name", "chunk_index").alias("id_chunk"), F.col("project_name").alias("proyecto"), F.col("content").alias("contenido"),
        F.col("tokens").cast("int").alias("tokens"), F.col("chunk_index").cast("int").alias("indice_chunk"), F.col("sections_range").alias("rango_secciones"),
        F.col("chunking_strategy").alias("estrategia_chunking"), F.lit(cfg.max_tokens).alias("max_tokens_configurado"), F.lit(cfg.overlap_tokens).alias("overlap_tokens"),
        (F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if stamp is None else stamp.cast("string")).alias("timestamp_procesamiento"), F.lit(SOURCE).alias("fuente"), F.lit("1.0").alias("version_esquema"),
    )


def chunk_summary(chunked: DataFrame) -> DataFrame:
    return chunked.groupBy("project_name").agg(F.count_if("requires_chunking").alias("chunked"), F.count_if(~F.col("requires_chunking")).alias("not_chunked"), F.sum(F.size("chunks")).alias("total_chunks"))
