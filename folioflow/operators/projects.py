"""Chunking of whole projects, whose concatenated text is spread over many rows and tasks.

A project's text comes as ordered parts (layout.corpus). Their sections are packed greedily into chunks of a
token budget, each led by the last tokens of the one before, as the packer of single texts does. What a chunk
that begins at a section takes in depends on that section alone: it is led by min(overlap, budget - its
tokens) tokens, and by none after a section over the budget. So sections are laid out on the line of their
project's tokens, and the line is cut into ranges of RANGE budgets. Each range finds, without texts, where a
chunk that enters it would leave it; doubling these jumps tells in a logarithm of the ranges which entries are
real; and a second pass walks the real chunks of each range. Texts are joined to chunks at the end,
so that no row or task ever holds more of a project than a range's numbers or a chunk's text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import tokens as T
from ..functions.running import running_sums
from ..sources.staging import staged
from .chunking import UP_TO, WHOLE, Packer, split_sections

#: Budgets of tokens that a range of a project's line holds.
RANGE = 16
_KEY = ["project_name"]
_PART = [*_KEY, "part"]


def sections(parts: DataFrame, cfg: EngineConfig, file: str | None = None) -> DataFrame:
    """project_name, part, place, n (tokens), own (tokens of the part before it), text, pieces: the sections of
    every part. pieces: chunks of a section over the budget."""
    piece = pa.struct([("content", pa.string()), ("tokens", pa.int32()), ("sections_range", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(cfg.max_tokens, cfg.overlap_tokens, False, file)
        for batch in batches:
            for project, part, content in zip(*(batch.column(c).to_pylist() for c in ("project_name", "part", "content")), strict=True):
                rows, own = [], 0
                for place, text in enumerate(split_sections(content or "", cfg.section_patterns)):
                    n = packer.count(text)
                    large = [{k: c[k] for k in ("content", "tokens", "sections_range")} for c in packer.split_large(text)] if n > cfg.max_tokens else None
                    rows.append((project, part, place, n, own, text, large))
                    own += n
                if rows:
                    columns = zip(*rows, strict=True)
                    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(piece)]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["project_name", "part", "place", "n", "own", "text", "pieces"])

    return parts.select("project_name", "part", "content").mapInArrow(cut, "project_name string, part string, place long, n long, own long, text string, pieces array<struct<content:string,tokens:int,sections_range:string>>")


class Line:
    """Sections of a range and its neighbours on a project's line, in order: number, first token, tokens, whether
    the range owns them, whether nothing leads them."""

    def __init__(self, table: pa.Table, cfg: EngineConfig):
        by = np.argsort(table.column("number").to_numpy(), kind="stable")
        self.number, self.start, self.n = (table.column(c).to_numpy()[by] for c in ("number", "start", "n"))
        self.mine, self.fresh = (table.column(c).to_numpy(zero_copy_only=False)[by] for c in ("mine", "fresh"))
        self.large = self.n > cfg.max_tokens
        self.end = self.start + self.n
        self.lead = np.where(self.fresh, 0, np.minimum(cfg.overlap_tokens, np.maximum(cfg.max_tokens - self.n, 0)))
        # the first later section that a chunk has no room for; a section over the budget never fits
        self.next = np.searchsorted(self.end, cfg.max_tokens - self.lead - self.n + self.end, side="right")


def _jumps(line: Line, bound: int) -> Iterator[tuple[int, int | None]]:
    """(number, number of the first chunk start beyond the range) of sections at which a chunk may enter it: those that begin
    before `bound`, and those that nothing leads. None: the chunks end before, or at a section over the budget."""
    out: dict[int, int | None] = {}
    n = len(line.number)
    for i in range(n - 1, -1, -1):
        if not line.mine[i] or line.large[i]:
            continue
        j = int(line.next[i])
        if j >= n or line.large[j]:
            out[i] = None
        else:
            out[i] = out[j] if line.mine[j] else int(line.number[j])
        if line.start[i] < bound or line.fresh[i]:
            yield int(line.number[i]), out[i]


def _walk(line: Line, entered: np.ndarray) -> Iterator[tuple[int, int, int, int, int | None]]:
    """(first, tokens, last, number, keep) of the sections of every chunk that begins in the range: keep is how many of
    the last tokens of a leading section it takes, and null for sections that it takes whole."""
    seen = set()
    for i in np.flatnonzero(entered & line.mine).tolist():
        while i < len(line.number) and line.mine[i] and not line.large[i] and i not in seen:
            seen.add(i)
            j = int(line.next[i])
            first, held = int(line.number[i]), int(line.lead[i] + line.end[j - 1] - line.start[i])
            last = int(line.number[j] if j < len(line.number) and line.large[j] else line.number[j - 1])
            if line.lead[i]:
                begin = line.start[i] - line.lead[i]
                for s in range(int(np.searchsorted(line.end, begin, side="right")), i):
                    keep = int(line.end[s] - begin)
                    yield first, held, last, int(line.number[s]), keep if keep < line.n[s] else None
            for s in range(i, j):
                yield first, held, last, int(line.number[s]), None
            i = j


def chunk_projects(parts: DataFrame, cfg: EngineConfig, file: str | None = None) -> DataFrame:
    """Chunks of projects whose text comes in ordered parts (project_name, part, content; a part's name is unique in its
    project): named {project}_chunk_000, of {project}_concatenated, with index, content, tokens, sections_range, total_chunks
    and strategy. A project within the budget is one chunk, as it stands. The last tokens of a chunk are counted in words;
    byte-pair vocabularies may differ by a few tokens at seams and are refused, as is compat."""
    if cfg.compat or file is not None:
        raise ValueError("projects are chunked by word tokens and with continuing numbers only")
    size, overlap = cfg.max_tokens, cfg.overlap_tokens
    span = RANGE * size
    cut = staged(sections(parts, cfg), "sections")
    sizes = cut.groupBy(*_PART).agg(F.count("*").alias("sections"), F.sum("n").alias("tokens"))
    before = running_sums(sizes, _KEY, ["part"], ["sections", "tokens"])
    counted = sizes.groupBy("project_name").agg(F.sum("tokens").alias("total"))
    totals = parts.select("project_name").distinct().join(counted, "project_name", "left").select("project_name", F.coalesce("total", F.lit(0)).alias("total"))
    within = totals.where(F.col("total") <= size)
    over = totals.where(F.col("total") > size).select("project_name")

    # a section's number and first token on its project's line
    placed = staged(cut.select(*_PART, "place", "n", "own").join(over, "project_name", "left_semi").join(before, _PART).select(*_PART, "place", (F.col("before_sections") + F.col("place")).alias("number"), (F.col("before_tokens") + F.col("own")).alias("start"), "n"), "placed")
    after_large = placed.where(F.col("n") > size).select("project_name", (F.col("number") + 1).alias("number"), F.lit(True).alias("after"))
    line = placed.drop(*_PART[1:], "place").join(after_large, ["project_name", "number"], "left").select("project_name", "number", "start", "n", ((F.col("number") == 0) | F.col("after").isNotNull()).alias("fresh"))
    r, into = F.floor(F.col("start") / span), F.col("start") % span
    ranges = [F.struct(r.alias("range"), F.lit(True).alias("mine")), F.when((into < 2 * size) & (r > 0), F.struct((r - 1).alias("range"), F.lit(False).alias("mine"))), F.when((F.col("n") <= size) & (into + F.col("n") > span - overlap), F.struct((r + 1).alias("range"), F.lit(False).alias("mine")))]
    dealt = staged(line.withColumn("x", F.explode(F.array_compact(F.array(*ranges)))).select("project_name", "number", "start", "n", "fresh", "x.range", "x.mine"), "line")

    def jumps(key: tuple, table: pa.Table) -> pa.Table:
        bound = key[1].as_py() * span + 2 * size
        rows = [(key[0].as_py(), a, b) for a, b in _jumps(Line(table, cfg), bound)]
        return pa.Table.from_pylist([dict(zip(("project_name", "a", "b"), x, strict=True)) for x in rows], pa.schema([("project_name", pa.string()), ("a", pa.int64()), ("b", pa.int64())]))

    jump = staged(dealt.groupBy("project_name", "range").applyInArrow(jumps, "project_name string, a long, b long").where("b is not null"), "jumps")
    reached = staged(line.where(F.col("fresh") & (F.col("n") <= size)).select("project_name", F.col("number").alias("a")), "entries")
    n = reached.count()
    while True:  # after k rounds, jumps are 2^k ranges long and all entries within 2^k ranges are known
        reached = staged(reached.union(reached.join(jump, ["project_name", "a"]).select("project_name", F.col("b").alias("a"))).distinct(), "entries")
        if (now := reached.count()) == n:
            break
        n = now
        jump = staged(jump.join(jump.select("project_name", F.col("a").alias("b"), F.col("b").alias("c")), ["project_name", "b"]).select("project_name", "a", F.col("c").alias("b")), "jumps")

    fields = [("project_name", pa.string()), ("first", pa.int64()), ("held", pa.int64()), ("last", pa.int64()), ("number", pa.int64()), ("keep", pa.int64())]

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        by = np.argsort(table.column("number").to_numpy(), kind="stable")
        entered = table.column("entered").to_numpy(zero_copy_only=False)[by]
        rows = list(_walk(Line(table, cfg), entered))
        columns = zip(*rows, strict=True) if rows else ([],) * 5
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), *(pa.array(c, t) for c, (_, t) in zip(columns, fields[1:], strict=True))], schema=pa.schema(fields))

    marked = dealt.join(reached.select("project_name", F.col("a").alias("number"), F.lit(True).alias("entered")), ["project_name", "number"], "left").withColumn("entered", F.coalesce("entered", F.lit(False)))
    members = staged(marked.groupBy("project_name", "range").applyInArrow(walk, "project_name string, first long, held long, last long, number long, keep long"), "members")

    @F.pandas_udf("string")
    def tail(texts: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([T.tail(t, int(k)) for t, k in zip(texts, keep, strict=True)], dtype=object)

    numbered = placed.select(*_PART, "place", "number")
    texts = cut.where("pieces is null").select(*_PART, "place", "text").join(numbered, [*_PART, "place"]).select("project_name", "number", "text")
    own = members.join(texts, ["project_name", "number"])
    own = own.where("keep is null").unionByName(own.where("keep is not null").withColumn("text", tail("text", "keep")))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))), lambda x: x["text"])
    packed = own.groupBy("project_name", "first", "held", "last").agg(F.array_join(in_order, "\n\n").alias("content"))
    packed = packed.select("project_name", "first", F.lit(0).alias("sub"), "content", F.col("held").cast("int").alias("tokens"), F.replace(F.lit(UP_TO), F.lit("{}"), F.col("last").cast("string")).alias("sections_range"))
    large = cut.where("pieces is not null").join(over, "project_name", "left_semi").join(numbered, [*_PART, "place"]).select("project_name", F.col("number").alias("first"), F.posexplode("pieces").alias("sub", "p")).select("project_name", "first", "sub", "p.content", "p.tokens", "p.sections_range")
    keys = members.select("project_name", "first", F.lit(0).alias("sub")).distinct().union(large.select("project_name", "first", "sub")).withColumn("one", F.lit(1))
    order = running_sums(keys, _KEY, ["first", "sub"], ["one"])
    counts = keys.groupBy("project_name").agg(F.count("*").cast("int").alias("total_chunks"))
    long = packed.unionByName(large).join(order, ["project_name", "first", "sub"]).join(counts.join(totals, "project_name"), "project_name")
    long = long.select("project_name", F.col("total").alias("total_tokens"), F.col("before_one").cast("int").alias("chunk_index"), "content", "tokens", "sections_range", "total_chunks", F.lit("sections_with_overlap").alias("chunking_strategy"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", F.coalesce("content", F.lit("")).alias("content")))), lambda x: x["content"]), "")
    short = parts.join(within, "project_name").groupBy("project_name", "total").agg(whole.alias("content"))
    short = short.select("project_name", F.col("total").alias("total_tokens"), F.lit(0).alias("chunk_index"), "content", F.col("total").cast("int").alias("tokens"), F.lit(WHOLE).alias("sections_range"), F.lit(1).alias("total_chunks"), F.lit("none").alias("chunking_strategy"))
    every = long.unionByName(short)
    return every.select("project_name", F.format_string("%s_chunk_%03d", "project_name", "chunk_index").alias("document_name"), "chunk_index", "content", "tokens", "sections_range", F.concat("project_name", F.lit("_concatenated")).alias("original_document"), "total_chunks", "chunking_strategy", "total_tokens")
