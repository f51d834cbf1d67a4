"""Quality rules on how tokenisers split a text, with bands per language or script.

Every word `[^\\x20\\x09-\\x0D]+` of a whole text is split by each of the public vocabularies. Three
measures follow: characters per token, the share of byte-fallback tokens (bytes of characters that the
vocabulary has no token for), and the entropy of the text's tokens in bits. Texts of one group (the
language if it is known, else the script of most letters) and of about one length (tokens in powers
of two) are held against the group's band: its quartiles, taken over all documents, and so far beyond
them. A text is rejected if one measure is outside its band under every vocabulary.

Base rules come before: fewer than 50 words, or more than half of the words in 3-word windows that
the text holds twice or more.

Results for odd input: null and empty texts have no words and fail the base rules; repeated rows
count each and get the same verdict; null ids are judged as well; a null language is replaced by the
script; groups of one length with fewer than LEAST documents take the band of their script, and without one
nothing is rejected; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stage, text_chunks

#: Base rules: least words, and most percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A band reaches so many interquartile ranges beyond the quartiles, and so large a share of the median at least.
REACH, LEAST_REACH = 3.0, 0.05
#: Byte-fallback tokens that no band rejects, as a share of all.
FREE_BYTES = 0.05
#: Documents that a group of one length has to have for a band of its own.
LEAST = 50
#: Words whose tokens a Python worker remembers per vocabulary.
REMEMBERED = 150_000
_SYMBOLS = b"#*$%&|<>"
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
MEASURES = ("chars_per_token", "byte_share", "token_entropy")


class Vocabulary:
    """Tokens of single words, by sentencepiece (`.model`) or from merge ranks (`.tiktoken`)."""

    def __init__(self, file: str, pattern: str | None = None):
        self.known: dict[bytes, np.ndarray] = {}
        if file.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=file)
            self.size = model.get_piece_size()
            self.is_byte = np.array([model.is_byte(k) for k in range(self.size)])
            self.split = lambda words: model.encode(words, num_threads=1)
        elif file.endswith(".tiktoken"):
            import tiktoken

            with open(file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.size = max(ranks.values()) + 1
            self.is_byte = np.zeros(self.size, dtype=bool)
            for token, k in ranks.items():
                self.is_byte[k] = "�" in token.decode("utf-8", "replace")
            self.split = lambda words: [encoding.encode_ordinary(f" {w}") for w in words]
        else:
            raise ValueError(f"no vocabulary of a known kind: {file}")

    def tokens(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        known = self.known
        out = [known.get(w) for w in words]
        missing = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(missing, self.split([words[k].decode() for k in missing]), strict=True):
            out[k] = np.array(ids, dtype=np.int64)
            if len(known) < REMEMBERED and len(words[k]) < 64:
                known[words[k]] = out[k]
        return out


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(file: str, pattern: str | None) -> Vocabulary:
    if file not in _VOCABULARIES:
        _VOCABULARIES[file] = Vocabulary(file, pattern)
    return _VOCABULARIES[file]


def script(text: str) -> str:
    """The script of most letters, by the first word of their names (`LATIN`, `CJK`, ...); the first by name at a tie."""
    found: Counter = Counter()
    for letter, n in Counter(text).items():
        if letter.isalpha():
            found[unicodedata.name(letter, "OTHER").split(" ")[0].split("-")[0]] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "NONE"


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(codes) - 2
    if n < 2:
        return 0
    width = int(codes.max()) + 1
    pairs = codes[:-1].astype(np.int64) * width + codes[1:]
    if width >= 1 << 21:  # three codes don't fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, at, times = np.unique(pairs[:-1] * width + codes[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    inside = np.zeros(n + 2, dtype=bool)
    for k in range(3):
        inside[k : n + k] |= again
    return int(inside.sum())


def base_counts(text: bytes, codes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = np.frombuffer(text, dtype=np.uint8)
    letters = int(((data & 0xC0) != 0x80).sum() - _BLANK[data].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(codes), letters, len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated_words(codes)


def measures(codes: np.ndarray, begin: np.ndarray, words: list[bytes], chars: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, characters per token, byte share and entropy of texts whose words are codes[begin[i]:begin[i+1]] of `words`."""
    split = v.tokens(words)
    size = np.array([len(x) for x in split], dtype=np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    ids = np.concatenate(split) if split else np.empty(0, np.int64)
    per = size[codes]
    total = np.concatenate(([0], np.cumsum(per)))
    n = total[begin[1:]] - total[begin[:-1]]
    flat = ids[np.repeat(start[codes] - total[:-1], per) + np.arange(total[-1])]
    text = np.repeat(np.arange(len(n)), n)
    in_bytes = np.bincount(text, v.is_byte[flat], minlength=len(n)) if len(flat) else np.zeros(len(n))
    keys, times = np.unique(text * v.size + flat, return_counts=True)
    own = times / n[keys // v.size]
    entropy = np.bincount(keys // v.size, -own * np.log2(own), minlength=len(n)) if len(keys) else np.zeros(len(n))
    some = np.maximum(n, 1)
    return n, chars / some, in_bytes / some, np.abs(entropy)


def measured(docs: DataFrame, files: list[str], pattern: str | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and, an entry for each vocabulary, the measures of every whole text; `group` is its language or script."""
    ready(docs.sparkSession)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    arrays = ["n_tokens", *MEASURES]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vs = [vocabulary(f, pattern) for f in files]
        for batch, texts in text_chunks(batches):
            split = [t.split() for t in texts]  # at the bytes 0x20 and 0x09 to 0x0D
            begin = np.concatenate(([0], np.cumsum([len(x) for x in split]))).astype(np.int64)
            coded = pa.array([w for x in split for w in x], pa.large_binary()).dictionary_encode()
            codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            base = [base_counts(t, codes[a:b]) for t, a, b in zip(texts, begin[:-1], begin[1:], strict=True)]
            chars = np.array([x[1] for x in base], dtype=np.int64)
            by = [measures(codes, begin, words, chars, v) for v in vs]
            names = [x.as_py() if x.is_valid else script(t.decode()) for x, t in zip(batch.column("lang"), texts, strict=True)]
            lists = [pa.array(np.stack([m[k] for m in by], axis=1).tolist(), pa.list_(pa.int64() if k == 0 else pa.float64())) for k in range(4)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()), *[pa.array([x[k] for x in base], pa.int64()) for k in range(5)], *lists], names=["doc_id", "group", *counts, *arrays])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    fields = ", ".join([*(f"{c} long" for c in counts), "n_tokens array<long>", *(f"{m} array<double>" for m in MEASURES)])
    return rows.mapInArrow(measure, f"doc_id long, group string, {fields}")


def judge(table: DataFrame, n_vocabularies: int) -> DataFrame:
    """base_failed, kept and `outside` (the measures that lie outside their bands) for a table of measured().

    Bands need one aggregation by group and length, which combines before the shuffle; their rows are as many as
    groups and powers of two. Equal rows count once, so that copies don't narrow a band.
    """
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    length = F.when(F.col("n_tokens")[0] > 0, F.floor(F.log2(F.col("n_tokens")[0].cast("double")))).otherwise(-1).cast("int")
    table = table.withColumns({"base_failed": base, "length": length})
    values = [(f"{m}_{k}", F.col(m)[k]) for m in MEASURES for k in range(n_vocabularies)]
    fit = table.where("not base_failed").select("group", "length", *[x.alias(name) for name, x in values]).distinct()
    quartiles = [F.percentile_approx(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(name) for name, _ in values]
    own = stage(fit.groupBy("group", "length").agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= LEAST), "bands")
    of_all = stage(fit.groupBy("length").agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= LEAST), "bands")
    named = lambda t, p: t.select(*[c for c in ("group", "length") if c in t.columns], *[F.col(name).alias(f"{p}_{name}") for name, _ in values])
    joined = table.join(named(own, "own"), ["group", "length"], "left").join(named(of_all, "all"), "length", "left")

    def outside(m: str, k: int):
        q, x = F.coalesce(F.col(f"own_{m}_{k}"), F.col(f"all_{m}_{k}")), F.col(m)[k]
        reach = F.greatest(REACH * (q[2] - q[0]), LEAST_REACH * q[1])
        high = x > q[2] + reach
        if m == "byte_share":
            return F.coalesce(high & (x > FREE_BYTES), F.lit(False))
        return F.coalesce((x < q[0] - reach) | high, F.lit(False))

    failed = [F.when(_all([outside(m, k) for k in range(n_vocabularies)]), F.lit(m)) for m in MEASURES]
    found = joined.withColumn("outside", F.array_compact(F.array(*failed)))
    kept = ~F.col("base_failed") & (F.size("outside") == 0)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "group", "n_tokens", *MEASURES, "outside")


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out &= c
    return out


def rules(docs: DataFrame, files: list[str], pattern: str | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, measures, base_failed and kept."""
    return judge(stage(measured(docs, files, pattern, id_col, text_col, lang_col), "measured"), len(files))
