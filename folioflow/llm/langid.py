"""Language identification by words first, then by ever shorter character n-grams.

A known word adds its log frequency in each language. An unseen word is looked up by its
5-grams; if none of them is known, by its 4-grams, and so on down to single letters; it
adds their mean. The language with the largest sum wins, the first by name at a tie.

Results for odd input: a null text or one without a letter is `und` with score 0; a text whose
words give no evidence gets the most frequent learned language and its share; rows with a
null id or language are predicted but not learned from; repeated rows count each; extra
columns are ignored; an empty table gives an empty result, and a table with nothing to
learn from predicts `und`.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, stage, text_chunks, threshold

#: Documents that the model is learned from at most (expected; taken by a hash of the id), and the
#: words and n-grams that it keeps at most, the most frequent ones.
TRAIN_DOCS, KEEP_WORDS, KEEP_GRAMS = 20_000, 150_000, 150_000
LONGEST = 5
#: Unseen words whose scores a Python worker remembers.
REMEMBERED = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, in lower case; numerals such as a superscript two are no letters."""
    out = []
    for w in _WORD.findall(text.lower()):
        if w.isalpha():
            out.append(w)
        else:
            out += "".join(c if c.isalpha() else " " for c in w).split()
    return out


def grams(word: str, n: int) -> list[str]:
    """n-grams of a word with its ends marked; at n = 1 its letters."""
    if n > 1:
        word = f"^{word}$"
    return [word[i : i + n] for i in range(len(word) - n + 1)]


class Model:
    def __init__(self, languages: list[str], shares: np.ndarray, known: dict[str, int], table: np.ndarray, pieces: dict[str, int], piece_table: np.ndarray):
        self.languages, self.shares, self.known, self.table, self.pieces, self.piece_table = languages, shares, known, table, pieces, piece_table
        self.unseen: dict[str, np.ndarray | None] = {}

    def back_off(self, word: str) -> np.ndarray | None:
        if word in self.unseen:
            return self.unseen[word]
        found = None
        for n in range(LONGEST, 0, -1):
            if at := [k for g in grams(word, n) if (k := self.pieces.get(g)) is not None]:
                found = self.piece_table[at].mean(0)
                break
        if len(self.unseen) < REMEMBERED and len(word) < 64:
            self.unseen[word] = found
        return found

    def predict(self, text: str) -> tuple[str, float]:
        own = words(text)
        if not own or not self.languages:
            return "und", 0.0
        total = np.log(self.shares)
        get = self.known.get
        at = [get(w) for w in own]
        if None in at:
            for w in (w for w, k in zip(own, at, strict=True) if k is None):
                if (found := self.back_off(w)) is not None:
                    total = total + found
            at = [k for k in at if k is not None]
        if at:
            total = total + self.table[at].sum(0, dtype=np.float64)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def _table(counts: dict[str, dict[str, int]], languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Rows of log frequencies with add-a-half smoothing."""
    names = sorted(counts)
    place = {x: k for k, x in enumerate(languages)}
    c = np.zeros((len(names), len(languages)), dtype=np.float64)
    for k, name in enumerate(names):
        for lang, n in counts[name].items():
            c[k, place[lang]] = n
    total = c.sum(0) + 0.5 * (len(names) + 1)
    return {name: k for k, name in enumerate(names)}, np.log((c + 0.5) / total).astype(np.float32)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> Model:
    """A model from labelled texts; its size is bounded by KEEP_WORDS, KEEP_GRAMS and the languages."""
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null and doc_id is not null")
    n = rows.count()
    if n > train_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * train_docs / n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            c: dict[str, Counter] = defaultdict(Counter)
            for lang, t in zip(batch.column("lang").to_pylist(), texts, strict=True):
                c[lang].update(words(t.decode()))
            flat = [(lang, w, k) for lang, own in c.items() for w, k in own.items()]
            if flat:
                yield pa.record_batch([pa.array(x) for x in zip(*flat, strict=True)], names=["lang", "gram", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c: Counter = Counter()
            for lang, w, k in zip(*(batch.column(x).to_pylist() for x in ("lang", "gram", "n")), strict=True):
                for size in range(1, LONGEST + 1):
                    for g in grams(w, size):
                        c[lang, g] += k
            if c:
                yield pa.record_batch([pa.array([x[0] for x in c]), pa.array([x[1] for x in c]), pa.array(list(c.values()), pa.int64())], names=["lang", "gram", "n"])

    fields = "lang string, gram string, n long"

    def most(counted: DataFrame, keep: int) -> dict[str, dict[str, int]]:
        """The most frequent grams with their counts by language; those that tie at the last place are left out."""
        per = stage(counted.groupBy("gram").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")), "grams")
        if per.count() > keep:
            per = per.where(F.col("total") > threshold(per, "total", keep + 1))
        return {r["gram"]: r["by"] for r in per.collect()}  # `keep` rows at most

    counted = stage(rows.mapInArrow(count, fields).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "words")
    shares = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(shares)
    known, table = _table(most(counted, KEEP_WORDS), languages)
    pieces, piece_table = _table(most(counted.mapInArrow(cut, fields).groupBy("lang", "gram").agg(F.sum("n").alias("n")), KEEP_GRAMS), languages)
    share = np.array([shares[x] for x in languages], dtype=np.float64)
    return Model(languages, share / max(share.sum(), 1), known, table, pieces, piece_table)


def predict(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see fit

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            found = [sent.value.predict(t.decode()) for t in texts]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
