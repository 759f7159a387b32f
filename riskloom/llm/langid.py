"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

Each language has a profile: its ``profile_size`` most frequent character
n-grams (orders 1 to 3, lower case, every run of non-letters is one boundary
mark) in order of frequency.  A text's own most frequent n-grams are ranked
the same way; the out-of-place distance to a profile is the sum over the
text's n-grams of the difference of ranks, or ``profile_size`` for an n-gram
that the profile lacks.  The language with the least distance wins.

Defined cases: null text, empty text and text without a letter give ``und``
with score 0; with no learned language every text gives ``und``; ties of
frequency are broken by code point, ties of distance by the language's name;
repeated rows are repeated in the result; null ids keep a row, count as not
held out and are never learned from; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import id_fold, sampled_ids, table, text_udf

PROFILE_SIZE = 300
SAMPLE_PER_LANG = 1000      # bound of the learning sample, documents a language
CHUNK = 1 << 22             # code points handled at once of one very long text
UND = "und"


LETTERS: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter (made once a worker)."""
    if not LETTERS:
        LETTERS["all"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return LETTERS["all"]


def _marks(text: str) -> np.ndarray:
    """Code points of the lower-cased text, runs of non-letters as one 1, a 1 at both ends."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[code]
    s = np.concatenate(([1], np.where(letter, code, 1), [1])).astype(np.int64)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 1) | (s[:-1] != 1)
    return s[keep]


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram keys ascending, counts).  A key packs up to three 21-bit code
    points, so it is exact; the boundary mark alone is not an n-gram."""
    s = _marks(text)
    if len(s) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    parts = []
    for a in range(0, len(s), CHUNK):
        uni = s[a:a + CHUNK]
        bi = (s[a:a + CHUNK + 1][:-1] << 21) | s[a:a + CHUNK + 1][1:]
        tri = (bi[: len(s[a:a + CHUNK + 2]) - 2] << 21) | s[a:a + CHUNK + 2][2:]
        parts.append(np.unique(np.concatenate((uni[uni > 1], bi, tri)), return_counts=True))
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def top_ngrams(text: str, size: int) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first, ties by key."""
    keys, n = ngram_counts(text)
    return keys[np.argsort(-n, kind="stable")[:size]]


class Profiles:
    """The learned profiles as one sorted key array and a rank for each language."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.size, self.langs = size, sorted(ranked)
        self.keys = np.unique(np.concatenate([np.asarray(ranked[x], np.int64) for x in self.langs])) if ranked else np.empty(0, np.int64)
        self.rank = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)   # last row: no such n-gram
        for j, x in enumerate(self.langs):
            self.rank[np.searchsorted(self.keys, ranked[x]), j] = np.arange(len(ranked[x]))

    def distances(self, text: str) -> np.ndarray | None:
        """Mean out-of-place distance to each language, over ``size`` (0 to 1)."""
        own = top_ngrams(text, self.size)
        if not len(own) or not len(self.keys):
            return None
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        rank = self.rank[np.where(self.keys[at] == own, at, len(self.keys))]
        far = np.where(rank < 0, self.size, np.minimum(self.size, np.abs(rank - np.arange(len(own))[:, None])))
        return far.sum(0) / (self.size * len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        far = self.distances(text) if text else None
        if far is None:
            return UND, 0.0
        j = int(np.argmin(far))
        return self.langs[j], float(1 - far[j])

    def column(self, text_col):
        """struct(lang_pred, score) of a text column."""
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

        def setup():
            return lambda texts: pa.array([dict(zip(("lang_pred", "score"), self.predict(t))) for t in texts], kind)

        return text_udf(setup, "lang_pred string, score double")(text_col)


def fit_profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 size: int = PROFILE_SIZE, sample_per_lang: int = SAMPLE_PER_LANG) -> Profiles:
    """Profiles from the rows of ``docs`` (give it the learning rows only).

    The sample holds ``sample_per_lang`` whole documents a language, those
    with the smallest hash of the id; its ids are bounded by languages times
    that number, hence the broadcast.  Counting is distributed; only the
    profiles reach the driver.
    """
    picked = sampled_ids(docs, id_col, lang_col, sample_per_lang).select(id_col).distinct()
    sample = (docs.select(id_col, F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
              .where("text is not null and lang is not null")
              .join(F.broadcast(picked), id_col, "left_semi").select("lang", "text"))

    def count(batches):
        for b in batches:
            total: dict[str, dict[int, int]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = total.setdefault(lang, {})
                for k, n in zip(*(x.tolist() for x in ngram_counts(text))):
                    own[k] = own.get(k, 0) + n
            for lang, own in total.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.int64()), pa.array(own.values(), pa.int64())],
                    ["lang", "gram", "n"])

    from pyspark.sql import Window
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (sample.mapInArrow(count, "lang string, gram long, n long")
           .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
           .withColumn("r", F.row_number().over(w)).where(F.col("r") <= size))
    ranked: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["r"])):
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked, size)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows with crc32(doc_id) mod 3 other than 1."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(id_fold("doc_id", 3) == 1, F.lit(False))
    model = fit_profiles(docs.where(id_fold("doc_id", 3) != 1))
    return (docs.select("doc_id", held.alias("held_out"), model.column(F.col("text")).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
