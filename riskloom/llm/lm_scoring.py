"""Cross-entropy difference (Moore and Lewis, 2010) between a target and a background language model.

Both models are bigram models over one vocabulary, every word of the documents
(or, if asked for, the most frequent ones); they have the same form and
smoothing, and the background's counts are scaled to the target's size.  With c
the counts and p1 the smoothed unigram model, which has one entry more for
words never seen, p(w | h) = (c(h, w) + M p1(w)) / (c(h) + M), and p1(w) for
the first word.  (With a smaller vocabulary, also beside words outside it, which
share the one entry.)  A document's score is its target loss less its
background loss a token: the lower, the more like the target.

Counts come from all documents and grow with them.  Documents are dealt into
chunks of about ``CHUNK_BYTES``.  A chunk sends each of its distinct words and
bigrams once, as a request with its own counts, to the range of hashes that the
key falls in: a blob of sorted keys, six bytes each, for each range.  A range
sums the requests of all chunks and answers each blob with the whole corpus's
counts in the same order, so answers need no keys.  A chunk then meets its
answers and scores its documents.  No key is hot (a chunk sends it once), no
table of counts is broadcast or collected, and only three totals reach the driver.
Words and bigrams are told apart by 59-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  Defined cases: null
and empty texts have no tokens and null losses; rows with one id are scored as
one document; null ids too; without a target row the target model is uniform
over the vocabulary; ties in the vocabulary go by the word's hash; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import few, mix64, stored, table
from riskloom.llm.shingles import CACHE, FACTORS, WordHashes

COMMON = 1 << 18
M = 20.0
CHUNK_BYTES = 8 << 20       # text of a chunk, about
KEY_BITS = 60               # a hash of 59 bits, and whether it is a word's
ROWS = "doc_id long, key long, times long, t_loss double, n_loss double, tokens long"
SHIFT = 20                  # bits of a word number in a bigram's key


class Vocabulary(dict):
    """Word (bytes) to its number from 1, or 0."""

    def __init__(self, hashes: np.ndarray):
        self.number = {int(h): i + 1 for i, h in enumerate(hashes)}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[word] = self.number.get(xxhash.xxh3_64_intdigest(word), 0)
        return n

    def of(self, text: str | None) -> np.ndarray:
        ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))


def bigrams(ids: np.ndarray) -> np.ndarray:
    """Keys of the bigrams of two known words."""
    h, w = ids[:-1], ids[1:]
    known = (h > 0) & (w > 0)
    return (h[known] << SHIFT) | w[known]


def _counts(batches, of, name: str):
    """(key, in all documents, in target documents), summed over a batch."""
    for b in batches:
        got = [of(t) for t in b.column(0).to_pylist()]
        keys = np.concatenate(got) if got else np.empty(0, np.int64)
        target = np.repeat(b.column(1).to_numpy(zero_copy_only=False).astype(bool), [len(x) for x in got])
        distinct, at = np.unique(keys, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(distinct.astype(np.int64), pa.int64()), pa.array(np.bincount(at, minlength=len(distinct)), pa.int64()),
             pa.array(np.bincount(at[target], minlength=len(distinct)), pa.int64())], [name, "n", "t"])


class Models:
    """Unigram parts of both models, for word numbers 0 (any other word) to the vocabulary's size."""

    def __init__(self, n: np.ndarray, t: np.ndarray):
        self.totals = float(t.sum()), float(n.sum())
        self.scale = self.totals[0] / self.totals[1] if self.totals[0] and self.totals[1] else 1.0
        self.count = t.astype(float), n * self.scale
        self.p1 = tuple((c + 1.0) / (c.sum() + len(c)) for c in self.count)

    def losses(self, key: np.ndarray, t: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """Target and background loss of bigrams with the given counts in target and all documents."""
        h, w = key >> SHIFT, key & ((1 << SHIFT) - 1)
        return [-np.log((c + M * p[w]) / (one[h] + M)) for c, p, one in zip((t, n * self.scale), self.p1, self.count)]

    def single(self, w: np.ndarray) -> list[np.ndarray]:
        return [-np.log(p[w]) for p in self.p1]


def _chunk(texts: list[str | None], known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words and of the bigrams that end in them (of a first word: none that counts), and the texts' sizes."""
    hashes = [known.of(t) for t in texts]
    size = np.array([len(h) for h in hashes], np.int64)
    w = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    before = np.concatenate(([np.uint64(0)], w[:-1])) if len(w) else w
    key = lambda x: (x >> np.uint64(5)) << np.uint64(1)
    return key(mix64(w)) | np.uint64(1), key(mix64(before * FACTORS[0] + w * FACTORS[1])), size


def _first_words(size: np.ndarray) -> np.ndarray:
    first = np.zeros(int(size.sum()), bool)
    first[(np.cumsum(size) - size)[size > 0]] = True
    return first


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where the keys (sorted) of each range begin, and the end."""
    return np.searchsorted((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))


def _pack(*columns: np.ndarray) -> bytes:
    return pa.compress(np.stack(columns).astype("<i8").tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, columns: int, rows: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, columns * rows * 8, codec="zstd", asbytes=True), "<i8").reshape(columns, rows)


def _requests(ranges: int):
    """A chunk's distinct keys with its own counts, a blob for each range of keys."""

    def run(rows: pa.Table) -> pa.Table:
        words, pairs, size = _chunk(rows["text"].to_pylist(), WordHashes())
        again, good = ~_first_words(size), np.repeat(rows["target"].to_numpy(zero_copy_only=False).astype(bool), size)
        keys, at = np.unique(np.concatenate((words, pairs[again])), return_inverse=True)
        good = np.concatenate((good, good[again]))
        n, t = np.bincount(at, minlength=len(keys)), np.bincount(at[good], minlength=len(keys))
        cut, out = _ranges(keys, ranges), []
        for r in np.flatnonzero(np.diff(cut)).tolist():
            k, part = keys[cut[r]:cut[r + 1]], slice(cut[r], cut[r + 1])
            steps = np.diff(k, prepend=np.uint64(0)).astype("<u8")
            wide = 6 if len(k) < 2 or int(steps[1:].max()) < 1 << 48 else 8
            out.append((r, len(k), wide, int(k[0]), steps[1:].view(np.uint8).reshape(-1, 8)[:, :wide].tobytes(), _pack(n[part], t[part])))
        chunk = rows["chunk"][0].as_py()
        return pa.table([pa.array([chunk] * len(out), pa.int64()), *(pa.array(c, k) for c, k in zip(
            zip(*out) if out else [[]] * 6, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())))],
            names=["chunk", "range", "size", "wide", "start", "steps", "counts"])

    return run


REQUEST = "chunk long, range long, size long, wide int, start long, steps binary, counts binary"
ANSWER = "a_chunk long, range long, size long, counts binary"
SCORED = "doc_id long, n_tokens long, t double, n double"


def _answer(rows: pa.Table) -> pa.Table:
    """The whole counts of each request's keys."""
    keys, counts, cut = [], [], [0]
    for size, wide, start, steps, own in zip(*(rows[c].to_pylist() for c in ("size", "wide", "start", "steps", "counts"))):
        full = np.zeros((size, 8), np.uint8)
        full[1:, :wide] = np.frombuffer(steps, np.uint8).reshape(-1, wide)
        full = full.view("<u8")[:, 0].copy()
        full[0] = start
        keys.append(np.cumsum(full))
        counts.append(_unpack(own, 2, size))
        cut.append(cut[-1] + size)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    n, t = (np.bincount(at, c, minlength=len(distinct)).astype(np.int64)[at] for c in np.concatenate(counts, axis=1))
    answers = [_pack(n[a:b], t[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table({"a_chunk": rows["chunk"], "range": rows["range"], "size": rows["size"], "counts": pa.array(answers, pa.binary())})


def _losses(size: float, n_all: float, t_all: float):
    """Losses of a chunk's documents from the answers to its requests."""
    scale = t_all / n_all if t_all and n_all else 1.0

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, pairs, length = _chunk(rows["text"].to_pylist(), WordHashes())
        first = _first_words(length)
        keys, at = np.unique(np.concatenate((words, pairs[~first])), return_inverse=True)
        answers = answers.sort_by("range")
        counts = [_unpack(c, 2, s) for c, s in zip(answers["counts"].to_pylist(), answers["size"].to_pylist())]
        n, t = np.concatenate(counts, axis=1) if counts else np.zeros((2, 0), np.int64)
        if len(n) != len(keys):
            raise ValueError("a chunk's answers do not fit its requests")
        word, sums, who = at[:len(words)], [], np.repeat(np.arange(len(length)), length)
        for c, total in ((t.astype(float), t_all), (n * scale, n_all * scale)):
            p1 = (c[word] + 1.0) / (total + size + 1.0)
            pair, before = np.zeros(len(words)), np.zeros(len(words))
            pair[~first] = c[at[len(words):]]
            before[1:] = c[word[:-1]]
            before[first] = 0
            sums.append(np.bincount(who, -np.log((pair + M * p1) / (before + M)), minlength=len(length)))
        return pa.table({"doc_id": rows["doc_id"], "n_tokens": pa.array(length), "t": pa.array(sums[0]), "n": pa.array(sums[1])})

    return run


def _score_all(docs: DataFrame, target: Column, chunk_bytes: int) -> DataFrame:
    """``score`` with every word in the vocabulary."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(target, F.lit(False)).alias("target"))

    def word_hashes(batches):
        known = WordHashes()
        return _counts(batches, lambda t: known.of(t).view(np.int64), "w")

    words = rows.select("text", "target").mapInArrow(word_hashes, "w long, n long, t long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    totals = [float(x or 0) for x in words.agg(F.count("*"), F.sum("n"), F.sum("t")).first()]
    chunks = 1 + int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // chunk_bytes
    # the same exchange serves requests and scores
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id", "text", "target")
    asked = rows.groupBy("chunk").applyInArrow(_requests(chunks), REQUEST)
    answers = asked.groupBy("range").applyInArrow(_answer, ANSWER)
    scored = rows.groupBy("chunk").cogroup(answers.groupBy("a_chunk")).applyInArrow(_losses(*totals), SCORED)
    return _per_token(scored.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("t").alias("t"), F.sum("n").alias("n")))


def _summed(rows: DataFrame, each: DataFrame) -> DataFrame:
    """Losses a token of each document, from its own sums and its bigrams' losses."""
    total = lambda a, b: F.sum(F.col(a) + F.col("times") * F.coalesce(b, F.lit(0.0)))
    return _per_token(rows.join(each, F.col("key") == F.col("of"), "left").groupBy("doc_id")
                      .agg(F.sum("tokens").alias("n_tokens"), total("t_loss", "t_each").alias("t"), total("n_loss", "n_each").alias("n")))


def _per_token(summed: DataFrame) -> DataFrame:
    per = lambda c: F.round(F.when(F.col("n_tokens") > 0, c / F.col("n_tokens")), 6)
    return summed.select("doc_id", "n_tokens", per(F.col("t")).alias("target_loss"), per(F.col("n")).alias("background_loss"),
                         per(F.col("t") - F.col("n")).alias("difference"))


def score(docs: DataFrame, target: Column, vocabulary: int | None = None, common: int = COMMON) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, difference; ``target`` marks the rows of the target model.

    The vocabulary is every word, or the given number of most frequent ones (then the ``common`` most
    frequent bigrams' losses are sent to every task).
    """
    if vocabulary is None:
        return _score_all(docs, target, CHUNK_BYTES)
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", F.coalesce(target, F.lit(False)).alias("target"))
    texts = marked.select("text", "target")

    def word_hashes(batches):
        known = WordHashes()
        return _counts(batches, lambda t: known.of(t).view(np.int64), "w")

    words = stored(texts.mapInArrow(word_hashes, "w long, n long, t long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "words")
    top = words.orderBy(F.col("n").desc(), "w").limit(vocabulary).toArrow()
    every = words.agg(F.sum("n"), F.sum("t")).first()
    n, t = (np.asarray(top[c].to_numpy(), float) for c in ("n", "t"))
    models = Models(np.concatenate(([(every[0] or 0) - n.sum()], n)), np.concatenate(([(every[1] or 0) - t.sum()], t)))
    hashes = spark.sparkContext.broadcast(top["w"].to_numpy().view(np.uint64))          # at most ``vocabulary`` numbers

    def pairs(batches):
        known = Vocabulary(hashes.value)
        return _counts(batches, lambda t: bigrams(known.of(t)), "key")

    counts = stored(texts.mapInArrow(pairs, "key long, n long, t long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "bigrams")
    often = counts.orderBy(F.col("n").desc(), "key").limit(common).toArrow().sort_by("key")
    key = often["key"].to_numpy()
    sent = spark.sparkContext.broadcast((key, *models.losses(key, often["t"].to_numpy(), often["n"].to_numpy())))

    def own(batches):
        """One row a document with what can be scored here (a key of its own, below 0), and its other bigrams."""
        known = Vocabulary(hashes.value)
        often, t_often, n_often = sent.value
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                keys, times, sums, who, size = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = known.of(text)
                    k, c = np.unique(bigrams(ids), return_counts=True)
                    at = np.minimum(np.searchsorted(often, k), max(0, len(often) - 1))
                    here = often[at] == k if len(often) else np.zeros(len(k), bool)
                    alone = ids[np.concatenate(([True], (ids[:-1] == 0) | (ids[1:] == 0)))] if len(ids) else ids
                    local = [x[at[here]] @ c[here] + y.sum() for x, y in zip((t_often, n_often), models.single(alone))]
                    rest = int((~here).sum())
                    keys += [[-1 - ((xxhash.xxh3_64_intdigest(str(a + i) + (text or "")[:64])) >> 2)], k[~here]]
                    times += [[0], c[~here]]
                    sums.append((*local, rest, len(ids)))
                    who.append(np.full(rest + 1, i))
                    size.append(rest + 1)
                who = np.concatenate(who)
                first = np.concatenate(([0], np.cumsum(size)[:-1]))
                values = np.zeros((3, len(who)))
                values[0, first], values[1, first], values[2, first] = ([s[j] for s in sums] for j in (0, 1, 3))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(who)), pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(times).astype(np.int64)),
                     pa.array(values[0]), pa.array(values[1]), pa.array(values[2].astype(np.int64))],
                    ["doc_id", "key", "times", "t_loss", "n_loss", "tokens"])

    rows = marked.select(F.col("doc_id").cast("long"), "text").mapInArrow(own, ROWS)

    def lose(batches):
        for b in batches:
            k, n, t = (b.column(i).to_numpy() for i in range(3))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in models.losses(k, t, n))], ["of", "t_each", "n_each"])

    each = counts.mapInArrow(lose, "of long, t_each double, n_each double")
    return _summed(rows, each)


def with_target(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``target``: whether the id is among ``ids`` (column target_id), which are sent to every task if they are few."""
    ids = stored(ids.where("target_id is not null").distinct(), "target-ids")
    return docs.select("doc_id", "text").join(few(ids), F.col("doc_id") == F.col("target_id"), "left").select("doc_id", "text", F.col("target_id").isNotNull().alias("target"))


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Every document against the documents labelled as good (target) and all documents (background)."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("target_id"))
    return score(with_target(table(spark, sf_dir, "documents"), good), F.col("target"))
