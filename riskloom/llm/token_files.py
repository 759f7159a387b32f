"""Token ids in Parquet: list columns that can be read in part.

``write`` encodes documents in ascending id order and leaves two tables:

  <path>/documents   shard, doc_id, start, n_tokens, ids (list of int)
  <path>/shards      shard, n_docs, n_tokens, first_doc, last_doc, token_start

A shard is one file.  ``start`` counts the ids before a document in its shard,
``token_start`` those before the shard, so a document's place in the whole
stream needs no more than the shards' sums.  Spark's own Parquet writer is
told how to lay the files out: ids are dictionary encoded (or, as asked, delta
encoded), the sorted numbers are delta encoded, row groups end after
``group_rows`` rows and pages after ``page_rows``, and every page has its least
and greatest value in the column and offset index.  A reader that wants
metadata alone never touches the ids, and one that wants a document or a range
of tokens reads only the pages that hold them.

Defined cases: null and empty texts hold the closing id alone; rows with a null
id come first; rows that share an id are documents of their own, in the order
of their texts' hashes, then texts; an empty table gives empty tables; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import per_worker, small_batches, table, temp_name
from riskloom.session import scratch_path

TOKENIZER, END = "word_bpe_49k.json", 2
GROUP_ROWS = 20_000         # rows of a row group
PAGE_ROWS = 200             # rows of a page
BYTES_AT_ONCE = 8 << 20     # text that is encoded together
CACHE = 250_000             # words whose ids one generation of a worker's memory holds
SCHEMA = "shard int, doc_id long, start long, n_tokens long, ids array<int>"
BEYOND = re.compile("[^\x00-\xFF]").search
PLAIN = re.compile("[a-z\xDF-\xF6\xF8-\xFF]+").fullmatch
# after a letter or digit, marks up to the word's end are a piece of their own (but for an apostrophe, which may open one)
MARK = r"[!-&(-/:-@\[-`{-~]"
TAIL = re.compile(rf"({MARK}(?<=[a-z0-9\xDF-\xF6\xF8-\xFF]{MARK}){MARK}*)(?![^ \n])")


class Kept:
    """A bounded memory of two generations: what was met since the last turn, and what was met before it."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def lacking(self, met: set) -> set:
        """What of ``met`` is not known; all that is known of it is in ``young`` afterwards."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        new = met - self.young.keys()
        again = new & self.old.keys()
        self.young.update({w: self.old[w] for w in again})
        return new - again


class WordIds:
    """Ids of texts by a vocabulary whose pre-tokeniser drops white space, so words can be encoded apart.

    Words repeat, so their ids are kept.  Texts of Latin-1 characters, which composition leaves alone, are
    lower-cased first and the marks that end a word are split off.  New words of plain letters, which the
    pre-tokeniser leaves whole, go to the vocabulary's model in one string; others to the library's whole
    tokenizer.  Texts that may hold an added token (``<|``) are encoded whole.
    """

    def __init__(self, path: str | None = None):
        path = path or public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        with open(path) as f:
            model = json.load(f)
        model |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.plain = Tokenizer.from_str(json.dumps(model))
        vocabulary, suffix = model["model"]["vocab"], model["model"]["end_of_word_suffix"]
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.words = Kept(CACHE)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def _encode(self, new: list[str], plain: bool) -> None:
        if plain:
            ids = np.array(self.plain.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<i4")
            at = np.append(0, np.flatnonzero(self.ends[ids]) + 1) * 4          # the last id of a word says so
        else:
            e = self.tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, "<i4")
            at = np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(new) + 1)) * 4
        data, at = ids.tobytes(), at.tolist()
        self.words.young.update(zip(new, [data[x:y] for x, y in zip(at[:-1], at[1:])], strict=True))

    def _plain_text(self, text: str) -> str:
        if BEYOND(text) is None:
            text = TAIL.sub(r" \1", text.lower())
        return text.replace("\n", " ")

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        new = self.words.lacking(set(words))
        known = self.words.young
        known[""] = b""
        new.discard("")
        plain = list(filter(PLAIN, new))
        for part, lean in ((plain, True), (list(new.difference(plain)), False)):
            if part:
                self._encode(part, lean)
        return list(map(known.__getitem__, words))

    def batch(self, texts: list[str | None], end: int) -> pa.ListArray:
        """Ids of each text, with the closing id."""
        whole = {i: self.whole(t) for i, t in enumerate(texts) if t and "<|" in t}
        split = pc.split_pattern(pa.array(["" if i in whole else self._plain_text(t or "") for i, t in enumerate(texts)], pa.string()), " ")
        words = split.flatten().dictionary_encode()
        # a table of ids: the distinct words', the texts' that are encoded whole, the closing one, and none
        table = [*self._known(words.dictionary.to_numpy(zero_copy_only=False).tolist()), *whole.values(), np.array([end], "<i4").tobytes(), b""]
        at = np.cumsum(np.fromiter(map(len, table), np.int32, len(table)) // 4, dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), at)), pa.array(np.frombuffer(b"".join(table), "<i4")))
        stop = split.offsets.to_numpy()[1:]
        more = np.full((len(texts), 2), len(table) - 2, np.int32)       # after each text's words: the whole text's ids if so encoded, the closing id
        more[:, 0] += 1
        more[list(whole), 0] = len(words.dictionary) + np.arange(len(whole))
        all_ids = ids.take(pa.array(np.insert(words.indices.to_numpy(), np.repeat(stop, 2), more.ravel())))
        ends = all_ids.offsets.to_numpy()[stop + 2 * np.arange(1, len(texts) + 1)]
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), all_ids.values)


def _parts(batch: pa.RecordBatch):
    """Rows of a batch with about ``BYTES_AT_ONCE`` of text together."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy())
    cut = [0, *(1 + np.flatnonzero(np.diff(upto // BYTES_AT_ONCE))).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cut[:-1], cut[1:]) if b > a]


def layout(encoding: str = "dictionary", group_rows: int = GROUP_ROWS, page_rows: int = PAGE_ROWS) -> dict[str, str]:
    """Options of Spark's Parquet writer.  Files of its second version hold integers without a dictionary as deltas."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding is dictionary or delta, not {encoding!r}")
    out = {"compression": "snappy", "parquet.writer.version": "PARQUET_2_0", "parquet.block.row.count.limit": str(group_rows),
           "parquet.page.row.count.limit": str(page_rows), "parquet.page.size.row.check.min": str(min(100, page_rows)),
           "parquet.enable.dictionary": str(encoding == "dictionary").lower()}
    for column in ("doc_id", "start", "n_tokens"):
        out[f"parquet.enable.dictionary#{column}"] = "false"
    return out


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, encoding: str = "dictionary",
          group_rows: int = GROUP_ROWS, page_rows: int = PAGE_ROWS, files: int | None = None) -> None:
    """Writes the documents (doc_id, text) under ``path``; ``files`` shards, or as many as the session's shuffles give."""
    docs = docs.select("doc_id", "text")
    small_batches(docs.sparkSession)
    key = temp_name(docs, "order")
    rows = docs.withColumn(key, F.xxhash64("text"))
    order = ["doc_id", key]
    rows = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)

    def encode(batches):
        ids_of, shard, before = per_worker(f"word ids {tokenizer}", lambda: WordIds(tokenizer)), TaskContext.get().partitionId(), 0
        for b in batches:
            for part in _parts(b):
                ids = ids_of.batch(part["text"].to_pylist(), end)
                n = np.diff(ids.offsets.to_numpy()).astype(np.int64)
                start = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard, np.int32)), part["doc_id"], pa.array(start), pa.array(n), ids],
                    ["shard", "doc_id", "start", "n_tokens", "ids"])

    # files keep their tasks' order: nothing is exchanged between the sort and the writer
    rows = rows.sortWithinPartitions(*order, "text").select("doc_id", "text").mapInArrow(encode, SCHEMA)
    rows.write.options(**layout(encoding, group_rows, page_rows)).parquet(f"{path}/documents")
    made = docs.sparkSession.read.schema(SCHEMA).parquet(f"{path}/documents")
    sums = made.groupBy("shard").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
                                     F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)        # one row a file
    sums.withColumn("token_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/shards")


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard int, n_docs long, n_tokens long, first_doc long, last_doc long, token_start long").parquet(f"{path}/shards")


def documents(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """shard, doc_id, start (in the whole stream), n_tokens, ids; of the given documents, or of all.

    Columns that are not used are not read, and ``doc_ids`` reach the page index as pushed filters.
    """
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/documents")
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    return (rows.join(shards(spark, path).select("shard", "token_start"), "shard")
            .withColumn("start", F.col("token_start") + F.col("start")).drop("token_start"))


def tokens(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The documents with ids of the stream's places ``first`` to ``last`` - 1, cut to them: shard, doc_id, start, ids."""
    held = shards(spark, path).where((F.col("token_start") < last) & (F.col("token_start") + F.col("n_tokens") > first))
    at = held.select(F.min("shard"), F.max("shard"), F.max(F.struct("shard", "token_start"))["token_start"], F.min("token_start")).first()
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/documents").where(F.col("shard").between(*(at[:2] if at[0] is not None else (0, -1))))
    if at[0] is not None and at[0] == at[1]:        # within one shard the places in it are pushed down as well
        rows = rows.where(F.col("start") < last - at[2])
    rows = rows.join(held.select("shard", "token_start"), "shard").withColumn("start", F.col("token_start") + F.col("start"))
    rows = rows.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    skip, stop = F.greatest(F.lit(0), first - F.col("start")), F.least(F.col("n_tokens"), last - F.col("start"))
    cut = F.slice("ids", (skip + 1).cast("int"), (stop - skip).cast("int"))
    return rows.select("shard", "doc_id", (F.col("start") + skip).alias("start"), cut.alias("ids"))


def ids_crc32(ids: Column | str) -> Column:
    """Unsigned crc32 of a list's ids as little-endian unsigned 32-bit integers."""
    def run(lists: pa.Array) -> pa.Array:
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4")
        return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())

    return F.arrow_udf(run, "long")(ids)


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents written as token ids, and what the files say of each."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, f"riskloom-token-files-{uuid.uuid4().hex}")
    write(docs, path)
    return documents(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))
