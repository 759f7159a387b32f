"""Toxicity by noisy-channel deobfuscation.

A written word is a lattice of what each character may stand for: a letter
for itself, a look-alike (``1`` for i or l, ``$`` for s), a mark or a space
for nothing, and a letter equal to the one before it for nothing (a
repetition).  Each reading has a channel cost; a character language model over
the words of the learning sample (orders 1 to ``ORDER``, interpolated) has the
cost of the letters.  Viterbi decoding finds the cheapest reading of the whole
lattice.  Words that hold letters only have a lattice of one path, unless
dropping their repeated letters gives a word that the scorer knows.  Runs of
three or more single characters are read as one spaced-out word.

The score is a logistic model over the restored words and their first letters
(4 to 6), learned from all labelled rows: words and features are counted by
Spark, and the regression is Spark ML's.

Defined cases: null and empty texts are scored by the intercept alone, like a
text without any known word; labels that contradict each other for one id
count as toxic; ids or labels that are null are not learned from; without a
label of both classes every score is the share of toxic labels (0 without
any); repeated rows are repeated in the result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import pickle
import re
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm.common import discard, few, id_fold, per_worker, stored, table, text_udf

LM_WORDS = 30_000           # words that teach the language model, the most frequent of the learned rows
FEATURES = 20_000           # features that the scorer may use, those that tell most
MIN_DOCS = 3                # documents that must hold a feature
MIN_SHARE = 1 / 4000        # share of the learned rows that must hold a word of the language model
L2 = 0.1                    # prior of the weights
ORDER = 4
THRESHOLD = 0.3
CACHE = 100_000             # tokens that a worker remembers; beyond it those met once are forgotten
COSTS = 150_000             # costs of letters that a worker keeps
RUNS = 30_000               # spaced-out runs whose words a worker keeps, twice
SLICE = 512                 # texts whose tokens are handled at once
EDGE = "^"

# Look-alikes of letters, and the channel's costs in nats.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SUBSTITUTE, DROP_MARK, DROP_REPEAT, KEEP_REPEAT, KEEP_DIGIT, DROP_SPACE, SPLIT = 1.0, 0.5, 0.3, 1.0, 4.0, 0.1, 1.0
TRAILING = ".,;:!?\"')]}…"
LEADING = "\"'([{¿¡"
MARKS = TRAILING + LEADING
TWICE, THRICE = re.compile(r"(.)\1", re.S), re.compile(r"(.)\1\1", re.S)


class Memory(dict):
    """Results by text, in two generations: when the younger is full, the elder is dropped."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, text):
        v = self.old.get(text)
        if v is None:
            v = self.make(text)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[text] = v
        return v


def kept(spark: SparkSession, thing):
    """A function that gives ``thing`` in a task; a worker unpacks it once, so what it remembers serves all its tasks.
    The worker drops what the step before kept."""
    name, packed = uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    return lambda: per_worker(name, lambda: pickle.loads(packed.value), place="toxicity")


class Numbered(dict):
    """Texts numbered in the order of their first use; ``fresh`` lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh = []

    def __missing__(self, text):
        n = self[text] = len(self)
        self.fresh.append(text)
        return n

    def of(self, texts: pa.Array) -> np.ndarray:
        """Their numbers, as a column."""
        return np.fromiter(map(self.__getitem__, texts.to_pylist()), np.int32, len(texts))[:, None]


def distinct(doc: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, in order."""
    width = int(number.max()) + 1 if len(number) else 1
    key = doc * width + number
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]][:len(key)]]
    doc = key // width
    return doc, key - doc * width


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where each text starts and the last ends, the UTF-8 bytes) of a fresh array."""
    starts = np.frombuffer(texts.buffers()[1], np.int32)[:len(texts) + 1]
    return starts, np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:starts[-1]]


def usual_words(tokens: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lower case without marks at the ends, whether that is the token's restored word, whether a piece may be short).

    Sure are tokens of A-Z and the letters of U+00C0 to U+00FF between marks, without equal letters side by side
    (their compatibility form is themselves); the others are left to ``plain`` and ``Restorer.word``."""
    raw = pa.array(tokens, pa.string())
    bare = pc.utf8_trim(raw, MARKS)
    words = pc.utf8_lower(bare)
    (starts, data), (begins, before) = _bytes(words), _bytes(bare)
    twice = np.zeros(len(data), bool)
    twice[1:] = data[1:] == data[:-1]
    twice[2:] |= (data[2:] == data[:-2]) & (data[2:] >= 0x80) & (data[2:] < 0xC0)
    until = np.r_[0, np.cumsum(twice)]
    # an equal byte at a word's very start belongs to the word before
    odd = until[starts[1:]] > until[np.minimum(starts[:-1] + 1, starts[1:])]
    until = np.r_[0, np.cumsum((before >= 0xC0) & (before != 0xC3))]
    odd |= until[begins[1:]] > until[begins[:-1]]
    sure = ~odd & pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
    return words, sure, (pc.utf8_length(bare).to_numpy() <= 2) | (pc.utf8_length(raw).to_numpy() == 1)


class Lexicon:
    """The numbers (at most ``width`` a token) that the tokens of texts stand for: ``of_words`` an array of restored
    words (a matrix, -1 for none), ``of`` a token that has to be restored, ``of_run`` a spaced-out run."""

    def __init__(self, of_words, of, width: int = 1, of_run=None):
        self.of_words, self.of, self.width, self.of_run = of_words, of, width, of_run
        self.clear()

    def clear(self) -> None:
        self.index = Numbered()
        self.values, self.short, self.met = np.empty((0, self.width), np.int32), np.empty(0, np.int8), np.empty(0, np.int32)

    def trim(self) -> None:
        """Forgets the tokens met once since the last time, or all if that leaves too many."""
        keep = self.met > 1
        if keep.sum() > CACHE // 2:
            self.clear()
            return
        tokens, self.index = list(itertools.compress(self.index, keep.tolist())), Numbered()
        self.index.update(zip(tokens, range(len(tokens))))
        self.values, self.short, self.met = self.values[keep], self.short[keep[:len(self.short)]], np.zeros(len(tokens), np.int32)

    def trim_numbers(self, numbers: Numbered) -> None:
        """Forgets the texts that no remembered token stands for."""
        numbers.fresh.clear()
        if len(numbers) > CACHE:
            names, some = list(numbers), self.values >= 0
            used, at = np.unique(self.values[some], return_inverse=True)
            self.values[some] = at
            numbers.clear()
            numbers.update(zip([names[i] for i in used.tolist()], range(len(used))))

    def _learn(self) -> None:
        fresh, self.index.fresh = self.index.fresh, []
        if not fresh:
            return
        words, sure, may = usual_words(fresh)
        values = np.full((len(fresh), self.width), -1, np.int32)
        values[sure] = self.of_words(words.filter(pa.array(sure)))
        for row in np.flatnonzero(~sure).tolist():
            for j, x in enumerate(self.of(fresh[row])):
                values[row, j] = x
        self.values = np.concatenate((self.values, values))
        if self.of_run:
            short, rows = np.zeros(len(fresh), np.int8), np.flatnonzero(may).tolist()
            pieces = short_pieces(fresh[r] for r in rows)
            short[rows] = [len(pieces.get(fresh[r], "")) for r in rows]
            self.short = np.concatenate((self.short, short))

    def held(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(place of a text, number): the different numbers of each text, in order."""
        tokens = [(t or "").split() for t in texts]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        at = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(tokens)), np.int64, int(sizes.sum()))
        self._learn()
        self.met = np.bincount(at, minlength=len(self.index)) + np.r_[self.met, np.zeros(len(self.index) - len(self.met), np.int32)]
        doc, found = np.repeat(np.arange(len(texts)), sizes), self.values[at]
        row, column = np.nonzero(found >= 0)
        docs, numbers = doc[row], found[row, column].astype(np.int64)
        if self.of_run and len(at):
            more = [(d, x) for d, run in self._runs(tokens, doc, self.short[at]) for x in self.of_run(run)]
            if more:
                docs, numbers = (np.concatenate(x) for x in zip((docs, numbers), np.array(more, np.int64).T))
        return distinct(docs, numbers)

    @staticmethod
    def _runs(tokens: list[list[str]], doc: np.ndarray, short: np.ndarray):
        """(place of a text, run) as ``spaced_runs`` finds them; only neighbours long enough to be one are looked at."""
        is_short = short > 0
        starts = np.flatnonzero(is_short & np.r_[True, ~is_short[:-1] | (doc[1:] != doc[:-1])])
        ends = np.flatnonzero(is_short & np.r_[~is_short[1:] | (doc[1:] != doc[:-1]), True]) + 1
        letters = np.r_[0, np.cumsum(short, dtype=np.int64)]
        may = (ends - starts >= 3) | (letters[ends] - letters[starts] >= 4)
        first = np.searchsorted(doc, np.arange(len(tokens)))
        for a, b in zip(starts[may].tolist(), ends[may].tolist()):
            d = int(doc[a])
            for run in spaced_runs(tokens[d][a - int(first[d]):b - int(first[d])]):
                yield d, run

    def batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """As ``held``, some texts after the other."""
        docs, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a in range(0, len(texts), SLICE):
            if len(self.index) > CACHE:
                self.trim()
            doc, number = self.held(texts[a:a + SLICE])
            docs.append(a + doc)
            numbers.append(number)
        return np.concatenate(docs), np.concatenate(numbers)


class Costs(dict):
    """-log P(last letter | the letters before it) of an n-gram, Witten-Bell like: longer contexts weigh by their counts."""

    def __init__(self, model: CharModel):
        super().__init__()
        self.model = model

    def __missing__(self, gram: str) -> float:
        m, p, context, letter = self.model, self.model.base, gram[:-1], gram[-1]
        for k in range(m.order):
            h = context[len(context) - k:]
            t = m.totals.get(h, 0)
            p = (m.counts.get(h + letter, 0) + 4 * p) / (t + 4)
        if len(self) > COSTS:
            self.clear()
        c = self[gram] = -math.log(p)
        return c


class CharModel:
    """Interpolated character n-gram model of words."""

    def __init__(self, words: dict[str, int], order: int = ORDER):
        self.order, self.counts, self.totals, letters = order, {}, {}, set()
        for word, n in words.items():
            padded = EDGE * (order - 1) + word + EDGE
            letters.update(word)
            for i in range(order - 1, len(padded)):
                for k in range(order):
                    gram = padded[i - k:i + 1]
                    self.counts[gram] = self.counts.get(gram, 0) + n
                    self.totals[gram[:-1]] = self.totals.get(gram[:-1], 0) + n
        self.base, self.costs = 1 / (len(letters) + 2), Costs(self)

    def cost(self, context: str, letter: str) -> float:
        """-log P(letter | the last order - 1 letters)."""
        return self.costs[context + letter]


def readings(text: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each character what it may stand for, and the channel's cost.  '' stands for nothing."""
    out = []
    for i, c in enumerate(text):
        if c.isalpha():
            again = i > 0 and text[i - 1] == c
            out.append([(c, KEEP_REPEAT if again else 0.0)] + ([("", DROP_REPEAT)] if again else []))
        else:
            keep = [(x, SUBSTITUTE) for x in LOOKALIKES.get(c, "")]
            if c == " ":                                  # inside a spaced-out word, or between two words
                keep = [(EDGE, SPLIT)]
            out.append(keep + [("", KEEP_DIGIT if c.isdigit() else DROP_SPACE if c == " " else DROP_MARK)])
    return out


def decode(text: str, model: CharModel) -> str:
    """Viterbi: the reading with the least sum of channel and model costs (ties: first in order of letters)."""
    width, costs = model.order - 1, model.costs
    states = {EDGE * width: (0.0, None)}                  # last letters -> cost, back pointer (letter, before)
    for options in readings(text):
        reached: dict[str, tuple] = {}
        for context, (cost, path) in states.items():
            for letter, channel in options:
                if letter:
                    gram = context + letter
                    c, to, back = cost + channel + costs[gram], gram[1:], (letter, path)
                else:
                    c, to, back = cost + channel, context, path
                if to not in reached or c < reached[to][0]:
                    reached[to] = (c, back)
        states = reached
    cost, path = min(((c + model.cost(h, EDGE), h, p) for h, (c, p) in states.items()), key=lambda x: x[:2])[::2]
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def plain(token: str) -> str:
    """Lower case, one form of each letter, without marks at the ends and without runs of
    three or more equal marks; runs of letters longer than three count as three."""
    t = (token if token.isascii() else unicodedata.normalize("NFKC", token)).lower().strip(MARKS)
    if not THRICE.search(t):
        return t
    if not t.isalpha():
        t = "".join("" if not k.isalnum() and n >= 3 else k * min(n, 3)
                    for k, n in ((k, sum(1 for _ in g)) for k, g in itertools.groupby(t)))
        return t.strip(MARKS)
    return "".join(k * min(3, sum(1 for _ in g)) for k, g in itertools.groupby(t))


def squeeze(word: str) -> str:
    return "".join(k for k, _ in itertools.groupby(word))


def piece(token: str) -> str:
    """A token without marks at its ends; one that is a single mark stays, as it may stand for a letter."""
    return token if len(token) == 1 else token.strip(MARKS)


def short_pieces(tokens) -> dict[str, str]:
    """The tokens whose piece has one or two characters, with it."""
    return {t: p for t in tokens if 0 < len(p := piece(t)) <= 2}


def spaced_runs(tokens: list[str], short: dict[str, str] | None = None) -> list[str]:
    """Each run of pieces of one or two characters, three or more or of four characters together, as one
    text with spaces (equal pieces in a row at most three times).  ``short``: the tokens that are such pieces."""
    if short is None:
        short = short_pieces(set(tokens))
    if not short:
        return []
    out, at = [], [i for i, t in enumerate(tokens) if t in short]
    for _, places in itertools.groupby(enumerate(at), key=lambda x: x[1] - x[0]):
        run = [x for k, g in itertools.groupby(short[tokens[i]] for _, i in places) for x in itertools.islice(g, 3)]
        if len(run) >= 3 or sum(map(len, run)) >= 4:
            out.append(" ".join(run))
    return out


def features(word: str) -> list[str]:
    """Of a restored word: itself, and its first letters."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) >= k)] if word else []


class Restorer:
    """Restored words of tokens."""

    def __init__(self, model: CharModel, known: set[str]):
        self.model, self.known = model, known
        self.squeezed = {squeeze(w) for w in known}
        self.runs = Memory(lambda run: decode(run, self.model).split(EDGE), RUNS)
        self.numbers = Numbered()
        self.lexicon = Lexicon(self.numbers.of, lambda t: self._numbers([self.word(t)]), 1, lambda run: self._numbers(self.spaced(run)))

    def _numbers(self, words: list[str]) -> list[int]:
        return [self.numbers[w] for w in words if w]

    def word(self, token: str) -> str:
        if token.isalpha() and token.isascii() and not TWICE.search(t := token.lower()):
            return t                                      # the usual case of what follows
        t = plain(token)
        if t.isalpha():
            if not TWICE.search(t) or t in self.known or squeeze(t) not in self.squeezed:
                return t
        elif not t or t.isdigit() or not any(c.isalpha() or c in LOOKALIKES for c in t):
            return ""
        return decode(t, self.model)

    def spaced(self, run: str) -> list[str]:
        return self.runs[run.lower()]

    def words(self, text: str | None) -> set[str]:
        """The restored words of a text."""
        return set(self.word_lists([text]).to_pylist()[0])

    def word_lists(self, texts: list) -> pa.ListArray:
        """The different restored words of each text."""
        doc, number = self.lexicon.batch(texts)
        out = _listed(list(self.numbers), doc, number, len(texts))
        self.lexicon.trim_numbers(self.numbers)
        return out


def _listed(names: list[str], doc: np.ndarray, number: np.ndarray, texts: int) -> pa.ListArray:
    """The names of each text's numbers, given in order of the texts."""
    many = np.bincount(number, minlength=1)
    used, at = np.flatnonzero(many), (np.cumsum(many > 0) - 1)[number]
    ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=texts))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([names[i] for i in used.tolist()], pa.string()).take(pa.array(at)))


class Scorer:
    """The learned model: features of restored words with weights."""

    def __init__(self, model: CharModel, weight: dict[str, float], intercept: float):
        self.names = sorted(weight)
        self.number = {x: i for i, x in enumerate(self.names)}
        self.weight = np.array([weight[x] for x in self.names], float)
        self.intercept = intercept
        self.restorer = Restorer(model, {x for x in self.names if x[-1:] != "*"})
        self.whole = {x: i for x, i in self.number.items() if x[-1:] != "*"}
        self.first = {k: {x[:-1]: i for x, i in self.number.items() if x[-1:] == "*" and len(x) == k + 1} for k in (4, 5, 6)}
        self.lexicon = Lexicon(self._of_all, lambda t: self._of(self.restorer.word(t)), 4,
                               lambda run: {x for word in self.restorer.spaced(run) for x in self._of(word)})

    def _of(self, word: str) -> tuple[int, ...]:
        # as ``features``, without making the names
        first = self.first
        own = (self.whole.get(word), first[4].get(word[:4]), first[5].get(word[:5]), first[6].get(word[:6]))
        return () if own == (None, None, None, None) else tuple(x for x in own if x is not None)

    def _of_all(self, words: pa.Array) -> np.ndarray:
        """``_of`` each word, -1 for none."""
        columns = []
        for numbers, starts in ((self.whole, words), *((self.first[k], pc.utf8_slice_codeunits(words, 0, k)) for k in (4, 5, 6))):
            at = pc.index_in(starts, pa.array(numbers, pa.string())).fill_null(len(numbers)).to_numpy()
            columns.append(np.array([*numbers.values(), -1], np.int32)[at])
        return np.stack(columns, 1)

    def found(self, text: str | None) -> set[int]:
        """Numbers of the features that the whole text holds."""
        return set(self.lexicon.batch([text])[1].tolist())

    def scores(self, texts: list) -> list[float]:
        doc, number = self.lexicon.batch(texts)
        ends, weight = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist(), self.weight[number]
        sums = (self.intercept + float(weight[a:b].sum()) for a, b in itertools.pairwise(ends))
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, z)))) for z in sums]

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]

    def column(self, text_col):
        model = kept(SparkSession.active(), self)

        def setup():
            scorer = model()
            return lambda texts: pa.array(scorer.scores(texts), pa.float64())

        return text_udf(setup, "double")(text_col)


COUNTS = "f string, clean long, toxic long"


def _counts(names, toxic: np.ndarray, doc: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    """(name, clean documents, toxic documents) of the different pairs (document, number of a name)."""
    many = [np.bincount(number[toxic[doc] == k], minlength=len(names)) for k in (0, 1)]
    used = np.flatnonzero(many[0] + many[1])
    names = names.take(pa.array(used)) if isinstance(names, pa.Array) else pa.array([names[i] for i in used.tolist()], pa.string())
    return pa.RecordBatch.from_arrays([names, *(pa.array(n[used].astype(np.int64)) for n in many)], ["f", "clean", "toxic"])


def _count_words(batches):
    """Plain words of a task's rows (toxic, text), summed a batch."""
    numbers = Numbered()
    lexicon = Lexicon(numbers.of, lambda t: (numbers[p],) if (p := plain(t)).isalpha() else ())
    for b in batches:
        doc, number = lexicon.batch(b.column(1).to_pylist())
        yield _counts(list(numbers), b.column(0).to_numpy(), doc, number)
        lexicon.trim_numbers(numbers)


def _features(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(names, document, number of a name): the different ``features`` of lists of words."""
    flat = lists.flatten().dictionary_encode()
    words, size = flat.dictionary, pc.utf8_length(flat.dictionary).to_numpy()
    fits = [np.arange(len(words)), *(np.flatnonzero(size >= k) for k in (4, 5, 6))]
    made = [words, *(pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.take(pa.array(at)), 0, k), "*", "") for k, at in zip((4, 5, 6), fits[1:]))]
    every = pa.concat_arrays(made).dictionary_encode()
    of, start = np.full((len(words), 4), -1, np.int32), 0
    for j, at in enumerate(fits):
        of[at, j] = every.indices.to_numpy()[start:start + len(at)]
        start += len(at)
    found = of[flat.indices.to_numpy()]
    row, column = np.nonzero(found >= 0)
    doc = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    return every.dictionary, *distinct(doc[row], found[row, column].astype(np.int64))


def _count_features(batches):
    """Features of a task's rows (toxic, words), summed some rows at a time."""
    for b in batches:
        for a in range(0, b.num_rows, SLICE):
            part = b.slice(a, SLICE)
            names, doc, number = _features(part.column(1))
            yield _counts(names, part.column(0).to_numpy(), doc, number)


def _summed(counts: DataFrame) -> DataFrame:
    """(f, clean, toxic) summed over all rows."""
    return counts.groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Learns from all rows of ``labels`` (doc_id, toxic) given; texts come from ``docs``.

    The learned texts are stored once, and once more as restored words.  Words and
    features are counted by Spark; the driver gets the ``LM_WORDS`` most frequent
    words and the ``FEATURES`` best features, which bound the model.
    """
    one = stored(labels.where("doc_id is not null and toxic is not null")
                 .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")), "toxic-labels")
    shares = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    if len(shares) < 2:
        share = 1.0 if 1 in shares else 0.0
        return Scorer(CharModel({}), {}, 60.0 if share else -60.0)
    learned = stored(docs.select("doc_id", "text").join(few(one), "doc_id").select("toxic", "text"), "toxic-texts")
    found = {r["toxic"]: r["count"] for r in learned.groupBy("toxic").count().collect()}
    if len(found) < 2:
        return Scorer(CharModel({}), {}, math.log(shares[1] / shares[0]))
    # an obfuscated word must not teach the model its own spelling: a word needs MIN_DOCS documents, more of many
    least = max(MIN_DOCS, MIN_SHARE * sum(found.values()))
    top = (_summed(learned.mapInArrow(_count_words, COUNTS)).withColumn("n", F.col("clean") + F.col("toxic")).where(F.col("n") >= least)
           .orderBy(F.col("n").desc(), "f").limit(LM_WORDS).collect())
    model = CharModel({r["f"]: r["n"] for r in top})
    restorer = kept(docs.sparkSession, Restorer(model, {r["f"] for r in top}))

    def restored(batches):
        lists = restorer().word_lists
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), lists(b.column(1).to_pylist())], ["toxic", "words"])

    words = stored(learned.mapInArrow(restored, "toxic int, words array<string>"), "toxic-words")
    gap = F.abs(F.log((F.col("toxic") + 0.5) / (found[1] + 1)) - F.log((F.col("clean") + 0.5) / (found[0] + 1)))
    best = (_summed(words.mapInArrow(_count_features, COUNTS)).where(F.col("clean") + F.col("toxic") >= MIN_DOCS).where(gap > 1.5)
            .orderBy((gap * F.sqrt(F.col("clean") + F.col("toxic"))).desc(), "f").limit(FEATURES).collect())
    names = sorted(r["f"] for r in best)
    if not names:
        return Scorer(model, {}, math.log(found[1] / found[0]))

    def held(batches):
        known = pa.array(names, pa.string())
        for b in batches:
            for a in range(0, b.num_rows, SLICE):
                part = b.slice(a, SLICE)
                features, doc, number = _features(part.column(1))
                at = pc.index_in(features, known).fill_null(-1).to_numpy()[number]
                yield pa.RecordBatch.from_arrays([part.column(0), _listed(names, doc[at >= 0], at[at >= 0], part.num_rows)], ["y", "x"])

    vectors = CountVectorizerModel.from_vocabulary(names, "x", "features")
    data = vectors.transform(words.mapInArrow(held, "y int, x array<string>"))
    fitted = LogisticRegression(featuresCol="features", labelCol="y", regParam=L2 / sum(found.values()), standardization=False, maxIter=200).fit(data)
    discard(one, learned, words)
    return Scorer(model, dict(zip(names, fitted.coefficients.toArray().tolist())), float(fitted.intercept))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labelled rows with crc32(doc_id) mod 4 other than 2."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(id_fold("doc_id", 4) != 2))
    held = F.coalesce(id_fold("doc_id", 4) == 2, F.lit(False))
    return (docs.select("doc_id", held.alias("held_out"), model.column(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
