"""Quality rules as weak supervision, in DataFrame functions only.

Every rule looks at one statistic of a document and votes good (1), bad (0) or
abstains (null).  A latent class model ties the votes together: given the
class (good, or one of the modes of bad), rules vote independently, each with
its own accuracy; abstaining says nothing.  Expectation-maximisation estimates
the accuracies without any label, from the counts of the distinct vote
patterns (three to the power of the number of rules at most, however many
documents there are).  A document is
kept if the posterior probability of quality reaches ``KEEP``; one bad vote
alone does not sink it, as it would in all-must-pass filtering.

Words are ``[^\\x20\\x09-\\x0D]+``.  Windows of five words are compared by a
64-bit hash inside one document.

Defined cases: null text has no words, lines or symbols, like empty text, and
fails the base; repeated rows are repeated in the result; null ids keep their
row; in an empty table EM keeps its starting accuracies; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import stored, table

SYMBOLS = "#*$%&|<>"
MARKS = ".!?,;:"
WINDOW = 5
ROUNDS = 30
KEEP = 0.5
PRIOR_GOOD = 0.9            # where EM starts, and the centre of its prior
STRENGTH = 20.0             # weight of the prior accuracies, in documents


def words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0b\\f\\r]+"), lambda w: w != "")


def n_repeat_words(h: Column) -> Column:
    """Words that lie in a window of five words which the text holds twice or more.

    ``h`` has the words' hashes.  Only if two windows share a hash, the
    windows' hashes are sorted with their places; a window is repeated if a
    neighbour has its hash.  In order of place, each repeated window then adds
    the words that the one before did not cover.
    """
    n = F.size(h) - F.lit(WINDOW - 1)
    hashed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(s: Column) -> Column:
        twice = F.sort_array(F.filter(
            F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull()))
        return F.aggregate(twice, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                           lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.alias("last")),
                           lambda a: a["n"])

    # a transform over a one-element array names a value, so it is built once
    placed = lambda x: F.sort_array(F.transform(x, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
    none = F.lit(0).cast("long")
    once = F.transform(F.array(hashed), lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), none).otherwise(
        F.get(F.transform(F.array(placed(x)), covered), F.lit(0))))
    return F.when(n > 1, F.get(once, F.lit(0))).otherwise(none)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The base statistics of each text, beside ``doc_id``; a text is split and scanned once for all of them."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select("doc_id", t.alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_replace("text", "[^" + SYMBOLS + MARKS + "0-9A-Z]+", "").alias("special"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    count = lambda chars: (F.length("special") - F.length(F.translate(F.col("special"), chars, ""))).cast("long")
    size = lambda c: F.size(c).cast("long")
    return rows.select(
        "doc_id", size("words").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        n_repeat_words(F.col("hashes")).alias("n_repeat_words"),
        size("lines").alias("n_lines"), size(F.array_distinct("hashes")).alias("n_distinct"),
        count("0123456789").alias("n_digits"), count(MARKS).alias("n_marks"),
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"))


def votes() -> dict[str, Column]:
    """Rule name to vote: 1 good, 0 bad, null abstains (mid range, or too little text to tell)."""
    c = F.col
    n, chars, lines = c("n_words"), c("word_chars"), c("n_lines")

    def rule(good: Column, bad: Column, enough: Column) -> Column:
        return F.when(enough, F.when(bad, 0).when(good, 1))

    some = n >= 10
    return {
        "length": rule(n >= 20, n < 10, n >= 0),
        "word_size": rule((chars >= 3 * n) & (chars <= 12 * n), (chars < 2 * n) | (chars > 20 * n), n > 0),
        "symbols": rule(20 * c("n_symbols") <= n, 5 * c("n_symbols") > n, some),
        "symbol_share": rule(100 * c("n_symbols") <= chars, 25 * c("n_symbols") > chars, some),
        "digits": rule(4 * c("n_digits") <= chars, 2 * c("n_digits") > chars, some),
        "capitals": rule(10 * c("n_upper") <= chars, 4 * c("n_upper") > chars, some),
        "marks": rule(5 * c("n_marks") <= n, 5 * c("n_marks") > 2 * n, some),
        "repeat_words": rule(10 * c("n_repeat_words") <= n, 5 * c("n_repeat_words") > n, some),
        "dup_lines": rule(5 * c("n_dup_lines") <= lines, 2 * c("n_dup_lines") > lines, lines >= 3),
        "variety": rule(3 * c("n_distinct") >= n, 6 * c("n_distinct") < n, some),
    }


# Bad documents differ: each family of rules has a mode of the bad class in which its rules tend to vote bad.
FAMILIES = {"shape": {"length", "word_size"}, "noise": {"symbols", "symbol_share", "digits", "capitals", "marks"},
            "repetition": {"repeat_words", "dup_lines", "variety"}}


def start(names: list[str], families: dict[str, set] = FAMILIES) -> tuple[list[float], list[list[tuple[float, float]]]]:
    """Where EM starts, and the centre of its prior: shares of the classes (good first, then the
    modes of bad), and for each class and rule the chances of a good and of a bad vote if it votes."""
    fine, faulty = (0.95, 0.05), (0.25, 0.75)
    modes = [[faulty if x in rules else fine for x in names] for rules in families.values()]
    return [PRIOR_GOOD] + [(1 - PRIOR_GOOD) / len(modes)] * len(modes), [[fine] * len(names), *modes]


def fit(patterns: list[tuple[tuple, int]], names: list[str], rounds: int = ROUNDS, families: dict[str, set] = FAMILIES):
    """EM over (vote pattern, count); returns shares and chances as in ``start``."""
    share0, chance0 = start(names, families)
    share, chance, classes = share0, chance0, range(len(share0))
    for _ in range(rounds if patterns else 0):
        mass = [0.0 for _ in classes]
        seen = [[[0.0, 0.0] for _ in names] for _ in classes]
        for cast, n in patterns:
            for k, p in enumerate(posterior(cast, (share, chance))):
                mass[k] += n * p
                for r, v in enumerate(cast):
                    if v is not None:
                        seen[k][r][1 - v] += n * p
        total = sum(mass) + STRENGTH
        share = [(mass[k] + STRENGTH * share0[k]) / total for k in classes]
        chance = [[tuple((seen[k][r][v] + STRENGTH * chance0[k][r][v]) / (sum(seen[k][r]) + STRENGTH) for v in (0, 1))
                   for r in range(len(names))] for k in classes]
    return share, chance


def log_chances(model) -> list[tuple[float, list[tuple[float, float]]]]:
    """Of each class: log share, and each rule's log chances of vote 1 and vote 0 if it votes."""
    log = lambda p: math.log(min(max(p, 1e-6), 1.0))
    return [(log(s), [(log(a), log(b)) for a, b in c]) for s, c in zip(*model)]


def posterior(cast, model) -> list[float]:
    """Chance of each class (good first) given the votes."""
    z = [s + sum(0.0 if v is None else w[1 - v] for v, w in zip(cast, rules)) for s, rules in log_chances(model)]
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def judge(stats: DataFrame, rules: dict[str, Column] | None = None, model=None) -> DataFrame:
    """``stats`` with the votes, the posterior ``quality`` and ``kept``."""
    rules = rules or votes()
    voted = stats.select("*", *[v.cast("int").alias(f"vote_{k}") for k, v in rules.items()])
    names = [f"vote_{k}" for k in rules]
    if model is None:
        rows = voted.groupBy(*names).count().collect()            # at most 3 ** len(rules) rows
        model = fit(sorted(((tuple(r[x] for x in names), r["count"]) for r in rows), key=str), list(rules))
    z = []
    for prior, by_rule in log_chances(model):
        total = F.lit(prior)
        for x, (yes, no) in zip(names, by_rule):
            total = total + F.when(F.col(x) == 1, F.lit(yes)).when(F.col(x) == 0, F.lit(no)).otherwise(F.lit(0.0))
        z.append(total)
    odds = F.array(*z)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scaled = F.transform(odds, lambda v: F.exp(v - F.array_max(odds)))
    return (voted.withColumn("base_failed", base)
            .withColumn("quality", F.get(scaled, F.lit(0)) / F.aggregate(scaled, F.lit(0.0), lambda x, y: x + y))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP)))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base statistics and the weak-supervision verdict of every document."""
    stats = stored(statistics(table(spark, sf_dir, "documents")), "rule-statistics")
    return judge(stats).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept", F.round("quality", 6).alias("quality"))
