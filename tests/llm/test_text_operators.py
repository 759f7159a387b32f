"""Language ID, toxicity, quality rules, quality classifier, licence scan."""

import collections
import re
import zlib

import pytest
from conftest import SF, prose, rows
from pyspark.sql import functions as F

from riskloom.llm import langid, license_scan, quality_classifier, quality_rules, toxicity
from riskloom.llm.common import id_fold
from riskloom.llm.license_templates import TEMPLATES


def test_id_fold_is_crc32_of_text(spark):
    got = spark.range(50).select("id", id_fold("id", 3).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in got)


# language ID

def brute_ranks(text, size):
    s = re.sub(r"[\W\d_]+", "\x01", text.lower())
    s = "\x01" + s.strip("\x01") + "\x01"
    c = collections.Counter(x for n in (1, 2, 3) for x in (s[i:i + n] for i in range(len(s) - n + 1)) if x != "\x01")
    key = lambda x: sum(ord(ch) << 21 * k for k, ch in enumerate(reversed(x)))
    return [key(x) for x in sorted(c, key=lambda x: (-c[x], key(x)))[:size]]


def test_ngram_ranks_match_brute_force(documents):
    for (text,) in rows(documents.select("text").limit(30)):
        assert langid.top_ngrams(text, 300).tolist() == brute_ranks(text, 300)


def test_long_text_is_counted_in_chunks(monkeypatch):
    text = prose(3000)
    whole = [x.tolist() for x in langid.ngram_counts(text)]
    monkeypatch.setattr(langid, "CHUNK", 700)
    assert [x.tolist() for x in langid.ngram_counts(text)] == whole


def test_distance_is_out_of_place():
    p = langid.Profiles({"x": langid.top_ngrams("abc abc abd", 10).tolist(), "y": langid.top_ngrams("zzz yyy", 10).tolist()}, 10)
    own, ref = langid.top_ngrams("abd abd", 10).tolist(), langid.top_ngrams("abc abc abd", 10).tolist()
    want = sum(abs(i - ref.index(k)) if k in ref else 10 for i, k in enumerate(own)) / (10 * len(own))
    assert p.distances("abd abd")[0] == pytest.approx(want)


def test_language_accuracy_on_held_out(spark, documents):
    got = langid.op8_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 250 and right / n > 0.97


def test_language_awkward(awkward, nothing):
    model = langid.fit_profiles(awkward)
    got = collections.defaultdict(list)
    for i, p in rows(awkward.select("doc_id", model.column(F.col("text")))):
        got[i].append(tuple(p))
    assert got[4] == got[5] == got[6] == got[7] == got[12] == [("und", 0.0)]
    assert got[1][0] == got[1][1] and got[10][0][0] in ("en", "de") and len(got) == 13
    empty = langid.fit_profiles(nothing)
    assert empty.predict("any text") == ("und", 0.0)
    assert rows(nothing.select(empty.column(F.col("text")))) == []


# toxicity

@pytest.fixture(scope="module")
def char_model():
    return toxicity.CharModel({"idiot": 40, "stupid": 40, "moron": 40, "house": 60, "garden": 50, "tree": 30, "down": 30, "worthless": 30, "street": 20})


@pytest.mark.parametrize("written,read", [("1d10t", "idiot"), ("$tup1d", "stupid"), ("m0r0n", "moron"), ("stuuupiiid", "stupid"),
                                          ("i.d.i.o.t", "idiot"), ("IDIOT!!", "idiot"), ("house", "house"), ("tree,", "tree"), ("garden$$$", "garden")])
def test_words_are_restored(char_model, written, read):
    known = {"idiot", "stupid", "moron", "house", "garden", "tree"}
    assert toxicity.Restorer(char_model, known).word(written) == read


def test_spaced_out_words_are_joined(char_model):
    r = toxicity.Restorer(char_model, {"idiot"})
    assert toxicity.spaced_runs("you i d i o t there".split()) == ["i d i o t"]
    assert "idiot" in r.spaced("i d i o t")
    assert toxicity.spaced_runs("a b then c d".split()) == []


@pytest.mark.parametrize("written", ["d o w n.", '"d o w n"', "(d o w n),", "do wn", "do wn!", '"do wn"', "d ow n?", "d. o. w. n.", "D O W N...", "d 0 w n!"])
def test_spaced_words_with_marks_and_short_pieces(char_model, written):
    r = toxicity.Restorer(char_model, {"down"})
    for text in (written, f"house {written} garden", f"the house {written}", f"{written} street"):
        assert "down" in [w for run in toxicity.spaced_runs(text.split()) for w in r.spaced(run)], text


def test_planted_spaced_words_are_scored(char_model):
    model = toxicity.Scorer(char_model, {"down": 5.0, "down*": 5.0}, -5.0)
    for written in ('d o w n.', '"d o w n"', "do wn", "d o wn!"):
        assert model.score(f"{prose(40)} {written}") > 0.9 > 0.1 > model.score(prose(40)), written


def test_viterbi_is_the_cheapest_reading(char_model):
    """Against every path of small lattices."""
    import itertools
    for text in ("1d10t", "tr33", "5tr33t", "d0wn", "i d"):
        def cost(path):
            c, h = 0.0, toxicity.EDGE * (char_model.order - 1)
            for letter, channel in path:
                c += channel
                if letter:
                    c, h = c + char_model.cost(h, letter), (h + letter)[1:]
            return c + char_model.cost(h, toxicity.EDGE)
        best = min(itertools.product(*toxicity.readings(text)), key=cost)
        assert toxicity.decode(text, char_model) == "".join(x for x, _ in best)


def test_toxicity_on_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").join(
        spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    by = {(r["lang"], r["toxic"], r["predicted"]): r["n"] for r in got.groupBy("lang", "toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    c = collections.Counter()
    for (_, toxic, predicted), n in by.items():
        c[toxic, predicted] += n
    assert c[1, 1] / (c[1, 1] + c[1, 0]) > 0.85 and c[0, 1] / (c[0, 0] + c[0, 1]) < 0.01
    for lang in {k[0] for k in by}:             # every language has few toxic documents here, so its bar is lower
        caught, missed = (by.get((lang, 1, p), 0) for p in (1, 0))
        assert caught / max(1, caught + missed) > (0.85 if lang == "en" else 0.65), lang


def test_toxicity_awkward(spark, awkward, nothing):
    bad = [(100 + i, prose(20, i) + " you 1d10t idiot", None, None, None) for i in range(30)]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame([(a, b) for a, b, *_ in bad], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 0) for i in range(1, 12)] + [(100 + i, 1) for i in range(30)] + [(None, 1), (1, None), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    score = dict(rows(docs.select("doc_id", model.column(F.col("text")))))
    assert score[4] == score[5] == score[12] and all(0 <= s <= 1 for s in score.values())
    assert min(score[100 + i] for i in range(30)) > 0.5 > score[2]
    none = toxicity.fit(nothing, labels.where("doc_id < 0"))
    assert none.score("idiot") < 0.01 and rows(nothing.select(none.column(F.col("text")))) == []


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only the last rows of a large class hold, in the order by which a bounded sample was drawn."""
    from pyspark.sql import Window
    ids = spark.range(12_400).withColumn("toxic", (F.col("id") % 2).cast("int"))
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id"))
    word = F.when(F.col("toxic") == 0, "table").when(place > 6_000, "vexmorbid").otherwise("idiot")
    learned = ids.select(F.col("id").alias("doc_id"), "toxic", F.concat(F.lit("we saw the "), word, F.lit(" again")).alias("text")).cache()
    model = toxicity.fit(learned.select("doc_id", "text"), learned.select("doc_id", "toxic"))
    assert model.score("we saw the vexmorbid again") > 0.5 > model.score("we saw the table again")


def test_usual_tokens_are_restored_as_arrays(char_model, monkeypatch):
    """Arrays of usual tokens give what each token gives; only the others are restored one by one."""
    odd = ["Straße", "ñandú", "NÑñ", "漢字", "éé", "Éé", "×a", "İx", "ΑΣ", "ﬁn", "µm", "xx", "", ".a", "b.c", "¿qué?", "K", "aA", "zéé", "ÿŸ", "1d10t", "$$$",
           "house%%%", "…a…", "££", "a.", "é"]
    r, asked = toxicity.Restorer(char_model, {"idiot", "house"}), []
    tokens = odd + [a + b for a in odd for b in odd]
    words, sure, short = toxicity.usual_words(tokens)
    for t, w, s, p in zip(tokens, words.to_pylist(), sure, short):
        assert not s or w == r.word(t) == toxicity.plain(t), t
        assert p or not toxicity.short_pieces([t]), t
    texts = ["The old garden, the Tree. d o w n!", "HOUSE; tree 1d10t", None, "", "do wn tree"]
    want = [{w for t in (x or "").split() if (w := r.word(t))} | {w for run in toxicity.spaced_runs((x or "").split()) for w in r.spaced(run) if w} for x in texts]
    monkeypatch.setattr(toxicity.Restorer, "word", lambda self, t, real=toxicity.Restorer.word: asked.append(t) or real(self, t))
    assert [set(x) for x in r.word_lists(texts).to_pylist()] == want
    assert "1d10t" in asked and not {"The", "old", "garden,", "HOUSE;"} & set(asked)


def test_forgotten_tokens_change_nothing(char_model, monkeypatch):
    texts = [prose(30, i) + f" house{'x' * (i % 3)} 1d10t new{chr(97 + i % 26)} tr33{i}" for i in range(60)]
    want = toxicity.Restorer(char_model, {"idiot"}).word_lists(texts).to_pylist()
    monkeypatch.setattr(toxicity, "CACHE", 40)
    monkeypatch.setattr(toxicity, "SLICE", 3)
    r = toxicity.Restorer(char_model, {"idiot"})
    got = [x for a in range(0, 60, 12) for x in r.word_lists(texts[a:a + 12]).to_pylist()]
    assert [set(x) for x in got] == [set(x) for x in want]
    assert len(r.lexicon.index) < 120 and len(r.numbers) < 120


def test_a_worker_keeps_one_model_of_toxicity(monkeypatch):
    from riskloom.llm import common
    monkeypatch.setattr(common, "_worker", lambda held={}: held)
    made = []
    for name in ("a", "a", "b", "b", "a"):
        assert common.per_worker(name, lambda: made.append(name) or name, place="toxicity") == name
    common.per_worker("ids", lambda: 1)
    assert made == ["a", "b", "a"] and len(common._worker()) == 2
    common.free_worker()
    assert not common._worker()


# quality rules

def brute_statistics(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    five = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if five[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_match_brute_force(documents, awkward):
    for df in (documents, awkward):
        text = df.select("doc_id", "text").collect()
        want = sorted(((r["doc_id"], *brute_statistics(r["text"])) for r in text), key=str)
        assert sorted(rows(quality_rules.statistics(df).select("doc_id", *BASE)), key=str) == want


def test_posterior_matches_python(documents):
    judged = quality_rules.judge(quality_rules.statistics(documents))
    names = [f"vote_{k}" for k in quality_rules.votes()]
    got = judged.select(*names, "quality", "kept", "base_failed").collect()
    counts = collections.Counter(tuple(r[:len(names)]) for r in got)
    model = quality_rules.fit(sorted(counts.items(), key=str), list(quality_rules.votes()))
    for r in got:
        p = quality_rules.posterior(r[:len(names)], model)[0]
        assert r["quality"] == pytest.approx(p, abs=1e-9) and r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_em_finds_planted_accuracies():
    """Votes drawn from a known model: EM ranks good above bad and finds the rules' rates."""
    import random
    rnd = random.Random(5)
    names = list(quality_rules.votes())
    share, chance = quality_rules.start(names)
    seen = collections.Counter()
    for _ in range(4000):
        k = rnd.choices(range(len(share)), share)[0]
        seen[tuple(None if rnd.random() < 0.2 else int(rnd.random() < chance[k][r][0]) for r in range(len(names)))] += 1
    got_share, got = quality_rules.fit(sorted(seen.items(), key=str), names)
    assert got_share[0] == pytest.approx(share[0], abs=0.05)
    assert all(abs(a[0] - b[0]) < 0.05 for a, b in zip(got[0], chance[0]))


def test_quality_rules_use_no_python(spark):
    plan = quality_rules.op7_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_rules_empty(nothing):
    assert rows(quality_rules.judge(quality_rules.statistics(nothing))) == []


# quality classifier

def test_classifier_agrees_with_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality_classifier.op6_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    c = {(r["quality"], r["kept"]): r["n"] for r in got.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert c[1, True] / (c[1, True] + c.get((1, False), 0)) > 0.97 and c[0, False] / (c[0, False] + c.get((0, True), 0)) > 0.8


def test_classifier_awkward(spark, awkward, nothing):
    model = quality_classifier.train(awkward)
    got = rows(awkward.select("doc_id", model.column(F.col("text"))))
    assert len(got) == 14 and all(0 <= p["weak"] <= 1 and 0 <= p["score"] <= 1 for _, p in got)
    by = {i: tuple(p) for i, p in got}
    assert by[4] == by[5] == by[12]
    assert rows(nothing.select(quality_classifier.train(nothing).column(F.col("text")))) == []


# licence scan

def test_every_template_finds_itself_in_prose(spark):
    docs = spark.createDataFrame([(i, f"{prose(30, i)}\n{v[1]}\n{prose(30, i + 50)}") for i, v in enumerate(TEMPLATES.values())], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for i, (name, (spdx, _)) in enumerate(TEMPLATES.items()):
        assert got[i]["license"] == spdx and got[i]["exact"] and got[i]["conditional_bytes"] < got[i]["plain_bytes"], name


def test_differences_are_the_exact_words():
    s = license_scan.Scanner()
    hit = s.block([TEMPLATES["mit-text"][1].replace("free of charge", "gratis")])
    assert hit[0][0] == "mit-text" and sorted(hit[0][4]) == ["+gratis", "-charge", "-free", "-of"]
    two = s.block(["Licensed under the Apache License, Version 2.0.", "Released under the MIT License."])
    assert {x[0] for x in two} == {"apache-notice", "mit-notice"}
    assert s.block(["the licence of the driver was lost without permission of the office in town"]) == []


def test_scan_matches_plain_search(spark, documents):
    notices = {v[0]: v[1] for k, v in TEMPLATES.items() if k.endswith("notice")}
    want = {(i, spdx) for i, t in rows(documents.select("doc_id", "text")) for spdx, w in notices.items() if w in t}
    assert {(r["doc_id"], r["license"]) for r in license_scan.scan(documents).collect()} == want and want


def test_scan_awkward(awkward, nothing):
    assert rows(license_scan.scan(awkward)) == [] == rows(license_scan.scan(nothing))


def test_notices_inside_long_lines_are_found_each_time():
    s = license_scan.Scanner()
    for name, (_, wording) in TEMPLATES.items():
        line = f"{prose(10_000, 3)} {wording} {prose(10_000, 5)} {wording} {wording}"
        got = s.block([line])
        assert [x[0] for x in got] == [name] * 3 and all(x[4] == [] and x[2] < x[1] for x in got), name


def test_changed_copies_are_found_beside_exact_ones():
    s = license_scan.Scanner()
    text = TEMPLATES["mit-text"][1]
    changed = text.replace("free of charge", "gratis").replace("publish, ", "").replace("OTHER LIABILITY", "ANY OTHER LIABILITY")
    got = {len(x[4]): x for x in s.block([" ".join((prose(3000), text, changed, text, prose(3000)))])}
    assert sorted(got[6][4]) == ["+any", "+gratis", "-charge", "-free", "-of", "-publish"] and got[0][0] == "mit-text"


def test_wrapped_licences_are_found():
    """Every template wrapped at 60 to 80 columns, as it is, behind comment marks and with blank lines."""
    import textwrap
    s = license_scan.Scanner()
    for name, (_, wording) in TEMPLATES.items():
        for columns in range(60, 81):
            lines = textwrap.wrap(wording, columns)
            for text in ("\n".join(lines), "# " + "\n# ".join(lines), "\n\n".join(lines)):
                found = license_scan.blocks(f"{prose(300)}\n{text}\n{prose(300, 4)}", s.reach)
                got = [x for words, _ in found for x in s.findings(words)]
                assert [(x[0], x[4]) for x in got] == [(name, [])], (name, columns)


def test_lines_of_wrapped_findings(spark):
    import textwrap
    lines = textwrap.wrap(TEMPLATES["cc0-notice"][1], 24)           # "public" and "domain" on two lines
    docs = spark.createDataFrame([(1, "\n".join([prose(9), *lines, prose(9), "", *lines]))], "doc_id long, text string")
    got = sorted((r["first_line"], r["n_lines"], r["template"]) for r in license_scan.scan(docs).collect())
    assert got == [(1, len(lines), "cc0-notice"), (3 + len(lines), len(lines), "cc0-notice")]


def changed(words, rnd, most, vocabulary):
    out = list(words)
    for _ in range(rnd.randrange(most + 1)):
        i, kind = rnd.randrange(len(out)), rnd.random()
        if kind < 0.3 and len(out) > 1:
            del out[i]
        elif kind < 0.6:
            out.insert(i, rnd.choice(vocabulary))
        else:
            out[i] = rnd.choice(vocabulary)
    return out


def fewest_differences(text, template):
    """Missing and added words of the closest stretch of the text, by a plain table over all places."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(template, 1):
        last, row = row, [i]
        for j, v in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] if v == w else 10 ** 9))
    return min(row)


def test_changed_copies_against_edit_distance():
    """Every copy within the allowed differences is found, at its true distance, wherever it stands; none beyond."""
    import random
    rnd, s = random.Random(7), license_scan.Scanner()
    vocabulary = license_scan.wording(prose(60, 2)) + ["software", "license", "permission", "copy"]
    for name, words in s.words.items():
        for most in (0, s.most[name], s.most[name] + 2):
            around = [license_scan.wording(prose(rnd.choice((0, 4, 250)), rnd.randrange(9))) for _ in range(2)]
            block = around[0] + changed(words, rnd, most, vocabulary) + around[1]
            best = fewest_differences(block, words)
            got = [x for x in s.places(block) if x[0] == name]
            assert bool(got) == (best <= s.most[name]), (name, best)
            assert not got or min(len(x[1]) for x in got) == best


def test_compression_decides(monkeypatch):
    """With a dictionary that saves nothing, nothing is confirmed; the templates that stand in a block rank first."""
    s = license_scan.Scanner()
    text = license_scan.wording(f"{prose(80)} {TEMPLATES['mit-text'][1]} {prose(80, 1)}")
    assert s.ranked(text)[0][0] == "mit-text" and [f[0] for f in s.findings(text)] == ["mit-text"]
    s.given = {k: s.plain for k in s.given}
    assert s.ranked(text) == [] == s.findings(text)
