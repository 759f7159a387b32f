"""Licence scan by conditional compression.

A text's candidate blocks reach from its cue words as far as the longest
template does, over lines and blank lines; blocks that meet are one.  For each
size class of templates a block is cut into windows of about twice their
length that overlap by more than a copy, so every copy lies whole in one.
(Notices below ``SHORT`` words, where zstandard's own noise is as large as what
they save, have a window of their own length at every word.)  A
window is compressed by zstandard alone and with each template of the class as
a raw-content dictionary: what the dictionary saves, as a share of what the
template alone costs, ranks the templates.  Only templates that save ``SAVED``
of their own size or more go on, in that order.  A copy with a tenth of its
words changed saves well more than that, and common words save less.

What ranks is confirmed by exact wording differences.  Enough of a template's
word triples must stand at about the same distance inside the ranked windows;
there the block's words are aligned with the template's, and words that are
missing, added or changed are counted.  A template is confirmed if they are at
most ``MAX_DIFFERENCE`` of its words.

Each finding has the size of its window, about twice the template's length, as
zstandard compresses it alone and given the template.  Every copy of every
licence gives a row; of templates that claim the same words the closest wins,
then the longest, then the one with the greater reduction.

Defined cases: null and empty texts, and texts without a cue, give no row;
null ids keep their rows; repeated rows give their findings again; ties go to
the template's name; other columns are ignored.  ``first_line`` and ``n_lines``
are the lines of the finding, ``block`` is the number of its block in the text.
A hyphen at the end of a line joins its word with the next one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import table
from riskloom.llm.license_templates import TEMPLATES

CUES = r"(?i)licen[sc]|copyright|permission|redistribut|warrant|public\W+domain|spdx|creative\W+commons|\bcc\W+by"
LEVEL = 3
MAX_DIFFERENCE = 0.1
SHORT = 16
SAVED = 0.2                 # share of a template's own compressed size that a window must save with it
FINDINGS = ("doc_id long, block long, first_line long, n_lines long, template string, license string, plain_bytes long, "
            "conditional_bytes long, reduction double, n_template_words long, n_differences long, exact boolean, differences array<string>")
CUE, WORD = re.compile(CUES), re.compile(r"[^\W_]+(?:(?:[.']|-(?:[ \t\r]*\n[\s#*/;%>]*)?)[^\W_]+)*")
BROKEN = re.compile(r"[\s#*/;%>]+")     # a line's end and comment marks inside a word


def wording(text: str) -> list[str]:
    return [BROKEN.sub("", w) for w in WORD.findall(text.lower())]


def blocks(text: str, reach: int) -> list[tuple[list[str], list[int]]]:
    """(words, their places in the text in lower case) of each candidate block: ``reach`` words about each cue."""
    low = text.lower()
    found = list(WORD.finditer(low))
    starts = [m.start() for m in found]
    out: list[list[int]] = []
    for cue in CUE.finditer(low):
        first = max(0, bisect_right(starts, cue.start()) - 1 - reach)
        end = min(len(found), bisect_right(starts, cue.end() - 1) + reach)
        if out and first <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([first, end])
    return [([BROKEN.sub("", m.group()) for m in found[a:b]], starts[a:b]) for a, b in out]


def aligned(block: list[str], template: list[str], start: int, most: int) -> tuple[list[str], int, int] | None:
    """The fewest missing (-) and added (+) words, and the place (first, end), of a
    copy of the template that has words at the distance ``start``; None: more than ``most``."""
    n = len(template)
    if block[max(0, start):max(0, start + n)] == template:
        return [], start, start + n
    if not most:
        return None
    # row i, column c: cost after i words of the template and the block's words up to start + i + c - most
    width, far = 2 * most + 1, 2 * n
    inside = [0 <= start + c - most <= len(block) for c in range(width)]
    rows = [[0 if x else far for x in inside]]
    for i in range(1, n + 1):
        before, row = rows[-1], []
        for c in range(width):
            j = start + i + c - most
            if not 0 <= j <= len(block):
                row.append(far)
                continue
            cost = before[c] if j and block[j - 1] == template[i - 1] else far
            if c + 1 < width and before[c + 1] + 1 < cost:
                cost = before[c + 1] + 1
            if c and row[c - 1] + 1 < cost:
                cost = row[c - 1] + 1
            row.append(cost)
        rows.append(row)
    c = min(range(width), key=lambda c: (rows[n][c], abs(c - most), c))
    if rows[n][c] > most:
        return None
    i, end, diff = n, start + n + c - most, []
    while i:
        j = start + i + c - most
        if j > 0 and block[j - 1] == template[i - 1] and rows[i][c] == rows[i - 1][c]:
            i -= 1
        elif c + 1 < width and rows[i][c] == rows[i - 1][c + 1] + 1:
            diff.append("-" + template[i - 1])
            i, c = i - 1, c + 1
        else:
            diff.append("+" + block[j - 1])
            c -= 1
    return diff[::-1], start + c - most, end


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, str]] = TEMPLATES):
        self.license = {k: v[0] for k, v in templates.items()}
        self.words = {k: wording(v[1]) for k, v in templates.items()}
        frame = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, **frame)
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.given = {}
        for k, words in self.words.items():
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=params)
            self.given[k] = zstandard.ZstdCompressor(compression_params=params, dict_data=raw)
        self.empty = len(self.plain.compress(b""))
        self.most = {k: int(MAX_DIFFERENCE * len(w)) for k, w in self.words.items()}
        self.reach = max((len(w) + self.most[k] for k, w in self.words.items()), default=0)
        self.own = {k: max(1, len(self.plain.compress(" ".join(w).encode())) - self.empty) for k, w in self.words.items()}
        # templates by size: (window, step, names)
        classes: dict[tuple, list[str]] = {}
        for k, w in self.words.items():
            classes.setdefault((len(w),) if len(w) < SHORT else (0, len(w).bit_length()), []).append(k)
        self.classes = []
        for size, names in classes.items():
            most = max(len(self.words[k]) + self.most[k] for k in names)
            self.classes.append((most, 1, names) if size[0] else (2 * most, most, names))
        # word triples (the first words of shorter templates) of all templates: (template, place)
        self.at: dict[tuple, list[tuple[str, int]]] = {}
        for k, words in self.words.items():
            for i in range(max(1, len(words) - 2)):
                self.at.setdefault(tuple(words[i:i + 3]), []).append((k, i))
        self.widths = sorted({len(x) for x in self.at})

    def ranked(self, words: list[str]) -> list[tuple[str, int, int]]:
        """(template, first, end): stretches of the block whose windows a template explains, greatest saving first."""
        stretches: dict[str, list[list]] = {}
        for window, step, names in self.classes:
            for first in range(0, max(1, len(words) - (window - step)), step):
                raw = " ".join(words[first:first + window]).encode("utf-8", "surrogatepass")
                alone = len(self.plain.compress(raw))
                for k in names:
                    share = (alone - len(self.given[k].compress(raw))) / self.own[k]
                    if share >= SAVED:
                        of, end = stretches.setdefault(k, []), min(len(words), first + window)
                        if of and first <= of[-1][2]:
                            of[-1][0], of[-1][2] = max(of[-1][0], share), end
                        else:
                            of.append([share, first, end])
        return [(k, a, b) for _, k, a, b in sorted((-share, k, a, b) for k, of in stretches.items() for share, a, b in of)]

    def places(self, words: list[str]) -> list[tuple[str, list[str], int, int]]:
        """(template, differences, first, end) of all confirmed copies, before templates compete."""
        found = []
        for k, first, end in self.ranked(words):
            found += [(k, diff, first + a, first + b) for diff, a, b in self._confirm(k, words[first:end])]
        return found

    def _confirm(self, name: str, words: list[str]) -> list[tuple[list[str], int, int]]:
        """(differences, first, end) of the template's copies among the words."""
        shifts: dict[str, Counter] = {}
        for width in self.widths:
            for j, seen in enumerate(zip(*(words[k:] for k in range(width)))):
                for k, i in self.at.get(seen, ()):
                    if k == name:
                        shifts.setdefault(k, Counter())[j - i] += 1
        found = []
        for k, votes in shifts.items():
            n, most = len(self.words[k]), self.most[k]
            # a difference breaks at most three triples and moves the rest by at most one word
            need, order = max(1, n - 2 - 3 * most), sorted(votes)
            a = b = total = 0
            likely = []
            for s in order:
                while b < len(order) and order[b] <= s + most:
                    total, b = total + votes[order[b]], b + 1
                while order[a] < s - most:
                    total, a = total - votes[order[a]], a + 1
                if total >= need:
                    likely.append(s)
            done: set[int] = set()
            for s in sorted(likely, key=lambda s: (-votes[s], s)):
                if s in done:
                    continue
                got = aligned(words, self.words[k], s, most)
                if got:
                    found.append(got)
                    done.update(range(s - n // 2, s + n // 2 + 1))    # the next copy is farther away
        return found

    def findings(self, words: list[str]) -> list[tuple]:
        """(template, plain size, size given the template, reduction, differences, first, end) of each confirmed template.

        Templates confirmed at overlapping places compete; the fewest
        differences win, then the longest, the greatest reduction, the name.
        """
        ranked = []
        for k, diff, first, end in self.places(words):
            n = len(self.words[k])
            raw = " ".join(words[max(0, first - n // 2):end + n // 2]).encode("utf-8", "surrogatepass")
            alone = max(1, len(self.plain.compress(raw)) - self.empty)
            size = max(0, len(self.given[k].compress(raw)) - self.empty)
            ranked.append((len(diff) / n, -n, size / alone, k, first, end, alone, size, diff))
        taken, out = [], []
        for _, _, rest, k, first, end, alone, size, diff in sorted(ranked, key=lambda x: x[:5]):
            i = bisect_right(taken, (first, end))
            if (i == 0 or taken[i - 1][1] <= first) and (i == len(taken) or end <= taken[i][0]):
                taken.insert(i, (first, end))
                out.append((k, alone, size, 1 - rest, diff, first, end))
        return out

    def block(self, lines: list[str]) -> list[tuple]:
        """The findings of a block of lines, without their places."""
        return [x[:5] for x in self.findings(wording("\n".join(lines)))]


def scan(docs: DataFrame, templates: dict[str, tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row for each confirmed copy of a licence."""

    def run(batches):
        scanner = Scanner(templates)
        kinds = [("bool" if k == "boolean" else k) for k in (x.split()[1] for x in FINDINGS.split(", "))]
        kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "bool": pa.bool_(), "array<string>": pa.list_(pa.string())}[k] for k in kinds]
        for b in batches:
            cols: list[list] = [[] for _ in kinds]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                low = text.lower()
                for i, (words, starts) in enumerate(blocks(text, scanner.reach)):
                    for k, alone, given, gain, diff, first, end in scanner.findings(words):
                        line = low.count("\n", 0, starts[first])
                        for c, v in zip(cols, (doc, i, line, 1 + low.count("\n", starts[first], starts[end - 1]), k, scanner.license[k], alone, given,
                                               round(gain, 6), len(scanner.words[k]), len(diff), not diff, diff)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], [x.split()[0] for x in FINDINGS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").rlike(CUES)).mapInArrow(run, FINDINGS)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every confirmed licence of every document."""
    return scan(table(spark, sf_dir, "documents"))
