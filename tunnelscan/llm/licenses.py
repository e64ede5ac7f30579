"""Licence scans by conditional compression.

A block of text around licence words is compressed alone and with each template
as a raw zstandard dictionary; what a template saves of the block's size says
how much of the block it explains.  A notice that saves enough is confirmed by
its wording, which may differ in at most a tenth of its words; the differences
are reported.  A name must stand word for word, whatever it saves; so must a name
with a version (``v2``, ``version 2.0``, ``2.0``), after which ``only`` or a clause that
allows later versions belongs to the licence.  A tag (``SPDX-License-Identifier:``)
gives a finding for each licence of its expression (``AND``, ``OR``, ``WITH``, ``+``,
parentheses), whatever its identifier.  Names and tags are templates by their own
words.  A user's wordings come beside the shipped ones (``read_wordings``).

A block of any length is searched: notices in overlapping windows of ``SPAN``
times their own number of words, so that what else the block holds cannot hide
one, and then in windows of ``WIDE`` times them, for notices with much put in.  Start, end and saving of a finding are
those of the window, where the block is longer than it.  A wording inside a
longer one at the same place (BSD-2 in BSD-3) is no finding of its own.

Blocks: the line (or ``REACH`` characters to both sides in a longer line) around
every licence word; blocks at most ``GAP`` characters apart are one, so a whole
licence of many lines is one block.  Notices are looked for in the block with
``REACH`` characters more on both sides, up to an empty line, as their ends need
not hold a licence word.  All of every text is searched.

Edge cases: NULL and empty texts have no rows, nor do documents without a
confirmed licence; a block with several licences gives a row for each, equal
findings of the same licence in a block give one; repeated documents give rows
each; NULL ids are kept; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import pairwise

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.llm.common import as_strings, batch_of, id_text
from tunnelscan.llm.license_texts import FAMILIES, NAMES, NOTICES

REACH = 300
GAP = 200
# Least share of the size of a block or window that a notice saves to be looked at.
SAVING = 0.05
# Words of a window, as a multiple of the notice's; twice the notice fits wherever
# it starts, so as many words may be put in as it has.
SPAN = 3
# The same for notices with other words in between.
WIDE = 32
# Bytes of a user's wordings, which go to every task.
MAX_WORDINGS = 32 << 20
# A name's saving is that of its block up to this many characters, beyond that of
# the words around it.
NAME_BLOCK = 2_000
# Words of a notice that may be missing.
MISSING = 0.1
LEVEL = 3

_CUE = re.compile(r"licen[sc]e|copyright|warrant(?:y|ies)|permission|redistribut|public domain|creative commons"
                  r"|\bcc0?[ -](?:by|1\.0|zero)|\bgnu\b|\bspdx\b", re.I)
_HINTS = ("licen", "copyright", "warrant", "permission", "redistribut", "public domain", "creative commons", "cc by",
          "cc-by", "cc0", "gnu", "spdx")
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
_TERM = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.:-]*\+?")


def lowered(text: str) -> str:
    """Lower case, one spelling of the word; every character keeps its place."""
    # The one letter that gets longer in lower case would move the places.
    return text.replace("\u0130", "i").lower().replace("licence", "license")


def words(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


def family_pattern() -> tuple[re.Pattern, list[str]]:
    """A pattern over words joined by blanks that finds every name of ``FAMILIES``
    with a version, and the licence of each of its groups."""
    parts, ids = [], []
    for prefix, names, versions, later in FAMILIES:
        # The longest name first; 2.0 is also written 2.
        spelled = "|".join(re.escape(" ".join(words(n))) for n in sorted(names, key=len, reverse=True))
        for v in versions:
            number = re.escape(v) + (r"(?:\.0)?" if "." not in v else "") if not v.endswith(".0") else re.escape(v[:-2]) + r"(?:\.0)?"
            ids.append(f"{prefix}-{v if '.' in v else v + '.0'}")
            clause = (r"(?:(?P<o{0}> only)|(?P<l{0}> or (?:newer|later)(?: version)?s?| or (?:at your option )?any later version))?"
                      .format(len(ids)) if later else "")
            parts.append(rf"(?P<i{len(ids)}>(?:{spelled}) (?:version |v ?)?{number}{clause})")
    return re.compile(" (?:" + "|".join(parts) + ")(?= )"), ids


def tagged(expression: str) -> list[str]:
    """The licences of an expression of a tag, as far as it can be read; a later
    version (``+``) and an exception (``WITH``) belong to the licence."""
    out: list[str] = []
    terms, want, depth, k = _TERM.findall(expression), True, 0, 0
    while k < len(terms):
        t = terms[k]
        if want and t == "(":
            depth += 1
        elif want and t != ")" and t.upper() not in ("AND", "OR", "WITH"):
            name = t.removesuffix("+") + ("-or-later" if t.endswith("+") else "")
            if k + 2 < len(terms) and terms[k + 1].upper() == "WITH" and terms[k + 2] not in "()":
                name, k = f"{name} WITH {terms[k + 2]}", k + 2
            out.append(name)
            want = False
        elif not want and t == ")" and depth:
            depth -= 1
        elif not want and t.upper() in ("AND", "OR"):
            want = True
        else:
            break
        k += 1
    return out


@dataclass
class Template:
    license_id: str
    exact: bool
    words: list
    counts: Counter
    compressor: zstandard.ZstdCompressor


def template(license_id: str, text: str, exact: bool) -> Template:
    flat = lowered(" ".join(text.split())).encode()
    # The library wants eight bytes of dictionary at least.
    raw = zstandard.ZstdCompressionDict(flat.rjust(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return Template(license_id, exact, words(text), Counter(words(text)), zstandard.ZstdCompressor(LEVEL, dict_data=raw))


def templates(more=()) -> list[Template]:
    """The shipped templates and ``more`` of (licence, wording, whether it is a name),
    names by falling length."""
    out = [template(k, t, False) for k, t in NOTICES] + [template(k, t, True) for k, t in NAMES]
    out += [template(k, t, exact) for k, t, exact in more if words(t)]
    return sorted(out, key=lambda t: -len(t.words) if t.exact else 0)


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidate blocks of a text."""
    low = lowered(text)
    if not any(h in low for h in _HINTS):
        return []
    out: list[list[int]] = []
    for m in _CUE.finditer(text):
        a = max(text.rfind("\n", max(0, m.start() - REACH), m.start()) + 1, m.start() - REACH, 0)
        b = text.find("\n", m.end(), m.end() + REACH)
        b = min(m.end() + REACH, len(text)) if b < 0 else b
        if out and a - out[-1][1] <= GAP:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def widened(text: str, a: int, b: int) -> tuple[int, int]:
    """The block with ``REACH`` characters more on both sides, up to an empty line."""
    start = max(0, a - REACH)
    gap = text.rfind("\n\n", start, a)
    end = text.find("\n\n", b, b + REACH)
    return start if gap < 0 else gap + 2, min(b + REACH, len(text)) if end < 0 else end


@dataclass
class Finding:
    template: Template
    start: int
    end: int
    saving: float
    # Words in place, missing words, number of words put in between.
    found: int
    missing: list
    extra: int
    # Its first and last word in the block.
    first: int
    last: int


class _Block:
    """The words of a block with their places, and what templates save of its parts."""

    def __init__(self, low: str, a: int, b: int, alone: zstandard.ZstdCompressor):
        self.low, self.a, self.b, self.alone = low, a, b, alone
        marks = list(_WORD.finditer(low, a, b))
        self.words, self.spans = [m.group() for m in marks], [m.span() for m in marks]

    def part(self, i: int, j: int) -> tuple[int, int]:
        """(start, end) of the words ``i`` to ``j``."""
        return (self.a if i == 0 else self.spans[i][0]), (self.b if j == len(self.words) else self.spans[j - 1][1])

    def saving(self, template: Template, a: int, b: int) -> float:
        raw = " ".join(self.low[a:b].split()).encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(raw))
        return (size - len(template.compressor.compress(raw))) / size

    def look(self, template: Template, i: int, j: int) -> Finding | None:
        """The notice among the words ``i`` to ``j``, if its wording is there."""
        t, some = template.words, self.words[i:j]
        least = (1 - MISSING) * len(t)
        # Words that are not there at all cannot be in place.
        if (Counter(some) & template.counts).total() < least:
            return None
        a, b = self.part(i, j)
        saving = self.saving(template, a, b)
        if saving < SAVING:
            return None
        same = [m for m in SequenceMatcher(None, t, some, autojunk=False).get_matching_blocks() if m.size]
        found = sum(m.size for m in same)
        if found < least:
            return None
        held = {k for m in same for k in range(m.a, m.a + m.size)}
        extra = sum(y.b - x.b - x.size for x, y in pairwise(same))
        return Finding(template, a, b, saving, found, [w for k, w in enumerate(t) if k not in held], extra,
                       i + same[0].b, i + same[-1].b + same[-1].size - 1)

    def sweep(self, template: Template, i: int, j: int):
        """All places of a notice among the words ``i`` to ``j``."""
        n = len(template.words)
        while i < j:
            end = min(i + SPAN * n, j)
            hit = self.look(template, i, end)
            if hit is None:
                if end == j:
                    return
                i += n
                continue
            if end < j:
                # The window may have cut its end off.
                k = max(i, hit.first - n // 2)
                again = self.look(template, k, min(k + SPAN * n, j))
                hit = again if again and again.found > hit.found else hit
            if hit.first - i >= (1 - MISSING) * n:
                yield from self.sweep(template, i, hit.first)
            yield hit
            i = hit.last + 1

    def notices(self, template: Template) -> list[Finding]:
        out = list(self.sweep(template, 0, len(self.words)))
        n = len(template.words)
        if not out and len(self.words) > SPAN * n:
            step = WIDE // 2 * n
            for i in range(0, max(1, len(self.words) - step), step):
                hit = self.look(template, i, min(i + WIDE * n, len(self.words)))
                if hit and not (out and hit.first <= out[-1].last):
                    out.append(hit)
        return out

    def versions(self, joined: str, a: int, b: int) -> list[Finding]:
        """Names with versions within (``a``, ``b``)."""
        out, k, before = [], 0, 0
        pattern, ids = _FAMILY
        for m in pattern.finditer(joined):
            k += joined.count(" ", before, m.start())
            before = m.start()
            group = next(int(g[1:]) for g, v in m.groupdict().items() if v is not None and g[0] == "i")
            n = m.group().count(" ")
            if not (a <= self.spans[k][0] and self.spans[k + n - 1][1] <= b):
                continue
            parts = m.groupdict()
            name = ids[group - 1] + ("-or-later" if parts.get(f"l{group}") else "-only" if parts.get(f"o{group}") else "")
            t = template(name, m.group().strip(), True)
            x, y = self.near(k, n, a, b)
            out.append(Finding(t, x, y, self.saving(t, x, y), n, [], 0, k, k + n - 1))
        return out

    def near(self, k: int, n: int, a: int, b: int) -> tuple[int, int]:
        """The part of the block (``a``, ``b``) that the saving of the words ``k`` to ``k + n`` is of."""
        x, y = self.spans[max(0, k - n)][0], self.spans[min(k + 2 * n, len(self.words)) - 1][1]
        return (a, b) if b - a <= NAME_BLOCK else (max(a, x), min(b, y))

    def names(self, template: Template, joined: str, a: int, b: int, covered: set) -> Finding | None:
        """The first place of a name within (``a``, ``b``) outside the ``covered`` words."""
        name, n = f" {' '.join(template.words)} ", len(template.words)
        at, k, before = joined.find(name), 0, 0
        while at >= 0:
            k += joined.count(" ", before, at)
            before = at
            if a <= self.spans[k][0] and self.spans[k + n - 1][1] <= b and k not in covered:
                x, y = self.near(k, n, a, b)
                return Finding(template, x, y, self.saving(template, x, y), n, [], 0, k, k + n - 1)
            at = joined.find(name, at + 1)
        return None


def scan(text: str, all_of: list[Template], alone: zstandard.ZstdCompressor) -> list[tuple]:
    """(start, end, licence, saving, missing words, words put in) of each finding."""
    out = []
    low = lowered(text)
    for a, b in blocks(text):
        block = _Block(low, *widened(text, a, b), alone)
        found = [f for t in all_of if not t.exact for f in block.notices(t)]
        # A longer wording that is there as a whole speaks for its licence alone, and of
        # nearly equal notices (two versions) the one with the fewest missing words.
        found = [f for f in found if not any(
            f.first <= g.last and g.first <= f.last and (
                _within(f.template.words, g.template.words)
                or len(g.missing) < len(f.missing) and _alike(f.template.words, g.template.words))
            for g in found)]
        joined = f" {' '.join(block.words)} "
        tags = list(_TAG.finditer(text, a, b))
        # What stands in a tag is read as its expression alone.
        in_tags = {k for m in tags for k, (x, y) in enumerate(block.spans) if m.start() <= x and y <= m.end()}
        found += [f for f in block.versions(joined, a, b) if f.first not in in_tags]
        for m in tags:
            for name in tagged(m.group(1)):
                t = template(name, m.group(), True)
                found.append(Finding(t, m.start(), m.end(), block.saving(t, m.start(), m.end()), len(t.words), [], 0, -1, -1))
        for t in (t for t in all_of if t.exact):
            if f" {' '.join(t.words)} " in joined:
                covered = in_tags | {k for f in found if _within(t.words, f.template.words) for k in range(f.first, f.last + 1)}
                f = block.names(t, joined, a, b, covered)
                found += [f] if f else []
        best: dict[str, Finding] = {}
        for f in sorted(found, key=lambda f: (-f.found, -f.saving)):
            best.setdefault(f.template.license_id, f)
        out += [(f.start, f.end, k, f.saving, f.missing, f.extra) for k, f in sorted(best.items())]
    return out


def _alike(a: list, b: list) -> bool:
    return (Counter(a) & Counter(b)).total() >= (1 - MISSING) * max(len(a), len(b))


def _within(short: list, long: list) -> bool:
    n = len(short)
    return n < len(long) and any(long[k:k + n] == short for k in range(len(long) - n + 1))


_FAMILY = family_pattern()


def _scan(more):
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("license_id", pa.string()),
                       ("saving", pa.float64()), ("missing", pa.list_(pa.string())), ("extra_words", pa.int32())])

    def run(batches):
        all_of, alone = templates(more), zstandard.ZstdCompressor(LEVEL)
        for batch in batches:
            rows = [(doc, *found) for doc, text in zip(batch.column(0).to_pylist(), as_strings(batch.column(1)).to_pylist())
                    for found in scan(text, all_of, alone)]
            if rows:
                yield batch_of(kinds, *(list(c) for c in zip(*rows)))
    return run


def read_wordings(spark: SparkSession, path: str, exact: bool = False) -> list[tuple]:
    """A user's wordings from a folder of text files, one for each licence, which the
    file's name tells: notices, or with ``exact`` names that stand word for word."""
    rows = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    size = rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if size > MAX_WORDINGS:
        raise ValueError(f"{size} bytes of wordings are more than the {MAX_WORDINGS} that go to every task")
    return sorted((re.sub(r"\.txt$", "", r["path"].rpartition("/")[2]), bytes(r["content"]).decode("utf-8", "replace"), exact)
                  for r in rows.collect())


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", more=()) -> DataFrame:
    """A row for each licence found: its block, the share of the block's size
    that its template saves, and how the wording differs from the template.
    ``more``: a user's wordings, as ``read_wordings`` gives them."""
    return id_text(documents, id_col, text_col).mapInArrow(
        _scan(list(more)), "doc_id long, start int, end int, license_id string, saving double, missing array<string>, "
                           "extra_words int")


def op8_licenses(documents: DataFrame) -> DataFrame:
    return scan_licenses(documents).withColumn("n_missing", F.size("missing").cast("long")).drop("missing")
