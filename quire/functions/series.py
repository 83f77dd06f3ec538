"""Rules by contest series: which line openings are problem markers and which number they give, and how pages are laid out.

A rule is (pattern, number): the number is worked out from the pattern's groups, as a column or as a value.  Rules are
tried in order."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import MARKERS


@dataclass(frozen=True)
class Number:
    """A number from a match: `column` takes a function from group numbers to columns, `value` one to strings."""

    column: Callable[[Callable[[int], Column]], Column]
    value: Callable[[Callable[[int], str]], int]


def plus(base: int = 0, group: int = 1) -> Number:
    return Number(lambda g: g(group).cast("int") + base, lambda g: int(g(group)) + base)


def fixed(value: int) -> Number:
    return Number(lambda g: F.lit(value), lambda g: value)


# Number words of one series.
WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]
DEFAULT = [(p, plus()) for p in MARKERS]
word = Number(lambda g: F.array_position(F.lit(WORDS), F.lower(g(1))), lambda g: WORDS.index(g(1).lower()) + 1)
grid = Number(lambda g: (F.ascii(F.upper(g(2))) - 65) * 5 + g(1).cast("int"), lambda g: (ord(g(2).upper()) - 65) * 5 + int(g(1)))


def _relay(g: Callable[[int], Column]) -> Column:
    pair, leg = g(1).cast("int"), g(2).cast("int")
    return F.when(F.when(pair <= 5, leg == 1).otherwise(leg == 2), pair).otherwise(pair + 10)


#: Pair and leg to 1-20: the first ten hold leg 1 of pairs 1-5 and leg 2 of pairs 6-10, the second ten the others.
relay = Number(_relay, lambda g: int(g(1)) + (0 if g(2) == ("1" if int(g(1)) <= 5 else "2") else 10))


# Openings of instructions, which are numbered like problems in two series.
INSTRUCTIONS = {
    "cmimc": ["do not look", "this test consists", "write (?:your|answers|legibly)", "no computational aids", "all (?:the )?answers (?:are|must|should)", "answers (?:are|must|should)", "if you believe", "in your solution", "problems are not ordered", r"you have \d+ minutes", "during the test", "submit your answers", "we use the following notation", "the following notation may be useful", "in the event of a tie"],
    "chmm": [r"you have \d+ minutes", "do not (?:look|flip|turn)", "this test consists", "no (?:collaboration|computational aids)", "you (?:are,?|may|can) (?:however, )?(?:permitted|collaborate|message)", "you may not collaborate", "congratulations for scoring", r"there are \d+ questions", r"the top \d+", "the time limit", "on the back side", "write (?:your|answers|legibly)", "all (?:the )?answers (?:are|must|should)", "answers (?:are|must|should)", "if you believe", "for multi-part problems", r"number of (?:correct\s+)?answers", "time at which", r"ties (?:will\s+be\s+)?broken"],
}


@dataclass(frozen=True)
class Series:
    name: str
    rules: list = field(default_factory=lambda: DEFAULT)
    refused: list[str] = field(default_factory=list)  #: line openings that are never markers
    most: int | None = None  #: largest number that rules from `capped_from` on may give
    capped_from: int = 0
    skipped: str = ""  #: opening markup that is passed over
    instructions: list[str] = field(default_factory=list)  #: what may not follow a capped rule's marker
    follows: str = ""  #: what must follow a marker

    def marker(self, line: Column) -> Column:
        """STRUCT<number, end>, null where the line opens no problem."""
        lead = F.length(F.regexp_extract(line, self.skipped, 0)) if self.skipped else F.lit(0)
        probe = F.substring(line, lead + 1, F.length(line))
        out = F.lit(None).cast("struct<number:int,end:int>")
        for i, (pattern, number) in reversed(list(enumerate(self.rules))):
            hit = F.regexp_extract(probe, pattern, 0)
            value = number.column(lambda g, pattern=pattern: F.regexp_extract(probe, pattern, g)).cast("int")
            found = F.struct(value.alias("number"), (lead + F.length(hit)).alias("end"))
            if self.most is not None and i >= self.capped_from:
                rest = F.substring(probe, F.length(hit) + 1, F.length(probe))
                told = rest.rlike(r"(?i)^\s*(?:" + "|".join(self.instructions) + r")\b") if self.instructions else F.lit(False)
                found = F.when((value <= self.most) & ~told, found)
            if self.follows:
                found = F.when(F.substring(probe, F.length(hit) + 1, F.length(probe)).rlike(self.follows), found)
            out = F.when(hit != "", found).otherwise(out)
        for pattern in self.refused:
            out = F.when(~line.rlike(pattern), out)
        return out

    @cached_property
    def _compiled(self) -> tuple[list[re.Pattern], re.Pattern | None, list[tuple[re.Pattern, Number]], re.Pattern | None]:
        """The patterns of `match`, looked up once instead of for each line."""
        one = lambda p: re.compile(p) if p else None
        return [re.compile(p) for p in self.refused], one(self.skipped), [(re.compile(p), number) for p, number in self.rules], one(self.follows)

    @cached_property
    def known(self) -> dict[str, object]:
        """What a reader made of short lines, which recur from page to page; it keeps the number of them bounded."""
        return {}

    def match(self, line: str) -> tuple[int, int] | None:
        """(number, end) as `marker` gives them, for one line."""
        refused, skipped, rules, follows = self._compiled
        for pattern in refused:
            if pattern.search(line):
                return None
        lead = m.end() if skipped and (m := skipped.match(line)) else 0
        probe = line[lead:]
        for i, (pattern, number) in enumerate(rules):
            m = pattern.match(probe)
            if not m or not m[0]:
                continue
            value, rest = number.value(lambda g, m=m: m[g]), probe[m.end() :]
            if self.most is not None and i >= self.capped_from:
                if value > self.most or (self.instructions and re.match(r"(?i)\s*(?:" + "|".join(self.instructions) + r")\b", rest)):
                    return None
            if follows and not follows.search(rest):
                return None
            return value, lead + m.end()
        return None


# Markers of one series, shared by its statements and solutions.
FARML = [(r"(?i)^\s*T([1-9]|10)\b", plus()), (r"(?i)^\s*I([1-9]|10)\b", plus(10)), (r"(?i)^\s*R1[/.-]([123])\b", plus(20)), (r"(?i)^\s*R2[/.-]([123])\b", plus(23)), (r"(?i)^\s*R([1-6])\b", plus(20)), (r"(?i)^\s*(?:Tiebreaker\s*2|TB2)\b", fixed(28)), (r"(?i)^\s*(?:TB1?\b|Tiebreaker(?:\s*1)?\b(?!\s+EVENT\b))", fixed(27))]

# Markers of each series.
REGISTRY = {s.name: s for s in [
    Series("default"),
    Series("usamts", [(r"^\s*(\d+)\s*/\s*\d+\s*/\s*\d+\s*\.", plus())]),
    Series("hmmt", [(r"(?i)^\s*Question\s+(" + "|".join(WORDS) + r")\s*[.:]?", word), (r"(?i)^\s*(?:#+\s*)?(?:1998\s+)?Power\s+Question(?:\s+Solutions)?\b\s*[-:]?", fixed(1)), (r"(?i)^\s*Problem\s+[A-Za-z]{1,3}\s*(\d+)\b", plus()), *DEFAULT], skipped=r"(?i)^\s*(?:<(?:p|strong|b|em|span)\b[^>]*>\s*)+"),
    Series("cmimc", [(r"^\s*(\d{1,2})-([12])\s*\.", relay), *DEFAULT], most=100, capped_from=1, instructions=INSTRUCTIONS["cmimc"]),
    Series("chmm", [(r"(?i)^\s*(?:\\textbf\{\s*)?Integral\s+(\d+)\b(?:\s+Answer)?\s*\}?", plus()), (r"(?i)^\s*(?:IR|MR|TR|TBR)\s*(\d+)\s*[.)]?", plus()), (r"(?i)^\s*Problem\s+0[.](\d+)\s*[.)]?", plus()), (r"(?i)^\s*Solution\s+(\d+)\s*[.:)]?", plus()), *DEFAULT], refused=[r"(?i)^\s*(?:Lemma|Proof|Observation|Case)?\s*\d+\.\d+"], most=100, capped_from=4, instructions=INSTRUCTIONS["chmm"]),
    Series("mpfg_solutions", [(r"(?i)^\s*(?:\*{1,2}\s*)?Problem\s+(\d+)\b", plus())]),
    Series("farml", FARML),
    Series("farml_solutions", [(r"(?i)^\s*Appendix\s+to\s+T([1-9]|10)\b", plus()), *FARML]),
    Series("pumac", [(r"(?i)^\s*Bonus\b\s*:?", fixed(0)), (r"(?i)^\s*(\d{1,2})\s+(?=Across\b)", plus(1000)), (r"(?i)^\s*(\d{1,2})\s+(?=Down\b)", plus(2000)), (r"(?i)^\s*(?:\d+\s+)?[AB]\s*(\d{1,2})\b", plus()), *DEFAULT]),
    Series("nimo", follows=r"^\s*(?:[*_]+\s*)?\((?=[^)]*[A-Za-z])[^)=+\\^\d]{1,80}\)"),
    Series("nimo_solutions", most=8),
    Series("smt", [(r"(?i)^\s*(?:[*_#]{0,3}[A-Z]{1,4}\d{1,3}[*_#]{0,3}\s+)?(?:Problem|Question|Q)?\s*(\d+)\s*[.:]\s*", plus())]),
    Series("grid", [(r"(?i)^\s*(\d)\s*([A-H])\.\s*", grid)]),
    Series("bmt", [(r"(?i)^\s*(?:[*_#]{0,3}[A-Z0-9]{3,6}[*_#]{0,3}\s+)?(?:Problem|Question|Q)?\s*(\d+)\s*[.:]\s*", plus())]),
]}


def series(name: str) -> Series:
    return REGISTRY.get(name, REGISTRY["default"])


@dataclass(frozen=True)
class Layout:
    """How pages of a series are read: the rules of sequence.Numbering by name, what opens problems beside markers, and the
    filters of pictures (null: no filter; shares of the page's size)."""

    numbering: dict[str, bool] = field(default_factory=dict)
    table_rows: bool = False  #: rows of tables may open problems
    list_items: bool = False  #: list items are problems
    point_items: bool = False  #: list items that begin with a point value are problems
    titles: bool = False  #: headings of the first level are problems, numbers are not
    glued_bare: bool = False  #: bare numbers behind display formulas open lines
    inline_figures: bool = False
    temperature: float | None = None
    picture_score: float | None = None
    max_area: float | None = None
    header: float | None = None
    right_margin: float | None = None
    footer: float | None = None
    min_height: float | None = None
    equation_overlap: float | None = None
    equation_aspect: float | None = None
    glyph_coverage: float | None = None
    solution_equations: bool = False
    answer_boxes: bool = False
    answer_box_width: float | None = None
    answer_table: bool = False
    sponsor: bool = False
    point_rows: bool = False
    gap_starts: bool = False
    inline_tags: bool = False
    header_starts: bool = False


def _rules(*names: str) -> dict[str, bool]:
    return dict.fromkeys(names, True)


# Layout of each series.
LAYOUTS = {
    "usamts": Layout(header=0.20),
    "pumac": Layout(header=0.15, min_height=0.02, equation_overlap=0.80, equation_aspect=0.0, solution_equations=True, answer_boxes=True),
    "hmmt": Layout(_rules("point_values", "strict", "page_restart"), point_items=True, glued_bare=True, inline_figures=True, equation_overlap=0.3, solution_equations=True, answer_boxes=True),
    "smt": Layout(glued_bare=True, inline_figures=True, header=0.07),
    "smt_flat": Layout(_rules("strict", "consecutive"), glued_bare=True, inline_figures=True, header=0.07),
    "bmt": Layout(_rules("strict"), glued_bare=True, inline_figures=True, header=0.09),
    "chmm": Layout(_rules("strict", "flat"), glued_bare=True, inline_figures=True, max_area=0.2, header=0.1, min_height=0.025, answer_boxes=True, answer_box_width=0.40, answer_table=True),
    "cmimc": Layout(_rules("strict"), inline_figures=True, header=0.10, glyph_coverage=0.20),
    "cmimc_titled": Layout(_rules("strict"), titles=True, inline_figures=True, header=0.10, glyph_coverage=0.20),
    "farml": Layout(_rules("backward"), table_rows=True, inline_figures=True, equation_overlap=0.3, solution_equations=True),
    "mandelbrot": Layout(table_rows=True, list_items=True, temperature=0.1, picture_score=0.15, max_area=0.15, header=0.20, right_margin=0.20, footer=0.14, min_height=0.036, equation_overlap=0.3, point_rows=True),
    "mathcounts": Layout(_rules("strict", "consecutive"), table_rows=True, gap_starts=True, inline_tags=True, sponsor=True),
    "mpfg": Layout(inline_figures=True),
    "omo": Layout(inline_figures=True, answer_boxes=True),
    "purplecomet": Layout(_rules("flat"), header_starts=True),
    "nimo": Layout(_rules("consecutive", "flat"), inline_figures=True),
}


@dataclass(frozen=True)
class Discovery:
    """Where a series' tests lie: a pattern of paths below the root, how many folder names make the id (None: all), whether
    the file's stem is part of it, and which last folders or stems are taken or left out."""

    glob: str
    parts: int | None = None
    stem: bool = False
    only: tuple[str, ...] = ()
    never: tuple[str, ...] = ()


# Discovery of each series; the solution file beside a test.
DISCOVERY = {
    "usamts": [Discovery("*/*/test.pdf", 2)],
    "pumac": [Discovery("*/*/*/test.pdf", 3, only=("algebra", "combinatorics", "geometry", "individual_finals", "number_theory")), Discovery("*/team/test.pdf", 2)],
    "hmmt": [Discovery("**/test.pdf")],
    "smt": [Discovery("**/test.pdf", never=("power", "construction"))],
    "bmt": [Discovery("**/test.pdf", never=("power", "relay", "puzzle", "partner"))],
    "chmm": [Discovery("**/test.pdf", never=("power",))],
    "cmimc": [Discovery("**/test.pdf", never=("power",))],
    "mandelbrot": [Discovery("*/*test*.pdf", 1, stem=True)],
    "mathcounts": [Discovery("*/*/*.pdf", 2, stem=True, only=("sprint", "target", "team", "countdown"))],
    "mpfg": [Discovery("*/*/test.pdf", 2)],
    "omo": [Discovery("**/problems.pdf")],
    "purplecomet": [Discovery("*/*/test.pdf", 2)],
}
# Tests left out by a part of their id, and tests whose problems are proofs, by series.
IGNORED = {"chmm": ["math-talk", "tcs"], "cmimc": ["mathdash"], "mandelbrot": ["mtp"], "mathcounts": ["masters", "warmup", "workout"]}
PROOFS = {
    "usamts": r"^\d+_\d+$", "pumac": r"^\d{4}_[AB]_individual_finals$", "hmmt": r"^\d{4}_hmic$", "chmm": r"^\d{4}_(?:fall|winter|spring|annual)_proof$",
    "cmimc": r"^\d+_team_computer-science$", "mpfg": r"^\d{4}_olympiad$", "nimo": r"^\d{4}_winter_olympiad$",
}


def response_kind(name: str, test: Column) -> Column:
    """`proof` for tests without an answer key, else `answer`."""
    return F.when(test.rlike(PROOFS[name]), "proof").otherwise("answer") if name in PROOFS else F.lit("answer")
