"""License scan: ordered signature rules over normalised words, gated by keywords, overlaps resolved by priority.

A text is read as its words in lower case with single spaces between. `rules()` combines a table of license names with a
table of forms into some hundreds of signatures, each with a priority, a confidence and the keywords without which it
cannot match. One pass of a keyword automaton over a text chooses the rules to try; most texts have no keyword and end
there. Of two detections, one that lies inside another of higher priority is suppressed, and so is the later of two that
cover the same words.

Texts are scanned whole where they lie; nothing is shuffled or broadcast but the rule table, whose size is fixed.

Cases: null and empty texts have no words and no detections. Repeated rows get equal answers; an empty table gives no
rows. Other columns pass through `scanned`. Detections that tie in priority and length go by place, then rule name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import named
from tripspark.llm.text_blocks import SMALL_TABLE, blocks, lists, word_counts

# The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
BASE_KEYWORDS = {"under the mit license": ("mit", "licen"), "apache license version 2": ("apache", "licen"), "cc by nc": ("cc", "by")}

LICENSE = "licen[cs]e"

# Label, pattern of the name, keywords, versions (as words).
NAMES = (
    ("mit", "(?:mit|expat)", ("licen", "mit|expat"), ()),
    ("x11", "x11", ("x11",), ()),
    ("apache", "apache(?: software)?", ("apache",), ("1 0", "1 1", "2 0")),
    ("gpl", "(?:gnu )?(?:general public|gpl)", ("general public|gpl",), ("1 0", "2 0", "3 0")),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", ("lesser|library|lgpl",), ("2 0", "2 1", "3 0")),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", ("affero|agpl",), ("1 0", "3 0")),
    ("gfdl", "(?:gnu )?(?:free documentation|gfdl)", ("documentation|gfdl",), ("1 1", "1 2", "1 3")),
    ("mpl", "(?:mozilla public|mpl)", ("mozilla|mpl",), ("1 0", "1 1", "2 0")),
    ("epl", "(?:eclipse public|epl)", ("eclipse|epl",), ("1 0", "2 0")),
    ("cddl", "(?:common development and distribution|cddl)", ("distribution|cddl",), ("1 0", "1 1")),
    ("cpl", "common public", ("common public",), ("1 0",)),
    ("eupl", "(?:european union public|eupl)", ("european union|eupl",), ("1 0", "1 1", "1 2")),
    ("osl", "open software", ("open software",), ("1 0", "2 0", "3 0")),
    ("afl", "academic free", ("academic",), ("2 0", "2 1", "3 0")),
    ("bsd-0-clause", "(?:0 clause bsd|bsd zero clause)", ("bsd",), ()),
    ("bsd-2-clause", "(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)", ("bsd",), ()),
    ("bsd-3-clause", "(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd)", ("bsd",), ()),
    ("bsd-4-clause", "(?:4 clause bsd|bsd 4 clause|original bsd)", ("bsd",), ()),
    ("cc-by", "(?:cc by|creative commons attribution)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)", ("cc|creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", "(?:cc0|cc zero|creative commons zero)", ("cc|creative",), ("1 0",)),
    ("isc", "isc", ("isc", "licen"), ()),
    ("zlib", "zlib", ("zlib",), ()),
    ("bsl", "boost software", ("boost",), ("1 0",)),
    ("unlicense", "unlicense", ("unlicense",), ()),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", ("wtfpl|do what the",), ("2 0",)),
    ("artistic", "artistic", ("artistic", "licen"), ("1 0", "2 0")),
    ("python", "python(?: software foundation)?", ("python", "licen"), ("2 0",)),
    ("php", "php", ("php", "licen"), ("3 0", "3 01")),
    ("ofl", "(?:sil open font|open font|ofl)", ("open font|ofl",), ("1 0", "1 1")),
    ("ms-pl", "(?:microsoft public|ms pl)", ("microsoft|ms pl",), ()),
    ("ms-rl", "(?:microsoft reciprocal|ms rl)", ("microsoft|ms rl",), ()),
    ("odbl", "(?:open database|odbl)", ("open database|odbl",), ("1 0",)),
    ("odc-by", "(?:open data commons attribution|odc by)", ("open data|odc",), ("1 0",)),
    ("pddl", "(?:public domain dedication and|pddl)", ("dedication|pddl",), ("1 0",)),
    ("openssl", "openssl", ("openssl", "licen"), ()),
    ("zpl", "(?:zope public|zpl)", ("zope|zpl",), ("2 0", "2 1")),
    ("ruby", "ruby", ("ruby", "licen"), ()),
    ("postgresql", "postgresql", ("postgresql", "licen"), ()),
    ("ncsa", "(?:university of illinois|ncsa)", ("illinois|ncsa",), ()),
    ("lppl", "(?:latex project public|lppl)", ("latex|lppl",), ("1 0", "1 3")),
    ("public-domain", "public domain", ("public domain",), ()),
    ("all-rights-reserved", "all rights reserved", ("rights reserved",), ()),
)
ALONE = {"unlicense", "cc0", "public-domain", "all-rights-reserved", "cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd"}

# Form: priority (lower goes first), confidence, pattern around the name.
GRANT = "(?:licensed|released|distributed|available|provided|published|covered|governed|used) (?:under|by|on|with) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
FORMS = (
    ("tag", 1, 1.0, "spdx license identifier {name}{version}"),
    ("grant", 2, 0.95, GRANT + "{name}{license}{version}"),
    ("version", 3, 0.85, "{name}{license}{version}"),
    ("name", 4, 0.7, "{name} " + LICENSE),
    ("alone", 5, 0.6, "{name}"),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern[str]
    keywords: tuple[tuple[str, ...], ...]  # one of each must be there


@cache
def rules() -> tuple[Rule, ...]:
    """All signatures, in order of priority."""
    made = []
    for label, name, keywords, versions in NAMES:
        needs = tuple(tuple(k.split("|")) for k in keywords)
        for version in ("", *versions):
            major, _, minor = version.partition(" ")
            number = f" (?:version |v ?)?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}") if version else ""
            short = major if minor == "0" else f"{major}.{minor}"
            for form, priority, confidence, around in FORMS:
                if form == "version" and not version or form == "name" and version:
                    continue
                if form == "alone" and (version or label not in ALONE):
                    continue
                text = around.format(name=name, version=number, license=f"(?: (?:public )?{LICENSE})?")
                made.append(
                    Rule(
                        f"{label}-{short}/{form}" if version else f"{label}/{form}",
                        f"{label}-{short}" if version else label,
                        # The same form with a version says more than without.
                        2 * priority - (1 if version else 0),
                        confidence,
                        re.compile(rf"(?<![^ ]){text}(?![^ ])"),
                        needs,
                    )
                )
    return tuple(sorted(made, key=lambda r: (r.priority, r.name)))


@cache
def _automaton() -> ahocorasick.Automaton:
    keywords = {k for r in rules() for choice in r.keywords for k in choice}
    keywords |= {k for own in BASE_KEYWORDS.values() for k in own}
    found = ahocorasick.Automaton()
    for k in keywords:
        for part in k.split(" "):  # words may be parted by anything in the text itself
            found.add_word(part, part)
    found.make_automaton()
    return found


_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


@dataclass(frozen=True)
class Detection:
    label: str
    rule: str
    first: int  # words
    last: int
    confidence: float


def detections(text: str) -> tuple[list[tuple[str, int]], list[Detection]]:
    """Base phrases as (label, first word), all places; and the detections that survive suppression."""
    small = text.encode().translate(SMALL_TABLE).decode()
    seen = {part for _, part in _automaton().iter(small)}
    has = lambda k: all(part in seen for part in k.split(" "))
    tried = [r for r in rules() if all(any(has(k) for k in choice) for choice in r.keywords)]
    phrases = [p for p, own in BASE_KEYWORDS.items() if all(has(k) for k in own)]
    if not tried and not phrases:
        return [], []
    words = _WORD.findall(small)
    joined = " ".join(words)
    place, starts = 0, {}
    for i, w in enumerate(words):
        starts[place] = i
        place += len(w) + 1
    base = []
    for phrase in phrases:
        own = re.compile(rf"(?<![^ ])(?={re.escape(phrase)}(?![^ ]))")
        base += [(BASE_PHRASES[phrase], starts[m.start()]) for m in own.finditer(joined)]
    found = []
    for rule in tried:
        for m in rule.pattern.finditer(joined):
            first = starts[m.start()]
            found.append((rule.priority, first - (first + m.group().count(" ") + 1), first, rule))
    found.sort(key=lambda d: (d[0], d[1], d[2], d[3].name))
    kept: list[Detection] = []
    for _, minus, first, rule in found:
        last = first - minus
        if not any(k.first <= first and last <= k.last for k in kept):
            kept.append(Detection(rule.label, rule.name, first, last, rule.confidence))
    return sorted(base, key=lambda b: (b[1], b[0])), sorted(kept, key=lambda d: (d.first, d.last, d.rule))


_SCAN = (
    "n_words long, base array<struct<label:string,first:int>>, "
    "found array<struct<label:string,rule:string,first:int,last:int,confidence:double>>"
)


def _scan(texts: pa.Array) -> pa.Array:
    n_words, base, found, n_base, n_found = [], [], [], [], []
    for block in blocks(texts):
        n_words += word_counts(block).tolist()
        for i in range(len(block)):
            text = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().decode()
            own_base, own = detections(text)
            base += own_base
            found += own
            n_base.append(len(own_base))
            n_found.append(len(own))
    bases = pa.StructArray.from_arrays(
        [pa.array([b[0] for b in base], pa.string()), pa.array([b[1] for b in base], pa.int32())], names=["label", "first"]
    )
    kinds = {"label": pa.string(), "rule": pa.string(), "first": pa.int32(), "last": pa.int32(), "confidence": pa.float64()}
    founds = pa.StructArray.from_arrays(
        [pa.array([getattr(d, k) for d in found], t) for k, t in kinds.items()], names=list(kinds)
    )
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), lists(bases, n_base), lists(founds, n_found)], names=["n_words", "base", "found"]
    )


def scan(text: Column) -> Column:
    return F.arrow_udf(_scan, _SCAN)(text)


def scanned(df: DataFrame, text: str = "text", into: str = "licenses") -> DataFrame:
    """All columns and the struct `into`: n_words, base phrases, detections (label, rule, words, confidence)."""
    return df.withColumn(into, scan(named(text)))
