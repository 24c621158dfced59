"""License scans: Aho-Corasick finds identifier tags and notice phrases, a
shunting-yard parser evaluates and/or/with licence expressions.

One automaton holds all phrases, each between spaces, and runs over the
text's words joined by single spaces. Texts in which it meets the words of an
identifier tag are scanned once more, by a second automaton, for the tag
itself as written; the expression after each tag is parsed.

Defined results: a null or empty text has no words, no places, null first and
last word, empty labels and score 0; repeated rows give repeated results; an
empty table gives an empty result; only the key and text columns are read.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from subledger.llm.common import byte_rows, table

#: The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further notice phrases, their labels and how sure each makes a notice.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.95),
    "mit license": ("mit", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "bsd 2 clause": ("bsd-2-clause", 0.8),
    "bsd 3 clause": ("bsd-3-clause", 0.8),
    "gnu general public license": ("gpl", 0.9),
    "gnu general public license version 2": ("gpl-2", 0.95),
    "gnu general public license version 3": ("gpl-3", 0.95),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "mozilla public license version 2": ("mpl-2", 0.95),
    "eclipse public license": ("epl", 0.9),
    "apache license": ("apache", 0.8),
    "cc by 4 0": ("cc-by", 0.8),
    "cc by 3 0": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc by nc sa": ("cc-by-nc-sa", 0.8),
    "cc by nc nd": ("cc-by-nc-nd", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons attribution sharealike": ("cc-by-sa", 0.9),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.9),
    "creative commons zero": ("cc0", 0.9),
    "dedicated to the public domain": ("public-domain", 0.8),
    "all rights reserved": ("proprietary", 0.6),
}

BASE_WEIGHT, TAG_WEIGHT, BAD_TAG_WEIGHT = 0.9, 0.95, 0.5
TAG, TAG_WORDS = "spdx-license-identifier:", "spdx license identifier"

#: How freely a text under a licence may be used, by the start of its label.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "cc0": 1.0, "0bsd": 1.0,
    "cc-by": 0.9, "cc-by-sa": 0.6, "mpl": 0.6, "lgpl": 0.6, "epl": 0.6,
    "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN_FREEDOM = 0.1

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_tags long, n_bad_tags long, freedom double")

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_RANK = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """A licence identifier's label: lower case, without or-later marks, trailing zeros and, for Creative Commons, versions."""
    label = re.sub(r"(-only|-or-later|\+)+$", "", identifier.lower())
    label = re.sub(r"-[0-9.]+$", "", label) if label.startswith("cc-") else label
    return re.sub(r"(\.0)+$", "", label)


def freedom_of(label: str) -> float:
    fits = [k for k in FREEDOM if label == k or label.startswith(f"{k}-")]
    return FREEDOM[max(fits, key=len)] if fits else UNKNOWN_FREEDOM


def postfix(text: str, at: int = 0, end: int | None = None) -> tuple[list[str], bool]:
    """Shunting-yard over the expression that begins at a place in a text: its postfix form and whether it is well formed.

    The expression ends at the line's end or before the first token that
    cannot continue it. ``with`` binds closest, then ``and``, then ``or``.
    """
    out: list[str] = []
    held: list[str] = []
    end = len(text) if end is None else end
    want_operand, good = True, True
    while found := _TOKEN.match(text, at, end):
        mark, word = found.groups()
        operator = word.lower() if word and word.lower() in _RANK else None
        if mark == "(" and want_operand:
            held.append("(")
        elif mark == ")" and not want_operand and "(" in held:
            while (top := held.pop()) != "(":
                out.append(top)
        elif operator and not want_operand:
            while held and _RANK.get(held[-1], 0) >= _RANK[operator]:
                out.append(held.pop())
            held.append(operator)
            want_operand = True
        elif word and not operator and want_operand:
            out.append(word)
            want_operand = False
        else:
            break
        at = found.end()
    if want_operand or "(" in held:
        good = False
    out += [x for x in reversed(held) if x != "("]
    return out, good


def evaluate(text: str, at: int = 0, end: int | None = None) -> tuple[list[str], float | None]:
    """Labels of the expression at a place in a text and its freedom: ``or`` lets the reader choose the
    freest side, ``and`` binds to the strictest, an exception after ``with``
    goes halfway to no condition. None if it is not well formed."""
    steps, good = postfix(text, at, end)
    exceptions = {i - 1 for i, x in enumerate(steps) if x.lower() == "with"}
    labels = [label_of(x) for i, x in enumerate(steps) if x.lower() not in _RANK and i not in exceptions]
    if not good:
        return labels, None
    stack: list[float] = []
    for step in steps:
        kind = step.lower()
        if kind not in _RANK:
            stack.append(freedom_of(label_of(step)))
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(max(left, right) if kind == "or" else min(left, right) if kind == "and" else (left + 1) / 2)
    return labels, stack[0]


@functools.cache
def _automata():
    import ahocorasick

    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    phrases = {p: (label, BASE_WEIGHT, True) for p, label in BASE_PHRASES.items()}
    phrases |= {p: (label, weight, False) for p, (label, weight) in NOTICE_PHRASES.items()}
    phrases[TAG_WORDS] = (None, 0.0, False)
    for phrase, (label, weight, base) in phrases.items():
        words.add_word(f" {phrase} ", (len(phrase) + 2, label, weight, base))
    tags.add_word(TAG, len(TAG))
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def _inside(hits: list[tuple]) -> set[tuple[int, int]]:
    """Spans that lie in a longer labelled span: one sweep by start, the longest of a start first."""
    found, reach = set(), -1
    for start, end, label, _, _ in sorted(hits, key=lambda x: (x[0], -x[1])):
        if end <= reach:
            found.add((start, end))
        if label:
            reach = max(reach, end)
    return found


def scan(raw: bytes | None) -> tuple:
    """The result row (without key) of one text."""
    words, tags = _automata()
    tokens = (raw or b"").translate(_WORD_BYTES).split()
    line = f" {b' '.join(tokens).decode('latin-1')} "
    hits = [(end + 1 - size, end + 1, label, weight, base) for end, (size, label, weight, base) in words.iter(line)]
    starts, seen, words_before = [], 0, 0
    for start in sorted(start for start, _, _, _, base in hits if base):
        words_before += line.count(" ", seen, start)
        starts.append(words_before)
        seen = start
    covered = _inside(hits)
    base_labels = {label for _, _, label, _, base in hits if base}
    sure: dict[str, float] = {label: BASE_WEIGHT for label in base_labels}
    for start, end, label, weight, base in hits:
        if label and not base and (start, end) not in covered:
            sure[label] = max(sure.get(label, 0.0), weight)
    n_tags = n_bad = line_end = 0
    freedoms = []
    if any(label is None for _, _, label, _, _ in hits):
        text = raw.decode("utf-8", "replace")
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for end, _ in tags.iter(lowered):
            line_end = text.find("\n", end + 1) if end + 1 > line_end else line_end
            line_end = len(text) if line_end < 0 else line_end
            labels, freedom = evaluate(text, end + 1, line_end)
            n_tags += 1
            n_bad += freedom is None
            freedoms += [freedom] * (freedom is not None)
            for label in labels:
                sure[label] = max(sure.get(label, 0.0), BAD_TAG_WEIGHT if freedom is None else TAG_WEIGHT)
    if not freedoms and sure:
        freedoms = [freedom_of(label) for label in sure]
    miss = 1.0
    for label in sorted(sure):
        miss *= 1 - sure[label]
    return (len(tokens), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(sure)), 1 - miss, n_tags, n_bad, min(freedoms, default=None))


def scan_licenses(df: DataFrame) -> DataFrame:
    """One row per row of ``df`` (doc_id, text): base places and labels, all labels,
    score (how sure a licence notice is), tags, and the freedom of all notices together."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.float64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            for at, texts in byte_rows(batch):
                found = list(zip(*map(scan, texts), strict=True))
                yield pa.record_batch([batch.column("doc_id").slice(at, len(texts)), *map(pa.array, found, types)], names)

    return df.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
