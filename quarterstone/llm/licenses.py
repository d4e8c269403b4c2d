"""Licence scans: an Aho-Corasick search for identifier tags and notice phrases, and a shunting-yard
parser for the licence expressions behind tags.

The search runs over the words of whole texts: ASCII letters in lower case, every other ASCII
character but digits a gap. Positions are word numbers. A tag is followed by an expression in the
text as written (``MIT OR (GPL-2.0+ WITH Classpath-exception-2.0)``); it is turned into postfix
order and evaluated twice: to the set of licences it names, and to the least demanding level
with which all of it can be met (``OR`` lets the reader choose, ``AND`` binds to both sides,
``WITH`` loosens copyleft).
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import text_or_empty, tidied

# Levels, from no condition at all to conditions unknown.
LEVELS = ["public", "permissive", "weak copyleft", "strong copyleft", "restricted", "unknown"]

# Phrases of the base scan, by label, as words in lower case.
BASE = {
    "mit": ["under the mit license"],
    "apache-2": ["apache license version 2"],
    "cc-by-nc": ["cc by nc"],
}

# Label, level, identifiers in lower case, further notice phrases.
LICENSES = [
    ("0bsd", 0, ["0bsd"], ["zero clause bsd license"]),
    ("agpl-3", 4, ["agpl-3.0", "agpl-1.0"], ["gnu affero general public license"]),
    ("apache-1.1", 1, ["apache-1.0", "apache-1.1"], ["apache software license version 1 1"]),
    ("apache-2", 1, ["apache-2.0"], ["licensed under the apache license", "www apache org licenses license 2 0"]),
    ("artistic", 2, ["artistic-1.0", "artistic-2.0"], ["the artistic license"]),
    ("boost", 1, ["bsl-1.0"], ["boost software license"]),
    ("bsd-2", 1, ["bsd-2-clause"], ["bsd 2 clause license", "simplified bsd license"]),
    ("bsd-3", 1, ["bsd-3-clause"], ["bsd 3 clause license", "new bsd license"]),
    ("bsd", 1, ["bsd-4-clause"], ["redistribution and use in source and binary forms with or without modification"]),
    ("cc-by", 1, ["cc-by-2.0", "cc-by-3.0", "cc-by-4.0"], ["creative commons attribution 4 0", "cc by 4 0", "cc by 3 0"]),
    ("cc-by-nc", 4, ["cc-by-nc-2.0", "cc-by-nc-3.0", "cc-by-nc-4.0"], ["creative commons attribution noncommercial"]),
    ("cc-by-nc-nd", 4, ["cc-by-nc-nd-3.0", "cc-by-nc-nd-4.0"], ["cc by nc nd"]),
    ("cc-by-nc-sa", 4, ["cc-by-nc-sa-3.0", "cc-by-nc-sa-4.0"], ["cc by nc sa"]),
    ("cc-by-nd", 4, ["cc-by-nd-3.0", "cc-by-nd-4.0"], ["cc by nd"]),
    ("cc-by-sa", 3, ["cc-by-sa-3.0", "cc-by-sa-4.0"], ["creative commons attribution sharealike", "cc by sa"]),
    ("cc0", 0, ["cc0-1.0"], ["cc0 1 0 universal", "creative commons zero"]),
    ("cddl", 2, ["cddl-1.0", "cddl-1.1"], ["common development and distribution license"]),
    ("epl", 2, ["epl-1.0", "epl-2.0"], ["eclipse public license"]),
    ("gpl-2", 3, ["gpl-2.0"], ["gnu general public license version 2", "gnu general public license v2",
                               "general public license as published by the free software foundation either version 2"]),
    ("gpl-3", 3, ["gpl-3.0"], ["gnu general public license version 3", "gnu general public license v3",
                               "general public license as published by the free software foundation either version 3"]),
    ("isc", 1, ["isc"], ["permission to use copy modify and or distribute this software for any purpose"]),
    ("lgpl-2", 2, ["lgpl-2.0", "lgpl-2.1"], ["gnu lesser general public license version 2", "gnu library general public license"]),
    ("lgpl-3", 2, ["lgpl-3.0"], ["gnu lesser general public license version 3"]),
    ("mit", 1, ["mit", "x11", "expat"], ["permission is hereby granted free of charge to any person obtaining a copy"]),
    ("mit-0", 0, ["mit-0"], ["mit no attribution license"]),
    ("mpl-2", 2, ["mpl-1.1", "mpl-2.0"], ["mozilla public license"]),
    ("postgresql", 1, ["postgresql"], []),
    ("python-2", 1, ["psf-2.0", "python-2.0"], ["python software foundation license"]),
    ("unlicense", 0, ["unlicense"], ["this is free and unencumbered software released into the public domain"]),
    ("wtfpl", 0, ["wtfpl"], []),
    ("zlib", 1, ["zlib"], ["this software is provided as is without any express or implied warranty in no event will the authors"]),
]
# Words of the tags that a colon and an expression follow.
TAGS = ["spdx license identifier", "license expression"]
# How sure a hit of each kind makes that the text carries a licence.
WEIGHTS = {"tag": 0.95, "base": 0.9, "notice": 0.8}

IDENTIFIERS = {name: label for label, _, names, _ in LICENSES for name in names}
LEVEL = {label: level for label, level, _, _ in LICENSES}
BINDS = {"or": 1, "and": 2, "with": 3}

TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.\-]*\+?)")
OPENING = re.compile(r"[ \t\"'=]*:[ \t\"'=:]*")
HIT = pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()),
                 ("expression", pa.string()), ("level", pa.int32())])
SCANNED = ("doc_id long, n_words long, hits array<struct<kind: string, label: string, start: bigint, words: bigint, "
           "expression: string, level: int>>")


# ---- expressions ---------------------------------------------------------------------

def label_of(identifier: str) -> str:
    """The label of a licence identifier, later versions included; of an unknown one, itself."""
    name = identifier.lower().rstrip("+").removesuffix("-or-later").removesuffix("-only")
    return IDENTIFIERS.get(name, name)


def read_tokens(text: str, start: int = 0) -> list[str]:
    """Tokens of the longest complete expression that begins at ``start``; none if there is none.

    Operators count in upper or lower case. An unknown word is an identifier only if it looks like one
    (a digit, a hyphen or a capital), so that prose behind an expression ends it.
    """
    tokens, depth, complete, want, after = [], 0, 0, True, ""
    while found := TOKEN.match(text, start):
        token, start = found[1], found.end()
        word = token.lower()
        if token == "(":
            if not want or after == "with":
                break
            depth, after = depth + 1, ""
        elif token == ")":
            if want or not depth:
                break
            depth -= 1
        elif word in BINDS:
            if want or (word == "with" and (after == "with" or tokens[-1] == ")")):
                break
            token, want, after = word, True, word
        else:
            plain = word == token and word.isalpha() and label_of(word) not in LEVEL
            if not want or plain:
                break
            # an exception belongs to its licence: no second one may follow
            want, after = False, "with" if after == "with" else ""
        tokens.append(token)
        if not want and not depth:
            complete = len(tokens)
    return tokens[:complete]


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, each operator behind its two operands."""
    out, waiting = [], []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def evaluate(order: list[str]) -> tuple[set[str], int]:
    """Labels of the licences of a postfix expression, and the least level that meets it."""
    stack: list[tuple[str, int]] = []
    labels, exceptions = set(), {i - 1 for i, token in enumerate(order) if token == "with"}
    for i, token in enumerate(order):
        if token in BINDS:
            (_, right), (name, left) = stack.pop(), stack.pop()
            if token == "with":
                level = 2 if left == 3 else left
            else:
                level = min(left, right) if token == "or" else max(left, right)
            stack.append((name, level))
        elif i in exceptions:
            stack.append((token, 0))
        else:
            label = label_of(token)
            labels.add(label)
            stack.append((label, LEVEL.get(label, len(LEVELS) - 1)))
    return labels, stack[0][1]


# ---- search --------------------------------------------------------------------------

def automaton(base: dict[str, list[str]]) -> ahocorasick.Automaton:
    """Aho-Corasick automaton of all phrases, each with its hits' (kind, label)."""
    found: dict[str, list[tuple[str, str]]] = {}
    for label, phrases in base.items():
        for phrase in phrases:
            found.setdefault(phrase, []).append(("base", label))
    for label, _, _, phrases in LICENSES:
        for phrase in phrases:
            found.setdefault(phrase, []).append(("notice", label))
    for phrase in TAGS:
        found.setdefault(phrase, []).append(("tag", ""))
    machine = ahocorasick.Automaton()
    for phrase, hits in found.items():
        machine.add_word(phrase, (len(phrase), phrase.count(" ") + 1, hits))
    machine.make_automaton()
    return machine


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32
BREAK = 10  # before each text, and after the last


def scan_texts(data: np.ndarray, ends: np.ndarray, machine) -> tuple[np.ndarray, dict[int, list[dict]]]:
    """Number of words of each text, and the hits of the texts that have any, by place.

    ``data`` holds the texts' bytes in a row, ``ends`` the end of each. Folded bytes with one gap
    between two words go through the automaton in one pass; a hit counts if whole words match.
    """
    begins = np.concatenate([[0], ends])
    folded = np.insert(_FOLD[data], begins, BREAK)
    breaks = begins + np.arange(len(begins))
    gap = folded <= 32
    start = ~gap[1:] & gap[:-1]
    starts = np.flatnonzero(start) + 1
    first = np.searchsorted(starts, breaks)
    double = np.append(False, (folded[1:] == 32) & gap[:-1])
    keep = np.flatnonzero(~double) if double.any() else None
    text = (folded if keep is None else folded[keep]).tobytes().decode("latin-1")
    hits: dict[int, list[dict]] = {}
    for last, (length, n, kinds) in machine.iter(text):
        begin = last - length + 1
        if text[begin - 1] > " " or text[last + 1] > " ":
            continue
        at, end = (begin, last) if keep is None else (int(keep[begin]), int(keep[last]))
        place = int(np.searchsorted(breaks, at)) - 1
        word = int(np.searchsorted(starts, at)) - int(first[place])
        for kind, label in kinds:
            if kind != "tag":
                hits.setdefault(place, []).append(
                    {"kind": kind, "label": label, "start": word, "words": n, "expression": None,
                     "level": LEVEL.get(label, len(LEVELS) - 1)})
                continue
            line = _line_after(data, end - place, int(ends[place]))
            opening = OPENING.match(line)
            tokens = read_tokens(line, opening.end()) if opening else []
            if tokens:
                labels, level = evaluate(postfix(tokens))
                for name in sorted(labels):
                    hits.setdefault(place, []).append(
                        {"kind": kind, "label": name, "start": word, "words": n, "expression": " ".join(tokens), "level": level})
    return np.diff(first), hits


def _line_after(data: np.ndarray, begin: int, end: int) -> str:
    """The rest of the line, as written, from a byte of a text that ends at ``end``."""
    width, stop = 256, begin
    while stop < end:
        found = np.flatnonzero(data[stop:min(end, stop + width)] == 10)
        if len(found):
            stop += int(found[0])
            break
        stop, width = min(end, stop + width), 2 * width
    return data[begin:stop].tobytes().decode("latin-1")


def _scan_batches(base: dict[str, list[str]], size: int):
    def run(batches):
        machine = automaton(base)
        for batch in batches:
            texts = batch.column("text")
            texts = pc.fill_null(texts.cast(pa.large_string()), "")
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            if not len(texts):
                continue
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
                words, hits = scan_texts(data[offsets[at]:offsets[to]], offsets[at + 1:to + 1] - offsets[at], machine)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), pa.array(words, pa.int64()),
                     pa.array([hits.get(i, []) for i in range(to - at)], pa.list_(HIT))], ["doc_id", "n_words", "hits"])
                at = to
    return run


def scan(docs: DataFrame, base: dict[str, list[str]] | None = None, size: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, hits; a hit is (kind, label, start, words, expression, level).

    ``start`` is a word's number from 0. Kind is base (phrases of ``base``), notice (further phrases) or tag; a tag has a
    hit for each licence that its expression names, with the expression and the level it evaluates to; a tag without
    a complete expression gives none. Hits come in the order of their last word; overlapping ones all count.
    A null text is empty and has no hits. Repeated rows, rows without doc_id and empty tables come back as given; other
    columns are not read. Whole texts are searched, about ``size`` bytes at a time and one text at least, so
    memory is some 15 bytes for each byte of the longest text.
    """
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(tidied(_scan_batches(BASE if base is None else base, size)), SCANNED))


def labels(kinds: list[str] | None = None) -> Column:
    """Distinct labels of a row's ``hits``, of some kinds or all, sorted and joined by commas."""
    hits = F.col("hits")
    if kinds is not None:
        hits = F.filter(hits, lambda h: h["kind"].isin(kinds))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")


def certainty() -> Column:
    """0 to 1: how sure the kinds of a row's ``hits`` make that the text carries a licence."""
    kinds, doubt = F.transform("hits", lambda h: h["kind"]), F.lit(1.0)
    for kind, weight in WEIGHTS.items():
        doubt = doubt * F.when(F.array_contains(kinds, kind), 1 - weight).otherwise(1.0)
    return 1 - doubt


def summary(scanned: DataFrame) -> DataFrame:
    """A row for each row of ``scan``: counts and places of base hits, labels, certainty, and the name of
    the most demanding level of all hits (null without hits)."""
    base = F.filter("hits", lambda h: h["kind"] == "base")
    starts = F.transform(base, lambda h: h["start"])
    level = F.array_max(F.transform("hits", lambda h: h["level"]))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(["base"]).alias("base_labels"), labels().alias("labels"),
        certainty().alias("score"), F.get(F.array(*[F.lit(x) for x in LEVELS]), level).alias("level"))
