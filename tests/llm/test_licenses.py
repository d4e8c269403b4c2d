import re

import pytest

from quarterstone.llm import licenses, queries
from tests.llm.helpers import FOLDER, clashing, documents, tables

FOLD = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def places(text, phrases):
    given, out = words(text), []
    for label, held in phrases.items():
        for phrase in held:
            want = phrase.split()
            out += [(i, label) for i in range(len(given)) if given[i:i + len(want)] == want]
    return sorted(out)


def notices():
    out = {}
    for label, _, _, phrases in licenses.LICENSES:
        out.setdefault(label, []).extend(phrases)
    return out


def check(text, row):
    base = places(text, licenses.BASE)
    assert row.n_words == len(words(text)) and row.n_base == len(base)
    assert (row.first_word, row.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
    assert row.base_labels == ",".join(sorted({label for _, label in base}))
    assert 0 <= row.score <= 1 and (row.score > 0) == (row.labels != "")
    assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))


def test_whole_table_against_plain_search(spark):
    texts = {r["doc_id"]: r["text"] for r in tables("documents").to_pylist()}
    got = queries.op11_license_scan(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for row in got:
        check(texts[row.doc_id], row)
        found = {label for _, label in places(texts[row.doc_id], licenses.BASE) + places(texts[row.doc_id], notices())}
        assert set(row.labels.split(",")) - {""} == found  # the table has no tags


TEXTS = [
    None, "", " \n\t", "MIT", "under the MIT license", "under the\nMIT -- License.", "under the mit licenses",
    "wunder the mit license", "ünder the mit license", "under the mit licenseé", "Apache License, Version 2.0, January 2004",
    "Apache License, Version 20", "CC BY-NC 4.0 and cc/by/nc, CC BY-NC-SA", "under the mit license" * 3, "under the mit license " * 3,
    "cc by nc" + " x" * 70_000 + " cc by nc", "mit license\0under\0the\0mit\0license", "under the mit", "license",
    "\U0001F600 under the mit license \U0001F600", "GNU General Public License, Version 3", "K" + "under the mit license"]


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_odd_texts_in_slices_of_any_size(spark, size):
    docs = documents(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (4, TEXTS[4]), (4, TEXTS[4])])
    got = licenses.summary(licenses.scan(clashing(docs, "hits", "n_words", "label"), size=size)).collect()
    assert len(got) == len(TEXTS) + 3 and sum(r.doc_id == 4 for r in got) == 3
    for row in got:
        check(TEXTS[4 if row.doc_id is None else row.doc_id], row)
    assert licenses.summary(licenses.scan(documents(spark, []))).count() == 0


def test_tags(spark):
    texts = {
        1: "# SPDX-License-Identifier: MIT OR (GPL-2.0+ WITH Classpath-exception-2.0)\nimport os",
        2: "/* SPDX-License-Identifier: Apache-2.0 AND CC-BY-NC-4.0 */",
        3: "SPDX license identifier without a colon MIT",
        4: "SPDX-License-Identifier:\nMIT",
        5: "SPDX-License-Identifier: LicenseRef-House",
        6: "'License-Expression': 'BSD-3-Clause or later'\nSPDX-License-Identifier: ((MIT",
        7: "SPDX-License-Identifier: MIT"}
    got = {r.doc_id: r for r in licenses.summary(licenses.scan(documents(spark, list(texts.items())))).collect()}
    assert {i: (r.labels, r.level) for i, r in got.items()} == {
        1: ("gpl-2,mit", "permissive"), 2: ("apache-2,cc-by-nc", "restricted"), 3: ("", None), 4: ("", None),
        5: ("licenseref-house", "unknown"), 6: ("bsd-3", "permissive"), 7: ("mit", "permissive")}
    assert {i for i, r in got.items() if r.n_base} == {2}  # its identifier is also a phrase


def value(text):
    """Recursive descent: or over and over with, as the least demanding level."""
    tokens = re.findall(r"[()]|[^\s()]+", text)

    def choice():
        level = both()
        while tokens and tokens[0].lower() == "or":
            tokens.pop(0)
            level = min(level, both())
        return level

    def both():
        level = one()
        while tokens and tokens[0].lower() == "and":
            tokens.pop(0)
            level = max(level, one())
        return level

    def one():
        token = tokens.pop(0)
        if token == "(":
            level = choice()
            assert tokens.pop(0) == ")"
            return level
        level = licenses.LEVEL.get(licenses.label_of(token), 5)
        if tokens and tokens[0].lower() == "with":
            del tokens[:2]
            level = 2 if level == 3 else level
        return level
    return choice()


@pytest.mark.parametrize("text", [
    "MIT", "MIT OR GPL-3.0", "MIT AND GPL-3.0", "MIT OR GPL-3.0 AND CC-BY-NC-4.0", "(MIT OR GPL-3.0) AND CC-BY-NC-4.0",
    "GPL-2.0-only WITH Classpath-exception-2.0 AND MPL-2.0", "GPL-2.0+ OR LGPL-2.1-or-later AND (X-1 OR MIT)",
    "((MIT))", "(GPL-3.0 WITH GCC-exception-3.1 OR Y-2) AND Unlicense", " AND ".join(["MIT"] * 20_000)])
def test_expressions_against_recursive_descent(text):
    tokens = licenses.read_tokens(text)
    assert len(tokens) == len(re.findall(r"[()]|[^\s()]+", text))
    assert licenses.evaluate(licenses.postfix(tokens))[1] == value(text)


def test_postfix_order_and_longest_complete_expression():
    assert licenses.postfix(licenses.read_tokens("A-1 OR B-1 AND (C-1 OR D-1)")) == ["A-1", "B-1", "C-1", "D-1", "or", "and", "or"]
    for text, n in [("(MIT", 0), ("MIT OR", 1), ("AND MIT", 0), ("MIT License applies", 1), ("MIT) OR ISC", 1), ("", 0),
                    ("MIT OR (ISC AND", 1), ("GPL-2.0 WITH a-1 WITH b-1", 3), ("(MIT) WITH x-1", 3), ("see below", 0), ("mit or later", 1)]:
        assert len(licenses.read_tokens(text)) == n, text
