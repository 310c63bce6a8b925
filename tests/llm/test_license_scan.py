"""The license scan against a plain walk over words."""

import re

import duckdb
import pytest

from lakeloader.llm import license_scan as L
from lakeloader.llm.license_rules import signatures
from llm_cases import awkward, rows_of

TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)", "This is GPL-3.0-or-later and LGPLv2.1.", "MIT License MIT license",
    "cc by", "CC BY-NC 4.0; CC-BY-SA-4.0!", "gnu\ngeneral\tpublic-license v2", "SPDX-License-Identifier: Apache-2.0", "Gnu Public",
    "the mit  (license)", "GNU Affero General Public License version 3", "nothing to see", "BSD 3-Clause License and new BSD license",
    "mıt lıcense", "MIT Lİcense", "mit license", "cc by " * 500, "gpl " * 40 + "license",
    "GNU GPL version 2 or any later version of the Apache Software License 1.1", "Creative Commons Attribution-ShareAlike 4.0",
]


RULES = [(re.compile(rule.regex), rule) for rule in signatures()]


def expected(doc_id, text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    base, found = [], []
    for at in range(len(words)):
        seen = " ".join(words[at:]) + " "
        base += [(at, label) for phrase, label in L.BASE.items() if seen.startswith(phrase + " ")]
        matches = [(m[0].count(" "), -r.priority, r.relevance, r.label) for p, r in RULES if r.keyword == words[at] and (m := p.match(seen))]
        if matches:
            size, strength, relevance, label = max(matches)
            found.append((at, at + size, label, -strength, relevance))
    whole, reach = [], -1
    for x in found:
        if x[1] > reach:
            whole.append(x)
            reach = x[1]
    kept = []
    for i, x in enumerate(whole):
        before, after = whole[i - 1] if i else None, whole[i + 1] if i + 1 < len(whole) else None
        beaten = before and before[1] > x[0] and before[3] <= x[3] or after and after[0] < x[1] and after[3] < x[3]
        if not beaten:
            kept.append(x)
    own = {label for _, label in base}
    score = max([x[4] for x in kept] + [0.5 if base else 0.0])
    return (
        doc_id, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
        ",".join(sorted(own)), ",".join(sorted(own | {x[2] for x in kept})), score,
    )


def test_known_texts(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = rows_of(L.summary(L.scan(frame)))
    assert found == sorted((expected(i, text) for i, text in enumerate(TEXTS)), key=repr)
    labels = {row[0]: row[6] for row in found}
    assert labels[0] == "apache,apache-2.0" and labels[1] == "gpl-3.0,lgpl-2.1" and labels[4] == "cc-by,cc-by-nc-4.0,cc-by-sa-4.0"
    assert labels[6] == "apache-2.0" and labels[9] == "agpl-3.0"


def test_sql_says_the_same(spark, tmp_path):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "d"))
    found = duckdb.connect().sql(L.oracle(f"read_parquet('{tmp_path}/d/*.parquet')")).fetchall()
    assert sorted(found, key=repr) == rows_of(L.summary(L.scan(frame)))


def test_awkward_rows(documents):
    assert rows_of(L.summary(L.scan(documents))) == sorted((expected(x[0], x[1]) for x in awkward()), key=repr)


def test_empty_table(no_documents):
    assert L.summary(L.scan(no_documents)).count() == 0


def test_no_python_and_no_shuffle_in_the_plan(documents):
    plan = L.summary(L.scan(documents))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Aggregate|Join|Window", plan)


def test_signatures_are_sound():
    rules = signatures()
    assert len(rules) > 300
    for rule in rules:
        assert re.fullmatch("[0-9a-z]+", rule.keyword) and rule.gates
        assert rule.regex.startswith(f"^(?:{rule.keyword}")
        re.compile(rule.regex)


@pytest.mark.parametrize("text", ["gpl 3 0 ", "apache license ", "cc by nc nd 4 0 ", "spdx license identifier mit "])
def test_the_gate_lets_matching_texts_through(text):
    words = set(text.split())
    for rule in signatures():
        if re.match(rule.regex, text):
            assert words & set(rule.gates), rule


def spelled(regex):
    """The longest text of a signature: optional words taken, of several choices the longest."""
    text = regex.removeprefix("^(?:")[:-2].replace("[sc]", "s").replace("[a-z]*", "rec").replace(" ?", " ")
    while "(?:" in text:
        text = re.sub(r"\(\?:([^()]*)\)\??", lambda x: max(x[1].split("|"), key=lambda y: y.count(" ")), text)
    return text.replace("?", "")


def test_every_signature_matches_its_own_words(spark):
    """Also the longest ones, optional words included, in the scan as in the rules."""
    texts = [spelled(rule.regex) for rule in signatures()]
    for text, rule in zip(texts, signatures()):
        assert re.match(rule.regex, text + " "), (text, rule.regex)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: row for row in L.scan(frame).collect()}
    for i, (text, rule) in enumerate(zip(texts, signatures())):
        assert any(x.start == 0 and x.end == len(text.split()) for x in found[i].detections), (text, found[i].detections)
    assert rows_of(L.summary(L.scan(frame))) == sorted((expected(i, text) for i, text in enumerate(texts)), key=repr)
