"""The mix against targets filled up step by step, and documents walked one by one."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from lakeloader.llm import mixing as M

from llm_cases import SCHEMA, awkward, prose, rows_of


def filled(sizes, percent=150):
    """Targets by resharing the excess of full sources until there is none."""
    order = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [x for x in sizes if x is None]
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(order)}
    full, rest = {}, Fraction(percent * sum(sizes.values()), 100)
    while True:
        open_ = [x for x in order if x not in full]
        level = rest / sum(weight[x] for x in open_) if open_ else 0
        over = [x for x in open_ if level * weight[x] > 2 * sizes[x]]
        if not over:
            return {x: float(full[x] if x in full else level * weight[x]) for x in order}
        for x in over:
            full[x] = 2 * sizes[x]
            rest -= full[x]


def expected(rows):
    documents, sizes = defaultdict(list), Counter()
    for doc_id, text, _, source, *_ in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        documents[source].append((-size, doc_id is None, doc_id))
        sizes[source] += size
    target, made = filled(sizes), []
    for source, found in documents.items():
        each = target[source] / sizes[source] if sizes[source] else 0.0
        shift = int(hashlib.md5(f"{M.SEED}:{source or ''}".encode()).hexdigest()[:8], 16) / 2**32
        for at, (size, _, doc_id) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))):
            copies = min(math.floor((at + 1) * each + shift) - math.floor(at * each + shift), 2)
            made.append((doc_id, -size, sizes[source], target[source], -size * copies))
    return sorted(made, key=repr)


def uneven():
    """One source holds most, some hold next to nothing, one has no name, one no words."""
    rows = [(i, prose(i, 5 + i % 90), "en", "big" if i % 3 else f"s{i % 12}", 0) for i in range(300)]
    rows += [(400 + i, prose(i, 3), "en", ("tiny", None, "", "Zed", "ähnlich")[i % 5], 0) for i in range(10)]
    return rows + rows[:4] + [(500, None, "en", "silent", 0), (501, " ", "en", "silent", 0), (None, "a b c", "en", "big", 0)]


COLUMNS = ("doc_id", "size", "source_size", "target", "taken")


def test_awkward_rows_of_clashing_names(documents):
    assert rows_of(M.summary(M.assign(documents)), *COLUMNS) == expected(awkward())


@pytest.mark.parametrize("rows", [1, 7, 10**6])
def test_ranges_do_not_change_the_mix(spark, monkeypatch, rows):
    monkeypatch.setattr(M, "RANGE_ROWS", rows)
    frame = spark.createDataFrame(uneven(), SCHEMA).repartition(5)
    assert rows_of(M.summary(M.assign(frame)), *COLUMNS) == expected(uneven())


def test_targets_add_up_and_are_met(spark):
    rows = [(i, prose(i, 20 + i % 30), "en", f"s{i % 5}", 0) for i in range(1500)]
    made = M.assign(spark.createDataFrame(rows, SCHEMA)).collect()
    target = {row.source: row.target for row in made}
    taken = Counter()
    for row in made:
        taken[row.source] += row.size * row.copies
    assert sum(target.values()) == pytest.approx(1.5 * sum(row.size for row in made))
    assert all(abs(taken[x] - target[x]) < 100 for x in target)
    assert all(target[row.source] <= 2 * row.source_size and row.copies <= 2 for row in made)


def test_all_sources_full(spark):
    rows = [(i, prose(i, 9), "en", f"s{i % 3}", 0) for i in range(12)]
    made = M.assign(spark.createDataFrame(rows, SCHEMA), percent=200).collect()
    assert {row.copies for row in made} == {2} and all(row.target == 2 * row.source_size for row in made)


def test_the_mix_holds_each_document_as_often_as_it_is_taken(documents):
    copies = Counter()
    for row in M.assign(documents).collect():
        copies[row.doc_id] += row.copies
    made = M.mix(documents)
    assert made.columns == documents.columns
    assert Counter(row.doc_id for row in made.collect()) == +copies


def test_another_seed_gives_another_mix(spark):
    frame = spark.createDataFrame(uneven(), SCHEMA)
    one, two = (rows_of(M.assign(frame, seed=seed), "doc_id", "copies") for seed in (1, 2))
    assert one != two and one == rows_of(M.assign(frame, seed=1), "doc_id", "copies")


def test_empty_table(no_documents):
    assert M.assign(no_documents).count() == 0 and M.mix(no_documents).count() == 0
