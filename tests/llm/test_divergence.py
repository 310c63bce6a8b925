"""The source audit against a plain count of every term of every source."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloader.llm import divergence as D

from llm_cases import SCHEMA, awkward, prose, rows_of

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def terms(text):
    kept = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text or "")
    return [x for x in kept.split(" ") if x]


def expected(rows):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = terms(text)
        counts[lang or "", source or ""].update(found)
        documents[lang or ""].update(set(found))
    made = []
    for lang in documents:
        kept = sorted(x for x, n in documents[lang].items() if n >= 3)
        sources = sorted(source for of, source in counts if of == lang)

        def shares(count):
            total = sum(count[x] for x in kept) + len(kept)
            return {x: 1 + 10**9 * (count[x] + 1) // total for x in kept}

        usual = shares(sum((counts[lang, x] for x in sources), Counter()))
        share = {x: shares(counts[lang, x]) for x in sources}
        for source in sources:
            own = share[source]
            pairs = [(-sum((own[x] - share[y][x]) ** 2 // share[y][x] for x in kept), y) for y in sources if y != source]
            above = [(-((own[x] - usual[x]) ** 2 // usual[x]), x) for x in kept if counts[lang, source][x] and own[x] > usual[x]]
            above.sort(key=lambda x: (x[0], x[1].encode()))
            made += [(lang, source, "pair", y, -value, i + 1) for i, (value, y) in enumerate(sorted(pairs))]
            made += [(lang, source, "term", x, -value, i + 1) for i, (value, x) in enumerate(above[: D.TERMS_SHOWN])]
    return sorted(made, key=repr)


def many():
    """Several sources of several languages, beside the awkward rows."""
    rows = [(i, prose(i, 40 + i % 50) + f" Straße{i % 4} word{'abc'[i % 3]}", f"l{i % 2}", f"s{i % 7}", 1) for i in range(60)]
    return awkward() + rows + rows[:5] + [(900, None, "l0", "empty", 0), (901, "alone", "rare", "s0", 0), (902, "x", "rare", "s1", 0)]


@pytest.fixture(scope="module")
def several(spark):
    return spark.createDataFrame(many(), SCHEMA).repartition(4)


def test_awkward_rows_of_clashing_names(documents):
    assert rows_of(D.audit(documents), *COLUMNS) == expected(awkward())


def test_groups_blocks_and_flushes(several, monkeypatch):
    monkeypatch.setattr(D, "GROUP_ROWS", 1)
    monkeypatch.setattr(D, "BLOCK_SOURCES", 2)
    assert rows_of(D.audit(several), *COLUMNS) == expected(many())


def test_terms_that_share_a_digest_are_counted_apart(several):
    assert rows_of(D.audit(several, digest_bits=3), *COLUMNS) == expected(many())


def test_tables_that_fill_are_written_early():
    import pyarrow as pa

    texts = [prose(i, 200) for i in range(20)]
    batch = pa.record_batch([["a"] * 20, ["s"] * 20, pa.array([x.encode() for x in texts])], ["lang", "source", "text"])
    whole = Counter(x for text in texts for x in terms(text))
    for limit in (10, 10**9):
        D.TABLE_TERMS, before = limit, D.TABLE_TERMS
        try:
            rows = [row for made in D._count_terms(iter([batch])) for row in made.to_pylist()]
        finally:
            D.TABLE_TERMS = before
        name = {row["digest"]: row["term"].decode() for row in rows if row["lang"] is None}
        counts = [row for row in rows if row["lang"] is not None]
        total = Counter()
        for row in counts:
            total[name[row["digest"]]] += row["n"]
        assert total == whole and all(row["term"] is None for row in counts)
        assert sum(row["docs"] for row in counts) == sum(len(set(terms(text))) for text in texts)


def test_long_texts_are_counted_piece_by_piece(monkeypatch):
    monkeypatch.setattr(D, "_PIECE", 7)
    text = prose(4, 300) + " " + "ü" * 50
    assert [x.decode() for part in D._terms(text.encode()) for x in part] == terms(text)


def test_ties_go_by_the_bytes_of_terms(spark, monkeypatch):
    monkeypatch.setattr(D, "TERMS_SHOWN", 3)
    names = ["zz", "z", "é", "longer term", "longer", "aaaaaaaab", "aaaaaaaaa", "aaaaaaaac"]
    rows = [(i, " ".join(x.replace(" ", "q") for x in names), "l", "one", 0) for i in range(3)] + [(9, "z other", "l", "two", 0)]
    assert rows_of(D.audit(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == expected(rows)


def test_shares_are_exact_for_large_counts():
    total = np.int64(9 * 10**15)
    counts = [0, 1, 10**9, 10**12 + 7, 9 * 10**15 - 1]
    assert D.share(np.array(counts), total).tolist() == [1 + 10**9 * (n + 1) // int(total) for n in counts]


def test_empty_table(no_documents):
    assert D.audit(no_documents).count() == 0
