"""Documents with every awkward case, beside plain ones."""

import random

#: Names that operators use inside, as columns of the input.
CLASHES = "digest long, bits string, id string, variant long, start string, spans string, key long, shard string, `a.b` string"
WORDS = "the cat sat on a mat while rain fell over old stone walls and nobody came home before dark".split()


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(words))


def awkward():
    """`doc_id, text, lang, source, n_chars`: nulls, empty and long texts, ties, repeated rows."""
    long = prose(5, 30_000)
    texts = [
        None, "", "   \n\t ", "one", "Same Text here", "same text HERE", "SAME TEXT HERE", "ÄÖ same", "äö same",
        prose(1, 60), prose(1, 60), prose(2, 300), prose(2, 300) + " tail", long, long + " more", "x" * 200_000,
        "é" * 3000 + "\n\n" + "▁ ▁▁", "a\x00b\u0085c d 漢字 \U0001f600", "\r\n\r\n", "| " * 400,
    ]
    rows = [(i, text, "en" if i % 3 else "de", "s", len(text or "")) for i, text in enumerate(texts)]
    rows += [rows[9], rows[11], rows[11], (None, "same text here", None, None, None), (None, None, None, None, None)]
    rows += [(40, prose(3, 50), "en", "s", 1), (40, prose(4, 50), "de", "s", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(frame, *columns):
    columns = columns or frame.columns
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)
