"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, base string, spans string, lang_pred string, items int, n_words int, key long"


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = prose(160), prose(120)
    near = base.split()
    near[60] = "other"
    rows = [(i, prose(rng.randrange(3, 90))) for i in range(20)]
    rows += [(20, base), (21, base), (22, " ".join(near)), (23, base.upper()), (24, f"{prose(30)} {passage} {prose(9)}")]
    rows += [(25, f"{passage} {prose(30)}"), (26, "ab" * 700), (27, "é" * 500), (28, None), (29, ""), (30, "  \n\t "), (31, "one two")]
    rows += [(32, "one two"), (33, prose(6000)), (34, "!!! 123 ..."), (35, "x" * 399), (36, "x" * 400), (37, "naïve café 日本語 \U0001f600 end")]
    return rows


def documents(spark, rows=None):
    full = [
        (i, t, None if i is None or i % 5 == 0 else ("en", "fr")[i % 2], None, None, "a", "b", "c", "d", 2, 3, 1)
        for i, t in (texts() if rows is None else rows)
    ]
    return spark.createDataFrame(full, SCHEMA)
