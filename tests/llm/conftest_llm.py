"""Small tables for the operator tests."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    """`documents` from (doc_id, text) pairs or whole rows."""
    rows = [r if len(r) == 5 else (r[0], r[1], "en", f"s{(r[0] or 0) % 3}", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(seed, n, words=400):
    """n words; frequent ones are drawn more often."""
    draw = random.Random(seed)
    return " ".join(f"w{int(words * draw.random() ** 3)}é" if draw.random() < 0.1 else f"w{int(words * draw.random() ** 3)}" for _ in range(n))


def corpus():
    """Documents with exact and near copies, shared passages, odd characters and repeated lines."""
    rows = [(i, prose(i, 30 + 7 * (i % 9))) for i in range(40)]
    passage = prose(900, 60)
    for i in range(40, 48):
        rows.append((i, prose(i, 20) + " " + passage + " " + prose(i + 500, 15)))
    base = prose(901, 120).split()
    for i in range(48, 60):
        edited = list(base)
        edited[10 * (i - 48) % 120] = f"edit{i}"
        rows.append((i, " ".join(edited)))
    rows += [(60 + i, rows[3][1]) for i in range(4)]
    rows.append((64, "one line\n" * 40))
    rows.append((65, " " * 300 + "a" * 900))
    rows.append((66, "a" * 700))
    rows.append((67, "\U0001f600 ñandú\t\x0b\n" * 30))
    rows.append((68, prose(3, 20000)))
    return rows


#: rows that no operator may choke on: nulls, empty texts, repeated rows, one id with two texts
EDGES = [
    (None, None), (None, "no id here"), (1, None), (2, ""), (3, "   \n "), (4, "word"), (4, "word"), (5, "same id one"), (5, "same id two"),
    (6, prose(6, 60)), (6, prose(6, 60)), (-7, "a b c d e"), (1 << 60, "big id"),
]
