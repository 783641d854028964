"""Plain Python versions of the contracts, and the odd rows that every operator has to take."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

# (doc_id, text, lang, source, n_chars, rank, u): the last two columns clash with names used inside.
ODD_ROWS = [
    (1, "alpha beta gamma delta", "en", "a", 22, 1, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "a", 0, 1, "x"),
    (4, " \n\t ", "en", "b", 4, 1, "x"),
    (5, LONG, "en", "a", len(LONG), 1, "x"),
    (6, LONG + " end", "en", "a", len(LONG) + 4, 1, "x"),
    (7, "one", "de", "b", 3, 1, None),
    (8, "One", "de", "b", 3, 1, None),
    (9, PASSAGE + "\nline one\nline two\nÄrger über 😀 alles", "de", None, 10, 1, "x"),
    (10, "before " + PASSAGE + " after", "de", "c", 10, 1, "x"),
    (11, "before " + PASSAGE + " after", "de", "c", 10, 1, "x"),
    (11, "before " + PASSAGE + " after", "de", "c", 10, 1, "x"),
    (None, "no id here but words", "en", "c", 10, 1, "x"),
    (None, "no id here but words", "en", "c", 10, 1, "x"),
    (12, "same same same same " * 30, "es", "d", 10, 2, "x"),
    (-5, "x y z\x0bq\x1fr", "es", "d", 10, 2, "x"),
]
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, u string"


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def hot(spark, n=3000):
    """A third of all rows in one source with one text, a third in near copies of one text."""
    rows = []
    base = [f"n{i}" for i in range(120)]
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, "the same words in every one of these rows", "en", "hot", 1, 1, "x"))
        elif i % 3 == 1:
            copy = list(base)
            copy[i % 120] = f"other{i}"
            rows.append((i, " ".join(copy), "en", "hot", 1, 1, "x"))
        else:
            rows.append((i, " ".join(f"r{i}_{j}" for j in range(i % 40)), "de", f"s{i % 7}", 1, 1, "x"))
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(7)


def rows(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is None, str(type(x)), x if not isinstance(x, list) else tuple(x)) for x in row)


def same(left, right):
    assert sorted(left, key=key) == sorted(right, key=key)
