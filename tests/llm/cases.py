"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random
import re

SPACE = re.compile("[\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in SPACE.split(text) if w]


def documents(seed=5, families=6, alone=30):
    """Rows of documents: families of copies and near copies, single texts, and the awkward ones."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghiklmnoprstuvwé") for _ in range(r.randint(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(vocabulary) + ("\n" if r.random() < 0.08 else "") for _ in range(n))
    rows = []
    for f in range(families):
        base = text(r.choice([3, 6, 9, 20, 60, 200])).split(" ")
        for _ in range(r.randint(2, 14)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append(" ".join(copy) if r.random() < 0.7 else " ".join(copy).upper())
    rows += [text(r.choice([1, 2, 4, 5, 7, 12, 40, 150])) for _ in range(alone)]
    rows += ["", "", None, None, " \t\n ", "one", "One", "one two", "x " * 3000, "x " * 3000 + "y", text(4000)]
    out = [(k, t, r.choice(["en", "fr", None]), r.choice(["src0", "src0", "src1", "src2", None]), None) for k, t in enumerate(rows)]
    return out + [out[3], out[3], out[-4]]
