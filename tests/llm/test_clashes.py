"""Rows without ids or with repeated ones, and columns with the names that operators use themselves."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup, line_dedup, mixing, ngram_join

from .cases import DOCS, documents, words

#: Names that joins and windows of the operators use.
INTERNAL = (
    "g_id ref doc n key root x y a b c_ref f_ref least top node r_id r_lines ld_key ld_at ld_gone ld_0 oe_0 line line_no gone removed pair p i n_lines n_removed component_id n_shingles size source_size target taken keep_id kept group_size "
    "text_sha256 bm_at bm_row bm_bits maybe at u v m k h several first later j1 j2 s1 s2 codes pairs weight"
).split()


def with_clashes(df):
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in INTERNAL))


@pytest.fixture(scope="module")
def given(spark):
    rows = [(i, t and t[:600], *x) for i, t, *x in documents(seed=9, families=3, alone=8)]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize("stage", [ngram_join.one_of_each, exact_dedup.drop_exact_copies, mixing.mixed_documents, line_dedup.clean])
def test_clashing_columns_stay_as_they_are(stage, given):
    _, docs = given
    plain, clashing = stage(docs), stage(with_clashes(docs))
    assert clashing.columns == [*docs.columns, *INTERNAL]
    assert sorted(map(repr, (tuple(r) for r in clashing.select(docs.columns).collect()))) == sorted(map(repr, (tuple(r) for r in plain.collect())))
    assert clashing.select(INTERNAL).distinct().collect() in ([], [tuple(f"own {c}" for c in INTERNAL)])


def similar(a, b):
    return 100 * len(a & b) >= 75 * len(a | b)


def plain_clean(rows):
    """Texts by row; rows (id, text) in the order given. A row that repeats the one before it is the same document."""
    before, out = [], []
    for n, (i, text) in enumerate(rows):
        if n and rows[n - 1] == (i, text):
            out.append(out[-1])
            continue
        kept = []
        for line in (text or "").split("\n"):
            own = set(words(line.lower()))
            if not (own and any(similar(own, x) for x in before)):
                kept.append(line)
            before += [own] * bool(own)
        out.append(None if text is None else "\n".join(kept))
    return out


def test_clean_of_rows_that_share_an_id(spark):
    rows = [(1, "shared line here\nfirst"), (2, "shared line here\nonly one"), (2, "this line is unique\nshared line here"), (None, "shared line here\nsecond"), (None, "nothing like it elsewhere"), (None, None), (3, "")]
    got = line_dedup.clean(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, [(1, "shared line here\nfirst"), (2, "only one"), (2, "this line is unique"), (None, "second"), (None, "nothing like it elsewhere"), (None, None), (3, "")]))


def test_clean_against_brute_force(spark):
    r = random.Random(4)
    line = lambda: " ".join(r.choice("abcdefgh") + r.choice(["", "1"]) for _ in range(r.choice([0, 1, 2, 4, 5, 8])))
    pool = [line() for _ in range(25)]
    rows = [(r.choice([None, *range(12)]), "\n".join(r.choice(pool) for _ in range(r.randint(1, 5)))) for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = [(x.doc_id, x.text) for x in df.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).collect()]
    want = sorted(map(repr, zip((i for i, _ in order), plain_clean(order), strict=True)))
    assert sorted(map(repr, ((x.doc_id, x.text) for x in line_dedup.clean(df.repartition(4)).collect()))) == want
