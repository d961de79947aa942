"""Trees and proofs against hashing level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import merkle

from .cases import DOCS, documents, low


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc):
    i, text, lang, source, n = doc
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes, fan=16):
    """The root of nodes, and for each of them the siblings from level to level as one text."""
    proofs, at, level = [""] * len(nodes), list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[k : k + fan] for k in range(0, len(level), fan)]
        for j, p in enumerate(at):
            run = runs[p // fan]
            proofs[j] += "".join(run[: p % fan] + run[p % fan + 1 :])
            at[j] = p // fan
        level = [sha("".join(run)) for run in runs]
    return level[0], proofs


def plain(docs):
    by_source = {}
    for d in docs:
        by_source.setdefault(d[3], []).append(d)
    subroots, out = [], []
    keys = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in keys:
        own = sorted(by_source[s], key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d)))
        root, proofs = climb([leaf_of(d) for d in own])
        subroots.append((root, own, proofs))
    root, over = climb([r for r, *_ in subroots])
    for (subroot, own, proofs), above in zip(subroots, over, strict=True):
        for d, p in zip(own, proofs, strict=True):
            touched = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            good = not (touched and d[1] is not None and low(d[1]) != d[1])
            out.append((d[0], leaf_of(d), subroot, root, sha(p + above), good))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in df.collect()), key=repr)


@pytest.mark.parametrize("levels", [3, 1])
def test_manifest(spark, levels):
    r = random.Random(4)
    rows = [(k, r.choice(["Text " * 9, "text", "é", None, ""]), "en", "hot", 3) for k in range(700)]
    rows += [(k + 1000, "Alone", None, f"s{k}", None) for k in range(40)] + [(None, "No id", "en", "hot", 1), (None, None, None, None, None), (3, "Text again", "en", "hot", 3)]
    rows += documents()
    rows = [(i, t and t[:2000], *x) for i, t, *x in rows]
    clash = {"tree": 1, "pos": 2, "n": 3, "digest": 4, "leaf": 5, "by_0": 6, "c_doc_id": 7, "root": 8, "block": 9}
    docs = spark.createDataFrame(rows, DOCS).select("*", *(F.lit(v).alias(k) for k, v in clash.items())).repartition(5)
    assert got(merkle.manifest(docs, levels)) == plain(rows)


def test_changed_rows_fail_and_only_they(spark):
    rows = [(k, "ABC" if k % 3 else "abc", "en", f"s{k % 2}", 3) for k in range(60)]
    made = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text, *_ in rows:
        touched = zlib.crc32(str(i).encode()) % 5 == 0 and text == "ABC"
        assert made[i].verified == (not touched) and (made[i].folded_root != made[i].root) == touched


def test_few(spark):
    for rows in ([], [(1, "a", None, None, None)], [(1, "a", "en", "s", 1), (2, "b", "en", "t", 1)]):
        assert got(merkle.manifest(spark.createDataFrame(rows, DOCS))) == (plain(rows) if rows else [])


def test_traversal_equals_all_levels():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 700, 4095, 4096):
        leaves = [sha(str(k)) for k in range(n)]
        h = merkle.height(n)
        root, proofs = climb(leaves)
        assert merkle.block_root(leaves, h) == root
        for (places, siblings), want, k in zip(merkle.traversal(leaves, h), proofs, range(n), strict=True):
            assert "".join(siblings) == want and places == [k // 16**j % 16 for j in range(h)]


def test_state_is_small():
    stack = merkle.Stack(3)
    for k in range(4095):
        stack.push(sha(str(k)))
        assert sum(map(len, stack.runs)) <= 3 * 15 and not stack.nodes
