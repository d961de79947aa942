"""Line deduplication by an exact set-similarity join. JVM side only.

A line is the set of its words, the rarest in the corpus first. Lines of one set are one row. For sets that may be similar
the prefix filter works on pairs of words that are neighbours in that order: of two sets of a and b words that share s, at
least 3 s - a - b - 1 such pairs are in both, as a missing word breaks two pairs and an added one breaks one. Pairs are far
rarer than words, so that lists of lines with a common pair stay short however large the corpus is. Length, positional and
parity filters thin the candidates; the words themselves decide. Pairs meet in rounds, each of a share of all pairs, so that
only a round's entries are on their way at once."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_RUN, bitmap, bits_for, made, maybe_in, remove_tables, whole_text, written

#: Counters of the frequency sketch. Its size doesn't depend on the corpus; a collision only changes the order of tokens.
COUNTERS = 1 << 16
#: Lines of fewer distinct words stay: only those without a word.
LEAST_WORDS = 1
LAST_ID = (1 << 63) - 1


def tokens(line: Column) -> Column:
    """Words of a lower-cased line, and an empty one where white space begins or ends it."""
    return F.split(line, SPACE_RUN)


def numbered_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, line_no (from 0), lower-cased line; null ids rank last."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"), F.lower(whole_text(text_col)).alias("text"))
    return rows.select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def rarity(docs: DataFrame, text_col: str) -> Column:
    """An array of COUNTERS classes (floor of log2 of a counter, in the bits above the 57th) from the counts of all words of
    all texts."""
    words = docs.select(F.explode(tokens(F.lower(whole_text(text_col)))).alias("w")).select(F.expr(f"xxhash64(w) & {COUNTERS - 1}").alias("c"))
    counts = {r["c"]: r["count"] for r in words.groupBy("c").count().collect()}  # at most COUNTERS rows
    classes = [counts.get(k, 0).bit_length() << 57 for k in range(COUNTERS)]
    return F.from_json(F.lit(str(classes)), "array<bigint>")


def codes(line: Column, classes: Column) -> Column:
    """The line's distinct words as numbers that sort the rarest first: 6 bits of class, 57 bits of hash. Each word is hashed
    once; no step yields nulls, so that Spark keeps plain numbers and sorts them as such."""
    hashes = F.array_distinct(F.transform(tokens(line), lambda w: F.xxhash64(w)))
    rank = lambda h: F.coalesce(F.get(classes, h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")), F.lit(0).cast("long"))
    ranked = F.transform(F.array_remove(hashes, F.xxhash64(F.lit(""))), lambda h: rank(h).bitwiseOR(h.bitwiseAND(F.lit((1 << 57) - 1))))
    return F.sort_array(ranked)


def parity() -> Column:
    """64 bits, each the parity of the codes that fall on it. Two lines differ in at most as many bits as in words."""
    one = F.lit(1).cast("long")
    return F.aggregate("codes", F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(F.call_function("shiftleft", one, c.bitwiseAND(F.lit(63)).cast("int"))))


#: Lines of so many words carry 256 parities: on 64 bits those of unlike ones are as close as those of similar ones.
WIDE = 48


def quarter(k: int) -> Column:
    """Parities of the codes whose seventh and eighth bits are k, 0 for small lines. The fourth quarter follows from parity(),
    which is all four in one."""
    bit = lambda c: F.when(F.shiftright(c, 6).bitwiseAND(F.lit(3)) == k, F.call_function("shiftleft", F.lit(1).cast("long"), c.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long"))
    return F.when(F.col("n") >= WIDE, F.aggregate("codes", F.lit(0).cast("long"), lambda a, c: a.bitwiseXOR(bit(c)))).otherwise(F.lit(0).cast("long"))


#: The quarters that lines carry.
QUARTERS = ("q0", "q1", "q2")

#: How many pairs similar lines share at least, as far as a line of n words knows: it has 3/4 of the other's words or more,
#: and 3 * ceil(3 x / 7) - x - 1 >= ceil(2 x / 7) - 1 for x words in both.
PAIRS_SHARED = "(2 * (n + (3 * n + 3) div 4) + 6) div 7 - 1"

LENGTHS = "4 * a.n >= 3 * b.n and 4 * b.n >= 3 * a.n"
MOST_APART = "a.n + b.n - 2 * ((3 * (a.n + b.n) + 6) div 7)"
APART = " + ".join([*(f"bit_count(a.{q} ^ b.{q})" for q in QUARTERS), "bit_count(a.p ^ b.p ^ " + " ^ ".join(f"a.{q} ^ b.{q}" for q in QUARTERS) + ")"])
PARITIES = f"bit_count(a.p ^ b.p) <= {MOST_APART} and (least(a.n, b.n) < {WIDE} or {APART} <= {MOST_APART})"
#: A pair at places i (from 0) of the n - 1 pairs of each can be the first of enough shared ones.
POSITIONS = "1 + least(a.n - a.i, b.n - b.i) - 2 >= 3 * ((3 * (a.n + b.n) + 6) div 7) - a.n - b.n - 1"
EARLIER = "(a.doc < b.doc or (a.doc = b.doc and a.line_no < b.line_no))"
MATCH = f"{EARLIER} and {LENGTHS} and {POSITIONS} and {PARITIES}"


def line_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each line, read once: place, number of different words, two hashes of their set, parity, and the pairs of
    its prefix."""
    classes = rarity(docs, text_col)
    lines = numbered_lines(docs, id_col, text_col)
    # As a generated column the codes are made once and not again for each use.
    rows = lines.select("doc", "line_no", F.explode(F.array(codes(F.col("line"), classes))).alias("codes")).withColumn("n", F.size("codes"))
    many = F.when(F.col("n") > 1, F.expr(f"n - ({PAIRS_SHARED})")).otherwise(0)
    pairs = F.zip_with(F.slice("codes", F.lit(1), many), F.slice("codes", F.lit(2), many), lambda a, b: F.xxhash64(a, b))
    return written(rows.select("doc", "line_no", "n", F.xxhash64("codes").alias("s1"), F.xxhash64(F.lit(1), "codes").alias("s2"), parity().alias("p"), *(quarter(k).alias(q) for k, q in enumerate(QUARTERS)), pairs.alias("pairs")), "lines")


def first_copies(lines: DataFrame, sets: DataFrame) -> DataFrame:
    """The lines that are the first of their set. Sets of one line are told by a bitmap, and such lines stay where they are;
    only lines of the others, and a few that the bitmap can't tell, cross the network to meet their set's first place and are
    written again. A set has one place, so an inner join repeats no line; Spark would move a semi-join below the bitmap's and
    send all lines."""
    lines = lines.withColumns({q: F.lit(0).cast("long") for q in QUARTERS if q not in lines.columns})  # without quarters p alone tells lines apart
    several = written(sets.filter("many > 1").select(F.struct("s1", "s2").alias("k")), "repeated-lines")
    bits = bits_for(several.count())
    flagged = maybe_in(lines, F.struct("s1", "s2"), bitmap(several, "k", bits), bits, "several")
    known = sets.select(F.col("doc").alias("f_doc"), F.col("line_no").alias("f_no"), F.col("s1").alias("f1"), F.col("s2").alias("f2"))
    same = (F.col("doc") == F.col("f_doc")) & (F.col("line_no") == F.col("f_no")) & (F.col("s1") == F.col("f1")) & (F.col("s2") == F.col("f2"))
    kept = ("doc", F.expr("shiftleft(cast(line_no as bigint), 32) | n").alias("ln"), "p", *QUARTERS, "pairs")
    return flagged.filter("not several").select(*kept).union(written(flagged.filter("several").join(known, same).select(*kept), "first-lines"))


#: Columns of an entry: a pair and one of its lines. Line number and size share a number; i is the pair's place.
LINE = ("doc", "ln", "p", *QUARTERS, "i")


def spelled(condition: str, a: str, b: str) -> Column:
    """A condition on lines a and b in terms of entries' columns with these prefixes."""
    own = {c: c for c in LINE if c != "ln"} | {"n": "(ln & 4294967295)", "line_no": "shiftright(ln, 32)"}
    for side, prefix in (("a", a), ("b", b)):
        for name, value in own.items():
            condition = re.sub(rf"\b{side}\.{name}\b", re.sub(rf"\b({'|'.join(LINE)})\b", rf"{prefix}\1", value), condition)
    return F.expr(condition)


def shared_entries(firsts: DataFrame) -> DataFrame:
    """pair and LINE for each pair that, as far as is told, more than one of the lines (LINE but for i, and pairs) has. Halves of pairs
    are counted without their lines, as whole ones take much room on their way; a bitmap brings those that repeat back to the
    lines. Different pairs of one half, and what the bitmap can't tell, are entries that meet nothing."""
    half = lambda pair: F.shiftright(pair, 32).cast("int")
    shared = written(firsts.select(F.explode("pairs").alias("pair")).groupBy(half(F.col("pair")).alias("half")).count().filter("count > 1").select("half"), "shared-pairs")
    bits = bits_for(shared.count())
    lines = firsts.select(*LINE[:-1], F.posexplode("pairs").alias("i", "pair"))
    return written(maybe_in(lines, half(F.col("pair")), bitmap(shared, "half", bits), bits, "maybe").filter("maybe").select("pair", *LINE), "shared-entries")


def places(a: str, b: str) -> list[Column]:
    """Places of the two lines of a candidate."""
    return [c for s, x in (("a", a), ("b", b)) for c in (F.col(f"{x}doc").alias(f"{s}_doc"), F.expr(f"cast(shiftright({x}ln, 32) as int)").alias(f"{s}_line_no"))]


#: A round has at most so many entries for each line that is the first of its set, or in all, whichever is more: what is on
#: its way between tasks stays in proportion to the lines, though entries grow faster than these.
ENTRIES_A_LINE, ENTRIES_A_ROUND = 2, 1 << 20


def rounds(entries: DataFrame, lines: int) -> list[DataFrame]:
    """The entries dealt by their pairs, so that each pair has all of its entries in one round."""
    n = max(1, math.ceil(entries.count() / max(ENTRIES_A_LINE * lines, ENTRIES_A_ROUND)))
    return [entries.filter(F.pmod("pair", F.lit(n)) == k) for k in range(n)]


def all_candidates(parts: list[DataFrame], found: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What is found in each part, one after the other. A part's shuffles go before the next one's, as written() has garbage
    collected; the table it may have written, named name, goes too."""
    out = []
    for part in parts:
        before = len(made)
        out.append(written(found(part).distinct(), "round-pairs"))
        remove_tables(part.sparkSession, before, names=(name,))
    return reduce(DataFrame.union, out)


def pairs_with_earliest(entries: DataFrame) -> DataFrame:
    """Each line with the earliest line that has one of its pairs. In a group of near copies this finds most matches in as
    many rows as there are entries, and matched lines ask for no more."""
    firsts = entries.groupBy(F.col("pair").alias("a_pair")).agg(F.min(F.struct(*LINE)).alias("a")).select("a_pair", *(F.col(f"a.{c}").alias(f"a_{c}") for c in LINE))
    met = entries.join(firsts, F.col("pair") == F.col("a_pair")).filter(spelled(MATCH, "a_", ""))
    return met.select(*places("a_", ""))


def marked_entries(entries: DataFrame, gone: DataFrame) -> DataFrame:
    """entries with the column until: the line's doc while it is open, the least number if it is gone. Only entries that a
    bitmap takes for gone cross the network."""
    bits = bits_for(gone.count())
    place = F.struct("doc", F.expr("cast(shiftright(ln, 32) as int)").alias("line_no"))
    flagged = maybe_in(entries, place, bitmap(gone.select(F.struct("doc", "line_no").alias("k")), "k", bits), bits, "maybe")
    later = gone.select(F.col("doc").alias("g_doc"), F.col("line_no").alias("g_no"))
    met = flagged.filter("maybe").join(later, (F.col("doc") == F.col("g_doc")) & (F.expr("cast(shiftright(ln, 32) as int)") == F.col("g_no")), "left")
    until = F.when(F.col("g_doc").isNull(), F.col("doc")).otherwise(F.lit(-(1 << 63)))
    return written(flagged.filter("not maybe").select("pair", *LINE, F.col("doc").alias("until")).union(met.select("pair", *LINE, until)), "marked-entries")


def pairs_of_open(marked: DataFrame) -> DataFrame:
    """All candidates whose later line is still open. Both sides read the same rows and columns, so that the entries are
    shuffled once: a line that is gone is kept out by the join's condition and not by a filter before it."""
    rows = marked.filter(" and ".join(f"{c} is not null" for c in ("pair", *LINE, "until")))
    a = rows.select(F.col("pair").alias("a_pair"), *(F.col(c).alias(f"a_{c}") for c in (*LINE, "until")))
    still_open = (F.col("a_doc") <= F.col("until")) & (F.col("a_until") <= F.col("doc"))  # the second follows from the order
    return a.join(rows, (F.col("a_pair") == F.col("pair")) & still_open & spelled(MATCH, "a_", "")).select(*places("a_", ""))


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Places (doc, line_no) of the later lines of those pairs whose word sets have a Jaccard similarity of 0.75 or more.

    Only the texts of documents that hold such lines, found by a bitmap, are split again."""
    pairs = written(pairs.distinct(), "line-pairs")
    ends = written(pairs.select(F.col("a_doc").alias("w_doc"), F.col("a_line_no").alias("w_line_no")).union(pairs.select("b_doc", "b_line_no")).distinct(), "line-ends")
    bits = bits_for(ends.count())
    members = bitmap(ends.select(F.col("w_doc").alias("k")), "k", bits)
    places = bitmap(ends.select(F.struct("w_doc", "w_line_no").alias("k")), "k", bits)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"), F.col(text_col).alias("text"))
    rows = maybe_in(rows, F.col("doc"), members, bits, "maybe").filter("maybe").select("doc", "text")
    lines = maybe_in(numbered_lines(rows, "doc", "text"), F.struct("doc", "line_no"), places, bits, "maybe").filter("maybe").drop("maybe")
    lines = written(lines.dropDuplicates(), "candidate-lines")
    side = lambda s: lines.select(F.col("doc").alias(f"{s}_d"), F.col("line_no").alias(f"{s}_l"), F.col("line").alias(f"{s}_line"))
    both = pairs.join(side("x"), (F.col("a_doc") == F.col("x_d")) & (F.col("a_line_no") == F.col("x_l")))
    both = both.join(side("y"), (F.col("b_doc") == F.col("y_d")) & (F.col("b_line_no") == F.col("y_l")))
    once = lambda c: F.explode(F.array(F.array_remove(F.array_distinct(tokens(F.col(c))), "")))
    words = both.select("b_doc", "b_line_no", "y_line", once("x_line").alias("x_words")).select("b_doc", "b_line_no", "x_words", once("y_line").alias("y_words"))
    shared = F.size(F.array_intersect("x_words", "y_words"))
    match = 100 * shared >= 75 * (F.size("x_words") + F.size("y_words") - shared)
    return words.filter(match).select(F.col("b_doc").alias("doc"), F.col("b_line_no").alias("line_no")).distinct()


def judged_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """doc, line_no and gone (whether a line before it matches) of every line."""
    before = len(made)
    wide = line_sets(docs, id_col, text_col)
    lines = written(wide.select("doc", "line_no", "n", "s1", "s2"), "line-places")
    sets = lines.filter(F.col("n") >= least_words).groupBy("s1", "s2").agg(F.min(F.struct("doc", "line_no")).alias("at"), F.count(F.lit(1)).alias("many"))
    sets = written(sets.select("s1", "s2", "at.doc", "at.line_no", "many"), "line-sets")
    entries = shared_entries(first_copies(wide.filter(F.col("n") >= least_words), sets))
    remove_tables(docs.sparkSession, before, names=("lines", "repeated-lines", "first-lines", "shared-pairs"))  # the entries hold what is needed of them
    parts = rounds(entries, sets.count())
    gone = written(verified(all_candidates(parts, pairs_with_earliest, ""), docs, id_col, text_col), "lines-gone")
    remove_tables(docs.sparkSession, before, names=("round-pairs", "line-pairs", "line-ends", "candidate-lines"))
    met = all_candidates(parts, lambda part: pairs_of_open(marked_entries(part, gone)), "marked-entries")
    remove_tables(docs.sparkSession, before, names=("shared-entries",))
    more = written(verified(met, docs, id_col, text_col), "lines-gone")
    remove_tables(docs.sparkSession, before, names=("round-pairs", "line-pairs", "line-ends", "candidate-lines"))
    later = gone.union(more).distinct().select(F.col("doc").alias("g_doc"), F.col("line_no").alias("g_no"))
    judged = sets.join(later, (F.col("doc") == F.col("g_doc")) & (F.col("line_no") == F.col("g_no")), "left")
    judged = judged.select(F.col("s1").alias("j1"), F.col("s2").alias("j2"), F.struct("doc", "line_no").alias("first"), F.col("g_doc").isNotNull().alias("later"))
    rows = lines.select("doc", "line_no", "s1", "s2").join(judged, (F.col("s1") == F.col("j1")) & (F.col("s2") == F.col("j2")), "left")
    return rows.select("doc", "line_no", (F.col("j1").isNotNull() & (F.col("later") | (F.struct("doc", "line_no") != F.col("first")))).alias("gone"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per id: n_lines, n_removed, and the numbers (from 0) of the lines to remove, in order.

    A line goes if any line before it (smaller id, then smaller number) has a word set with a Jaccard similarity of 0.75
    or more, words being what white space separates, lower-cased. Lines of fewer than least_words distinct words
    stay. Null and empty texts are one empty line. Null ids rank last and share a row, as do repeated rows of one id,
    whose lines of one number don't precede each other. Extra columns are ignored; an empty table gives an empty
    result."""
    rows = judged_lines(docs, id_col, text_col, least_words)
    numbers = F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("line_no"))))  # the lines of one document
    out = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("gone").alias("n_removed"), numbers.alias("removed"))
    return out.select(F.when(F.col("doc") != LAST_ID, F.col("doc")).alias(id_col), "n_lines", "n_removed", "removed")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """docs with the lines taken out of the texts that removed_lines() names when each different row is a document of its
    own: rows in the order of their ids, then of a hash of their texts, null ids last. So of rows that share an id or have
    none, each keeps what no row before it has; rows that repeat id and text are one document and stay alike. Other columns
    stay, whatever their names. Null texts stay null; a table without rows stays empty.

    A row's key is its place in that order, written once, so that later passes see the same keys."""
    names = {c: f"ld_{k}" for k, c in enumerate(docs.columns)}
    rows, text = docs.toDF(*names.values()), F.col(names[text_col])
    rows = rows.withColumns({"ld_id": F.col(names[id_col]).cast("long"), "ld_h": F.xxhash64(text), "ld_g": F.xxhash64(F.lit(1), text)})
    order = F.col("ld_id").asc_nulls_last(), F.col("ld_h").asc(), F.col("ld_g").asc()
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("ld_key", F.monotonically_increasing_id())
    rows = rows.withColumn("ld_first", F.min("ld_key").over(Window.partitionBy("ld_id", "ld_h", "ld_g"))).drop("ld_id", "ld_h", "ld_g")
    rows = written(rows, "line-rows")
    different = rows.filter("ld_key = ld_first")
    gone = removed_lines(different, "ld_key", names[text_col], least_words).filter("n_removed > 0").select(F.col("ld_key").alias("ld_at"), F.col("removed").alias("ld_gone"))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line, k: ~F.array_contains("ld_gone", k)), "\n")
    shown = F.when(F.col("ld_gone").isNull(), text).otherwise(kept)
    joined = rows.join(gone, F.col("ld_first") == F.col("ld_at"), "left")
    return joined.select(*((shown if c == text_col else F.col(k)).alias(c) for c, k in names.items()))
