"""Ingest of database dumps, delimited bulk files, JSON lines, company files and JDBC tables."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokens of T-SQL: comments, literals, names in brackets or quotes, numbers, plain names, and single signs.
TOKEN = re.compile(
    r"(?P<blank>\s+|--[^\n]*|/\*.*?\*/)|(?P<string>[Nn]?'(?:[^']|'')*')|(?P<name>\[(?:[^\]]|\]\])*\]|\"(?:[^\"]|\"\")*\")|(?P<binary>0[xX][0-9A-Fa-f]*)"
    r"|(?P<number>[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)|(?P<word>[^\W\d]\w*)|(?P<sign>.)",
    re.DOTALL,
)


class Statement:
    """One INSERT, read token by token."""

    def __init__(self, script: str) -> None:
        self.tokens = [(m.lastgroup, m[0]) for m in TOKEN.finditer(script) if m.lastgroup != "blank"]
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *texts: str) -> bool:
        """Steps over one of these words or signs."""
        kind, text = self.peek()
        if kind in ("word", "sign") and text.upper() in texts:
            self.at += 1
            return True
        return False

    def expect(self, text: str) -> None:
        if not self.take(text):
            raise ValueError(f"{text} expected, {self.peek()[1] or 'the end'} found")

    def name(self) -> str:
        kind, text = self.peek()
        if kind not in ("name", "word"):
            raise ValueError(f"a name expected, {text or 'the end'} found")
        self.at += 1
        return text[1:-1].replace(2 * text[-1], text[-1]) if kind == "name" else text

    def value(self) -> str | None:
        kind, text = self.peek()
        if kind not in ("string", "binary", "number") and text.upper() != "NULL":
            raise ValueError(f"a value expected, {text or 'the end'} found")
        self.at += 1
        if kind == "string":
            return text[text.index("'") + 1 : -1].replace("''", "'")
        return None if kind == "word" else text

    def listed(self, item) -> list:
        """Items in parentheses, with commas between them."""
        self.expect("(")
        out = [item()]
        while self.take(","):
            out.append(item())
        self.expect(")")
        return out


def inserts(script: str) -> Iterator[tuple[str | None, list[str] | None, list[str | None] | None, str | None]]:
    """Table, columns (None if not listed), values and None for each inserted row; of a statement that can't be read its
    table and columns as far as known, no values, and why. Other statements are stepped over."""
    s = Statement(script)
    while s.peek()[0] != "end":
        if not s.take("INSERT"):
            s.at += 1
            continue
        table = columns = None
        try:
            s.take("INTO")
            table = s.name()
            while s.take("."):
                table = s.name()
            columns = s.listed(s.name) if s.peek()[1] == "(" else None
            s.expect("VALUES")
            rows = [s.listed(s.value)]
            while s.take(","):
                rows.append(s.listed(s.value))
            for row in rows:
                if columns is not None and len(row) != len(columns):
                    raise ValueError(f"{len(row)} values for {len(columns)} columns")
        except ValueError as e:
            yield table, columns, None, str(e)
            continue
        for row in rows:
            yield table, columns, row, None


DUMP = "table_name string, values array<string>, named map<string, string>, error string"
DUMP_ARROW = pa.schema([("table_name", pa.string()), ("values", pa.list_(pa.string())), ("named", pa.map_(pa.string(), pa.string())), ("error", pa.string())])

#: Where a line of a dump can begin: in plain text, a string, a name in quotes or brackets, or a comment.
PLAIN, STRING, QUOTED, BRACKETED, COMMENT = range(5)
OPENING = re.compile(r"'|\"|\[|--|/\*")
OPENS = {"'": STRING, '"': QUOTED, "[": BRACKETED, "/*": COMMENT}
CLOSES = {STRING: "'", QUOTED: '"', BRACKETED: "]"}
#: In plain text a line that begins so begins a statement.
CUT = re.compile(r"\ufeff?\s*(insert|go)\b", re.IGNORECASE)


def after(line: str, state: int) -> int:
    """Where the next line begins, if this one begins in a state."""
    at = 0
    while True:
        if state == PLAIN:
            m = OPENING.search(line, at)
            if m is None or m[0] == "--":
                return PLAIN
            state, at = OPENS[m[0]], m.end()
        elif state == COMMENT:
            at = line.find("*/", at) + 2
            if at == 1:
                return COMMENT
            state = PLAIN
        else:
            sign = CLOSES[state]
            at = line.find(sign, at)
            if at < 0:
                return state
            doubled = line[at + 1 : at + 2] == sign
            at += 1 + doubled
            state = state if doubled else PLAIN


def ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """File, start and lines of each byte range among a task's lines."""
    rows = ((file, start, line) for b in batches for file, start, line in zip(*(b.column(c).to_pylist() for c in ("file", "start", "value")), strict=True))
    for (file, start), own in itertools.groupby(rows, key=lambda r: r[:2]):
        yield file, start, (line for _, _, line in own)


def composed(lines: Iterator[str]) -> tuple[list[int], list[bool]]:
    """For each state that a range may begin in: the one it ends in, and whether a statement begins within it."""
    now, cut = list(range(5)), [False] * 5
    for line in lines:
        begins = CUT.match(line) is not None
        cut = [c or (begins and s == PLAIN) for c, s in zip(cut, now, strict=True)]
        then = {s: after(line, s) for s in set(now)}
        now = [then[s] for s in now]
    return now, cut


def statements(lines: Iterator[str], state: int, first: bool) -> Iterator[tuple[bool, str]]:
    """The texts of a range between its cuts, and whether each begins with one; the first range of a file does."""
    own, begun = [], first
    for line in lines:
        if state == PLAIN and CUT.match(line):
            if own or begun:
                yield begun, "\n".join(own)
            own, begun = [], True
        own.append(line)
        state = after(line, state)
    yield begun, "\n".join(own)


def dump_rows(scripts: Iterable[str]) -> Iterator[pa.RecordBatch]:
    """The rows that scripts insert, in batches."""
    rows = ((table, row, list(zip(columns, row, strict=True)) if row is not None and columns else None, why) for script in scripts for table, columns, row, why in inserts(script))
    while some := list(itertools.islice(rows, 4096)):
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*some, strict=True), DUMP_ARROW, strict=True)], schema=DUMP_ARROW)


def sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """A row for each row inserted by dumps: its table, values in their order (null for NULL) and, where the statement lists
    columns, by name. A statement that can't be read gives a row with an error. A statement begins with a line that begins
    with INSERT or GO outside strings, names and comments; lines end with a line feed, with or without a return.

    Files are read in byte ranges. A first pass maps, for each range, every state that it may begin in to the one that it
    ends in; a few numbers a range go to the driver, which chains them and so knows where each range really begins. A second
    pass cuts the ranges at statements. Those within a range are read where they are; only what the ranges' edges leave of a
    statement moves, to be put together with its other pieces."""
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, own in ranges_of(batches):
            ends, cuts = composed(own)
            yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "ends": ends, "cuts": cuts}])

    found = lines.mapInArrow(compose, "file string, start long, ends array<long>, cuts array<boolean>").collect()
    begins, owner = {}, {}
    for file, ranges in itertools.groupby(sorted(found), key=lambda r: r["file"]):
        state, last = PLAIN, None
        for r in ranges:
            begins[file, r["start"]], owner[file, r["start"]] = state, last
            last = r["start"] if last is None or r["cuts"][state] else last
            state = r["ends"][state]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int | None, list[tuple[bool, str]]]]:
        for file, start, own in ranges_of(batches):
            yield file, start, owner[file, start], list(statements(own, begins[file, start], owner[file, start] is None))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, own in pieces(batches):
            yield from dump_rows(text for begun, text in own[:-1] if begun)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, before, own in pieces(batches):
            ends = [own[0], *own[1:][-1:]] if not own[0][0] else own[-1:]
            rows = [{"file": file, "owner": start if begun else before, "start": start, "text": text} for begun, text in ends]
            yield pa.RecordBatch.from_pylist(rows, EDGE)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from dump_rows(b.column("script").to_pylist())

    cut = lines.mapInArrow(edges, "file string, owner long, start long, text string").groupBy("file", "owner")
    joined = cut.agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "text"))).getField("text"), "\n").alias("script"))
    return lines.mapInArrow(inside, DUMP).unionByName(joined.select("script").mapInArrow(read, DUMP))


EDGE = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("text", pa.string())])


#: Two-digit years from here on belong to the last century. Fixed value.
CENTURY_TURN = 69


def us_date(x: Column) -> Column:
    """Month, day and year (of four or two digits), with or without a time; null if it is none."""
    day = F.substring_index(F.trim(x), " ", 1)
    short = F.regexp_extract(day, "^\\d{1,2}/\\d{1,2}/(\\d{2})$", 1)
    century = F.when(short.try_cast("int") >= CENTURY_TURN, "19").otherwise("20")
    long_ = F.when(short != "", F.concat(F.regexp_extract(day, "^(\\d{1,2}/\\d{1,2}/)", 1), century, short)).otherwise(day)
    return F.coalesce(F.try_to_date(long_, "M/d/yyyy"), F.try_to_date(day, "yyyy-MM-dd"))


def delimited(spark: SparkSession, path: str, columns: list[str], field: str = "\t", row: str = "\n", encoding: str = "UTF-8") -> DataFrame:
    """Bulk files with free terminators of fields and rows, in any encoding whose terminators are whole bytes (UTF-16 is
    little-endian; say UTF-16BE for the other). Rows are cut as bytes, so large files are read in parallel. Short rows are
    dropped, empty fields are null, a byte-order mark and a return before a line feed are skipped."""
    encoding = "UTF-16LE" if encoding.upper() in ("UTF-16", "UTF16") else encoding
    # The reader cuts at the terminator's bytes and leaves the others as they are.
    lines = spark.read.option("encoding", encoding).text(path, lineSep=row)
    value = F.decode(F.col("value").cast("binary"), encoding)
    value = F.regexp_replace(value, "^\\uFEFF", "")
    value = F.regexp_replace(value, "\r$", "") if row == "\n" else value
    rows = lines.select(F.split(value, re.escape(field), -1).alias("p")).filter(F.size("p") >= len(columns))
    return rows.select(*(F.nullif(F.get("p", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(columns)))


def json_lines(spark: SparkSession, path: str, schema: str, ok_only: bool = False) -> DataFrame:
    """Manifest lines under an explicit schema; lines that aren't JSON give nulls."""
    rows = spark.read.schema(schema).json(path)
    return rows.filter("status = 'ok'") if ok_only else rows


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file: path and parsed value."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select("path", F.from_json("value", schema).alias("doc"))


def jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int = 16) -> DataFrame:
    """A database table in parallel ranges of its key; needs the database's driver on the class path."""
    options = {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options).load()
