"""Secret scans: candidates in every text, judged by how many repositories and owners share them."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, map_in_arrow, whole_text, written

#: The kinds in the order of the spans' digest. Fixed values.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # shorter runs fail and hold no longer one
HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds beyond the base ones.
KEY_BLOCK = re.compile(r"-----BEGIN ((?:[A-Z]+ ){0,3}PRIVATE KEY)-----")
WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+")
KINDS = ("assign", "access", "hex", "key_block", "web_token")
BASE = KINDS[:3]
HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)


def key_body(text: str, head: re.Match, before: int) -> str:
    """A private key without white space: up to the END line of its kind, or to the next key or the text's end if none
    stands before. Keys of one type and size share their first characters, so a part of it wouldn't tell them apart."""
    end = text.find(f"-----END {head[1]}-----", head.end(), before)
    return "".join(text[head.end() : end if end >= 0 else before].split())


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and value of all candidates, by start and then kind. Offsets count code points."""
    found = []
    if HINT.search(text):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        heads = list(KEY_BLOCK.finditer(text))
        found += [(m.start(), 3, m.end(), key_body(text, m, after.start() if after else len(text))) for m, after in zip(heads, [*heads[1:], None])]
    if "eyJ" in text:
        found += [(m.start(), 4, m.end(), m[0]) for m in WEB_TOKEN.finditer(text)]
    return [(KINDS[k], start, end, value) for start, k, end, value in sorted(found)]


def joined(found: list[tuple[str, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in found)


FOUND = "row_key string, doc_id long, repo string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, hashes array<string>"


def scan(docs: DataFrame, repo: Column, owner: Column, id_col: str, text_col: str) -> DataFrame:
    """One row per row of docs with the candidates' spans and the digests of their values, never the values."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), repo.alias("repo"), owner.alias("owner"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(3):
                found = candidates(text.as_buffer().to_pybytes().decode("utf-8", "replace"))
                count = [sum(x[0] == kind for x in found) for kind in BASE]
                base = joined([x for x in found if x[0] in BASE])
                out.append((*count, hashlib.sha256(base.encode()).hexdigest(), joined(found), [hashlib.sha256(x[3].encode()).hexdigest()[:32] for x in found]))
            kinds = (*[pa.int64()] * 3, pa.string(), pa.string(), pa.list_(pa.string()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)]
            keys = pa.array([uuid.uuid4().hex for _ in range(batch.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([keys, batch.column(0), batch.column(1), batch.column(2), *columns], names=[x.split()[0] for x in FOUND.split(", ")])

    return map_in_arrow(rows, run, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate's hash: n_repos and n_owners, over all rows. Repeats within a repository collapse before
    the counting, so that a value in a third of all rows sends a row for each repository and task."""
    seen = found.select(F.explode(F.array_distinct("hashes")).alias("hash"), "repo", "owner").groupBy("hash", "repo", "owner").agg(F.lit(1).alias("one"))
    return seen.groupBy("hash").agg(F.count_distinct(F.struct("owner", "repo")).alias("n_repos"), F.count_distinct(F.struct("owner")).alias("n_owners"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"), widely: int = 3) -> DataFrame:
    """One row per row of docs: the base kinds' counts, digest of base spans, all spans, and of the candidates how many
    look live (one owner only), shared (fewer owners than widely) or like copied examples.

    Null text counts as empty: no spans, the digest of nothing. Null owners or repositories count as one owner or
    repository of their own. Repeated rows stay. An empty table gives an empty result; extra columns are ignored."""
    repo = F.to_json(F.struct(*(F.col(c).alias(f"c{k}") for k, c in enumerate(repo_cols))))
    found = written(scan(docs, repo, F.col(owner_col).cast("string"), id_col, text_col), "secrets")
    counts = broadcast_if_small(written(ownership(found), "secret-owners"))
    each = found.select("row_key", F.explode("hashes").alias("hash")).join(counts, "hash")
    alone, wide = F.col("n_owners") == 1, F.col("n_owners") >= widely
    per_row = each.groupBy("row_key").agg(F.count_if(alone).alias("n_live"), F.count_if(~alone & ~wide).alias("n_shared"), F.count_if(wide).alias("n_example"), F.max("n_repos").alias("most_repos"))
    none = F.lit(0).cast("long")
    return found.join(per_row, "row_key", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *(F.coalesce(c, none).alias(c) for c in ("n_live", "n_shared", "n_example", "most_repos"))
    )
