"""A dataset made in parts by one writer at a time, with statistics that are merged as parts arrive.

A log of numbered entries says what holds. An entry is created only if its number is free, so all writers agree on the order.
A writer's `open` entry is its lock, and the entry's number fences it: once a later writer has opened, an earlier one's next
commit finds that entry before its own and stops. A part's rows, its state and the merged state are written to folders of
their own first; the entry that names them makes them the dataset's, all at once. What a killed run has written but not
committed is never read."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import query
from ..sources import storage
from .dataset import ROWS_SQL, rows_of
from .publish import card_text

LEASE = 3600.0


class Busy(RuntimeError):
    """Another writer holds the dataset."""


class Fenced(RuntimeError):
    """A later writer has taken the dataset over."""


class PartLog:
    """The log of a dataset in parts, and what it names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._seen = spark, storage.qualified(spark, path), []

    def _name(self, number: int) -> str:
        return f"{self.path}/_log/{number:012d}.json"

    def entries(self) -> list[dict]:
        """All entries in order. Entries never change, so only new ones are read."""
        while storage.exists(self.spark, self._name(len(self._seen) + 1)):
            number = len(self._seen) + 1
            self._seen.append({**json.loads(storage.read_text(self.spark, self._name(number))), "number": number})
        return self._seen

    def append(self, number: int, entry: dict) -> bool:
        return storage.create_new(self.spark, self._name(number), json.dumps(entry))

    def committed(self) -> dict[str, dict]:
        """The entry that holds for each part: its last one."""
        return {e["part"]: e for e in self.entries() if e["kind"] == "part"}

    def holder(self) -> dict | None:
        """The writer that has opened last, unless it has closed; `until` as of its last entry."""
        now = None
        for e in self.entries():
            if e["kind"] == "open":
                now = {**e, "fence": e["number"]}
            elif now is not None and e["fence"] == now["fence"]:
                now = None if e["kind"] == "close" else {**now, "until": e["until"]}
        return now

    def read(self) -> DataFrame | None:
        """The rows of all committed parts, with their part; None before the first."""
        parts = [self.spark.read.parquet(e["data"]).withColumn("part", F.lit(p)) for p, e in sorted(self.committed().items())]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def state(self) -> DataFrame | None:
        """The merged state of all committed parts; None before the first."""
        merged = [e["merged"] for e in self.entries() if e["kind"] == "part"]
        return self.spark.read.schema(STATE).parquet(merged[-1]) if merged else None

    def vacuum(self) -> list[str]:
        """Removes folders that no entry names and that no open writer can still commit; returns them."""
        named = {e[k] for e in self.entries() if e["kind"] == "part" for k in ("data", "state", "merged")}
        if (holder := self.holder()) is not None and time.time() < holder["until"]:
            raise Busy(f"{holder['writer']} may still commit")
        found = [f"{self.path}/{k}/{name}" for k in ("data", "state", "merged") for name in storage.names(self.spark, f"{self.path}/{k}")]
        gone = [x for x in found if x not in named]
        for x in gone:
            storage.delete(self.spark, x)
        return gone


class Writer:
    """The single writer of a dataset in parts, from `with` on. A holder whose lease has run out is taken over."""

    def __init__(self, log: PartLog, name: str, lease: float = LEASE, clock: Callable[[], float] = time.time):
        self.log, self.name, self.lease, self.clock, self.fence = log, name, lease, clock, 0

    def __enter__(self) -> Writer:
        while True:
            entries, holder = self.log.entries(), self.log.holder()
            if holder is not None and self.clock() < holder["until"]:
                raise Busy(f"{holder['writer']} holds {self.log.path}")
            number = len(entries) + 1
            if self.log.append(number, {"kind": "open", "writer": self.name, "until": self.clock() + self.lease}):
                self.fence = number
                return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None or not issubclass(kind, Fenced):
            self._append({"kind": "close"})

    def _append(self, entry: dict) -> None:
        """Adds an entry unless a later writer has opened; whether one has is decided by the log's order."""
        while True:
            entries = self.log.entries()
            if any(e["kind"] == "open" and e["number"] > self.fence for e in entries):
                raise Fenced(f"{self.name} (fence {self.fence}) was taken over")
            if self.log.append(len(entries) + 1, {**entry, "fence": self.fence, "until": self.clock() + self.lease}):
                return

    def renew(self) -> None:
        self._append({"kind": "renew"})

    def add(self, part: str, rows: DataFrame, state_of: Callable[[DataFrame], DataFrame]) -> None:
        """Writes a part and its state, merges the state into that of the whole, and commits all three. A part that is there
        already is replaced."""
        log, spark = self.log, self.log.spark
        own = f"{self.fence:012d}-{uuid.uuid4().hex}"
        entry = {"kind": "part", "part": part, **{k: f"{log.path}/{k}/{own}" for k in ("data", "state", "merged")}}
        rows.write.parquet(entry["data"])
        state_of(spark.read.parquet(entry["data"])).write.parquet(entry["state"])
        known, others = log.state(), [e["state"] for p, e in log.committed().items() if p != part]
        if part in log.committed():  # sets can't be taken apart again
            known = spark.read.schema(STATE).parquet(*others) if others else None
        state = spark.read.schema(STATE).parquet(entry["state"])
        (state if known is None else merged([known, state])).coalesce(1).write.parquet(entry["merged"])
        self._append(entry)


def run_parts(log: PartLog, parts: dict[str, Callable[[], DataFrame]], state_of: Callable[[DataFrame], DataFrame], writer: str = "", lease: float = LEASE, redo: bool = False) -> list[str]:
    """Makes the parts that aren't committed yet (all with redo), in the order of their names; returns their names."""
    made = []
    with Writer(log, writer or uuid.uuid4().hex, lease) as w:
        for name in sorted(parts):
            if redo or name not in log.committed():
                w.add(name, parts[name](), state_of)
                made.append(name)
    return made


#: Rows of a state: of counters n and value; of sets a row for each member.
STATE = "kind string, counter string, key string, split string, member string, n long, value decimal(28,2)"


def state(rows: DataFrame, counters: dict[str, tuple[Column, Column]], value: Column, sets: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """The state of some rows: for each counter (key, split) their number and sum of values, for each set (key, split, member)
    its members. Partial sums are formed before anything moves. Nulls count as the empty text."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    item = lambda kind, name, key, split, member, n, v: F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("counter"), text(key).alias("key"), text(split).alias("split"), member.alias("member"), F.lit(n).cast("long").alias("n"), v.cast("decimal(18,2)").alias("value"))
    items = [item("count", name, key, split, F.lit(""), 1, F.coalesce(value, F.lit(0))) for name, (key, split) in counters.items()]
    items += [item("set", name, key, split, text(member), 0, F.lit(0)) for name, (key, split, member) in sets.items()]
    return _summed(rows.select(F.explode(F.array(*items)).alias("x")).select("x.*"))


def _summed(rows: DataFrame) -> DataFrame:
    """Counters add up, members of sets stay members."""
    return rows.groupBy("kind", "counter", "key", "split", "member").agg(F.sum("n").alias("n"), F.sum("value").cast("decimal(28,2)").alias("value"))


def merged(states: list[DataFrame]) -> DataFrame:
    """The state of the rows of all states together, whatever their order and grouping."""
    return _summed(reduce(DataFrame.unionByName, states))


def totals_of(state: DataFrame) -> DataFrame:
    """counter, key, split, n, value: counters as they are, of sets the number of members."""
    n = F.when(F.col("kind") == "set", F.count(F.lit(1))).otherwise(F.sum("n"))
    return state.groupBy("kind", "counter", "key", "split").agg(n.alias("n"), F.sum("value").cast("decimal(28,2)").alias("value")).drop("kind")


def dataset_state(rows: DataFrame) -> DataFrame:
    """The counters of the dataset and its companies by split."""
    none = F.lit("")
    keys = {"by_type": "doc_type", "by_source": "source", "by_locale": "locale", "by_layout": "design", "by_sector": "sector"}
    counters = {name: (F.col(c), none) for name, c in keys.items()} | {"documents": (none, F.col("split")), "by_type_split": (F.col("doc_type"), F.col("split"))}
    return state(rows, counters, F.col("total"), {"companies": (none, F.col("split"), F.col("company"))})



def stats_json(state: DataFrame) -> str:
    """The statistics of a dataset in one JSON object: for each counter its numbers by key, by split, or by key and split;
    for each set its members by split. A few rows for each type of document, and one for each company."""
    out: dict = {}
    for r in state.orderBy("counter", "key", "split", "member").collect():
        if r.kind == "set":
            out.setdefault(r.counter, {}).setdefault(r.split or r.key, []).append(r.member)
        elif r.key and r.split:
            out.setdefault(r.counter, {}).setdefault(r.key, {})[r.split] = r.n
        else:
            out.setdefault(r.counter, {})[r.key or r.split] = r.n
    return json.dumps(out, indent=1, ensure_ascii=False) + "\n"


def write_card(log: PartLog, configs: DataFrame, title: str, wanted: list[str], licences: dict[str, str]) -> None:
    """README.md, stats.json and licenses/ of a dataset in parts, as far as its parts are committed. The card says which
    types are there and which are still to come, until none is; licences are texts by file name. Each file is replaced by
    a whole new one, and licences that aren't given any more go."""
    spark, state = log.spark, log.state()
    if state is None:
        raise ValueError("no part is committed yet")
    done = set(log.committed())
    left = sorted(set(wanted) - done)
    counts = state.filter("counter = 'by_type'").select("key", "n")
    notice = f"Complete: all {len(wanted)} types are here." if not left else f"Types so far: {', '.join(sorted(done))}. To come: {', '.join(left)}."
    card = card_text(configs, counts, title).replace(f"\n# {title}\n", f"\n# {title}\n\n{notice}\n", 1)
    if licences:
        card += "\n## Licences\n\n" + "".join(f"- [{name}](licenses/{name})\n" for name in sorted(licences))
    storage.replace_text(spark, f"{log.path}/README.md", card)
    storage.replace_text(spark, f"{log.path}/stats.json", stats_json(state))
    for name, body in licences.items():
        storage.replace_text(spark, f"{log.path}/licenses/{name}", body)
    for name in set(storage.names(spark, f"{log.path}/licenses")) - set(licences):
        storage.delete(spark, f"{log.path}/licenses/{name}")


_counted = {"by_type": ("doc_type", "''"), "by_source": ("source", "''"), "by_locale": ("locale", "''"), "by_layout": ("design", "''"), "by_sector": ("sector", "''"), "documents": ("''", "split"), "by_type_split": ("doc_type", "split")}


@query(f"with {ROWS_SQL} " + " union all ".join(
    [f"select '{name}' as counter, {key} as key, {split} as split, count(*) as n, sum(total)::decimal(28,2) as value from docs group by all" for name, (key, split) in _counted.items()]
    + ["select 'companies', '', split, count(distinct company), 0::decimal(28,2) from docs group by 3"]))
def incremental_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a dataset made in parts by type: a first run is killed after one part, a second one takes over and makes
    the others; the state merged from part to part equals that of the whole."""
    rows = rows_of(spark, sf_dir)
    log = PartLog(spark, storage.work_folder(spark, "parts"))
    parts = {t: (lambda t=t: rows.filter(F.col("doc_type") == t)) for t in ("invoice", "quote", "receipt")}
    first = Writer(log, "first", lease=0).__enter__()  # it never closes
    first.add("quote", parts["quote"](), dataset_state)
    run_parts(log, parts, dataset_state, "second")
    return totals_of(log.state())
