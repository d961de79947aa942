"""Datasets made in parts: one writer, killed runs, merged statistics."""

import decimal
import random
import threading

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import parts
from tallyloom.sources import storage

ROWS = "k int, doc_type string, source string, locale string, design string, sector string, split string, company long, total decimal(18,2)"


def rows(spark, seed=1, n=60):
    r = random.Random(seed)
    one = lambda *x: r.choice(x)
    return [(k, one("invoice", "quote", None), one("a", "b"), one("en", "fr"), "x/y", one("s", "t"), one("train", "test"), r.randrange(9), None if k % 7 == 0 else decimal.Decimal(k)) for k in range(n)]


def plain(given):
    """counter, key, split: number and sum, or number of different companies."""
    out, sets = {}, {}
    for _, doc_type, source, locale, design, sector, split, company, total in given:
        keys = [("by_type", doc_type or "", ""), ("by_source", source, ""), ("by_locale", locale, ""), ("by_layout", design, ""), ("by_sector", sector, ""), ("documents", "", split), ("by_type_split", doc_type or "", split)]
        for key in keys:
            n, v = out.get(key, (0, 0))
            out[key] = n + 1, v + (total or 0)
        sets.setdefault(("companies", "", split), set()).add(company)
    return out | {k: (len(v), 0) for k, v in sets.items()}


def got(state):
    return {(r.counter, r.key, r.split): (r.n, r.value) for r in parts.totals_of(state).collect()}


def frame(spark, given):
    return spark.createDataFrame(given, ROWS).repartition(3)


def test_merging_in_any_order_and_grouping(spark):
    given = rows(spark)
    r = random.Random(2)
    for n_parts in (2, 5):
        of = {k: r.randrange(n_parts) for k in range(len(given))}
        states = [parts.dataset_state(frame(spark, [x for x in given if of[x[0]] == p])) for p in range(n_parts)]
        r.shuffle(states)
        while len(states) > 1:
            take = states[: r.randint(2, len(states))]
            states = [*states[len(take) :], parts.merged(take)]
        assert got(states[0]) == plain(given)
    assert got(parts.dataset_state(frame(spark, []))) == {}


def three(spark, given):
    d = frame(spark, given)
    return {t: (lambda t=t: d.filter(F.coalesce("doc_type", F.lit("other")) == t)) for t in ("invoice", "quote", "other")}


def test_killed_run_resumes(spark, tmp_path):
    given = rows(spark)
    log = parts.PartLog(spark, str(tmp_path / "d"))
    assert log.read() is None and log.state() is None

    def dies(d):
        raise KeyboardInterrupt

    w = parts.Writer(log, "first", lease=0).__enter__()
    w.add("invoice", three(spark, given)["invoice"](), parts.dataset_state)
    with pytest.raises(KeyboardInterrupt):
        w.add("quote", three(spark, given)["quote"](), dies)  # its rows are written, nothing is committed
    assert {r.part for r in log.read().select("part").distinct().collect()} == {"invoice"}
    again = parts.PartLog(spark, str(tmp_path / "d"))
    assert parts.run_parts(again, three(spark, given), parts.dataset_state, lease=0) == ["other", "quote"]
    assert parts.run_parts(again, three(spark, given), parts.dataset_state, lease=0) == []
    assert sorted(r.k for r in again.read().collect()) == list(range(len(given)))
    assert got(again.state()) == plain(given)
    gone = again.vacuum()
    assert len(gone) == 1 and "/data/" in gone[0] and again.read().count() == len(given)


def test_part_made_again_counts_once(spark, tmp_path):
    given = rows(spark)
    log = parts.PartLog(spark, str(tmp_path / "d"))
    parts.run_parts(log, three(spark, given), parts.dataset_state)
    fewer = [x for x in given if x[1] != "quote" or x[0] % 2]
    assert parts.run_parts(log, {"quote": three(spark, fewer)["quote"]}, parts.dataset_state, redo=True) == ["quote"]
    assert got(log.state()) == plain(fewer)
    assert sorted(r.k for r in log.read().collect()) == [x[0] for x in fewer]


def test_two_writers_at_once(spark, tmp_path):
    for k in range(5):
        won, lost = [], []
        start = threading.Barrier(4)

        def go(name, path=str(tmp_path / f"d{k}"), won=won, lost=lost, start=start):
            log = parts.PartLog(spark, path)
            start.wait()
            try:
                parts.Writer(log, name).__enter__()
                won.append(name)
            except parts.Busy:
                lost.append(name)

        threads = [threading.Thread(target=go, args=(f"w{j}",)) for j in range(4)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(won) == 1 and len(lost) == 3
        assert [e["writer"] for e in parts.PartLog(spark, str(tmp_path / f"d{k}")).entries()] == won


def test_writer_that_was_taken_over_commits_nothing(spark, tmp_path):
    now = [100.0]
    log = parts.PartLog(spark, str(tmp_path / "d"))
    old = parts.Writer(log, "old", lease=10, clock=lambda: now[0]).__enter__()
    with pytest.raises(parts.Busy):
        parts.Writer(parts.PartLog(spark, str(tmp_path / "d")), "new", lease=10, clock=lambda: now[0]).__enter__()
    now[0] = 105.0
    old.renew()
    now[0] = 112.0  # past the first lease, within the renewed one
    with pytest.raises(parts.Busy):
        parts.Writer(parts.PartLog(spark, str(tmp_path / "d")), "new", lease=10, clock=lambda: now[0]).__enter__()
    now[0] = 116.0
    new = parts.Writer(parts.PartLog(spark, str(tmp_path / "d")), "new", lease=10, clock=lambda: now[0]).__enter__()
    given = rows(spark)
    with pytest.raises(parts.Fenced):
        old.add("quote", three(spark, given)["quote"](), parts.dataset_state)
    with pytest.raises(parts.Fenced):
        old.__exit__(None, None, None)
    assert log.committed() == {}
    new.add("quote", three(spark, given)["quote"](), parts.dataset_state)
    new.__exit__(None, None, None)
    assert set(log.committed()) == {"quote"} and log.holder() is None


def test_new_files_are_made_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    assert storage.create_new(spark, path, "é") and not storage.create_new(spark, path, "x")
    assert storage.read_text(spark, path) == "é" and storage.names(spark, f"{tmp_path}/a") == ["b.json"]
    assert storage.qualified(spark, "/x").startswith("file:")


def test_card_and_statistics(spark, tmp_path):
    """A card while parts are missing and when all are there; statistics as one object; licences come and go."""
    import json

    given = rows(spark)
    log = parts.PartLog(spark, str(tmp_path / "d"))
    configs = spark.createDataFrame([("all", "train", "data/invoice/train-*.parquet", True, 0)], "config string, split string, paths string, is_default boolean, place int")
    with pytest.raises(ValueError):
        parts.write_card(log, configs, "Papers", ["invoice"], {})
    some = three(spark, given)
    parts.run_parts(log, {"invoice": some["invoice"]}, parts.dataset_state)
    parts.write_card(log, configs, "Papers", sorted(some), {"a.txt": "MIT", "b.txt": "BSD"})
    card = (tmp_path / "d/README.md").read_text()
    assert "# Papers\n\nTypes so far: invoice. To come: other, quote.\n" in card and "- [b.txt](licenses/b.txt)" in card
    parts.run_parts(log, some, parts.dataset_state)
    parts.write_card(log, configs, "Papers", sorted(some), {"a.txt": "MIT 2"})
    assert "Complete: all 3 types are here." in (tmp_path / "d/README.md").read_text()
    assert [p.name for p in sorted((tmp_path / "d/licenses").iterdir()) if p.name[0] != "."] == ["a.txt"] and (tmp_path / "d/licenses/a.txt").read_text() == "MIT 2"
    stats = json.loads((tmp_path / "d/stats.json").read_text())
    want = plain(given)
    assert stats["by_locale"] == {k: n for (c, k, _), (n, _) in want.items() if c == "by_locale"} and stats["documents"] == {s: n for (c, _, s), (n, _) in want.items() if c == "documents"}
    assert {s: len(m) for s, m in stats["companies"].items()} == {s: n for (c, _, s), (n, _) in want.items() if c == "companies"}
    assert stats["by_type_split"]["quote"] == {s: n for (c, k, s), (n, _) in want.items() if c == "by_type_split" and k == "quote"}
