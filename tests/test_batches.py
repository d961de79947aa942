"""Batches of uploads against a serial packer."""

import random

import pytest

from tallyloom.plans import batches


def serial(files, most_bytes, most_files):
    out, held, n, batch = [], 0, 0, 0
    for path, size in sorted(files):
        if n and (n == most_files or held + size > most_bytes):
            batch, held, n = batch + 1, 0, 0
        out.append((path, size, batch))
        held, n = held + size, n + 1
    return out


@pytest.mark.parametrize(("seed", "n", "most_bytes", "most_files", "block"), [(1, 300, 100, 7, 20), (2, 300, 10**9, 9, 9), (3, 200, 1, 5, 40), (4, 500, 60, 500, 50), (5, 1, 5, 5, 5), (6, 120, 50, 1, 30)])
def test_equals_a_serial_packer(spark, seed, n, most_bytes, most_files, block):
    r = random.Random(seed)
    files = [(f"f/{r.randrange(10**6):06d}-{k}", r.choice([0, 0, 1, 5, 30, 70, 400])) for k in range(n)]
    df = spark.createDataFrame(files, "path string, bytes long").repartition(4)
    got = sorted(tuple(x) for x in batches.batches(spark, df, most_bytes, most_files, block).collect())
    assert got == serial(files, most_bytes, most_files)


def test_nothing(spark):
    assert batches.batches(spark, spark.createDataFrame([], "path string, bytes long"), 10, 10).count() == 0
