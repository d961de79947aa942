"""Archives written and read back."""

import base64
import glob
import hashlib
import random

import pytest

from tallyloom.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string, first_id long, value int, n long"


def awkward(seed=3):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["é", "日本"]
    page = lambda n: "<html>" + " ".join(r.choice(words) for _ in range(n)) + "</html>"
    rows = [(k, f"http://h{k % 7}.example/{k}", page(r.choice([1, 5, 50, 400]))) for k in range(300)]
    rows += [(k, "http://copies.example/", "<html>one of very many</html>") for k in range(1000, 1150)]
    rows += [(400, None, None), (401, "", ""), (402, "http://x.example/a b\r\nWARC-Type: xé", None), (403, "u", "a\r\n\r\nb WARC/1.1\r\n\r\n"), (404, "u", page(60_000)), (405, "u", page(60_000))]
    rows += [rows[5], (None, "u", "only null ids"), (None, "u", "only null ids"), (None, "u", rows[0][2]), (500, "u", "<p>same</p>"), (499, "v", "<p>same</p>"), (501, "u", "x"), (502, "u", "x")]
    return [(*x, "clash", "clash", 7, 1, 2) for x in rows]


def plain(rows, least=0):
    groups = {}
    for i, _, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        ids = [x for x in groups[data] if x is not None]
        first = min(ids, default=None)
        again = first is not None and i != first and len(data) >= least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("least", "small", "piece"), [(0, 50_000, 1 << 20), (2, 0, 3000)])
def test_round_trip(spark, tmp_path, monkeypatch, least, small, piece):
    monkeypatch.setattr(warc, "SMALL", small)
    rows = awkward()
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), str(tmp_path / "w"), least, piece=piece, pieces=4, sample=20_000)
    back = warc.read_archives(spark, str(tmp_path / "w"))
    assert got(back) == plain(rows, least)
    texts = sorted(r.payload.decode() for r in back.where("record_type = 'response'").collect())
    kinds = {x[0]: x[3] for x in plain(rows, least)}
    assert len(texts) == sum(x[3] == "response" for x in plain(rows, least))
    assert max(texts, key=len) == max((x[2] for x in rows if x[2] and kinds[x[0]] == "response"), key=len)


def test_any_reader_of_zstandard_can_read_it(spark, tmp_path):
    rows = awkward()
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "w"))
    data = b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{tmp_path}/w/part-*")))
    assert data[:4] == warc.DICTIONARY_MAGIC and data.count(warc.FRAME_MAGIC) >= len(rows)
    found = [warc.parsed(r) for r in warc.frames_of(memoryview(data))]
    assert len(found) == len(rows)
    plain_size = sum(len((x[2] or "").encode()) for x in rows)
    assert len(data) < plain_size / 2
    urls = {x[0]: x[1] for x in found}
    assert urls[402] == "http://x.example/a%20b%0D%0AWARC-Type:%20x%C3%A9" and urls[400] == "urn:x-page:400"


def test_changed_archives_are_noticed():
    import zstandard

    made = warc.record(1, "u", b"abc", 3, hashlib.sha1(b"abc").hexdigest(), None, "d")
    assert warc.parsed(made)[0] == 1
    with pytest.raises(ValueError):
        warc.parsed(made.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.parsed(made[:-2])
    with pytest.raises(ValueError):
        list(warc.frames_of(memoryview(b"none of it here")))
    broken = bytearray(zstandard.ZstdCompressor(write_checksum=True).compress(made))
    broken[-1] ^= 1
    with pytest.raises(zstandard.ZstdError):
        list(warc.frames_of(memoryview(bytes(broken))))


def test_nothing(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0
