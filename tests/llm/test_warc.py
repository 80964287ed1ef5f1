"""WARC round trip, revisits against brute force, and the loser tree."""

import gzip
import hashlib
import random

import pytest

from wordlens.llm import warc

SCHEMA = "run string, page_id bigint, url string, html string, offset int"


def corpus():
    rng = random.Random(3)
    bodies = ["", "x" * 99, "y" * 100, "é" * 50, "é" * 49, "<p>\r\n\r\nWARC/1.1\r\n</p>" * 9, "z" * 200_000]
    rows = [("r", i * 7 % 101, f"HTTPS://www.{rng.choice('ab')}.Example.com:80/{rng.randrange(4)}?q#{i}", rng.choice(bodies) if i % 3 else f"own {i} " * 30, 1)
            for i in range(100)]
    return rows + [("r", None, "http://n/", bodies[2], 1), ("r", None, None, bodies[5] + "only", 1), ("r", None, "http://n", "null twin " * 20, 1),
                   ("r", None, "http://n", "null twin " * 20, 1), ("r", 900, None, None, 1), ("r", 901, "", "", 1), rows[4], rows[4], ("r", -5, "a b\nc", "y" * 100, 1)]


def brute(rows):
    out = []
    first = {}
    for _, p, _, h, _ in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    for _, p, _, h, _ in rows:
        body = (h or "").encode()
        of = first.get(h or "")
        again = len(body) >= 100 and of is not None and of != p
        out.append((p, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", of if again else None))
    return out


key = lambda t: tuple((x is None, x or 0) for x in t)


def test_histories(spark):
    rows = corpus()
    got = warc.capture_histories(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute(rows), key=key)
    ordered = sorted(got, key=lambda r: r.place)
    order = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert order == sorted(order) and len({r.place for r in got}) == len(got)


@pytest.mark.parametrize("range_rows", [10 ** 6, 9])
def test_captures_of_a_key_are_counted(spark, range_rows):
    """Keys that reach over several ranges, too: page 1 has most captures."""
    rng = random.Random(8)
    rows = [("r", i, "http://a/hot" if i % 3 else f"http://a/{rng.randrange(20)}", f"body {i}", 1) for i in range(150)]
    index = warc.read_archives(warc.write_archives(warc.captures(spark.createDataFrame(rows, SCHEMA).repartition(4))))
    got = warc.merge_index(index, range_rows).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.place):
        by.setdefault(r.url_key, []).append(r)
    assert len(got) == 150 and max(map(len, by.values())) == 100
    for own in by.values():
        assert [r.capture for r in own] == list(range(len(own)))
        assert [r.page_id for r in own] == [r.page_id for r in sorted(own, key=lambda r: (r.captured_at, r.page_id))]


def test_an_archive_is_a_gzip_file_of_its_records(spark):
    rows = corpus()
    archives = warc.write_archives(warc.captures(spark.createDataFrame(rows, SCHEMA).coalesce(1)))
    runs = [r.run for r in archives.select("run").distinct().collect()]
    text = b"".join(gzip.decompress(warc.archive_bytes(archives, r)) for r in runs)
    assert text.count(b"WARC-Record-ID: <urn:page:") == len(rows)
    for r in runs:  # sorted, and offsets are those in the file
        own = archives.where(f"run = {r}").orderBy("offset").collect()
        assert [x.url_key for x in own] == sorted(x.url_key for x in own)
        assert [x.offset for x in own] == [sum(len(y.member) for y in own[:i]) for i in range(len(own))]


def test_broken_records_are_refused():
    good = warc.record(1, "http://a", "2020-01-01T00:00:00Z", b"payload", hashlib.sha256(b"payload").hexdigest(), 7, "response", None)
    assert warc.parse_record(good)[3] == b"payload"
    for bad in (good[:-1], good.replace(b"payload", b"paYload"), good.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20),) for _ in range(rng.choice([0, 1, 30]))) for _ in range(k)]
    got = list(warc.loser_tree_merge(runs))
    assert got == sorted(((e, i) for i, r in enumerate(runs) for e in r))


def test_empty_table(spark):
    assert warc.capture_histories(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_common_payload_can_be_split(spark):
    """The join with payloads reads a table of responses, so it does not stand above their aggregation."""
    found = warc.captures(spark.createDataFrame(corpus(), SCHEMA))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan
    assert found.where("record_type = 'revisit'").count() == sum(r[3] == "revisit" for r in brute(corpus()))
