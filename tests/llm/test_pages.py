"""WARC archives and URL filters."""

import base64
import gzip
import hashlib
import pathlib
import random

import pytest

from shelfmark.llm import url_filters, warc
from shelfmark.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, digest string, payload string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h in rows], PAGES)


ROWS = [
    (3, "http://a.com/x\r\ny", "same"),
    (1, "http://b.com", "same"),
    (2, None, "same"),
    (4, "http://c.net/é", "é" * 30_000),
    (5, "", None),
    (6, "x", ""),
    (None, "n", "same"),
    (8, "n", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
    (8, "n", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
    (9, "n", "".join(random.Random(4).choice("abcdefgh") for _ in range(200_000))),
]


def expected():
    first = {}
    for i, _, html in ROWS:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in ROWS:
        payload = (html or "").encode()
        again = first[html or ""] != i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64 << 20, 20_000])
def test_warc_round_trip(spark, folder, split):
    warc.write_pages(frame(spark, ROWS), folder)
    assert sorted((tuple(r) for r in warc.read_pages(spark, folder).collect()), key=str) == expected()
    whole = spark.read.format("warc").option("splitBytes", split).load(folder)
    rows = whole.collect()
    assert len(rows) == len(ROWS)
    stored = {r.record_id: r for r in rows}
    assert bytes(stored["urn:page:4"].payload).decode() == "é" * 30_000
    assert stored["urn:page:1"].payload is not None and stored["urn:page:3"].payload is None
    assert stored["urn:page:3"].refers_to == "urn:page:1" and stored["urn:page:3"].payload_length == 4
    assert stored["urn:page:2"].target_uri is None


def test_warc_pushes_predicates_and_skips_payloads(spark, folder, monkeypatch):
    warc.write_pages(frame(spark, ROWS), folder)
    warc.register(spark)
    found = spark.read.format("warc").load(folder).where("record_type = 'revisit' AND refers_to IS NOT NULL AND target_uri NOT LIKE 'q%'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" not in plan or "record_type" in plan
    assert {r.record_id for r in found.collect()} == {"urn:page:3", "urn:page:"} | {"urn:page:6"}
    # A reader that turns every record down, or needs no payload, inflates the headers only.
    reader = warc.WarcReader(folder, ["record_id"], 1 << 26)
    (only,) = list(reader.partitions())[0].ranges[:1]
    sizes = []
    upto = warc._Member.upto
    monkeypatch.setattr(warc._Member, "upto", lambda self, size: sizes.append(size) or upto(self, size))
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == len(ROWS)
    assert max(sizes) <= warc.HEADER_BYTES


def test_warc_reads_members_without_lengths_and_plain_files(spark, folder):
    row = {"record_type": "response", "record_id": "urn:a", "target_uri": "u", "refers_to": None, "payload": b"x" * 9000}
    one, two = warc.record_bytes(row), warc.record_bytes(row | {"record_id": "urn:b", "payload": b""})
    pathlib.Path(folder, "a.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    pathlib.Path(folder, "b.warc").write_bytes(one + two)
    pathlib.Path(folder, "_hidden").write_bytes(b"no")
    warc.register(spark)
    rows = spark.read.format("warc").load(folder).collect()
    assert sorted((r.record_id, len(r.payload)) for r in rows) == [("urn:a", 9000), ("urn:a", 9000), ("urn:b", 0), ("urn:b", 0)]


def test_warc_of_nothing(spark, folder):
    warc.write_pages(frame(spark, []), folder)
    assert warc.read_pages(spark, folder).count() == 0


def test_failed_tasks_leave_nothing_visible(spark, folder):
    writer = warc.WarcWriter(folder, frame(spark, []).schema, False)
    done = writer.write(iter([]))
    writer.abort([done, None])
    assert list(warc.WarcReader(folder, ["record_id"], 1).partitions()[0].ranges) == []


URLS = [
    "http://a.com/x", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/2", "http://m.example.com/en/", "http://example.com/EN/",
    "http://notexample.com/en/1", "http://a.net/es/1", "http://a.net/fr", "http://net/fr/1", "http://a.org/x", "http://com", "http://a.com?x",
    "no mark", "", None, "http://b.spam-farm.a.org/1", "http://spam-farmer.a.org", "http://x.org/?u=http://spam-farm.b.com/", "http://a.b.c:80/com/",
    "ftp://u@example.com/en/#x", "http://cheap-pills.example.com/en/1", "http://aéb.com/x", "http://casino-win.net/de/", "x" * 100_000 + "://a.com/",
]


def brute(rules, url):
    host, path = url_filters.split_url(url)
    lowered = (url or "").lower() if (url or "").isascii() else (url or "").translate(url_filters._LOWER)
    hosts = [r for r in rules if r.is_host and ("." + host).endswith("." + r.name.partition("/")[0]) and path.startswith("/" + r.name.partition("/")[2])]
    if hosts:
        best = max(hosts, key=lambda r: (len(r.name), r.action == "block", r.name))
        return host, path, best.name, best.action
    inside = lowered.partition("://")
    listed = [r for r in rules if not r.is_host and inside[1] and "." + r.pattern[2:] in "." + inside[2].split("/")[0].split("?")[0].split("#")[0] + "/"]
    return host, path, None, "block" if listed else "allow"


def test_url_filters_match_running_every_rule(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(0, URLS[0], 1), (None, URLS[1], 1)], "page_id long, url string, host int")
    found = url_filters.filtered(pages, URL_RULES).collect()
    assert len(found) == len(URLS) + 2
    for row in found:
        url = URLS[1] if row.page_id is None else URLS[row.page_id]
        assert (row.host, row.path, row.rule, row.verdict) == brute(URL_RULES, url), url
    assert url_filters.filtered(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filters.filtered(pages, []).collect()} == {"allow"}


def test_rules_are_indexed_by_rarest_token():
    counts = {"com": 100, "example": 90, "en": 95, "www": 50, "net": 10, "es": 5, "fr": 6}
    index = url_filters.RuleIndex(URL_RULES, counts)
    assert {r.name for r in index.by_token["www"]} == {"www.example.com/en/"}
    assert {r.name for r in index.by_token["es"]} == {"net/es/"}
    assert index.candidates("http://a.net/de/1") == []
    assert url_filters.pattern_rule("block", "ads*track.").tokens() == set()
    assert url_filters.pattern_rule("block", "/ads/tr*").tokens() == {"ads"}
    loose = url_filters.RuleIndex([url_filters.pattern_rule("block", "ads*track")], {})
    assert loose.judge("http://x.org/myads/1/tracker")[3] == "block" and loose.judge("http://x.org/")[3] == "allow"
