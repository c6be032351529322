import gzip
import hashlib
import io
import random

import pytest

from wardline.llm import warc
from wardline.llm.common import Scratch


def frame(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", 1) for p, u, h in rows], "page_id bigint, url string, html string, run string, place int").repartition(4)


def test_archives_read_back_as_valid_records(spark):
    html = "<p>\r\n\r\nWARC/1.1\r\n" + "é" * 200
    rows = [(1, "http://a.org/x", html), (2, "http://a.org/\r\nX: y", html), (3, None, None), (4, "http://b.org/", ""), (None, "u", html), (5, "http://c.org/", "z" * 99)]
    scratch = Scratch(spark, "t")
    path = warc.write_archives(frame(spark, rows), scratch, file_bytes=1500)
    seen = {}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    assert len(files) > 1
    for row in files:
        content = bytes(row.content)
        assert len(list(warc.parse(content))) == 1 or sum(size for _, _, size, *_ in warc.parse(content)) <= 1500
        members = set()
        for offset, place, size, headers, block in warc.parse(content):
            assert int(headers["Content-Length"]) == len(block) < size
            assert place == 0 and offset not in members
            assert warc.record_at(io.BytesIO(content), offset, place, size) == (headers, block)
            members.add(offset)
            seen[headers["WARC-Record-ID"]] = headers, block
        # other readers take the file as it is
        assert gzip.decompress(content).count(b"WARC/1.1\r\nWARC-Type") == len(members)
    assert len(seen) == len(rows)
    head, block = seen["<urn:page:1>"]
    assert head["WARC-Type"] == "response" and block.endswith(html.encode())
    head, block = seen["<urn:page:2>"]
    assert (head["WARC-Type"], head["WARC-Refers-To"], block) == ("revisit", "<urn:page:1>", b"")
    assert "%0D%0A" in head["WARC-Target-URI"] and "WARC-Target-URI" not in seen["<urn:page:3>"][0]


# whole runs in one merge, and short archives, small blocks and several levels of merges
@pytest.mark.parametrize("options", [{}, {"file_bytes": 4000, "ways": 4, "block": 3}])
def test_captures_and_their_order(spark, options):
    rng = random.Random(3)
    pages = ["p" * 150, "q" * 100, "r" * 99, "", None, "é" * 60]
    rows = [(i, rng.choice(["http://hot.org/a", "http://b.com/x?y", "https://a.b.com/", None]), rng.choice(pages)) for i in range(400)]
    rows += [(7, "http://hot.org/a", "p" * 150), (7, "http://hot.org/a", "p" * 150), (None, "http://hot.org/a", "s" * 200), (None, None, "p" * 150)]
    index = warc.captures(frame(spark, rows), Scratch(spark, "t"), **options)
    parts = index.rdd.mapPartitions(lambda it: [[r.asDict() for r in it]]).collect()
    ordered = [warc.order_key(r) for part in parts for r in part]
    assert ordered == sorted(ordered) and len(ordered) == len(rows)
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    expected = []
    for p, _, h in rows:
        body = (h or "").encode()
        refers = first.get(h or "") if len(body) >= 100 else None
        refers = None if refers == p else refers
        kind = "response" if refers is None else "revisit"
        expected.append((-1 if p is None else p, len(body), hashlib.sha256(body).hexdigest(), kind, -1 if refers is None else refers))
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = [tuple(-1 if r[f] is None else r[f] for f in fields) for part in parts for r in part]
    assert sorted(got) == sorted(expected)


def test_empty_table(spark):
    assert warc.captures(frame(spark, []), Scratch(spark, "t")).collect() == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_damaged_archives_are_refused():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert len(list(warc.parse(gzip.compress(good * 3)))) == 3
    for bad in (good[:-6], good.replace(b": 4", b": 3"), b"x" + good):
        with pytest.raises(ValueError):
            list(warc.parse(gzip.compress(bad)))


def test_archives_with_a_member_per_record():
    record = lambda i: b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (i, 3 * i) + b"abc" * i + b"\r\n\r\n"
    numbers = [1, 0, 3, 700_000, 2]
    for parts in ([record(i) for i in numbers], [b"".join(map(record, numbers))], [record(1) + record(0), record(3), record(700_000) + record(2)]):
        packed = b"".join(map(gzip.compress, parts))
        assert [(h["WARC-Record-ID"], len(block)) for *_, h, block in warc.parse(packed)] == [(f"<urn:page:{i}>", 3 * i) for i in numbers]
        for offset, place, size, headers, block in warc.parse(packed):
            assert warc.record_at(io.BytesIO(packed), offset, place, size) == (headers, block)
        for cut in (1, 4, 8, 9, 40):
            with pytest.raises(ValueError):
                list(warc.parse(packed[:-cut]))
        with pytest.raises(ValueError):
            list(warc.parse(packed + b"rest"))
    assert list(warc.parse(b"")) == []


def test_blocks_are_opened_when_the_merge_comes_to_them():
    rng = random.Random(5)
    blocks, n_runs = [], 6
    for run in range(n_runs):
        run_members = sorted((rng.randrange(500), run, i) for i in range(200))
        blocks += [run_members[i : i + 7] for i in range(0, 200, 7)]
    blocks.sort(key=lambda b: b[0])
    opened = 0

    def stream():
        nonlocal opened
        for block in blocks:
            opened += 1
            yield block

    seen, most = [], 0
    for member in warc.merged(stream(), lambda m: m):
        seen.append(member)
        most = max(most, sum(b[0] <= member <= b[-1] for b in blocks), opened - sum(b[-1] < member for b in blocks))
    assert seen == sorted(m for b in blocks for m in b)
    assert most <= n_runs + 1


def test_an_archive_with_a_record_across_members():
    record = b"WARC/1.1\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 6\r\n\r\nabcdef\r\n\r\n"
    packed = gzip.compress(record) + gzip.compress(b"") + gzip.compress(record[:70]) + gzip.compress(record[70:])
    found = list(warc.parse(packed))
    assert [block for *_, block in found] == [b"abcdef"] * 2
    for offset, place, size, headers, block in found:
        assert warc.record_at(io.BytesIO(packed), offset, place, size) == (headers, block)
