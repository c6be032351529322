import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from wardline.llm import catalog, suffixes
from wardline.llm.common import Scratch

DDL = "doc_id bigint, text string, mark string, key int, runs int"


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], DDL).repartition(3)
    got = suffixes.removal_digests(docs, Scratch(spark, "t"), **options).collect()
    return sorted(((-1 if r.doc_id is None else r.doc_id), *tuple(r)[1:]) for r in got)


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in suffixes.removal_digests(docs, Scratch(spark, "t")).collect())
    assert got == sorted(brute.removal(rows, suffixes.LENGTH))


@pytest.mark.parametrize("group_bytes", [1 << 20, 0])  # 0: every hash goes by fingerprints
def test_passages_copies_and_runs(spark, group_bytes):
    rng = random.Random(7)

    def prose(n):
        return "".join(rng.choice("abcdeé \0") for _ in range(n))

    shared = [prose(n) for n in (24, 25, 40, 90)]
    rows = [(i, prose(rng.randrange(60)) + rng.choice(shared) + prose(rng.randrange(60)) + rng.choice(shared)) for i in range(40)]
    rows += [(100, "a" * 300), (101, "ab" * 200), (102, "b" + "a" * 60), (103, None), (104, ""), (105, shared[0][:-1])]
    rows += [(106, prose(200))] * 2 + [(None, prose(30)), (None, shared[3])]
    got = run(spark, rows, length=24, gram=8, group_bytes=group_bytes)
    expected = sorted(((-1 if d is None else d), *x) for d, *x in brute.removal(rows, 24))
    assert got == expected


def test_long_text_across_scan_slices(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_SLICE", 256)
    rng = random.Random(1)
    body = "".join(rng.choice("abcd") for _ in range(1500))
    keys = suffixes.anchors(suffixes.BYTE_UNITS.values((body + "x" + body).encode()), 24, 8)
    covered = np.concatenate([np.arange(a, b + 1) for _, a, b in zip(*keys, strict=True)])
    assert covered.tolist() == list(range(2 * 1500 + 1 - 23))


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", range(12))
def test_two_stage_order(seed):
    rng = np.random.default_rng(seed)
    data = np.append(rng.integers(1, 2 + seed % 5, 400).astype(np.uint8), np.uint8(0))
    body = data.tobytes()
    order = suffixes.suffix_order(data, 500)
    assert order.tolist() == sorted(range(len(body)), key=lambda p: body[p:])
    places = order[order + 21 <= len(body)]
    expected = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        n = 0
        while n < 21 and body[a + n] == body[b + n]:
            n += 1
        expected.append(n if n == 21 else n // 8 * 8)
    assert suffixes.common_prefixes(data, places, 21).tolist() == expected


@pytest.mark.parametrize("seed", range(12))
def test_two_stage_order_of_some_places(seed):
    rng = np.random.default_rng(seed)
    data = np.append(rng.integers(1, 2 + seed % 5, 400).astype(np.uint8), np.uint8(0))
    wanted = np.zeros(len(data), bool)
    for at in rng.integers(0, 380, 5).tolist():
        wanted[at : at + rng.integers(1, 20)] = True
    order = suffixes.suffix_order(data, 500, wanted)
    assert order[wanted[order]].tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda p: data.tobytes()[p:])


def test_passages_of_over_50_words_are_counted(spark, tmp_path):
    rng = random.Random(11)

    def prose(n, letters="abcdefghij", size=4):
        return " ".join("".join(rng.choice(letters) for _ in range(size)) for _ in range(n))

    planted = [prose(n) for n in (51, 60, 120)] + ["".join(rng.choice("天地玄黃宇宙洪荒") for _ in range(60))]  # the third has 599 bytes, the others under 400
    rows = [(10 * i + k, f"{prose(40, 'uvwxyz')} {p} {prose(40, 'uvwxyz')}") for i, p in enumerate([*planted, prose(50), prose(30)]) for k in range(2)]
    rows += [(100, None), (101, ""), (102, planted[0].replace(" ", ", ")), (103, f"{planted[0]}; {prose(9)} / {planted[1]}")]
    rows += [(104, "é " * 60)] * 2 + [(None, prose(60)), (None, planted[3])]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.QUERIES["op9_two_stage_suffixes"](spark, str(tmp_path)).collect()
    first = sorted(((-1 if r.doc_id is None else r.doc_id), *tuple(r)[1:5]) for r in found)
    assert first == sorted(((-1 if d is None else d), *x) for d, *x in brute.removal(rows, 400))

    expected = []
    for (doc, text), left in zip(rows, brute.cut_passages(rows, 51), strict=True):
        expected.append((-1 if doc is None else doc, len((text or "").encode()) - len(left.encode())))
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_passage_bytes) for r in found) == sorted(expected)
    counts = {r.doc_id: r.n_passages for r in found if r.doc_id is not None}
    assert counts == {doc: 2 if doc == 103 else int(doc < 40 or doc in (102, 104)) for doc in counts}


@pytest.mark.parametrize("unit", [suffixes.BYTE_UNITS, suffixes.WORD_UNITS])
def test_short_texts_are_scanned_together(unit, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é天-'") for _ in range(rng.randrange(90))).encode() for _ in range(100)]
    texts[7:9] = [b"", b"\xff\xe2 a-b " * 20]  # not UTF-8
    expected = []
    for i, text in enumerate(texts):
        expected += [(i, i + 1000, *x) for x in zip(*(c.tolist() for c in suffixes.anchors(unit.values(text), 9, 3)), strict=True)]
    calls = []
    hashes = suffixes.window_hashes
    monkeypatch.setattr(suffixes, "window_hashes", lambda *args: calls.append(1) or hashes(*args))
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(range(1000, 1100)), pa.array(texts)], ["doc_id", "mark", "body"])
    (found,) = suffixes._anchor_rows(9, 3, unit)(iter([batch]))
    assert list(zip(*(c.to_pylist() for c in found.columns), strict=True)) == expected
    assert len(expected) > 100 and len(calls) == 1


@pytest.mark.parametrize("unit", [suffixes.BYTE_UNITS, suffixes.WORD_UNITS])
def test_starts_without_an_equal_context_are_not_sorted(unit, monkeypatch):
    rng = random.Random(6)
    space = "" if unit.width == 1 else " "

    def prose(n, letters="abcdefgh"):
        return "".join(rng.choice(letters) + space for _ in range(n))

    def sorted_of(texts):
        """The marked and the sorted starts, and those that a plain count marks."""
        groups: dict[int, dict[bytes, int]] = {}
        windows: Counter = Counter()
        for text in texts:
            whole = unit.sequences([text.encode()])[0]
            windows.update(whole[p * unit.width : (p + 40) * unit.width] for p in range(len(whole) // unit.width - 39))
            for key, first, last in zip(*(c.tolist() for c in suffixes.anchors(unit.values(text.encode()), 40, 10)), strict=True):
                segment = whole[first * unit.width : (last + 40) * unit.width]
                groups.setdefault(key, {}).setdefault(segment, 0)
                groups[key][segment] += 1
        rows = [(s, k, n) for k, found in groups.items() for s, n in found.items()]
        sizes.clear()
        runs = suffixes.repeated_starts(*(list(c) for c in zip(*rows, strict=True)), 40, 10, unit)
        marked, plain = set(), set()
        for i, ((segment, _, _), found) in enumerate(zip(rows, runs, strict=True)):
            marked |= {(i, p) for a, b in found for p in range(a, b + 1)}
            starts = range(len(segment) // unit.width - 39)
            plain |= {(i, p) for p in starts if windows[segment[p * unit.width : (p + 40) * unit.width]] > 1}
        assert marked == plain
        return len(marked), sum(sizes)

    sizes: list[int] = []
    order = suffixes.suffix_order
    monkeypatch.setattr(suffixes, "suffix_order", lambda data, depth, wanted: sizes.append(int(wanted.sum())) or order(data, depth, wanted))
    gram = prose(12)
    assert sorted_of([prose(60) + gram + prose(60) for _ in range(20)]) == (0, 0)
    passages = [prose(n) for n in (40, 41, 55, 90)]
    marked, in_sort = sorted_of([prose(30) + rng.choice(passages) + prose(30) + rng.choice(passages) for _ in range(30)] + [prose(50, "a"), prose(70, "ab")] * 2)
    assert 0 < marked < 3 * in_sort
