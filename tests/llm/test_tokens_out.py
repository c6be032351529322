"""Wavelet shards and packing: exact round trips."""

import numpy as np
import pytest
from brute import crc

from wardline.llm import packing, wavelet
from wardline.llm.common import Scratch
from wardline.llm.tokens import PieceEncoder, default_path, definition

TOKENIZER = definition(default_path())
ODD = [(5, None), (3, ""), (None, "no id"), (9, "x " * 9000), (4, "same"), (4, "same"), (2, "Héllo, wörld!"), (7, " ")]


def library_ids(rows):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_str(TOKENIZER)
    return [e.ids + [1] for e in tool.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def frame(spark, rows):
    ddl = "doc_id bigint, text string, start int, shard int, part string, block int"
    return spark.createDataFrame([(d, t, 1, 2, "x", 3) for d, t in rows], ddl)


@pytest.mark.parametrize("n", [0, 1, 7, 512, 1025, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix(wavelet.WaveletMatrix.build(ids, 16), n)
    assert matrix.decode().tolist() == ids.tolist()
    for i in range(0, n, max(1, n // 40)):
        assert matrix.access(i) == ids[i]
        token = int(ids[i])
        assert matrix.rank(token, i) == (ids[:i] == token).sum()
        places = np.flatnonzero(ids == token)
        for k in {0, len(places) // 2, len(places) - 1}:
            assert matrix.select(token, k) == places[k]
    assert matrix.rank(49_999) == (ids == 49_999).sum()
    with pytest.raises(IndexError):
        matrix.select(65_535, 0)


def test_shards_hold_all_documents_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    expected, start = [], 0
    for (doc, _), ids in zip(rows, library_ids(rows), strict=True):
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in wavelet.token_digests(spark, docs.repartition(5), TOKENIZER).collect()) == expected


def test_small_shards_answer_counts_and_places(spark):
    rows = [(i, f"alpha beta {'gamma ' * (i % 5)}") for i in range(60)]
    scratch = Scratch(spark, "t")
    shards = wavelet.write_shards(frame(spark, rows), scratch, TOKENIZER, shard_tokens=50)
    assert shards.count() > 5
    assert len({r.f for r in shards.selectExpr("input_file_name() as f").collect()}) == shards.count()
    ids = np.concatenate(library_ids(rows))
    bases = {(r.part, r.shard): r.shard_start for r in wavelet.shard_bases(shards).collect()}
    token = int(library_ids([(0, "gamma")])[0][0])
    counts = wavelet.token_counts(shards, [token, 1]).groupBy("token").sum("n").collect()
    assert {r[0]: r[1] for r in counts} == {token: (ids == token).sum(), 1: 60}
    places = sorted(bases[r.part, r.shard] + r.place for r in wavelet.token_places(shards, token).collect())
    assert places == np.flatnonzero(ids == token).tolist()


def test_odd_rows_in_shards(spark):
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, start = [], 0
    for (doc, _), ids in zip(rows, library_ids(rows), strict=True):
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    got = wavelet.token_digests(spark, frame(spark, ODD).repartition(3), TOKENIZER).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected
    assert wavelet.token_digests(spark, frame(spark, []), TOKENIZER).collect() == []


@pytest.mark.parametrize("length", [1, 7, 2048])
def test_packed_sequences(spark, length):
    rows = ODD + [(100 + i, "word " * (i * 37 % 90)) for i in range(40)]
    sequences = packing.pack(frame(spark, rows).repartition(6), Scratch(spark, "t"), TOKENIZER, length=length).collect()
    by_text = {}
    for (doc, text), ids in zip(rows, library_ids(rows), strict=True):
        by_text.setdefault((doc, len(ids)), (ids, []))[1].append(text)
    total = sum(len(i) for i in library_ids(rows))
    assert sorted(s.sequence_id for s in sequences) == list(range(-(-total // length)))
    covered = {}
    for s in sequences:
        ids, at = np.frombuffer(s.input_ids, "<u4"), 0
        assert len(ids) == s.n_tokens == (length if s.sequence_id < total // length else total % length)
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            part = ids[at : at + p.length].tolist()
            assert part == by_text[p.doc_id, p.doc_tokens][0][p.start : p.start + p.length] and crc(part) == p.ids_crc32
            covered.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length))
            at += p.length
        assert at == len(ids)
    for name, (ids, copies) in by_text.items():
        times = np.zeros(len(ids), int)
        for start, n in covered[name]:
            times[start : start + n] += 1
        assert (times == len(copies)).all()


def test_packing_an_empty_table(spark):
    assert packing.pack(frame(spark, []), Scratch(spark, "t"), TOKENIZER).collect() == []


def test_capitals_that_compose_unlike_their_lower_case():
    pairs = ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c", "E\u0301", "\u00c9"]
    rows = [(i, f"Plain {p}abc, x{p} {p}{p}.Next,{p} AbC {p.lower()}abc") for i, p in enumerate(pairs)]
    got = PieceEncoder(TOKENIZER).each([t.encode() for _, t in rows], 1)
    assert [ids.tolist() for ids in got] == library_ids(rows)
