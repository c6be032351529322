import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardline.llm import token_counts
from wardline.llm.common import Scratch
from wardline.llm.tokens import PieceEncoder, default_path, definition

TOKENIZER = definition(default_path())


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(TOKENIZER)


def expected(rows):
    tool = library()
    texts = [t or "" for _, t in rows]
    found = tool.encode_batch(texts, add_special_tokens=False)
    return sorted(((-1 if d is None else d), len(t.encode()), len(e.ids)) for (d, _), t, e in zip(rows, texts, found, strict=True))


def run(spark, docs):
    got = token_counts.count_tokens(docs, Scratch(spark, "t"), TOKENIZER).collect()
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    return sorted(((-1 if r.doc_id is None else r.doc_id), r.n_bytes, r.n_tokens) for r in got)


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(spark, docs) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("block_bytes", [1, 2000, 1 << 25])
def test_odd_texts_in_blocks_of_any_size(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", block_bytes)
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "<|endoftext|> Hello<|startoftext|>x, y"), (4, "a a a"), (4, "a a a"), (None, "Don't, it's")]
    rows += [(5, "É! ΟΔΟΣ. ﬁ İ  x y ź ,́ a≠b 12345 \x00 \x1c"), (6, "the " * 3000), (7, "x" * 5000)]
    rows += [(10 + i, " ".join(rng.choice(["Über", "the", "a,b", "(x)", "…"]) for _ in range(50))) for i in range(30)]
    docs = spark.createDataFrame([(d, t, b"w", 1) for d, t in rows], "doc_id bigint, text string, words binary, block int")
    assert run(spark, docs.repartition(3)) == expected(rows)


def test_empty_table(spark):
    assert run(spark, spark.createDataFrame([], "doc_id bigint, text string")) == []


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 300_000), st.integers(1, 2000)), unique_by=lambda x: x[:2]))
@settings(max_examples=60, deadline=None)
def test_packed_frequencies_round_trip(entries):
    entries.sort()
    doc, word, times = (np.array([e[k] for e in entries], np.int64) for k in range(3))
    packed, pairs = token_counts.pack_frequencies(doc, word, times, 6)
    got_word, got_times = token_counts.unpack_frequencies(packed, pairs)
    of = np.repeat(np.arange(6), pairs)
    total = {}
    for d, w, n in zip(of.tolist(), got_word.tolist(), got_times.tolist(), strict=True):
        if n:
            total[d, w] = total.get((d, w), 0) + n
    assert total == {(d, w): n for d, w, n in entries}


@given(st.lists(st.text(alphabet=st.sampled_from("aAbéÉ .,'s!?<|>endoftx́ \n\x1cß中1İ"), max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_piecewise_ids_equal_the_library(texts):
    tool = library()
    encoder = PieceEncoder(TOKENIZER)
    for _ in range(2):  # the second time from the table
        got = [x.tolist() for x in encoder.each([t.encode() for t in texts], 1)]
        assert got == [e.ids + [1] for e in tool.encode_batch(texts, add_special_tokens=False)]
