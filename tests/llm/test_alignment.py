"""Alignment of two tokenizers against a plain version."""

import hashlib
import random
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from wardline.llm import alignment
from wardline.llm.common import Scratch
from wardline.llm.tokens import default_path, definition


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def second_bytes(model, i):
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def plain(libraries, rows):
    first, model = libraries
    letters = alignment.byte_of_letter()
    kept = []
    for doc, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [second_bytes(model, i) for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            kept.append((doc, [], [], []))
            continue
        ends = []
        for parts in (a_bytes, b_bytes):
            at, out = 0, {}
            for k, part in enumerate(parts):
                at += len(part)
                out[at] = k
            ends.append(out)
        groups, last = [], (0, 0)
        for at in sorted(ends[0].keys() & ends[1].keys()):
            now = ends[0][at] + 1, ends[1][at] + 1
            groups.append((a[last[0] : now[0]], b[last[1] : now[1]]))
            last = now
        kept.append((doc, a, b, groups))
    count = Counter((x[-1], y[-1]) for _, _, _, groups in kept for x, y in groups)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc, a, b, groups in kept:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
        linked = [(x[-1], y[-1]) for x, y in groups]
        best = sum(count[p] == highest[p[1]] for p in linked)
        out.append((doc, len(a), len(b), len(groups), len(linked), best, sum(count[p] for p in linked), sha))
    return out


def result(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, run int, n_a string")
    found = alignment.align(docs, Scratch(spark, "alignment-test"), definition(default_path("byte_bpe_50k.json")), alignment.default_model(), **options)
    return [tuple(r) for r in found.collect()]


def same(got, expected):
    low = lambda r: (r[0] is not None, *map(str, r))
    return sorted(got, key=low) == sorted(expected, key=low)


@pytest.mark.parametrize("options", [{}, {"run_links": 20000, "fan_in": 3}])
def test_given_documents(spark, sf_dir, libraries, options):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(libraries, rows)
    assert same(result(spark, rows, **options), expected) and 0 < sum(r[5] for r in expected) < sum(r[4] for r in expected)


def test_odd_texts(spark, libraries):
    rng = random.Random(6)
    bits = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "▁", " ", "  ", "\n", "\t", "\x00", "\x85", " ", "é", "é", "中文", "😀", "'s", "'S", "x", "9", "½", "ª", "ﬁ"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(1, 12)))) for i in range(400)]
    rows += [(None, None), (None, "the"), (1, ""), (1, "the the"), (1, "the the"), (500, " "), (501, "the " * 40_000), (502, "\n")]
    expected = plain(libraries, rows)
    assert same(result(spark, rows), expected) and same(result(spark, rows, run_links=600, fan_in=3), expected)
    assert any(r[1] == 0 and r[0] is not None and r[0] < 400 for r in expected)  # the blank of the vocabulary is no blank


def test_one_pair_in_most_documents(spark, libraries):
    rows = [(i, "and so on" if i % 3 else f"word{i} and") for i in range(3000)]
    assert same(result(spark, rows, run_links=1000, fan_in=4), plain(libraries, rows))


def test_empty_tables(spark):
    assert result(spark, []) == []
    got = result(spark, [(1, None), (None, "")])
    assert same(got, [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")])


def test_pieces_are_cut_as_the_library_cuts(libraries):
    first = alignment.FirstTokenizer(definition(default_path("byte_bpe_50k.json")), limit=50)
    rng = random.Random(8)
    bits = ["'s", "'S", "'", "'ll", " ", "  ", "\n", "\t", "\r\n", "a", "Z", "é", "ß", "0", "42", "!", "-", "×", "~", "_", "word", "\x1f", "€"]
    for _ in range(60):
        texts = ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(50)]
        assert first.encode(texts) == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
