"""Spelling variants against a plain version, on the given tables and on odd ones."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardline.llm import spelling
from wardline.llm.common import Scratch


def words_of(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, ratio=10):
    n = words_of(rows)
    by = defaultdict(set)  # words that share what is left after one letter, or the whole
    for w in n:
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
        by[w].add(w)
    found = defaultdict(set)
    for some in by.values():
        for a in some:
            found[a] |= {b for b in some if a != b and near(a, b)}
    form = {}
    for w in n:
        best = min(found[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(found[w]), n.get(form[w])) for w in n}


def result(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id bigint, text string, word string, n int")
    got = spelling.variants(docs, Scratch(spark, "spelling-test"), **options).collect()
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(found) == len(got)
    return found


def test_index_finds_every_near_word_once():
    rng = random.Random(1)
    for alphabet in ("ab", "abcdé", "abcdefghijklmnop"):
        words = {"".join(rng.choices(alphabet, k=rng.choice([7, 8, 9, 15]))) for _ in range(300)}
        words |= {w[:i] + rng.choice(alphabet) + w[i + rng.randrange(2) :] for w in words for i in [rng.randrange(len(w))]}
        words = [w for w in words if len(w) >= 7]
        index = spelling.BidirectionalIndex(words)
        pairs = []
        for first in (True, False):
            question, place = index.near(words, first)
            pairs += [(words[q], index.words[p]) for q, p in zip(question.tolist(), place.tolist(), strict=True)]
        assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if a != b and near(a, b)}


def test_suffixes_are_sorted():
    rng = np.random.default_rng(2)
    for n in (1, 5, 700):
        text = np.concatenate([[0], rng.integers(0, 3, n), [0]]).astype(np.uint8)
        order = spelling._suffixes(text).tolist()
        assert order == sorted(range(len(text)), key=lambda i: text[i:].tobytes())


def test_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(rows)
    assert result(spark, rows) == expected and len(expected) > 1000 and any(r[1] for r in expected)


@pytest.mark.parametrize("shard_words", [3, 40, 50_000])
def test_variants_and_keys_with_many_words(spark, shard_words):
    rng = random.Random(5)
    base = ["collection", "internal", "señoría", "abcdefg", "aaaaaaa", "aaaaaaaa", "zzzzzzzz"]
    rows = []
    for doc in range(300):
        some = rng.choices(base, weights=[400, 200, 40, 10, 5, 50, 5], k=20)
        for i, w in enumerate(some):
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                some[i] = rng.choice([w[:at] + rng.choice("abÀ×") + w[at:], w[:at] + w[at + 1 :], w[:at] + "q" + w[at + 1 :]])
        rows.append((doc, " ".join(some)))
    expected = plain(rows)
    assert result(spark, rows, shard_words=shard_words) == expected


def test_chains_of_forms(spark):
    # thousandsx -> thousands -> thousand, by n of 2, 30, 400
    rows = [(1, "Thousand " * 400), (2, "thousands-" * 30 + "thousandsx " * 2), (3, None)]
    got = {r[0]: r[1:] for r in result(spark, rows)}
    assert got == {r[0]: r[1:] for r in plain(rows)} and got["thousandsx"] == ("thousands", "thousand", 2, 1, 30)


def test_ties_odd_rows_and_empty_tables(spark):
    long = "ab" * 3_000
    rows = [(1, "abcdefgh " * 5 + "abcdefgi " * 50 + "abcdefgj " * 50), (1, None), (None, "abcdefgh ÀBCDEFG àbcdefg"), (2, ""), (2, "àbcdefg ÀBCDEFG")]
    rows += [(3, f"{long} {long}c {long}"), (4, f"{long}c"), (4, f"{long}c"), (5, "٣ 中文 words"), (6, "abcdefǵ abc×efg÷")]
    got = result(spark, rows)
    assert got == plain(rows)
    assert result(spark, []) == set() == result(spark, [(1, None), (2, "short words")])
