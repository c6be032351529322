import random
import time

import brute
import pytest

from wardline.llm import jaccard
from wardline.llm.common import CLEANUP, Scratch

DDL = "doc_id bigint, text string, node string, n int, key string"


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1, None) for d, t in rows], DDL).repartition(3)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, Scratch(spark, "t")).collect())


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected = sorted((d, *x) for d, x in brute.jaccard_components(rows).items())
    got = sorted(tuple(r) for r in jaccard.near_duplicates(docs, Scratch(spark, "t")).collect())
    assert got == expected


def test_edges_of_the_similarity_and_chains(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for size in (5, 6, 9, 14, 24, 60, 200):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(14):  # each a step further away: chains of links, and pairs about the limit
            rows.append((doc, " ".join(base)))
            doc += 1
            base = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                base[rng.randrange(size)] = rng.choice(words)
            if rng.random() < 0.3:
                base = base[: max(1, size - 2)] + ["tail"] * 2
    passage = " ".join(rng.choice(words) for _ in range(30))
    rows += [(doc + i, f"{passage} " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    expected = sorted((d, *x) for d, x in brute.jaccard_components(rows).items())
    assert run(spark, rows) == expected
    assert len({c for *_, c in expected}) < len(rows)


def test_short_blank_and_null_texts(spark):
    rows = [(1, "a B c"), (2, "A b\tC "), (3, "a b"), (4, None), (5, ""), (6, " \n"), (7, "a b c d e"), (8, "A  B C D\x0bE")]
    assert run(spark, rows) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7)]


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = " ".join(f"x{i}" for i in range(40))
    got = run_rows = jaccard.near_duplicates(
        spark.createDataFrame([(3, long), (3, long), (None, long), (None, None), (9, long + " y")], "doc_id bigint, text string"),
        Scratch(spark, "t"),
    ).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in run_rows) == [(-1, 0, -1), (-1, 36, 3), (3, 36, 3), (3, 36, 3), (9, 37, 3)]
    assert len(got) == 5
    assert run(spark, []) == []


def test_a_very_long_text(spark):
    long = " ".join(f"w{i * i % 9973}" for i in range(120_000))
    rows = [(1, long), (2, long + " and more"), (3, "short one")]
    assert [c for *_, c in run(spark, rows)] == [1, 1, 3]


@pytest.mark.parametrize("texts", [40, 160])
def test_a_shared_template_leaves_few_comparisons(spark, texts):
    rng = random.Random(texts)
    template = " ".join(f"t{i}" for i in range(120))
    rows = [(d, template + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(80))) for d in range(texts)]
    scratch = Scratch(spark, "t")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert all(r.component_id == r.doc_id for r in jaccard.near_duplicates(docs, scratch).collect())
    compared = sum(spark.read.parquet(f"{scratch.path}/{name}-pairs").count() for name in ("stars", "rest"))
    assert compared <= texts


def test_rows_of_tiles_without_a_possible_pair_are_left_out(spark):
    """A long text and the short ones it is made of share shingles, but no tile."""
    words = [f"w{i}" for i in range(400)]
    pieces = [words[max(0, 40 * i - 4) : 40 * i + 40] for i in range(10)]
    rows = [(0, " ".join(words))] + [(i + 1, " ".join(piece)) for i, piece in enumerate(pieces)]
    scratch = Scratch(spark, "t")
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted((d, *x) for d, x in brute.jaccard_components(rows).items())
    assert spark.read.parquet(f"{scratch.path}/open").count() == 0


def test_a_table_leaves_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {path for path in files.getAllFiles().mkString("|").split("|") if "shuffle_" in path}

    before = shuffled()
    spark.range(1000).selectExpr("id % 300 AS k").groupBy("k").count().collect()
    left = shuffled() - before
    assert left  # the plain query's files stay until the driver collects garbage
    table = Scratch(spark, "t").table(spark.range(3000).selectExpr("id % 700 AS k").groupBy("k").count(), "groups")
    for _ in range(100):
        if not shuffled() - before - left:
            break
        time.sleep(0.1)
    assert not shuffled() - before - left
    assert table.count() == 700 and spark.conf.get(CLEANUP) == "false"


@pytest.mark.parametrize("n", range(1, 60))
def test_prefix_holds_a_shared_shingle(n):
    num, den = jaccard.SIMILAR
    least = -(-num * n // den)  # a similar set shares so many at least
    assert jaccard.prefix_size(n) + least > n
