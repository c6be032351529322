"""Decontamination and URL rules: against SQL and by hand; DataFrame functions only."""

import random
import re

import duckdb
import pytest
from oracle import compare

from wardline.llm import catalog, decontaminate, url_rules


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_match_their_sql(spark, sf_dir, con, name):
    rows, why = compare(catalog.QUERIES[name](spark, sf_dir), con, catalog.SQL[name])
    assert rows and why is None


@pytest.mark.parametrize("name", ["op2_spaced_seeds", "op7_url_rules"])
def test_plans_hold_no_python(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def found(spark, docs, items):
    left = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, item_id int, words string")
    right = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, doc_id int")
    return {(r.doc_id, r.item_id): (r.n_matched, r.doc_word) for r in decontaminate.contaminated(left, right).collect()}


def test_substitutions_within_a_window(spark):
    rng = random.Random(4)
    item = [f"t{i}" for i in range(24)]
    docs, expected = [], set()
    for doc in range(300):
        words = list(item)
        for at in rng.sample(range(24), rng.randrange(0, 14)):
            words[at] = f"other{rng.randrange(9)}"
        docs.append((doc, " ".join(["Lead,"] * rng.randrange(4) + words + ["tail"])))
        same = [a == b for a, b in zip(item, words, strict=True)]
        if any(sum(same[s : s + 16]) >= 13 for s in range(9)):
            expected.add((doc, 1))
    assert set(found(spark, docs, [(1, " ".join(item))])) == expected
    assert 20 < len(expected) < 280


def test_short_items_odd_rows_and_empty_tables(spark):
    short = "one two three four five six seven eight"
    docs = [(1, "X ONE, two three; four five six seven-eight y"), (2, short.replace("four", "4")), (3, short.replace("two", "2").replace("six", "6"))]
    docs += [(4, None), (5, ""), (None, short), (1, "nothing"), (6, "one two four"), (7, f"{short} " * 2000)]
    items = [(1, short), (3, None), (1, short), (4, " - ")]
    assert found(spark, docs, items) == {(1, 1): (8, 1), (2, 1): (7, 0), (None, 1): (8, 0), (7, 1): (8, 0)}
    assert found(spark, [], items) == {} == found(spark, docs, [])


def test_items_of_few_words_and_scripts_without_blanks(spark, tmp_path):
    items = [(n, " ".join(f"k{n}w{i}" for i in range(n))) for n in range(1, 9)] + [(20, "天地玄黃宇宙洪荒"), (21, "天地"), (22, "ก ข")]
    docs = [(n, f"Lead, {text.upper()}; tail") for n, text in items]
    docs += [(100 + n, text.replace("w0", "x0")) for n, text in items]  # one word is another
    docs += [(200, "k3w0 k3w1"), (201, "在天地玄黃之間"), (202, "天x地"), (203, "k2w0... k2w1 k2w1"), (204, None), (205, "天地玄黑宇宙洪荒")]
    got = found(spark, docs, items)
    own = {(n, n) for n, _ in items} | {(120, 20), (121, 21), (122, 22), (20, 21), (120, 21), (205, 21), (205, 20), (201, 21), (203, 2), (108, 8)}
    assert set(got) == own
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/b")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    con.execute(f"create view benchmark as select * from '{tmp_path}/b/*.parquet'")
    assert {(r[0], r[1]): (r[3], r[4]) for r in con.execute(catalog.OP2_SQL).fetchall()} == got


def judged(spark, urls, rules=url_rules.RULES):
    rows = [(i, u, "r", "v") for i, u in urls]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, host string")
    return sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect())


def test_rules_by_hand(spark):
    urls = [(1, "http://A.Example.org/es/x?q#f"), (2, "https://example.org/en/12"), (3, "http://notexample.org/es/"), (4, "http://x.com/de/1")]
    urls += [(5, "http://com/fr/"), (6, "x.org/es/"), (7, None), (8, "http://example.org"), (9, "http://a.org:80/es/"), (9, "http://a.org:80/es/")]
    urls += [(None, "http://org/\n"), (10, ""), (11, "http://x.com/FR/"), (12, "http://x.com/a" * 9000)]
    got = judged(spark, urls)
    assert got[0] == (0, "org", "/\n", "org/", "allow")
    assert [(r[0], *r[3:]) for r in got[1:]] == [
        (1, "example.org/es/", "block"),
        (2, "example.org/en/1", "block"),
        (3, "org/", "allow"),
        (4, "com/de/", "block"),
        (5, "com/fr/", "allow"),
        (6, None, "allow"),
        (7, None, "allow"),
        (8, None, "allow"),
        (9, None, "allow"),
        (9, None, "allow"),
        (10, None, "allow"),
        (11, None, "allow"),
        (12, None, "allow"),
    ]
    assert got[1][1:3] == ("a.example.org", "/es/x") and judged(spark, []) == []


def test_free_patterns_with_and_without_literals(spark):
    rules = (
        url_rules.Rule("sessions", "block", r"/s[0-9]{4,}/"),
        url_rules.Rule("shop basket", "block", r"^(?:[^/]*\.)?shop\.example/.*/basket$", ("h:shop", "h:example", "p:basket")),
    )
    got = judged(spark, [(1, "http://a.b/s12345/x"), (2, "http://www.shop.example/u/basket"), (3, "http://shop.example/basket/x")], rules)
    assert [r[3] for r in got] == ["sessions", "shop basket", None]
