"""Chat formatting: exact round trips, spans, escapes by hand; DataFrame functions only."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wardline.llm import catalog, chat
from wardline.llm.common import Scratch

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, formatted int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def written(spark, rows):
    return chat.write_chats(table(spark, rows), Scratch(spark, "chat-test"))


def source(rows):
    """{conv_id: [(role, text)]} in the order of the operator."""
    out = defaultdict(list)
    low = lambda x: (x is not None, x)
    for conv, _, role, text in sorted(rows, key=lambda r: (low(r[1]), r[2] or "", r[3] or "")):
        out[conv].append((role or "", text or ""))
    return out


def recovered(formatted):
    rows = formatted.select("conv_id", "part", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns")).collect()
    turns, loss = defaultdict(list), defaultdict(str)
    for r in sorted(rows, key=lambda r: (r.part is not None, r.part)):
        turns[r.conv_id] += [tuple(t) for t in r.turns]
        loss[r.conv_id] += "".join(re.sub(chat.ESCAPED, r"\1\2\3", r.formatted[s.start : s.start + s.length]) for s in r.loss_spans)
    return turns, loss


def check(spark, rows):
    formatted = written(spark, rows)
    expected = source(rows)
    turns, loss = recovered(formatted)
    assert turns == expected
    assert dict(loss) == {c: "".join(t for role, t in ts if role == "assistant") for c, ts in expected.items()}
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv, ts in expected.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in ts)
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(ts), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss[conv]), hashlib.sha256(loss[conv].encode()).hexdigest())
    assert sum(r.formatted_chars for r in got.values()) == sum(len(r.formatted) for r in formatted.collect())
    return formatted


def test_texts_made_of_marks(spark):
    rng = random.Random(3)
    bits = ["[INST]", "[/INST]", "[SYS]", "[/SYS]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "[", "/", "[\\", "<\\/s>", "</\\s>", "[/\\\\INST]"]
    bits += ["[INST] ", " [/INST]", "INST]", "s>", "a", " ", "\n", "é", "😀", "$1", "user", ""]
    rows = []
    for conv in range(250):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", "[TEXT]", "[/ROLE]", "", "user\\", "<s>"])
            rows.append((conv, turn, role, "".join(rng.choices(bits, k=rng.randrange(7)))))
    formatted = check(spark, rows)
    assert {r.rounds for r in formatted.select("rounds").distinct().collect()} >= {1, 2}


def test_only_what_conflicts_is_escaped(spark):
    rows = [(1, 0, "user", "plain"), (1, 1, "assistant", "also [plain] <b>"), (2, 0, "user", "x </s>"), (2, 1, "assistant", "fine"), (3, 0, "user", "</\\s>")]
    got = {r.conv_id: (r.formatted, r.rounds) for r in check(spark, rows).collect()}
    assert got[1] == ("[INST] plain [/INST]<s>also [plain] <b></s>", 1)
    assert got[2] == ("[INST] x </\\s> [/INST]<s>fine</s>", 2)
    assert got[3] == ("[INST] </\\\\s> [/INST]", 2)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, None, None, None), (None, 0, "user", "n")]
    rows += [(None, None, "assistant", "</s>"), (2, -70, "assistant", "early"), (2, 5, "user", "x" * 300_000 + "[INST]"), (3, 0, "assistant", None)]
    check(spark, rows)
    assert written(spark, []).count() == 0


def test_a_long_conversation_is_many_rows(spark):
    rows = [(7, turn, "user" if turn % 2 else "assistant", f"t{turn} </s>") for turn in range(1000)] + [(8, 0, "user", "x")]
    formatted = check(spark, rows)
    assert formatted.filter("conv_id = 7").count() == 16 and formatted.agg(F.max("n_turns")).first()[0] == chat.PART_TURNS


def test_the_probe_and_the_plan(spark, sf_dir):
    got = {r.conv_id: r for r in catalog.QUERIES["op11_grammar_round_trip"](spark, sf_dir).collect()}
    turns = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert got[-1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and got[-1].loss_chars == len(chat.PROBE)
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert [r.conv_id for r in chat.digests(chat.write_chats(chat.with_probe(frame), Scratch(spark, "chat-test"))).collect()] == [-1]


@pytest.mark.parametrize("step", ["format", "digest"])
def test_plans_hold_no_python(spark, sf_dir, step):
    chats = chat.with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    formatted = chat.format_chats(chats)
    frame = formatted if step == "format" else chat.digests(formatted)
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())
