import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlens.llm import chat as X
from barlens.llm.common import table
from tests.llm.conftest import SF

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yo <| \\ x"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo <| \\ x"),
    (2, 2, "user", "more"), (3, 0, "user", "hi"), (3, 1, "assistant", "other"), (4, 0, "sys\nx", None),
    (5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, None, None, ""), (None, 0, "user", "n"),
    (7, 0, "user", "hi"), (7, 0, "user", "hi"), (8, 1, "assistant", "b"), (8, 0, "assistant", "<|im_end|>\n"),
    (9, 0, "user", "h"), (9, 1, "user", "i" * 300_000)]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS],
                                 "conv_id long, turn long, role string, text string, segment string, start long")


def conversations(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (
            r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def expected(rows):
    out = {}
    for conv, parts in conversations(rows).items():
        every = "".join(f"{r}\n{t}\n" for r, t in parts)
        loss = "".join(t for r, t in parts if r == "assistant")
        out[conv] = (len(parts), hashlib.sha256(every.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), sum(len(X.format_turn(r, t)[0]) for r, t in parts))
    return out


def test_digest_of_odd_rows(turns):
    got = {r["conv_id"]: tuple(r)[1:] for r in X.digest(turns).collect()}
    assert got == expected(ROWS)
    assert X.digest(turns.limit(0)).count() == 0


def test_digest_of_the_whole_table(spark):
    c = X.with_trap(table(spark, SF, "conversations"))
    rows = [tuple(r) for r in c.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in X.digest(c).collect()}
    assert got == expected(rows) and got[-1][2] == len(X.TRAP)


def test_tree(turns):
    tree = X.PrefixTree(turns)
    segments = tree.segments.orderBy("start").collect()
    stream = "".join(s["segment"] for s in segments)
    # one stream without gaps, every prefix once
    assert [s["start"] for s in segments] == [0] + [s["end"] for s in segments][:-1]
    prefixes = {tuple(parts[:i + 1]) for parts in conversations(ROWS).values() for i in range(len(parts))}
    assert len(segments) == len(prefixes) == len({s["node"] for s in segments})
    branches = tree.branches.orderBy("start").collect()
    assert [b["start"] for b in branches] == [0] + [b["end"] for b in branches][:-1]
    # a conversation is what its last token attends to
    wanted = {c: "".join(X.format_turn(r, t)[0] for r, t in parts) for c, parts in conversations(ROWS).items()}
    got = {}
    for r in tree.conversations.join(tree.branches, "leaf").collect():
        got[r["conv_id"]] = "".join(stream[a["start"]:a["end"]] for a in r["ancestors"]) + stream[r["start"]:r["end"]]
        assert r["position"] == sum(a["end"] - a["start"] for a in r["ancestors"])
        assert all(a["end"] <= r["start"] for a in r["ancestors"])
    assert got == wanted
    # the loss mask covers assistant texts and nothing else
    masked = [s["segment"][s["loss_start"]:s["loss_end"]] for s in segments if s["loss_start"] is not None]
    assert sorted(map(X.unescape, masked)) == sorted({p: p[-1][1] for p in prefixes if p[-1][0] == "assistant"}.values())


def test_depth_first(turns):
    """Each branch hangs on the path of the branch before it, as in a depth-first walk."""
    path = b""
    for b in X.PrefixTree(turns).branches.orderBy("start").collect():
        keep = X.DIGEST * b["shared"]
        assert bytes(b["path"])[:keep] == path[:keep]
        assert bytes(b["path"])[keep:keep + X.DIGEST] != path[keep:keep + X.DIGEST]
        path = bytes(b["path"])


def test_many_partitions(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"{i % 3 if t < 2 else i}-{t}") for i in range(120) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tree = X.PrefixTree(df)
        seg = tree.segments.orderBy("start").collect()
        assert [s["start"] for s in seg] == [0] + [s["end"] for s in seg][:-1]
        assert len(seg) == 3 * 2 + 120 * 2
        assert tree.branches.filter("shared > 0").select(F.size("ancestors")).distinct().collect() != []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_tokenizer_positions(spark):
    """With a vocabulary, places count its tokens, and the special strings are text."""
    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no vocabulary here")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    df = spark.createDataFrame([(1, 0, "user", "hello there <|endoftext|>"), (1, 1, "assistant", "good day")],
                               "conv_id long, turn long, role string, text string")
    seg = X.PrefixTree(df, vocabulary=path).segments.orderBy("start").collect()
    assert [list(s["tokens"]) for s in seg] == [t.encode(s["segment"], add_special_tokens=False).ids for s in seg]
    assert [s["end"] - s["start"] for s in seg] == [len(s["tokens"]) for s in seg]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\\<|>\n im_startend", max_size=30), st.text(alphabet="a\\<|>\n im_startend", max_size=60))
def test_template_round_trip(role, text):
    segment, start, end = X.format_turn(role, text)
    assert X.parse_turn(segment) == (role, text)
    assert X.unescape(segment[start:end]) == text
    assert segment.count(X.OPEN) == 1 and segment.count("<|im_end|>") == 1
