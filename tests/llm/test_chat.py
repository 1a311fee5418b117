from collections import defaultdict

from pyspark.sql import types as T

from sievemill.llm import chat

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("place", T.StringType()), T.StructField("h1", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "h") for r in rows], SCHEMA)


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "user", x or ""))
    seqs = {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in by.items()}
    first, copies = {}, defaultdict(int)
    for c, s in sorted(seqs.items()):
        first.setdefault(s, c)
        copies[s] += 1
    return {(first[s], len(s), copies[s]) for s in first if not any(len(o) > len(s) and o[: len(s)] == s for o in first)}


ROWS = [
    *[(1, k, ("user", "assistant")[k % 2], f"m{k}") for k in range(6)], *[(2, k, ("user", "assistant")[k % 2], f"m{k}") for k in range(4)], *[(3, k + 10, ("user", "assistant")[k % 2], f"m{k}") for k in range(6)],
    (4, 0, "user", "m0"), (5, 0, "assistant", "m0"), (6, 0, None, "m0"), (7, None, "user", None), (7, 0, "user", "b"), (8, 0, "user", ""), (9, 1, "user", "t"), (9, 1, "assistant", "t"), (9, 1, "user", "t"),
    (None, 0, "user", "m0"), (10, 0, "user", "<|im_start|>x"),
]


def test_maximal_conversations(spark):
    rows = chat.format_chats(frame(spark, ROWS)).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in rows} == brute(ROWS)
    by = {r.conv_id: r for r in rows}
    assert by[10].rendered == "<|im_start|>user\n< |im_start|>x<|im_end|>\n" and by[10].assistant_chars == 0
    assert by[1].rendered.startswith("<|im_start|>user\nm0<|im_end|>\n<|im_start|>assistant\nm1<|im_end|>\n") and by[1].assistant_chars == 6


def test_hot_first_turns(spark):
    rows = [(c, k, "user", "hello" if k == 0 else f"{c % 7}-{k}") for c in range(200) for k in range(1 + c % 5)]
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in chat.format_chats(frame(spark, rows)).collect()} == brute(rows)


def test_no_python_in_the_plan(spark, sf):
    plan = chat.op5_chat_snapshots(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert chat.format_chats(frame(spark, [])).count() == 0


def test_equal_turns_with_long_equal_heads(spark):
    head = "h" * 100
    rows = [(1, 0, "user", head + x) for x in ("b", "a", "c")] + [(2, 0, "user", head + x) for x in ("c", "a", "b")] + [(2, 1, "assistant", "é" * 100_000)] + [(3, None, None, "x"), (3, None, None, "x")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()}
    assert set(got) == {2, 3} and got[2].n_turns == 4 and got[3].n_turns == 2
    places = [got[2].rendered.index(head + x) for x in "abc"]
    assert places == sorted(places) and got[2].assistant_chars == 100_000
