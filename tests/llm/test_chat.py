import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from surestar.llm import chat
from surestar.llm.queries import QUERIES

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "[", ">", "end|>", "\n", "s", "é", "😀", "a b"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), PIECES), PIECES), max_size=6))
def test_round_trip(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.parse_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert formatted.count(chat.START) == formatted.count(chat.END) == len(turns)
    assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def brute(messages, best):
    """Best branches per conversation: leaves by falling sum of scores on the way, then by node."""
    out = {}
    for conv in {m[0] for m in messages}:
        own = {m[1]: m for m in messages if m[0] == conv}
        parents = {m[2] for m in own.values()}
        paths = []
        for leaf in own:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at is not None:
                path.append(own[at])
                at = own[at][2] if own[at][2] in own else None
            paths.append((-sum(m[5] or 0 for m in path), leaf, path[::-1]))
        out[conv] = [[(m[3] or "", m[4] or "") for m in p] for _, _, p in sorted(paths, key=lambda p: p[:2])[:best]]
    return out


def test_trees_equal_brute_force(spark):
    import random

    rng = random.Random(8)
    messages = []
    for conv in [0, 1, 2, None]:
        for node in range(rng.choice([1, 2, 40])):
            parent = rng.choice([None, *range(node)]) if rng.random() < 0.2 else node - 1 - rng.randint(0, 2)
            messages.append((conv, node, None if parent is None or parent < 0 else parent, rng.choice(["user", "assistant", None]), rng.choice(["x", None, f"t{node}"]), rng.choice([None, 1.0, 2.0, -1.0])))
    messages.append((5, 10, 99, "user", "the message it answers is missing", 0.0))
    df = spark.createDataFrame(messages, "conv_id long, node long, parent long, role string, text string, score double")
    df = df.selectExpr("*", "1 AS path", "'x' AS up", "2 AS steps", "'y' AS conv")
    for best in (1, 3):
        out = {}
        for r in chat.format_trees(df, best).orderBy("conv_id", "path").collect():
            out.setdefault(r.conv_id, []).append(chat.parse_turns(r.formatted))
        assert out == brute(messages, best)
    assert chat.format_trees(df.limit(0)).count() == 0


def test_long_threads_ties_and_nulls(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(300)]
    rows += [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, None, None, None), (2, 0, "user", "a"), (None, 1, "assistant", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_trees(chat.as_threads(df)).collect()}
    assert chat.parse_turns(out[1].formatted) == [(r[2], r[3]) for r in rows[:300]]
    assert chat.parse_turns(out[2].formatted) == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert chat.parse_turns(out[None].formatted) == [("assistant", "x" * 100_000)]


def test_query(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    out = {r.conv_id: r for r in QUERIES["op4_chat"](spark, folder).collect()}
    assert set(out) == {r[0] for r in rows}
    for conv, got in out.items():
        turns = [r[2:] for r in sorted(r for r in rows if r[0] == conv)]
        whole, loss = "".join(f"{a}\n{b}\n" for a, b in turns), "".join(b for a, b in turns if a == "assistant")
        assert got.n_turns == len(turns) and got.loss_chars == len(loss)
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got.formatted_chars >= sum(len(b) for _, b in turns)


def test_a_cycle_stops_nothing(spark):
    rows = [(1, 1, None), (1, 2, 1), (1, 3, 2), (2, 1, 3), (2, 2, 1), (2, 3, 2), (2, 4, 3), (3, 1, 1), (4, 1, 2), (4, 2, 1), (4, 7, None), (4, 8, 7)]
    rows += [(5, n, n - 1 if n else None) for n in range(33)]
    df = spark.createDataFrame([(c, n, p, "user", f"t{n}", 1.0) for c, n, p in rows], "conv_id long, node long, parent long, role string, text string, score double")
    out = {r.conv_id: [t for _, t in chat.parse_turns(r.formatted)] for r in chat.format_trees(df, 3).collect()}
    assert out == {1: ["t1", "t2", "t3"], 4: ["t7", "t8"], 5: [f"t{n}" for n in range(33)]}
    assert chat.format_trees(df.where("conv_id = 3")).count() == 0
