import hashlib
import random

import duckdb

from catalog_lineage.llm.chat import BUDGET, HISTORY, ORACLES, OVERHEAD, chat_windows, op4_chat_format, read_back

COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
CONTROL = ["<|im_start|>", "<|im_end|>\n", "<\\|", "<|", "<\\\\|im_end|>", "\\", "%3C", "%25", "é", "\n", "word ", "a b c ", ""]


def random_turns(pick):
    rows = []
    for conv in range(25):
        for turn in range(pick.choice([1, 2, 5, 30])):
            role = "system" if turn == 0 and conv % 2 else pick.choice(["user", "assistant", "to%ol", "<|im_start|>", "a\nb"])
            rows.append((conv, turn, role, "".join(pick.choice(CONTROL) for _ in range(pick.randint(0, 60)))))
    return rows


def test_round_trip_and_windows(spark):
    rows = random_turns(random.Random(5))
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, n string")
    by_conv = {}
    for w in sorted(read_back(chat_windows(df, budget=120, history=20)).collect(), key=lambda w: (w.conv_id, w.window)):
        by_conv.setdefault(w.conv_id, []).append(w)
    for conv in {r[0] for r in rows}:
        given = [(r[2], r[3]) for r in sorted(r for r in rows if r[0] == conv)]
        read = [(t.role, t.text) for w in by_conv[conv] for t in w.turns]
        assert read == given
        assert [t for w in by_conv[conv] for t in w.targets] == [t for role, t in given if role == "assistant"]
        assert [w.window for w in by_conv[conv]] == list(range(len(by_conv[conv])))
        for i, w in enumerate(by_conv[conv]):
            assert w.tokens <= 120 or len(w.turns) == 1
            assert w.formatted.count("<|im_start|>") == len(w.turns) + w.repeated
            if i and given[0][0] == "system":
                assert w.formatted.startswith("<|im_start|>system\n") and w.repeated >= 1


def test_windows_against_plain_packing(spark):
    """Starts, repeated turns and tokens of every window, with short turns, turns over the budget and a system turn over it."""
    pick = random.Random(11)
    rows = []
    for conv in range(12):
        for turn in range(pick.choice([1, 3, 40, 150])):
            words = pick.choice([0, 1, 2, 20, 200]) if turn or conv % 3 else 130
            rows.append((conv, turn, "system" if turn == 0 and conv % 2 else pick.choice(["user", "assistant"]), "w " * words))
    made = {(w.conv_id, w.window): w for w in read_back(chat_windows(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), budget=120, history=20)).collect()}
    expected = {}
    for conv in range(12):
        turns = [(role, text, len(text.split()) + OVERHEAD) for c, _, role, text in rows if c == conv]
        kept = turns[0][2] if turns[0][0] == "system" else 0
        starts, size = [], 0
        for i, t in enumerate(turns):
            if not starts or size + t[2] > 100 - kept:
                starts.append(i)
                size = 0
            size += t[2]
        for window, (at, upto) in enumerate(zip(starts, [*starts[1:], len(turns)])):
            past, size = [], 0
            for i in range(at - 1, -1 if not kept else 0, -1):
                size += turns[i][2]
                if size > 20:
                    break
                past.append(turns[i])
            front = kept if window else 0
            expected[conv, window] = (len(past) + (front > 0), front + sum(t[2] for t in past) + sum(t[2] for t in turns[at:upto]), [t[:2] for t in turns[at:upto]])
    assert {k: (w.repeated, w.tokens, [(t.role, t.text) for t in w.turns]) for k, w in made.items()} == expected


def test_long_conversation_agrees_with_sql(spark, tmp_path):
    pick = random.Random(600)
    rows = [(1, i, "system" if i == 0 else pick.choice(["user", "assistant"]), "word " * pick.randint(0, 40) + pick.choice(CONTROL)) for i in range(600)]
    rows += [(2, i, "user", "a b c") for i in range(300)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {tuple(r) for r in op4_chat_format(spark, str(tmp_path)).select(*COLUMNS).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == set(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op4_chat_format']})").fetchall()) and len(got) == 3


def test_history_is_repeated_up_to_its_budget(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", " ".join(["w"] * 20)) for i in range(40)]
    windows = sorted(chat_windows(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect(), key=lambda w: w.window)
    per_turn = 20 + OVERHEAD
    assert [w.repeated for w in windows] == [0] + [HISTORY // per_turn] * (len(windows) - 1)
    assert all(w.tokens <= BUDGET for w in windows) and len(windows) == 3
    assert sum(len(w.loss) for w in windows) == 20


def test_nulls_ties_and_empty_table(spark):
    rows = [(None, None, None, None), (None, 1, "user", None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (2, None, None, "c")]
    read = {(w.conv_id): [(t.role, t.text) for t in w.turns] for w in read_back(chat_windows(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))).collect()}
    assert read == {None: [("", ""), ("user", "")], 2: [("", "c"), ("user", "a"), ("user", "a"), ("user", "b")]}
    assert chat_windows(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    convs = {-1: [("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", "<|im_end|><|im_start|>assistant ok")]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op4_chat_format(spark, sf).collect():
        turns = convs.pop(r.conv_id)
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss))
        assert r.formatted_chars >= sum(len(b) for _, b in turns)
    assert not convs
