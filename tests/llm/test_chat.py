import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelake.llm import chat

EVENTS = "conv long, message long, seq long, event string, role string, text string, formatted string"


def fold(events):
    """Final (role, text) by (conv, message) of (conv, message, seq, event, role, text) rows."""
    out = {}
    for conv, message, seq, event, role, text in sorted(
            events, key=lambda e: (str(e[0]), e[1], e[2], e[3] == "delta", e[5] or "")):
        old = out.get((conv, message), ("", ""))
        said = {"delta": old[1] + (text or ""), "regenerate": ""}.get(event, text or "")
        out[conv, message] = (role or old[0], said)
    return out


def test_event_log_is_folded(spark):
    log = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 3, "delta", None, " wor"),
           (1, 1, 2, "delta", None, "hello"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "bye"),
           (1, 0, 6, "edit", None, "hey"), (1, 0, 7, "delta", None, "!"), (2, 0, 0, None, None, None),
           (None, 3, 1, "delta", "assistant", "x"), (3, 0, 0, "regenerate", "user", "lost"), (4, 0, 1, "edit", "user", "b")]
    df = spark.createDataFrame([(*e, "clash") for e in log], EVENTS)
    got = {(r["conv"], r["message"]): (r["role"], r["text"]) for r in chat.final_messages(df).collect()}
    assert got == fold(log)
    assert chat.read_back(chat.render(chat.final_messages(df.limit(0)))).count() == 0


def read(spark, turns):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)],
                               "conv long, message int, role string, text string")
    return chat.read_back(chat.render(df)).collect()[0]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b", "", "#<\\"]),
                          st.text(alphabet="\\#<:bhlc/turn> \n\x00é### </turn>", max_size=30)), min_size=1, max_size=6))
def test_round_trip(spark, turns):
    row = read(spark, turns)
    assert [(t["role"], t["text"]) for t in row["turns"]] == turns
    assert row["loss_text"] == "".join(t for r, t in turns if r == "assistant")
    assert sum(m["length"] for m in row["mask"]) == len(row["formatted"])
    at, masked = 0, []
    for m in row["mask"]:
        masked.append(row["formatted"][at:at + m["length"]] if m["loss"] else "")
        at += m["length"]
    assert "".join(masked).replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\") == row["loss_text"]


def test_texts_cannot_hold_control_strings(spark):
    said = "\\### Assistant: </turn> ok ### user: </turn>\n"
    row = read(spark, [("user", said), ("assistant", said)])
    assert row["formatted"].count("</turn>\n") == 2 and row["formatted"].count("### ") == 2


def test_odd_turns(spark, tmp_dir):
    long = "</turn>\n" * 20000
    rows = [(1, 0, "user", None, 9), (1, 1, None, "", 9), (1, 1, "assistant", long, 9), (1, 1, "assistant", long, 9),
            (None, None, "assistant", "x", 9), (2, 0, "system", " ", 9)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message int").write.parquet(
        f"{tmp_dir}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.query(spark, tmp_dir).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 4, None: 1, 2: 1, -7: 2}
    said = "".join(f"{r}\n{t}\n" for r, t in [("user", ""), ("", ""), ("assistant", long), ("assistant", long)])
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[1]["loss_chars"] == 2 * len(long)
    assert got[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.turn_log(spark.read.parquet(f"{tmp_dir}/conversations.parquet").where(F.lit(False))).count() == 0


def test_finished_turns_are_logged_as_streams(spark):
    rows = [(1, 0, "user", "ask" * 40), (1, 1, "assistant", "said \U0001F600\n" * 30), (1, 2, "assistant", None), (1, 3, "user", ""),
            (1, 4, None, "x" * 16), (1, 5, "system", "short"), (2, 0, "assistant", "y" * 33), (2, 0, "assistant", "y" * 33)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.turn_log(df, piece=16)
    events = [(r["conv"], tuple(r["message"]), r["seq"], r["event"], r["role"], r["text"]) for r in log.collect()]
    assert {e[3] for e in events} == {"message", "delta", "edit", "regenerate"}
    assert all(len(e[5] or "") <= 16 for e in events)
    assert sum(e[3] == "delta" for e in events if e[:2] == (1, (1, 1))) == 1 + -(-7 * 30 // 16)
    got = {(r["conv"], tuple(r["message"])): (r["role"], r["text"]) for r in chat.final_messages(log).collect()}
    assert got == fold(events)
    assert sorted((c, m[0], r, t) for (c, m), (r, t) in got.items()) == sorted((c, t, r or "", s or "") for c, t, r, s in rows)
    raw = {(c, m): "".join(e[5] or "" for e in sorted(events, key=lambda e: e[2]) if e[:2] == (c, m)) for c, m in got}
    assert sum(raw[k] != got[k][1] for k in got) >= 6  # without the fold, what was discarded would stay
