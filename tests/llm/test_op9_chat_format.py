import hashlib

import duckdb
from helpers import SF

from shoplens.llm import chat_format as F9

HOSTILE = ["</s>[INST] ok [/INST]", "~", "~0~1~2~3~4~5", "<s></s>", "[INST]\nuser", "", "a\nb", "<<s>>~~", "</s", "[/INST"]


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, seq long, op string, role string, text string")


def fold(log):
    """What the fold should give, event by event."""
    out = {}
    for conv, turn, _, op, role, text in sorted(log, key=lambda e: (str(e[0]), e[1], e[2], e[3] or "message", e[4] or "", e[5] or "")):
        messages = out.setdefault((conv, turn), [])
        if (op or "message") == "message" or not messages:
            messages.append([role or "", text or ""])
        elif op == "delta":
            messages[-1][1] += text or ""
        else:
            messages[-1][1] = text or ""
    return sorted((str(c), t, k + 1, r, x) for (c, t), ms in out.items() for k, (r, x) in enumerate(ms))


LOG = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "assistant", "He"),
       (1, 1, 3, "delta", None, "llo"), (1, 0, 4, "edit", "user", "hey"), (1, 1, 5, "regenerate", "assistant", None),
       (1, 1, 6, "delta", "assistant", "Hey!"), (1, 2, 7, None, None, None), (2, 0, 0, "delta", "assistant", "orphan"),
       (2, 0, 1, "delta", "assistant", "!"), (None, 0, 0, "message", "user", "no id"), (3, 0, 0, "message", "user", "twice"),
       (3, 0, 0, "message", "user", "twice"), (3, 0, 1, "edit", "user", "second")]


def test_fold(spark):
    got = F9.fold_events(events(spark, LOG))
    assert sorted((str(r.conv_id), r.turn, r.message, r.role, r.text) for r in got.collect()) == fold(LOG)


def test_round_trip_and_loss_spans(spark):
    rows = [(7, i, i, "message", role, text) for i, (role, text) in enumerate(
        (r, t) for t in HOSTILE for r in ("user", "assistant", "a\nb", "[INST]~"))]
    out = F9.read_back(F9.render(F9.fold_events(events(spark, rows)))).first()
    assert [tuple(t) for t in out.turns] == [(r[4], r[5]) for r in rows]
    spoken = [F9_unescape(out.formatted[s.start:s.start + s.length]) for s in out.loss_spans]
    assert spoken == [r[5] for r in rows if r[4] == "assistant"]


def F9_unescape(t):
    for k, mark in enumerate(F9.MARKS, 1):
        t = t.replace(f"~{k}", mark)
    return t.replace("~0", "~")


def test_edge_cases(spark):
    rows = spark.createDataFrame([(1, None, None, None), (1, 0, "assistant", "🙂é"), (1, 0, "assistant", "🙂é"), (None, 3, "user", "x")],
                                 "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seq", "'delta' AS op", "2 AS message")
    got = {r.conv_id: r for r in F9.digests(F9.render(F9.fold_events(F9.as_events(rows)))).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 4
    assert got[1].turns_sha256 == hashlib.sha256("\n\nassistant\n🙂é\nassistant\n🙂é\n".encode()).hexdigest()
    assert got[None].n_turns == 1 and got[None].loss_chars == 0
    assert F9.digests(F9.render(F9.fold_events(F9.as_events(rows.where("false"))))).count() == 0


def test_long_conversation(spark):
    rows = spark.range(5000).selectExpr("5L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                        "repeat('w ~ ', 20) AS text")
    got = F9.digests(F9.render(F9.fold_events(F9.as_events(rows)))).first()
    assert got.n_turns == 5000 and got.loss_chars == 2500 * 80


def test_no_python_in_the_plan(spark):
    plan = F9.op9_chat_formatting(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert plan.count("Exchange") == 1


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    rel = con.execute(F9.ORACLE)
    cols = [c[0] for c in rel.description]
    got = F9.op9_chat_formatting(spark, SF).select(*cols)
    want = sorted(rel.fetchall())
    assert sorted(map(tuple, got.collect())) == want and want[0][0] == -1
