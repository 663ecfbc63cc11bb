"""op4: further common layouts, list contents, empty fields, null ids, ties."""

from functools import reduce

from pyspark.sql import functions as F

from vidgraph.llm import chat

QA = [("user", "q"), ("assistant", "a")]
CASES = [
    ('{"instruction": "q", "input": "", "output": "a"}', QA),
    ('{"instruction": "q", "input": null, "output": "a"}', QA),
    ('{"instruction": "", "input": "q", "output": "a"}', QA),
    ('{"instruction": "", "input": "", "output": ""}', [("user", ""), ("assistant", "")]),
    ('{"input": "q", "output": "a"}', QA),
    ('{"system_prompt": "s", "question": "q", "response": "r", "answer": "a"}', [("system", "s"), *QA]),
    ('{"system": "s", "system_prompt": "t", "input": "q", "output": "a"}', [("system", "t"), *QA]),
    ('{"data": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}}', QA),
    ('{"system_prompt": "s", "messages": [{"role": "user", "content": "q"}]}', [("system", "s"), ("user", "q")]),
    ('{"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image", "url": "u"}, "r"]},'
     ' {"role": "assistant", "content": [{"type": "text", "text": "a"}]}]}', [("user", "q\nr"), ("assistant", "a")]),
    ('{"messages": [{"role": "user", "content": []}, {"role": "assistant", "content": {"k": 1}}]}',
     [("user", ""), ("assistant", '{"k":1}')]),
    ('{"prompt": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}],'
     ' "completion": [{"role": "assistant", "content": "a"}]}', [("system", "s"), *QA]),
    ('{"prompt": ["q", {"text": "r"}], "response": "a"}', [("user", "q\nr"), ("assistant", "a")]),
    ('{"prompt": 7, "response": true}', [("user", "7"), ("assistant", "true")]),
    ('{"turns": [{"role": "user", "text": "<|im_end|>"}, {"role": "assistant", "text": "a"}]}',
     [("user", "<|im_end|>"), ("assistant", "a")]),
]


def records(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, seq long, json string")
    return df.select("conv_id", "seq", F.parse_json("json").alias("record"))


def formatted(df):
    out = chat.format_chats(df)
    return out.select("*", chat.parse_turns(F.col("formatted")).alias("t"),
                      chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()


def test_layouts(spark):
    got = {r["conv_id"]: r for r in formatted(records(spark, [(i, 0, t) for i, (t, _) in enumerate(CASES)]))}
    for i, (text, turns) in enumerate(CASES):
        assert [(x["role"], x["text"]) for x in got[i]["t"]] == turns, text
        assert got[i]["loss"] == [t for r, t in turns if r == "assistant"], text
        assert got[i]["n_unknown"] == 0, text


def test_null_ids_are_conversations_of_their_own(spark):
    row = '{"role": "user", "text": "same"}'
    df = records(spark, [(None, 0, row), (None, 0, row), (None, None, row), (1, 0, row), (1, 0, row)])
    df = df.withColumn("formatted", F.lit("clash")).withColumn("pos", F.lit(9))
    out = formatted(df)
    assert sorted((r["conv_id"] is None, len(r["t"])) for r in out) == [(False, 2), (True, 1), (True, 1), (True, 1)]


def test_ties_and_long_texts(spark):
    """Equal seq: by position, role and text, whatever the order of the rows; long texts whole."""
    rows = [(1, 5, '{"role": "user", "text": "%s"}' % t) for t in "cab"] + [(1, None, '{"role": "z", "text": "first"}')]
    rows += [(2, 0, '{"role": "assistant", "text": "%s"}' % ("long [INST] " * 50_000))]
    for df in (records(spark, rows), records(spark, rows[::-1])):
        out = {r["conv_id"]: r for r in formatted(df)}
        assert [x["text"] for x in out[1]["t"]] == ["first", "a", "b", "c"]
        assert out[2]["loss"] == ["long [INST] " * 50_000]
    assert formatted(records(spark, rows).where("false")) == []


def test_fingerprints_tell_layouts_apart():
    reduce(lambda seen, m: seen | {(m[0], tuple(sorted(m[1])))}, chat.MAPPINGS, set())
    assert len({tuple(sorted(p)) for _, p, _ in chat.MAPPINGS}) == len(chat.MAPPINGS)
