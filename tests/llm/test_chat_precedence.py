"""op4: records that also hold fields of another layout keep their turns."""

from functools import reduce

from pyspark.sql import functions as F

from vidgraph.llm import chat

QA = [("user", "q"), ("assistant", "a")]
CASES = [
    ('{"instruction": "q", "input": "i", "output": "a", "text": "q i a"}', [("user", "q\ni"), ("assistant", "a")]),
    ('{"instruction": "q", "output": "a", "text": "q a"}', QA),
    ('{"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
     [("system", "s"), *QA]),
    ('{"prompt": "q", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}', QA),
    ('{"prompt": "q", "response": "a", "instruction": "other"}', QA),
    ('{"prompt": "q", "response": "a", "role": "r", "text": "t"}', QA),
    ('{"role": "user", "text": "q", "prompt": "p"}', [("user", "q")]),
    ('{"messages": [{"role": "system"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
     [("system", ""), *QA]),
    ('{"turns": [{"role": "user"}, {"text": "a"}], "system": null}', [("system", ""), ("user", ""), ("", "a")]),
    ('{"messages": [], "prompt": "q", "response": "a"}', QA),
    ('{"messages": [7, {"role": "user", "content": "q"}]}', [("", ""), ("user", "q")]),
    ('{"messages": "x", "instruction": "q"}', []),
]


def test_other_layouts_fields_lose_nothing(spark):
    rows = [spark.range(1).select(F.lit(i).alias("conv_id"), F.lit(0).alias("seq"), F.parse_json(F.lit(t)).alias("record"))
            for i, (t, _) in enumerate(CASES)]
    out = chat.format_chats(reduce(lambda a, b: a.unionByName(b), rows))
    got = {r["conv_id"]: r for r in out.select("*", chat.parse_turns(F.col("formatted")).alias("t")).collect()}
    for i, (text, turns) in enumerate(CASES):
        assert [(x["role"], x["text"]) for x in got[i]["t"]] == turns, text
        assert got[i]["n_unknown"] == (not turns), text
