"""op10: notices wrapped over lines, and every window by brute force."""

import math
import random
import re
import textwrap

from tests.llm.conftest import odd_texts
from vidgraph.llm import licenses


def split(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]


def slow(text, templates, threshold=0.8):
    """Template -> containment of the best window."""
    w, found = split(text), {}
    for name, template in templates.items():
        t, longest = set(split(template)), math.ceil(len(split(template)) / threshold - 1e-9)
        most = max((len(t & set(w[i:i + longest])) for i in range(len(w))), default=0)
        if most >= threshold * len(t) - 1e-9:
            found[name] = most / len(t)
    return found


def scan(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in licenses.scan_licenses(docs, **how).collect()}


def test_wrapped_notices(spark):
    """Headers as they stand in files: comment marks and line ends do not matter."""
    names = ["mit-permission", "gpl-header", "bsd", "apache-2.0-header"]
    texts = ["\n".join(f" * {line}" for line in textwrap.wrap(licenses.TEMPLATES[n], 50)) for n in names]
    out = scan(spark, [f"/*\n{t}\n */\nint main" for t in texts])
    for i, name in enumerate(names):
        assert name in out[i]["template_labels"] and out[i]["score"] == 1.0


def test_scattered_words_are_no_notice(spark):
    far = " ".join(f"{w} {'filler ' * 30}" for w in split(licenses.TEMPLATES["bsd"]))
    assert scan(spark, [far])[0]["template_labels"] == []


def test_windows_brute_force(spark):
    rng = random.Random(8)
    templates = {"one": "a b c d e", "two": "a a f g the the h i j k", "long": " ".join(f"w{i}" for i in range(12)) + " a b the"}
    vocabulary = [*"abcdefghijk", "the", *(f"w{i}" for i in range(12)), "x", "y", "z"]
    texts = [rng.choice([" ", "\n", ", "]).join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(300)]
    texts += [" ".join(rng.sample(t.split(), len(t.split()))) for t in templates.values()]
    out = scan(spark, texts, templates=templates, phrases={"no such phrase": "none"})
    assert sum(bool(r["template_labels"]) for r in out.values()) > 30
    for i, text in enumerate(texts):
        expected = slow(text, templates)
        assert out[i]["template_labels"] == sorted(expected), text
        assert abs(out[i]["score"] - max(expected.values(), default=0.0)) < 1e-12, text


def test_odd_texts_brute_force(spark):
    texts = [t for t in odd_texts() if len(t or "") < 20_000]
    out = scan(spark, texts, templates=licenses.TEMPLATES)
    for i, text in enumerate(texts):
        assert out[i]["template_labels"] == sorted(slow(text, licenses.TEMPLATES)), text
