"""op10: the SQL on a table of wrapped notices, near misses, repeated and odd rows; brute force with required words."""

import textwrap

import duckdb

from tests.llm.test_license_near_miss import NEAR
from vidgraph.llm import licenses, oracles, queries
from vidgraph.llm.licenses import NOTICES, REQUIRED, TEMPLATES, THRESHOLD


def texts():
    notices = [*TEMPLATES.values(), *NOTICES.values()]
    out = [t for t, _ in NEAR] + [f"before\n{t}\nafter" for t, _ in NEAR]
    out += ["\n".join(f" * {line}" for line in textwrap.wrap(t, 38)) for t in notices]
    out += [" ".join(t.split()[i:]) for t in notices for i in (1, 3, 6)]                     # beginnings lost
    out += [" ".join(w for k, w in enumerate(t.split()) if k % 7) for t in notices]           # words lost
    out += [" filler ".join(t.split()) for t in notices] + [f"{t} {t} {t}" for t in notices[:5]]
    return [*out, None, "", "cc by", "the " * 3000 + notices[0], *out[:3]]


def test_sql_agrees(spark, tmp_path):
    rows = list(enumerate(texts()))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(oracles.ORACLES["op10_license_scan"])
    names = [d[0] for d in cur.description]
    expected = sorted((tuple(r) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r) for r in queries.op10_license_scan(spark, str(tmp_path)).select(*names).collect()), key=repr)
    assert [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in got] == [
        tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in expected]
    labels = {r[names.index("doc_id")]: r[names.index("labels")] for r in got}
    assert sum(bool(x) for x in labels.values()) > 60


def test_brute_force_with_required_words(spark):
    """Every run of words of every text, in plain Python."""
    import math
    import re

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    rows = [t for t in texts() if len(t or "") < 2000]
    expected = []
    for text in rows:
        w, found = words(text), set()
        for name, t in {**TEMPLATES, **NOTICES}.items():
            tw, longest = set(words(t)), math.ceil(len(words(t)) / THRESHOLD - 1e-9)
            needed = math.ceil(THRESHOLD * len(tw) - 1e-9)
            if len(tw & set(w)) < needed:
                continue
            for i in range(len(w)):
                run = w[i:i + longest]
                line = f" {' '.join(run)} "
                if len(tw & set(run)) >= needed and all(f" {p} " in line for p in REQUIRED.get(name, [])):
                    found.add(name)
                    break
        expected.append(sorted(found))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["template_labels"] for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(rows))] == expected
