"""Operators tested against brute force, round trips and held-out accuracy (3, 5, 6, 7, 8) and the pipeline."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import NOTE, PASSAGE, odd_texts
from vidgraph.llm import common, components, embeddings, language, quality, queries, simhash, token_files

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


def grouped(n, linked):
    """Smallest member of each of n items' groups."""
    low = list(range(n))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        low[b] = a
    return [find(i) for i in range(n)]


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    for t in [*(t for t in odd_texts() if len(t or "") < 5000), "a b c", "a b c a b c a b c", "Ä b\x1cc d"]:
        assert simhash.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_every_close_pair_agrees_under_a_mask():
    masks = simhash.masks(3)
    assert len(masks) == 15
    for n in (1, 2, 3):
        for bits in itertools.combinations(range(64), n):
            flipped = sum(1 << b for b in bits)
            assert any(m & flipped == 0 for m in masks)
    for m in masks:  # splits: three differing bits outside the mask miss one block
        for bits in itertools.combinations([i for i in range(64) if not m >> i & 1][:14], 3):
            assert any(f & sum(1 << b for b in bits) == 0 for f in simhash._finer(m, 3))


@pytest.mark.parametrize("bucket", [3, 1024])
def test_simhash_links_with_large_buckets(spark, bucket):
    """Splitting buckets loses and adds no link."""
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) & (1 << 64) - 1 for b in base for _ in range(40)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    roots = {r["node"]: r["root"] for r in components.components(simhash.near_links(df, 3, bucket)).collect()}
    close = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2)
             if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 3]
    assert [roots.get(f, f) for f in fps] == [fps[i] for i in grouped(len(fps), close)]


def test_components_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    random.Random(2).shuffle(path)
    out = components.components(spark.createDataFrame(path, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in out} == {**{i: 0 for i in range(101)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_query_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    low = grouped(len(fps), [(i, j) for i, j in itertools.combinations(range(len(fps)), 2)
                             if (fps[i] ^ fps[j]).bit_count() <= 3])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op3_simhash_near_dedup(spark, SF).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", rows[i]["doc_id"]) for r, f, i in zip(rows, fps, low)}


def test_simhash_repeated_and_nameless_rows(spark, repeated):
    out = simhash.near_duplicates(repeated).collect()
    assert len(out) == 12
    empty = [r for r in out if r["fp"] == 0]
    assert len(empty) == 1 and empty[0]["component_id"] is None and empty[0]["representative"]


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + rng.normal(size=8) * 0.12).tolist(), i % 2) for i in range(300)]
    rows += [(1000 + i, [1.0] + [0.0] * 7, 0) for i in range(20)] + [(1000, [2.0] + [0.0] * 7, 0)]
    rows += [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [float("nan")] + [1.0] * 7, 0), (2003, [1.0, None], 0),
             (2004, [float("inf")] + [0.0] * 7, 0), (2005, [1.0] + [0.0] * 7, None), (2006, [], 0), (2007, [1.0], 0),
             (None, [-1.0] * 8, 0)]
    return rows


@pytest.mark.parametrize("sizes", [(256, 4096, 1024), (8, 16, 4)])
def test_embeddings_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("CELL", "CHUNK", "BLOCK"), sizes):
        monkeypatch.setattr(embeddings, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("kept", F.lit("clash"))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"])
                  for r in embeddings.near_duplicates(df, 0.93).collect()), key=str)

    def linked(a, b):
        va, vb = a[1], b[1]
        if a[2] is None or a[2] != b[2] or not va or not vb or len(va) != len(vb) or None in va or None in vb:
            return False
        x, y = np.array(va), np.array(vb)
        if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
            return False
        return x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93

    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    rows = [rows[i] for i in order]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if linked(rows[i], rows[j])]
    low, n = grouped(len(rows), pairs), [0] * len(rows)
    for i, j in pairs:
        n[i], n[j] = n[i] + 1, n[j] + 1
    expected = [(r[0], n[i], rows[low[i]][0], rows[low[i]][0] == r[0]) for i, r in enumerate(rows)]
    assert got == sorted(expected, key=str)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_LARGER}/documents.parquet").collect()}
    out = queries.op6_language_id(spark, SF_LARGER).collect()
    assert len(out) == len(truth) and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in out)
    test = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in test) / len(test) > 0.98


def test_language_odd_corpus(spark, odd_dir, empty_dir):
    out = {r["doc_id"]: r for r in queries.op6_language_id(spark, odd_dir).collect()}
    for i, t in enumerate(odd_texts()):
        r = out[i * 3]
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
        assert r["lang_pred"] in ("en", "de", "und") and (r["lang_pred"] != "und" or (r["score"] == 0 and r["rejected"]))
    assert queries.op6_language_id(spark, empty_dir).count() == 0
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    unlabelled = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_quality_held_out_accuracy_and_compiled_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert model.rules
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = quality.score_quality(docs, labels, model).collect()
    for r in out[:200]:
        assert r["score"] == pytest.approx(model.score(quality.text_statistics(texts[r["doc_id"]].encode())))
        assert r["held_out"] == held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.5)
    test = [(r["score"], truth[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, q in test if q], [s for s, q in test if not q]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95


def test_quality_odd_corpus(spark, odd_dir, empty_dir):
    out = queries.op7_quality_classifier(spark, odd_dir).collect()
    assert len(out) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in out)
    assert queries.op7_quality_classifier(spark, empty_dir).count() == 0
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score_quality(docs, none).collect()} == {0.5}
    a, b = [i * 3 for i in range(9) if not held(i * 3)][:2]
    one = spark.createDataFrame([(a, 1), (a, 0), (b, 1), (None, 0)], "doc_id bigint, quality int")
    assert all(r["score"] > 0.5 for r in quality.score_quality(docs, one).collect())


def expected_index(texts_by_id):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())  # as it comes
    start, out = 0, []
    for doc_id, text in texts_by_id:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, odd_dir, empty_dir):
    texts = [(i * 3, t) for i, t in enumerate(odd_texts())]
    got = sorted(tuple(r) for r in queries.op8_token_ids(spark, odd_dir).collect())
    assert got == expected_index(texts)
    assert queries.op8_token_ids(spark, empty_dir).count() == 0


def test_token_files_random_access(spark, tmp_path, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    manifest = token_files.write_tokens(docs, str(tmp_path / "out"), token_files.default_tokenizer(), length=16, batch_rows=4)
    for row in manifest.collect():
        before = pa.total_allocated_bytes()
        table = token_files.open_sequences(str(tmp_path / "out" / row["tokens"]))
        assert pa.total_allocated_bytes() == before  # mapped, not copied
        assert table.schema.field("input_ids").type.list_size == 16
        assert table.schema.field("mask").type == pa.list_(pa.bool_(), 16)
        assert sum(sum(m.as_py()) for m in table["mask"]) == row["n_tokens"]
        assert all(b.num_rows == 4 for b in table.to_batches()[:-1])


def test_encoder_random_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    encoder, rng = token_files.Encoder(token_files.default_tokenizer(), escape=False), random.Random(4)
    parts = [", ", ". ", ".\n", ",", ".", "\x00", "b7", "a", "bc", " ", "  ", "\n", "\t", "'s", "1", "é", "\x85", "\xa0",
             "!", "\x1c", "　", "<|endoftext|>", "Z"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2")
        assert encoder.encode([text])[0] == ids.tobytes(), repr(text)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(words, windows):
    hit = set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def expected_copies(rows):
    """Poisson counts inverted from the hash, in plain Python."""
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(r["text"] or "") + 1
    roots = {s: n ** 0.5 for s, n in sizes.items()}
    out = Counter()
    for r in rows:
        rate = roots[r["source"]] / sum(roots.values()) * sum(sizes.values()) / sizes[r["source"]]
        parts = math.ceil(rate / 64)
        for part in range(1, parts + 1):
            u = int(hashlib.md5(f"42|{r['doc_id']}|{part}".encode()).hexdigest()[:13], 16) / 2 ** 52
            k, term = 0, math.exp(-rate / parts)
            cum = term
            while cum <= u:
                k += 1
                term *= rate / parts / k
                cum += term
            out[r["doc_id"]] += k
    return Counter({i: n for i, n in out.items() if n})


def test_pipeline(spark):
    """Every stage against its own restatement; the index against the library."""
    docs = common.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, after = docs, common.scratch(stage(spark, docs, SF), "test-stage")
        if name != "token ids":
            assert after.columns == before.columns
        rows = {r["doc_id"]: r for r in before.collect()}
        kept = {r["doc_id"] for r in after.collect()}
        if name == "quality classifier":
            scores = quality.score_quality(before, common.table(spark, SF, "labels"))
            assert kept == {r["doc_id"] for r in scores.where("score >= 0.5").collect()}
        elif name == "simhash near-dedup":
            ids = sorted(rows)
            fps = [slow_fingerprint(rows[i]["text"]) for i in ids]
            low = grouped(len(ids), [(a, b) for a, b in itertools.combinations(range(len(ids)), 2)
                                     if (fps[a] ^ fps[b]).bit_count() <= 3])
            assert kept == {ids[i] for i in low}
        elif name == "benchmark decontamination":
            items = [plain_words(r["text"]) for r in common.table(spark, SF, "benchmark").collect()]
            windows = {tuple(w[i:i + min(13, len(w))]) for w in items if w for i in range(len(w) - min(13, len(w)) + 1)}
            assert kept == {i for i, r in rows.items() if not contaminated(plain_words(r["text"]), windows)}
            assert len(kept) < len(rows)
        elif name == "mixing sources to target weights":
            got = Counter(r["doc_id"] for r in after.collect())
            assert got == expected_copies(list(rows.values())) and got.keys() != rows.keys()
            assert all(r["text"] == rows[r["doc_id"]]["text"] for r in after.collect())
        elif name == "token ids":
            got = sorted((tuple(r) for r in after.collect()), key=lambda r: r[1])
            texts = {r["doc_id"]: r["text"] for r in before.collect()}
            assert Counter(r[0] for r in got) == Counter(r["doc_id"] for r in before.collect())
            assert got == expected_index([(r[0], texts[r[0]]) for r in got])
            ids = [r[0] for r in got]   # mixed: not by id, copies apart
            assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.6 * len(ids)
            together = sum(a == b for a, b in zip(ids, ids[1:]))
            assert together < 0.2 * (len(ids) - len(set(ids)))
        docs = after


def test_pipeline_odd_and_empty(spark, odd_dir, empty_dir):
    docs = common.table(spark, odd_dir, "documents")
    out = corpus_pipeline.benchmark_decontamination(spark, docs, odd_dir).collect()
    assert not any(PASSAGE in (r["text"] or "").lower() and len(r["text"]) < 500 for r in out)
    assert any(NOTE in (r["text"] or "") for r in out)
    assert corpus_pipeline.run(spark, odd_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_pipeline_keeps_the_documents_own_columns(spark, odd_dir):
    """Columns named like an operator's own come through unchanged."""
    docs = common.table(spark, odd_dir, "documents").withColumn("copy", F.lit("mine")).withColumn("size", F.lit(-1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd_dir)
        assert out.columns == docs.columns, name
        rows = out.select("score", "n_hit", "copy", "size").distinct().collect()
        assert [tuple(r) for r in rows] == [("clash", 0, "mine", -1)], name


def test_pipeline_dedup_keeps_one_row(spark, repeated):
    out = corpus_pipeline.simhash_near_dedup(spark, repeated, SF).collect()
    assert len(out) == len({(r["doc_id"], r["text"]) for r in out})
    assert sum(r["text"] is None for r in out) == 1
