"""op8: texts that hold an added token get what an untouched tokenizer gives."""

import random
import zlib

import numpy as np

from vidgraph.llm import queries, token_files

TEXTS = ["a <|endoftext|> b", "plain text, and more. Yes", "<|endoftext|>", "x<|endoftext|><|endoftext|>, y.\nz", None,
         "<|endoftext| >", "  <|endoftext|>  two  "]


def untouched():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.default_tokenizer())


def test_query_gives_the_plain_call(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, start, expected = untouched(), 0, []
    assert tokenizer.encode(TEXTS[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    for i, t in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op8_token_ids(spark, str(tmp_path)).collect()) == expected


def test_plain_and_escaped_random_texts():
    tokenizer, escaping, rng = untouched(), untouched(), random.Random(6)
    escaping.encode_special_tokens = True
    path = token_files.default_tokenizer()
    plain, escaped = token_files.Encoder(path, escape=False), token_files.Encoder(path, escape=True)
    parts = [", ", ". ", ".\n", "a", "bc", " ", "  ", "\n", "1", "é", "<|endoftext|>", "<|", "endoftext", "|>", "Z"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        for encoder, library in ((plain, tokenizer), (escaped, escaping)):
            ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u2")
            assert encoder.encode([text])[0] == ids.tobytes(), repr(text)
