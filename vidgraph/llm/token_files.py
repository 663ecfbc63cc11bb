"""Token ids as Arrow stream files of equal-length sequences.

Documents are dealt by ranges of ``doc_id`` (or of a given ``order``) and sorted,
equal rows apart; each task encodes its texts, ends every document with ``end_id`` and packs the ids into sequences of
``length`` ids.  A file is an Arrow IPC stream of record batches of
``batch_rows`` rows with two fixed-size lists: ``input_ids`` and ``mask`` (true:
an id, false: padding after the last document of the file).  Batches have equal
sizes, so a memory-mapped file gives every sequence without copying.  Beside it
an index stream holds ``doc_id, start, n_tokens`` (start: within the file).

A task writes new file names and reports them; the manifest of the files that
count is what the finished job returned, so a lost executor or a repeated task
leaves only files that nothing names.

Encoding: a byte-level BPE with spaces kept in front of words never joins text
across a single space between two non-blanks, nor a word and the mark after it,
so a text is cut there and every distinct piece is encoded once per task.  The pieces' ids are the library's own.
With any other tokenizer (another pre-tokenizer or model, a normalizer) texts go
through the library whole.
A text that holds an added token (such as ``<|endoftext|>``) goes through the
library as a whole and gets that token's id, as its plain call gives it; with
``escape_special`` strings that name special tokens are ordinary text.

Folders are Hadoop URIs as Spark takes them; tasks write through Arrow's file
systems, so ``s3a``, ``wasbs`` and the like are translated (``arrow_uri``) and a
scheme that Arrow doesn't know is an error before the job starts.

Defined cases: null and empty texts give the end id only; null ids come first;
rows of one ``doc_id`` are ordered by a hash of the text, equal rows by their place
in the input (each is written, and dealt to as many files as it takes); very long
texts are encoded whole; an empty table gives an empty manifest; other columns are
not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vidgraph.llm.common import scratch, text_hash
from vidgraph.session import scratch_path

LENGTH, BATCH_ROWS = 2048, 64
CACHE, CHUNK = 1_200_000, 1 << 20  # pieces remembered; characters encoded at a time
# Stand-ins for marks after a letter or digit, which are pieces of their own.
MARKS = {"\x00": ",", "\x01": ".", "\x02": ".\n"}
ASCII_BLANKS = "".join(chr(i) for i in range(128) if chr(i).isspace() and chr(i) != " ")
OTHER_BLANKS = "".join(chr(i) for i in range(128, 0x3001) if chr(i).isspace())
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def arrow_uri(folder: str) -> str:
    """A Hadoop folder URI as Arrow's file systems take it."""
    scheme, _, rest = folder.partition("://") if "://" in folder else folder.partition(":") if re.match(r"file:/", folder) else (
        "file", "", folder)
    scheme, plain = scheme.lower(), rest.rstrip("/")
    if scheme == "file":
        if not plain.startswith("/"):
            raise ValueError(f"not an absolute folder: {folder}")
        return "file://" + plain
    if scheme in ("s3", "s3a", "s3n"):
        return "s3://" + plain
    if scheme in ("abfs", "abfss", "wasb", "wasbs"):
        return "abfs" + ("s" if scheme.endswith("s") and scheme != "abfs" else "") + "://" + plain.replace(
            ".blob.core.", ".dfs.core.", 1)
    if scheme in ("gs", "hdfs", "viewfs"):
        return f"{scheme}://{plain}"
    raise ValueError(f"no way to write token files to {scheme}://")


class Encoder:
    """Texts to little-endian id bytes; remembers the ids of pieces.  With
    ``escape`` strings that name special tokens are ordinary text."""

    def __init__(self, path: str, escape: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread in a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = escape
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.named = [t.content for t in added if not (escape and t.special)]
        self.joined = not any(" " in n for n in self.named)
        self.cuts = _byte_level(json.loads(self.tokenizer.to_str()))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        self.spaced = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("\u0120")  # the byte alphabet's space

    @classmethod
    def of(cls, path: str, escape: bool = True) -> Encoder:
        if (path, escape) not in _ENCODERS:
            _ENCODERS[path, escape] = cls(path, escape)
        return _ENCODERS[path, escape]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype).tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces.  Those without an inner space go through the library
        as one text: only a piece's first id then starts with a space."""
        plain = [p for p in pieces if self.joined and p[:1] not in MARKS and " " not in p]
        other = [p for p in pieces if not self.joined or p[:1] in MARKS or " " in p]
        texts = [MARKS[p[0]] + p[1:] if p[:1] in MARKS else " " + p for p in other]
        self.pieces.update(zip(other, self._whole(texts)))
        if plain:
            ids = np.frombuffer(self._whole([" " + " ".join(plain)])[0], self.dtype)
            raw, size = ids.tobytes(), self.dtype.itemsize
            bounds = [*(np.flatnonzero(self.spaced[ids]) * size).tolist(), len(raw)]
            self.pieces.update(zip(plain, [raw[a:b] for a, b in zip(bounds, bounds[1:])], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of a few texts."""
        if not self.cuts:
            return self._whole(texts)
        cut = [[t] if any(n in t for n in self.named) else _pieces(t) for t in texts]
        heads = self._whole([c[0] for c in cut])
        for c in cut:
            del c[0]
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        new = set().union(*cut).difference(self.pieces)
        if new:
            self._learn(list(new))
        return [h + b"".join(map(self.pieces.__getitem__, c)) for h, c in zip(heads, cut)]

    def encode_stream(self, texts: Iterator[str | None]) -> Iterator[bytes]:
        """The ids of many texts, a bounded number of characters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK:
                yield from self.encode(held)
                held, size = [], 0
        if held:
            yield from self.encode(held)


def _byte_level(spec: dict) -> bool:
    """Whether texts may be cut: byte-level BPE split by the usual pattern, spaces
    kept in front of words, nothing normalised, no dropout or added end of word."""
    split = spec.get("pre_tokenizer") or {}
    model = spec.get("model") or {}
    return (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
            and not model.get("ignore_merges") and not spec.get("truncation") and not spec.get("padding"))


def _pieces(text: str) -> list[str]:
    """Cut where no token can reach across: at single spaces between non-blanks,
    and before a comma or full stop that ends a word.  The first piece is as it
    stands; the others follow a space, or start with one of ``MARKS``."""
    if any(m in text for m in MARKS):
        return [text]
    if not _evenly_spaced(text):
        return _rejoined(text.split(" "))
    marked = text.replace(", ", " \x00 ").replace(". ", " \x01 ").replace(".\n", " \x02")
    parts = marked.split(" ")
    # A mark that follows anything but a letter or digit may share its token.
    loose = [e for e in {p[-1:] for p in parts} if not e.isalnum()]
    return text.split(" ") if any(f"{e} {m}" in marked for e in loose for m in MARKS) else parts


def _evenly_spaced(text: str) -> bool:
    """No space has a blank (or nothing) beside it."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return False
    blanks = ASCII_BLANKS if text.isascii() else ASCII_BLANKS + OTHER_BLANKS
    return not any(b in text and (b + " " in text or " " + b in text) for b in blanks)


def _rejoined(parts: list[str]) -> list[str]:
    """Undo the cuts at spaces that have a blank (or nothing) beside them."""
    out, loose = [parts[0]], not parts[0] or parts[0][-1].isspace()
    for p in parts[1:]:
        if loose or not p or p[0].isspace():
            out[-1] += " " + p
        else:
            out.append(p)
        loose = not p or p[-1].isspace()
    return out


class _Writer:
    """The two streams of one file."""

    def __init__(self, folder: str, part: int, dtype: np.dtype, id_type: pa.DataType, length: int, batch_rows: int):
        self.fs, root = pa.fs.FileSystem.from_uri(arrow_uri(folder))
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        self.names = (f"{name}.tokens.arrows", f"{name}.index.arrows")
        self.length, self.rows, self.dtype = length, batch_rows, dtype
        ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("input_ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.fs.open_output_stream(f"{root}/{n}") for n in self.names]
        self.tokens = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.index = pa.ipc.new_stream(self.sinks[1], self.index_schema)
        self.held, self.size, self.total = [], 0, 0

    def add(self, ids: bytes) -> int:
        n = len(ids) // self.dtype.itemsize
        self.held.append(ids)
        self.size += n
        self.total += n
        if self.size >= self.length * self.rows:
            self._flush(False)
        return n

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), dtype=self.dtype)
        step = self.length * self.rows
        full = len(ids) // step * step
        for i in range(0, full, step):
            self._batch(ids[i:i + step], step)
        rest = ids[full:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.held, self.size = [rest.tobytes()], len(rest)

    def _batch(self, ids: np.ndarray, size: int) -> None:
        padded, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
        padded[:len(ids)], mask[:len(ids)] = ids, True
        self.tokens.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)], schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        for x in (self.tokens, self.index, *self.sinks):
            x.close()


MANIFEST = "part int, tokens string, index string, n_docs bigint, n_tokens bigint"


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, length: int,
           batch_rows: int, escape: bool) -> Iterator[pa.RecordBatch]:
    part, out, docs = TaskContext.get().partitionId(), None, 0
    encoder = Encoder.of(path, escape)
    end = np.array([end_id], encoder.dtype).tobytes()
    for batch in batches:
        out = out or _Writer(folder, part, encoder.dtype, batch.column(0).type, length, batch_rows)
        starts, counts = [], []
        for ids in encoder.encode_stream(t.as_py() for t in batch.column(1)):
            starts.append(out.total)
            counts.append(out.add(ids + end))
        out.index.write_batch(pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=out.index_schema))
        docs += batch.num_rows
    if out:
        out.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "tokens": out.names[0], "index": out.names[1],
                                           "n_docs": docs, "n_tokens": out.total}], schema=pa.schema(
            [("part", pa.int32()), ("tokens", pa.string()), ("index", pa.string()), ("n_docs", pa.int64()),
             ("n_tokens", pa.int64())]))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, length: int = LENGTH,
                 batch_rows: int = BATCH_ROWS, escape_special: bool = False, order: Column | None = None) -> DataFrame:
    """Write all texts of ``docs`` (``doc_id, text``) below ``folder`` (a shared
    folder, as a URI or an absolute path) and return the manifest: one row per
    file with ``first`` (ids in all files before it).  Files hold the documents in
    ascending ``doc_id``, or in that of ``order`` (an expression over ``docs``)."""
    spark = docs.sparkSession
    arrow_uri(folder)  # an unknown scheme fails here
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    rows = docs.select("doc_id", "text", text_hash(docs["text"]).alias("xh"), F.monotonically_increasing_id().alias("place"),
                       *([] if order is None else [order.alias("key")]))
    keys = [*([] if order is None else ["key"]), "doc_id", "xh", "place"]  # the place deals equal rows to many ranges
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    manifest = scratch(rows.mapInArrow(
        lambda it: _write(it, folder, tokenizer, end_id, length, batch_rows, escape_special), MANIFEST), "token-manifest")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))


def open_sequences(path: str) -> pa.Table:
    """A token file, memory-mapped: row i is sequence i, nothing is copied."""
    return pa.ipc.open_stream(pa.memory_map(path)).read_all()


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, root = pa.fs.FileSystem.from_uri(arrow_uri(folder))
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_file(f"{root}/{row['tokens']}") as a, fs.open_input_file(f"{root}/{row['index']}") as b:
                stream, held, begin = pa.ipc.open_stream(a), np.zeros(0, np.uint32), 0
                for index in pa.ipc.open_stream(b):
                    starts, counts, sums = index["start"].to_pylist(), index["n_tokens"].to_pylist(), []
                    for start, n in zip(starts, counts):
                        while begin + len(held) < start + n:
                            more = stream.read_next_batch()
                            ids, mask = (more[c].flatten().to_numpy(zero_copy_only=False) for c in ("input_ids", "mask"))
                            held, begin = np.concatenate([held[start - begin:], ids[mask]]), start
                        sums.append(zlib.crc32(held[start - begin:start - begin + n].astype("<u4").tobytes()))
                    yield pa.RecordBatch.from_arrays(
                        [index["doc_id"], pa.array([row["first"] + s for s in starts], pa.int64()),
                         index["n_tokens"], pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = max(1, manifest.count())  # a task for every file; small rows stand for large files
    dealt = manifest.select("part", "tokens", "index", "first").repartition(files, "part")
    return dealt.select("tokens", "index", "first").mapInArrow(lambda it: _read(it, folder), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-token-files")
