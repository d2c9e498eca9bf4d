"""Token ids in a Parquet layout for selective reads.

``write_tokens`` sorts the documents by id into ranges, encodes each range in
one pass and writes one row per document: ``part, doc_id, local_start,
n_tokens, ids``. The ids are a list column with dictionary encoding, the
positions are delta encoded (format version 2), row groups and pages have
fixed sizes and the page index is written by Parquet itself, so a reader of a
few documents or of the metadata columns touches only their pages. A small
manifest beside it holds the first token position of every range; the global
position of a document is ``base + local_start``.

The tokenizers library encodes each distinct chunk of text once per worker:
white space never lies inside a token of the word vocabulary, so the ids of a
text are those of its chunks in order. Caches are cleared at a fixed size.
A text that holds the text of an added token goes to the library whole, as
does every text of a vocabulary with another pre-tokenizer.

Defined results: a null or empty text has only the end id; repeated rows and
ids stay (ties ordered by text hash); a null id sorts first; extra columns are
ignored; an empty table gives empty files and no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomstat.llm import common as C
from loomstat.session import scratch_path

WORD_FILE = "word_bpe_49k.json"
END_ID = 1
ROW_GROUP = 32 << 20
PAGE = 256 << 10
CACHED = 700_000  # entries of a cache before it is cleared

# Pieces of lower-cased Latin-1 text as the word vocabulary's own split pattern takes them.
_LETTER, _NUMBER, _SPACE = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def vocabulary_path(name: str) -> str:
    """A path, or the name of a file among the installed public tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level
    vocabulary: printable Latin-1 letters stand for themselves, the other
    bytes, in order, for the letters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Cache(dict):
    """Ids, as packed 32-bit integers, of what ``make`` encodes."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.clear()
        out = self[key] = self.make(key)
        return out


class Encoder:
    """``encode(text)``: packed little-endian ids, equal to the library's."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        path = vocabulary_path(name)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"].lower() for t in spec.get("added_tokens") or []]
        pre = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.chunked = (pre.get("pattern", {}).get("Regex") == _SPLIT and pre.get("behavior") == "Removed" and pre.get("invert") is True
                        and steps == ["NFC", "Replace", "Lowercase"])
        self.letters = dict(enumerate(byte_letters()))
        self.pieces = _Cache(self._piece)
        self.foreign = _Cache(self._library)
        self.chunks = _Cache(self._chunk)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def _piece(self, piece: str) -> bytes:
        # normalised and split already: only the library's merges remain
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.library.model.tokenize(mapped)], "<i4").tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(chunk.decode("latin-1"))))

    def encode(self, text: str) -> bytes:
        if not self.chunked:
            return self._library(text)
        low = text.lower()
        if "<" in low and any(a in low for a in self.added):
            return self._library(text)
        try:
            return b"".join(map(self.chunks.__getitem__, low.encode("latin-1").split()))
        except UnicodeEncodeError:  # letters beyond Latin-1: the library takes the raw chunks
            return b"".join(map(self.foreign.__getitem__, re.split("[ \n\t]+", text)))


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def encode_ranges(docs: DataFrame, vocabulary: str = WORD_FILE, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """``part, doc_id, local_start, n_tokens, ids`` in ascending ``doc_id`` order."""
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # texts are dealt, not ids: the range sample then reads the input, and runs no encoder
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def go(batches):
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        enc, end = encoder(vocabulary), np.array([end_id], "<i4").tobytes()
        for b in batches:
            packed = [(enc.encode(t) if t else b"") + end for t in b.column("text").to_pylist()]
            size = np.array([len(p) // 4 for p in packed], np.int64)
            start = at + np.cumsum(size) - size
            at += int(size.sum())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), part, np.int32)), b.column("doc_id"), pa.array(start), pa.array(size), ids],
                                             names=["part", "doc_id", "local_start", "n_tokens", "ids"])

    return rows.mapInArrow(go, "part int, doc_id long, local_start long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, vocabulary: str = WORD_FILE, end_id: int = END_ID) -> None:
    """Write the token table to ``path/tokens`` and its manifest to ``path/manifest``."""
    w = encode_ranges(docs, vocabulary, end_id).write
    for k, v in {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": ROW_GROUP, "parquet.page.size": PAGE,
                 "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
                 "parquet.enable.dictionary#local_start": "false", "parquet.enable.dictionary#n_tokens": "false"}.items():
        w = w.option(k, v)
    w.parquet(f"{path}/tokens")
    tokens = docs.sparkSession.read.parquet(f"{path}/tokens")
    size = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))  # a row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    size.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), "n_tokens").write.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str, ids: bool = True, where: str | None = None) -> DataFrame:
    """``doc_id, start, n_tokens[, ids]``; without ``ids`` no token page is
    read, and ``where`` on ``doc_id`` skips row groups and pages."""
    t = spark.read.parquet(f"{path}/tokens")
    if where:
        t = t.where(where)
    base = spark.read.parquet(f"{path}/manifest").select("part", "base")
    return (t.join(F.broadcast(base), "part")  # one row for each range file
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", *(["ids"] if ids else [])))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` counted from the ids themselves."""
    def go(batches):
        for b in batches:
            col = b.column("ids")
            offs = np.asarray(col.offsets).astype(np.int64)
            raw = memoryview(np.ascontiguousarray(np.asarray(col.values), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(offs)), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(go, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path)
    return with_crc32(read_tokens(spark, path))
