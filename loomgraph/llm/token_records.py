"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A records file: the magic ``LGTR``, one byte version, one byte bytes-per-id (2 where all ids fit, else 4), two zero
bytes; then for each document a frame of

    u64 length of the payload | u32 masked CRC-32 of these 8 bytes | payload | u32 masked CRC-32 of the payload

with the payload ``i64 doc_id | u8 doc_id is null | ids``. All numbers are little-endian. A checksum c is masked as
``((c >> 15 | c << 17) + 0xa282ead8) mod 2**32``, so that a checksum stored among the data it covers does no harm.
The index file beside it holds a u64 offset for each frame and one for the end, so any record is read by one seek.

Files are named by attempt; only those in the manifest count, so a task that is run again leaves no wrong data.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.batches import TEXT_ROWS, Memo, held, small_batches
from loomgraph.llm.bpe_codec import byte_letters
from loomgraph.plans.scratch import folder, stored

MAGIC, VERSION = b"LGTR", 1
#: The word pattern of byte-level BPE files whose ByteLevel pre-tokenizer uses its own pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(zlib.crc32(head))) + payload + struct.pack("<I", masked(zlib.crc32(payload)))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload at an offset, and the offset after it. Raises ValueError if a checksum does not hold."""
    head = data[at : at + 8]
    if len(head) < 8 or struct.unpack_from("<I", data, at + 8)[0] != masked(zlib.crc32(head)):
        raise ValueError(f"damaged length at {at}")
    size = struct.unpack("<Q", head)[0]
    payload = data[at + 12 : at + 12 + size]
    if len(payload) < size or struct.unpack_from("<I", data, at + 12 + size)[0] != masked(zlib.crc32(payload)):
        raise ValueError(f"damaged record at {at}")
    return payload, at + 16 + size


class Encoder:
    """Ids of whole texts by the tokenizers library, whose model encodes each different word once; texts with an added
    token or with characters beyond Latin, for which Unicode versions may differ, go to the library whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        self.model = self.lib.model
        self._checked(json.loads(self.lib.to_str()))
        self.dtype = "<u2" if self.lib.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"
        self.words, self.beyond = re.compile(_latin(PATTERN)), re.compile("[^\\x00-\u02ff]")
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.memo = Memo(self.word)

    @staticmethod
    def _checked(said: dict) -> None:
        """Raises for a tokenizer whose words are not those that this class cuts."""
        cut = said.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        if not plain or said.get("normalizer") is not None or said["model"].get("type") != "BPE":
            raise ValueError("not a byte-level BPE tokenizer without normalizer and prefix space")

    def word(self, word: str) -> bytes:
        return self._packed(t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters)))

    def _packed(self, ids) -> bytes:
        return np.array([*ids], self.dtype).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.beyond.search(text) or any(a in text for a in self.added):
            return self._packed(self.lib.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.memo.__getitem__, self.words.findall(text)))


def _latin(pattern: str) -> str:
    """The pattern for texts of characters up to U+02FF, its classes spelled out: the standard library's regular
    expressions know no categories, but are faster."""
    span = "".join(map(chr, range(0x300)))
    listed = {c: "".join(map(re.escape, regex.findall(c, span))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    listed[r"\S"] = "".join(map(re.escape, regex.findall(r"\S", span)))
    inside = re.sub(r"\[\^([^\]]*)\]", lambda m: "[^" + "".join(listed[c] for c in re.findall(r"\\p\{.\}|\\s", m[1])) + "]", pattern)
    return re.sub(r"\\p\{[LN]\}|\\[sS](?=[+)])", lambda m: f"[{listed[m[0]]}]", inside)


@held
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


@dataclass(frozen=True)
class TokenFiles:
    """What was written: a manifest (part, records, index, n_docs, n_tokens), in ascending doc_id order by part."""

    path: str
    manifest: DataFrame


def write_records(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> TokenFiles:
    """Encodes docs (doc_id, text), appends end_id to each, and writes them in ascending doc_id order, nulls first.

    A null text is empty: the end id alone. Repeated doc_ids keep all their rows, ordered by a hash of the text; extra
    columns are not read; an empty table gives an empty manifest. Documents are dealt by ranges of doc_id, each range
    is sorted with spill and streamed into one file.
    """
    spark = docs.sparkSession
    path = path or folder(spark, "token-records")
    order = ["doc_id", "tie"]

    def run(batches):
        encode, out, index, at, n_docs, n_tokens = encoder_of(tokenizer), None, [], 8, 0, 0
        store, base = fs.FileSystem.from_uri(path)
        width = np.dtype(encode.dtype).itemsize
        end, part = np.array([end_id], encode.dtype).tobytes(), TaskContext.get().partitionId()
        name = f"{base}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        for b in batches:
            for lo in range(0, b.num_rows, TEXT_ROWS):
                some = b.slice(lo, TEXT_ROWS)
                if out is None and some.num_rows:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{name}.rec", buffer_size=1 << 20)
                    out.write(MAGIC + bytes([VERSION, width, 0, 0]))
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = encode(text or "")
                    data = frame(struct.pack("<qB", doc_id or 0, doc_id is None) + ids + end)
                    out.write(data)
                    index.append(at)
                    at, n_docs, n_tokens = at + len(data), n_docs + 1, n_tokens + len(ids) // width + 1
        if out is not None:
            out.close()
            with store.open_output_stream(f"{name}.idx") as f:
                f.write(np.array([*index, at], "<u8").tobytes())
            yield pa.RecordBatch.from_pylist([{"part": part, "name": os.path.basename(name), "n_docs": n_docs, "n_tokens": n_tokens}], schema=made)

    made = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return TokenFiles(path, stored(dealt.mapInArrow(run, "part int, name string, n_docs long, n_tokens long"), "token-manifest"))


def read_records(files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers), from the files and their indexes.

    One file is read by one task, record by record. The manifest, a row per file, comes to the driver for the running
    sum of ids.
    """
    spark, path = files.manifest.sparkSession, files.path
    starts, at = [], 0
    for r in sorted(files.manifest.collect(), key=lambda r: r["part"]):
        starts.append((r["name"], at))
        at += r["n_tokens"]
    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not starts:
        return spark.createDataFrame([], schema)

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{base}/{name}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8")
                with store.open_input_file(f"{base}/{name}.rec") as f:
                    head = f.read(8)
                    if head[:5] != MAGIC + bytes([VERSION]):
                        raise ValueError(f"{name}: not a records file of this version")
                    for lo in range(0, len(index) - 1, TEXT_ROWS):
                        ends = index[lo : lo + TEXT_ROWS + 1]
                        f.seek(int(ends[0]))
                        data, rows = f.read(int(ends[-1] - ends[0])), ([], [], [], [])
                        for k in ends[:-1] - ends[0]:
                            payload, _ = unframe(data, int(k))
                            doc_id, null = struct.unpack_from("<qB", payload)
                            ids = np.frombuffer(payload, f"<u{head[5]}", offset=9)
                            for column, value in zip(rows, (None if null else doc_id, start, len(ids), ids.astype("<u4").tobytes())):
                                column.append(value)
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "start", "n_tokens", "ids"])

    return spark.createDataFrame(starts, "name string, start long").repartition(len(starts), "name").mapInArrow(run, schema)


def record_index(files: TokenFiles) -> DataFrame:
    """part, name, number, at, size: where each record stands, from the index files."""
    path = files.path
    made = pa.schema([("part", pa.int32()), ("name", pa.string()), ("number", pa.int64()), ("at", pa.int64()), ("size", pa.int64())])

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        for b in batches:
            for part, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{base}/{name}.idx") as f:
                    ends = np.frombuffer(f.read(), "<u8").astype(np.int64)
                for lo in range(0, len(ends) - 1, 1 << 16):
                    some = ends[lo : lo + (1 << 16) + 1]
                    n = len(some) - 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array([name] * n), pa.array(np.arange(lo, lo + n)), pa.array(some[:-1]), pa.array(np.diff(some))], schema=made)

    return files.manifest.select("part", "name").mapInArrow(run, "part int, name string, number long, at long, size long")


def read_shuffled(files: TokenFiles, seed: int) -> DataFrame:
    """rank, doc_id, n_tokens, ids of all records in an order that depends on the seed alone: partitions are ranges of rank
    and sorted by it. Offsets are shuffled, not records; each task then reads its records by their offsets, those of a
    batch file by file."""
    path = files.path

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        for b in batches:
            ranks, names, ats, sizes = (b.column(i).to_pylist() for i in range(4))
            rows = [None] * len(ranks)
            for name in sorted(set(names)):
                with store.open_input_file(f"{base}/{name}.rec") as f:
                    head = f.read(8)
                    if head[:5] != MAGIC + bytes([VERSION]):
                        raise ValueError(f"{name}: not a records file of this version")
                    for i in sorted((i for i, n in enumerate(names) if n == name), key=ats.__getitem__):
                        f.seek(ats[i])
                        payload, _ = unframe(f.read(sizes[i]), 0)
                        doc_id, null = struct.unpack_from("<qB", payload)
                        ids = np.frombuffer(payload, f"<u{head[5]}", offset=9)
                        rows[i] = (None if null else doc_id, len(ids), ids.astype("<u4").tobytes())
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.int64(), pa.binary())))], names=["rank", "doc_id", "n_tokens", "ids"])

    small_batches(files.manifest.sparkSession)
    ranked = record_index(files).withColumn("rank", F.xxhash64(F.lit(seed), "part", "number"))
    dealt = ranked.repartitionByRange("rank", "part", "number").sortWithinPartitions("rank", "part", "number")
    return dealt.select("rank", "name", "at", "size").mapInArrow(run, "rank long, doc_id long, n_tokens long, ids binary")
