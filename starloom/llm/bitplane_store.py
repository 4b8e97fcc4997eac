"""Token ids in bit-plane files (operator 4).

File format (little endian), one file for each task of a range-sorted write:

    magic "BPL1" | blocks ... | footer | footer length (u32) | magic "BPL1"

A chunk holds whole documents, about ``CHUNK_IDS`` ids or one longer document,
cut into blocks of ``BLOCK_IDS`` ids (its last one may be shorter). A block is
transposed: bit plane k holds bit k of every id (byte planes: byte k), eight ids
a byte. Each plane is compressed alone with zstandard; a plane of zeros has
length 0. The footer is a zstandard-compressed JSON chunk index: for each chunk
its offset, the document ids and their numbers of ids, and for each block the
number of ids and the lengths of its planes. So a chunk is read with one seek.

Writing: documents are range-partitioned by id and sorted, so files follow each
other in id order and no task holds more than a chunk's ids. Each file is named
at random and one committed manifest row names it. Reading: one task a file.

Edge cases: a null text is empty (its only id is the end id); null ids come
first; rows with equal ids are kept, ordered by text; an empty table gives no
files and no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import create, map_arrow, materialize, open_shared, shared_folder, texts

MAGIC = b"BPL1"
BLOCK_IDS = 8192
CHUNK_IDS = 1 << 18
MEMO_PARTS = 500_000
MEMO_CHARS = 48
END_ID = 0
MANIFEST = "shard long, file string, n_docs long, n_ids long, n_bytes long"

#: A blank between two other characters: the byte-level pre-tokenizer always starts a token there.
SAFE = re.compile(r"(?<=\S) (?=\S)")


#: White space other than a blank and a line feed.
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


#: A part that is letters with at most a line feed before and marks (no apostrophe) after
#: them: these are one pre-token each. All characters of the Latin ranges are letters.
SIMPLE = re.compile("(\n?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
LETTERS = [c for c in map(chr, range(0x250)) if SIMPLE.fullmatch(c)]
MARKS = "".join(c for c in map(chr, range(0x80)) if SIMPLE.fullmatch("a" + c) and c not in LETTERS)


class Encoder(dict):
    """Encodes texts as the library does, by parts. Texts are cut before each
    blank or line feed that stands alone between other characters; there the
    pre-tokenizer always starts a new token. This is the memo of the parts' ids;
    of two generations the older one goes when the younger is full, so memory
    is bounded and frequent parts stay."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.older: dict[str, bytes] = {}
        self.literal: dict[str, bytes] = {}
        # how the pre-tokenizer spells the letters that are not ASCII
        self.spelled = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LETTERS if not c.isascii()})

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, blank: str, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(blank + (letters if letters.isascii() else letters.translate(self.spelled)))]).tobytes()

    def _marks(self, text: str) -> bytes:
        if (ids := self.literal.get(text)) is None:
            ids = self._encode(text)
            if len(text) <= 4:  # few
                self.literal[text] = ids
        return ids

    def __missing__(self, part: str) -> bytes:
        """The ids of a part that had a blank before it or starts with a line feed."""
        ids = self.older.get(part)
        if ids is None:
            if part.isascii() and (letters := part.rstrip(MARKS)).isalpha():  # most parts, without the pattern
                ids = self._letters("\u0120", letters) if letters == part else self[letters] + self._marks(part[len(letters) :])
            elif simple := SIMPLE.fullmatch(part):
                feed, letters, marks = simple.groups()
                if feed:
                    ids = self._marks(feed) + self._letters("", letters)
                else:
                    ids = self[letters] if marks else self._letters("\u0120", letters)
                if marks:
                    ids += self._marks(marks)
            else:
                ids = self._encode(part if part[:1] == "\n" else " " + part)
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        parts = None
        if not any(c in text for c in OTHER_SPACE):
            parts = text.replace("\n", " \n").split(" ")
            if "" in parts or "\n" in parts:
                parts = None
        first, *rest = parts or SAFE.split(text)
        return np.frombuffer(self._encode(first) + b"".join(map(self.__getitem__, rest)), "<u4")


class Whole:
    """Encodes whole texts: for tokenizers of which nothing is known."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def splits_before_blanks(path: str) -> bool:
    """Whether a tokenizer is byte-level with the usual pattern and no normalizer, by
    its JSON file: what ``Encoder``'s boundaries and memo rest on."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    own = file.get("pre_tokenizer") or {}
    return file.get("normalizer") is None and own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space", False)


_encoders: dict[str, Encoder | Whole] = {}


def encoder(path: str) -> Encoder | Whole:
    """The encoder, made once for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path) if splits_before_blanks(path) else Whole(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of a block: 32 bit planes or 4 byte planes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [x.tobytes() for x in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        packed = np.stack([np.frombuffer(p, np.uint8) for p in planes])
        raw = np.packbits(np.ascontiguousarray(np.unpackbits(packed, axis=1, count=n, bitorder="little").T), axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


class Writer:
    """Writes a file of chunks to a stream."""

    def __init__(self, out, kind: str = "byte", block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS, level: int = 1):
        self.out, self.kind, self.block_ids, self.chunk_ids = out, kind, block_ids, chunk_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.place, self.chunks, self.docs, self.parts, self.held, self.n_ids, self.n_docs = len(MAGIC), [], [], [], 0, 0, 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > self.chunk_ids:
            self._flush()
        self.docs.append((doc_id, len(ids)))
        self.parts.append(ids)
        self.held += len(ids)

    def _flush(self) -> None:
        ids, blocks, start = np.concatenate(self.parts), [], self.place
        for i in range(0, len(ids), self.block_ids):
            block = ids[i : i + self.block_ids]
            packed = [self.zstd.compress(p) if p.strip(b"\0") else b"" for p in to_planes(block, self.kind)]
            for p in packed:
                self.out.write(p)
            self.place += sum(map(len, packed))
            blocks.append([len(block), [len(p) for p in packed]])
        self.chunks.append({"offset": start, "docs": [d for d, _ in self.docs], "lengths": [n for _, n in self.docs], "blocks": blocks})
        self.n_ids, self.n_docs = self.n_ids + len(ids), self.n_docs + len(self.docs)
        self.docs, self.parts, self.held = [], [], 0

    def close(self) -> None:
        if self.docs:
            self._flush()
        footer = self.zstd.compress(json.dumps({"kind": self.kind, "chunks": self.chunks}).encode())
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.place += len(footer) + 8


def read_index(stream) -> dict:
    """The chunk index of a file."""
    end = stream.seek(0, 2)
    end = stream.tell() if end is None else end
    stream.seek(end - 8)
    size, magic = struct.unpack("<I4s", stream.read(8))
    if magic != MAGIC:
        raise ValueError("not a bit-plane file")
    stream.seek(end - 8 - size)
    return json.loads(zstandard.ZstdDecompressor().decompress(stream.read(size)))


def read_chunk(stream, chunk: dict, kind: str) -> np.ndarray:
    """All ids of a chunk."""
    zstd, out = zstandard.ZstdDecompressor(), []
    stream.seek(chunk["offset"])
    for n, lengths in chunk["blocks"]:
        zeros = bytes(n if kind == "byte" else -(-n // 8))
        out.append(from_planes([zstd.decompress(stream.read(k)) if k else zeros for k in lengths], n, kind))
    return np.concatenate(out) if out else np.empty(0, "<u4")


def write_ids(df: DataFrame, tokenizer_path: str, folder: str | None = None, kind: str = "byte", end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode the texts of ``df`` in ascending id order and write them;
    returns the written manifest, one row a file."""
    folder = folder or shared_folder(df.sparkSession, "token-ids")
    end = np.array([end_id], "<u4")

    def write(batches):
        shard, writer = TaskContext.get().partitionId(), None
        with create(folder, f"part-{shard:06d}.bpl") as (uri, out):
            writer = Writer(out, kind)
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    writer.add(doc_id, np.concatenate([encoder(tokenizer_path).encode(text.as_py()), end]))
            writer.close()
        if writer.n_docs:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [uri], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids], "n_bytes": [writer.place]})

    # equal (or null) ids are told apart by a hash, so they are spread over tasks too
    ordered = texts(df, id_col, text_col).withColumn("_tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text").drop("_tie")
    return materialize(map_arrow(ordered, write, MANIFEST), "token-id-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """(shard, file, start): each file's place in the whole id stream. The
    manifest has one short row for each file, not for each document."""
    start, rows = 0, []
    for r in sorted(manifest.select("shard", "file", "n_ids").collect()):
        rows.append((r.shard, r.file, start))
        start += r.n_ids
    return manifest.sparkSession.createDataFrame(rows, "shard long, file string, start long").repartition(max(1, len(rows)))


def read_ids(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read files back: (doc_id, start, n_tokens, ids_crc32), and the ids as
    little-endian binary if asked for."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches):
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_shared(uri) as stream:
                    index = read_index(stream)
                    for chunk in index["chunks"]:
                        ids = read_chunk(stream, chunk, index["kind"])
                        ends = np.cumsum(chunk["lengths"])
                        parts = [x.tobytes() for x in np.split(ids, ends[:-1])]
                        out = {"doc_id": pa.array(chunk["docs"], pa.int64()), "start": start + ends - chunk["lengths"], "n_tokens": pa.array(chunk["lengths"], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64())}
                        yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(parts, pa.binary())} if with_ids else {}))
                        start += int(ends[-1])

    return map_arrow(with_starts(manifest), read, schema)
