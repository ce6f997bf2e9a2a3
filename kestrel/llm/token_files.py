"""Token ids as Arrow IPC files of fixed-size-list batches.

Every file holds equal-length sequences ``ids`` (fixed-size list of unsigned 16- or 32-bit
integers) and ``mask`` (fixed-size list of booleans, false on the padding of the last
sequence).  Documents follow each other in ascending id order and run on over sequence
borders; a second small Arrow file beside it (``.docs.arrow``) gives each document's place.
Mapped into memory, any sequence or document is a view of the file without a copy."""

from __future__ import annotations

import functools
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, shared_folder, slices, written

BEFORE_WORD = re.compile(r" (?=\S)")
LATIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]{0,2})")
MEMO_BYTES = 160 << 20        # of remembered chunks, twice at most


class ChunkMemo:
    """Ids by chunk, bounded in bytes: at ``limit`` the table becomes the old generation and only chunks met
    again survive, so twice the limit is held at most.  Long chunks are kept only while their slice is
    encoded (``passing``): text without spaces fills no memory."""

    LONGEST, OVERHEAD = 128, 200         # characters of a remembered chunk; bytes of an entry besides its contents

    def __init__(self, limit: int):
        self.limit, self.bytes, self.known, self.old, self.passing = limit, 0, {}, {}, {}

    def put(self, chunk: str, ids: bytes):
        if len(chunk) > self.LONGEST:
            self.passing[chunk] = ids
        else:
            self.known[chunk] = ids
            self.bytes += 4 * len(chunk) + len(ids) + self.OVERHEAD

    def put_all(self, chunks: list[str], ids: list[bytes]):
        if max(map(len, chunks)) > self.LONGEST:
            for chunk, raw in zip(chunks, ids):
                self.put(chunk, raw)
        else:
            self.known.update(zip(chunks, ids))
            self.bytes += 4 * sum(map(len, chunks)) + sum(map(len, ids)) + self.OVERHEAD * len(chunks)

    def turn(self):
        """Before a slice: drop what only the last one needed, and the old generation if the table is full."""
        self.passing = {}
        if self.bytes > self.limit:
            self.old, self.known, self.bytes = self.known, {}, 0

    def recalled(self, chunks: set[str]) -> list[str]:
        """Those of ``chunks``, none of them known, that the old generation doesn't hold either."""
        out = []
        for chunk in chunks:
            ids = self.old.get(chunk)
            if ids is None:
                out.append(chunk)
            else:
                self.put(chunk, ids)
        return out

    def getter(self):
        if not self.passing:
            return self.known.__getitem__
        return lambda chunk: self.known.get(chunk) or self.passing[chunk]


class ChunkEncoder:
    """Byte-level BPE of whole texts with the ``tokenizers`` library, memoised by chunk.

    The vocabulary's pre-tokenizer always starts a new piece at a space that stands before a
    non-space character, and merges never cross pieces; so a text may be cut there and the
    chunks encoded apart without changing any id.  Chunks not met before are encoded together
    in one string (a call a chunk would cost more than the merges), and the ids are dealt back
    by their lengths in bytes."""

    TOGETHER = 2000

    def __init__(self, tokenizer_path: str, limit: int = MEMO_BYTES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab()
        self.code = "H" if len(vocabulary) <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)        # bytes of each token: a character stands for a byte
        for token, i in vocabulary.items():
            self.size[i] = len(token)
        self.memo, self.signs = ChunkMemo(limit), {}

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, chunks: list[str]):
        """Remember the ids of chunks (each as it stands after a space).  Latin letters with a sign or two behind
        them are a piece and one or two more, cut where the letters end: if the letters are known, so is the chunk."""
        fresh, made = set(), []
        for chunk in chunks:
            m = LATIN.fullmatch(chunk)
            if m is None or not m[2]:
                fresh.add(chunk)
            else:
                made.append((chunk, m[1], m[2]))
                if m[1] not in self.memo.known:
                    fresh.add(m[1])
        self.encode_all(list(fresh))
        get = self.memo.getter()
        for chunk, letters, signs in made:
            if signs not in self.signs:               # a few thousand pairs of ASCII signs at most
                self.signs[signs] = self.ids(signs)
            self.memo.put(chunk, get(letters) + self.signs[signs])

    def encode_all(self, chunks: list[str]):
        """Encode chunks together and deal the ids back by their lengths in bytes."""
        for at in range(0, len(chunks), self.TOGETHER):
            some = chunks[at:at + self.TOGETHER]
            text = " " + " ".join(some)
            if self.special(text):
                for c in some:
                    self.memo.put(c, self.ids(" " + c))
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum([1 + len(c) if c.isascii() else 1 + len(c.encode()) for c in some])
            stops = ((np.searchsorted(np.cumsum(self.size[ids]), ends) + 1) * self.dtype.itemsize).tolist()      # a chunk ends where a token ends
            raw = ids.tobytes()
            self.memo.put_all(some, [raw[a:b] for a, b in zip([0, *stops], stops)])

    @staticmethod
    def special(text: str) -> bool:
        """A special token's name in the text has a length of its own."""
        return "<|" in text

    def __call__(self, texts: list[str]) -> list[bytes]:
        self.memo.turn()
        parts = [t.split(" ") for t in texts]
        firsts, look = [p.pop(0) for p in parts], self.memo.known.get
        found = [list(map(look, p)) for p in parts]            # one look-up a word; most are known
        lacking = [{c for c, ids in zip(p, f) if ids is None} for p, f in zip(parts, found)]
        for i, lacks in enumerate(lacking):
            # a space that white space or the end follows is no border; such chunks are never remembered
            if any(not c or c[0].isspace() for c in lacks):
                firsts[i], *parts[i] = BEFORE_WORD.split(texts[i])
                found[i] = list(map(look, parts[i]))
                lacking[i] = {c for c, ids in zip(parts[i], found[i]) if ids is None}
        self.learn(self.memo.recalled(set().union(*lacking)))
        get, out = self.memo.getter(), []
        for first, p, f, lacks in zip(firsts, parts, found, lacking):
            out.append(self.ids(first) + b"".join([get(c) if ids is None else ids for c, ids in zip(p, f)] if lacks else f))
        return out


@functools.cache
def encoder(tokenizer_path: str) -> ChunkEncoder:
    """One encoder a worker process: its tasks go on with what earlier ones have met."""
    return ChunkEncoder(tokenizer_path)


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them in batches of fixed-size lists."""

    def __init__(self, stream, dtype: np.dtype, length: int, rows: int):
        self.length, self.rows, self.dtype = length, rows, dtype
        self.buffer, self.tokens = bytearray(), 0
        values = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(values, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = pa.ipc.new_file(stream, self.schema)

    def add(self, ids: bytes):
        self.buffer += ids
        self.tokens += len(ids) // self.dtype.itemsize
        full = self.length * self.rows * self.dtype.itemsize
        while len(self.buffer) >= full:
            self._write(bytes(self.buffer[:full]), self.length * self.rows)
            del self.buffer[:full]

    def _write(self, raw: bytes, real: int):
        ids = np.frombuffer(raw, self.dtype)
        columns = [pa.array(ids, self.schema[0].type.value_type), pa.array(np.arange(len(ids)) < real)]
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns], schema=self.schema))

    def close(self):
        if self.buffer:
            real, size = len(self.buffer) // self.dtype.itemsize, self.length * self.dtype.itemsize
            self._write(bytes(self.buffer) + bytes(-len(self.buffer) % size), real)
        self.out.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0, length: int = 2048, rows: int = 256) -> DataFrame:
    """Encode whole texts (null: empty), append ``end_id`` and write files in ascending id order,
    one for each range of ids.  Null ids come first; rows of one id are ordered by text.  Repeated rows are
    written repeatedly, an empty table gives an empty manifest, other columns are not read.

    Returns the manifest ``part, path, tokens, docs``, a written table that names only files of
    task attempts that succeeded; ``part`` gives the order of the files."""
    rows_in = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    ordered = rows_in.repartitionByRange("id").sortWithinPartitions("id", "t")
    schema = pa.schema([("part", pa.int64()), ("path", pa.string()), ("tokens", pa.int64()), ("docs", pa.int64())])

    def write(batches):
        encode, writer = encoder(tokenizer_path), None
        end = np.array([end_id], encode.dtype).tobytes()
        part, n_docs = TaskContext.get().partitionId(), 0
        stem = f"part-{part:06d}-{uuid.uuid4().hex}"
        for batch in slices(batches):
            if writer is None:
                fs, base = pafs.FileSystem.from_uri(folder)
                fs.create_dir(base, recursive=True)
                stream = fs.open_output_stream(f"{base}/{stem}.arrow", compression=None)
                writer = SequenceWriter(stream, encode.dtype, length, rows)
                index_stream = fs.open_output_stream(f"{base}/{stem}.docs.arrow", compression=None)
                index_schema = pa.schema([batch.schema.field(0), ("at", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(index_stream, index_schema)
            at, sizes = [], []
            for ids in encode(batch.column(1).to_pylist()):
                ids += end
                at.append(writer.tokens)
                sizes.append(len(ids) // encode.dtype.itemsize)
                writer.add(ids)
            index.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int64()), pa.array(sizes, pa.int64())],
                                                         schema=index_schema))
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            index.close()
            stream.close()
            index_stream.close()
            yield batch_of(schema, [[part], [f"{folder}/{stem}.arrow"], [writer.tokens], [n_docs]])

    return written(ordered.mapInArrow(write, "part long, path string, tokens long, docs long"), "token-manifest")


class TokenFile:
    """Random access to one file.  On a local file system the arrays are views of the mapped file."""

    def __init__(self, path: str):
        self.reader, self.index = (pa.ipc.open_file(self._open(p)) for p in (path, path.removesuffix(".arrow") + ".docs.arrow"))
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        self.at, self.batch = None, None

    @staticmethod
    def _open(path):
        fs, name = pafs.FileSystem.from_uri(path)
        return pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)

    def _flat(self, k: int) -> np.ndarray:
        if self.at != k:
            self.at, self.batch = k, self.reader.get_batch(k)
        return self.batch.column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; every batch but the last has the same number of rows."""
        ids = self._flat(i // self.rows)
        row = i % self.rows
        mask = self.batch.column(1).slice(row, 1).flatten()
        return ids[row * self.length:(row + 1) * self.length], mask.to_numpy(zero_copy_only=False)

    def span(self, at: int, n: int):
        """Views that together hold ids ``at`` to ``at + n``."""
        size = self.length * self.rows
        while n:
            piece = self._flat(at // size)[at % size:at % size + n]
            yield piece
            at, n = at + len(piece), n - len(piece)


def read_token_files(manifest: DataFrame, id_col: str, id_type: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, read back from the files, a task a file.

    ``start`` counts the ids of all documents before it over all files; ``ids_crc32`` is the CRC-32
    of the document's ids as little-endian unsigned 32-bit integers."""
    # one row a file, so this window is as small as the list of files
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("path", before.alias("base")).repartition(
        max(manifest.sparkSession.sparkContext.defaultParallelism, 1), "path")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["path"])
                for k in range(file.index.num_record_batches):
                    docs, crcs = file.index.get_batch(k), []
                    for at, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc = 0
                        for piece in file.span(at, n):
                            crc = zlib.crc32(piece.astype("<u4"), crc)
                        crcs.append(crc)
                    starts = pa.array(docs.column(1).to_numpy() + row["base"])
                    yield pa.RecordBatch.from_arrays([docs.column(0), starts, docs.column(2), pa.array(crcs, pa.int64())],
                                                     names=[id_col, "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(read, f"{id_col} {id_type}, start long, n_tokens long, ids_crc32 long")


def token_file_digest(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of all documents into the shared folder and read them back."""
    manifest = write_token_files(docs, shared_folder(docs.sparkSession, "tokens"), tokenizer_path, id_col, text_col)
    return read_token_files(manifest, id_col, docs.schema[id_col].dataType.simpleString())
