"""Token ids in files of length-delimited records, with a separate index of offsets.

A file is a row of frames, each

    length (8 bytes) | masked CRC-32C of the length (4) | record | masked CRC-32C of it (4)

with little-endian numbers. A record is its document's id (8 bytes), the number of ids before
it in the file (8), flags (4) and the ids, 2 bytes each where the vocabulary allows, else 4.

Documents are dealt to tasks by ranges of (doc_id, hash of the text), which Spark draws, and
sorted; each task writes one file. The index (file, path, offset, length) is a Spark table,
so it is committed with the task: files of lost or repeated attempts bear other names and no
entry points to them. With the index, records are read in any order.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeledger.llm.crc32c import crc32c, masked
from gradeledger.llm.runs import Runs
from gradeledger.llm.store import join_small, new_folder, stored
from gradeledger.llm.workers import begin, keeps

#: Bytes of text for one file, about.
FILE_BYTES = 64 << 20
#: Bytes of text encoded, and of records read, at once, about.
TEXT_BYTES = READ_BYTES = 8 << 20
#: A sign that is a piece and a token of its own, between runs asked for together.
MARK = "\x01"
#: Id that ends each document.
END_ID = 1

#: Runs whose tokens together have the bytes of their lower case: no marks to compose, no white space.
_PLAIN = re.compile("[\x21-\x7e\xa1-\u024f]+")
_WORD_END = "</w>"

_FIELDS = "<qqI"
_WIDE, _NULL_ID = 1, 2  # flags: ids of 4 bytes; the document's id is null
_FRAME = 16  # bytes of a frame besides the record
INDEX = "file int, path string, offset long, length long"


def token_bytes(content: str) -> tuple[np.ndarray, np.ndarray] | None:
    """By id, the bytes of normalized text that a token stands for and whether it ends a word;
    None unless the vocabulary only lower-cases, works on bytes and marks the ends of words."""
    told = json.loads(content)
    model, steps = told["model"], ((told.get("normalizer") or {}).get("normalizers") or [])
    cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    shape = [model.get("type"), model.get("end_of_word_suffix"), model.get("continuing_subword_prefix") or None, model.get("dropout")]
    last = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    if (
        shape != ["BPE", _WORD_END, None, None]
        or [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]
        or (steps[1]["pattern"], steps[1]["content"]) != ({"Regex": "\\s+"}, " ")
        or not last.items() <= cuts[-1].items()
        or any("<|" not in t["content"] for t in told["added_tokens"])
    ):
        return None
    vocabulary = model["vocab"]
    size, ends = np.zeros(max(vocabulary.values()) + 1, np.int64), np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():  # each byte is one character
        ends[i] = token.endswith(_WORD_END)
        size[i] = len(token) - len(_WORD_END) * ends[i]
    return size, ends


class RunEncoder(Runs):
    """The tokenizers library, asked once for each run of text without white space."""

    def __init__(self, content: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.token_bytes = token_bytes(content)

    def learn(self, runs: list[str]) -> None:
        """Asks the library for many runs in one text.

        Runs whose bytes are known are told apart by adding up their tokens' bytes; between the
        others stands ``MARK``.
        """
        plain: list[str] = []
        rest: list[str] = []
        for run in runs:
            (plain if self.token_bytes and _PLAIN.fullmatch(run) and "<|" not in run else rest).append(run)
        for i in range(0, len(plain), 1_000):
            if not self._measured(some := plain[i : i + 1_000]):
                rest += some
        self._marked(rest)

    def _measured(self, runs: list[str]) -> bool:
        """Learns the runs if each ends where a word of its bytes ends."""
        made = self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids
        ids, (size, ends) = np.array(made, np.int64), self.token_bytes
        if len(ids) == 0 or ids.max() >= len(size) or not size[ids].all():
            return False
        wanted = np.cumsum([len(r) if r.isascii() else len(r.lower().encode()) for r in runs])
        reached = np.cumsum(size[ids])
        last = np.minimum(np.searchsorted(reached, wanted), len(ids) - 1)
        if reached[-1] != wanted[-1] or (reached[last] != wanted).any() or not ends[ids[last]].all():
            return False
        data, item, at = ids.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize, 0
        for run, end in zip(runs, ((last + 1) * item).tolist(), strict=True):
            self.known[run] = data[at:end]
            at = end
        return True

    def _marked(self, runs: list[str]) -> None:
        for i in range(0, len(runs), 1_000):
            some = runs[i : i + 1_000]
            made = self.tokenizer.encode_batch_fast([f" {MARK} ".join([*some, ""])], add_special_tokens=False)
            ids = np.array(made[0].ids, self.kind)
            ends = np.flatnonzero(ids == self.mark).tolist() if len(self.mark) == 1 else []
            if len(ends) == len(some) and not any(MARK in r for r in some):
                data, size, at = ids.tobytes(), ids.itemsize, 0
                for run, end in zip(some, ends, strict=True):
                    self.known[run] = data[at * size : end * size]
                    at = end + 1
            else:
                for run, one in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    self.known[run] = np.array(one.ids, self.kind).tobytes()


_ENCODERS: dict[str, RunEncoder] = {}
keeps("records", _ENCODERS.clear)


def encoder(content: str) -> RunEncoder:
    """One encoder per worker process."""
    key = sha256(content.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = RunEncoder(content)
    return _ENCODERS[key]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows together up to about ``TEXT_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // TEXT_BYTES
    firsts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for first, last in zip(firsts, [*firsts[1:], batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


def frames(records: list[bytes]) -> list[bytes]:
    """Each record with its lengths and checksums."""
    heads = [struct.pack("<Q", len(r)) for r in records]
    of_head, of_record = (masked(crc32c(x)).astype("<u4") for x in (heads, records))
    return [b"".join((h, of_head[i].tobytes(), r, of_record[i].tobytes())) for i, (h, r) in enumerate(zip(heads, records, strict=True))]


def unframe(data: list[bytes]) -> list[bytes]:
    """The records of whole frames; a wrong length or checksum is an error."""
    heads, records = [d[:8] for d in data], [d[12:-4] for d in data]
    sizes = np.array([len(r) for r in records], np.uint64)
    sound = np.frombuffer(b"".join(heads), "<u8") == sizes
    sound &= np.frombuffer(b"".join(d[8:12] for d in data), "<u4") == masked(crc32c(heads))
    sound &= np.frombuffer(b"".join(d[-4:] for d in data), "<u4") == masked(crc32c(records))
    if not sound.all():
        raise ValueError(f"{int((~sound).sum())} records are damaged")
    return records


def files_of(uri: str) -> tuple[FileSystem, str]:
    """The file system and path of a folder or file, local or of a shared store."""
    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def write_records(docs: DataFrame, path: str | Path, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encodes documents (doc_id, text) with the vocabulary file ``path``, writes records below
    ``folder`` in ascending doc_id order, files numbered by range, and gives the index as stored.

    Null texts count as empty and have the end id alone. Null ids come first; rows with one
    id follow each other by hash and text, equal rows stay rows. Further columns are
    ignored; an empty table gives no files. A worker holds a batch of texts and the runs seen.
    ``folder`` must be one that all executors share.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    n = max((size.bytes or 0) // FILE_BYTES, min(size.n, spark.sparkContext.defaultParallelism), 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("records")
        words = encoder(content.value)
        end = np.array([end_id], words.kind).tobytes()
        part = TaskContext.get().partitionId()
        files, place = files_of(folder)
        name, out, offset, before = f"records-{part:06d}-{uuid.uuid4().hex}", None, 0, 0
        try:
            for batch in (part for b in batches for part in _slices(b)):
                if out is None:
                    files.create_dir(place, recursive=True)
                    out = files.open_output_stream(f"{place}/{name}")
                records = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(batch.column(1)), strict=True):
                    flags = _WIDE * words.wide + _NULL_ID * (doc_id is None)
                    records.append(struct.pack(_FIELDS, doc_id or 0, before, flags) + ids + end)
                    before += (len(ids) + len(end)) // len(end)
                made = frames(records)
                out.write(b"".join(made))
                lengths = np.fromiter(map(len, made), np.int64, len(made))
                offsets = offset + np.cumsum(lengths) - lengths
                offset += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(made), pa.int32()), pa.array([f"{folder}/{name}"] * len(made)), pa.array(offsets), pa.array(lengths)],
                    ["file", "path", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    key = ["doc_id", "_hash"]
    dealt = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange(int(n), *key).sortWithinPartitions(*key, "text")
    return stored(dealt.select("doc_id", "text").mapInArrow(work, INDEX), "index")


def read_records(index: DataFrame, seed: int | None = None) -> DataFrame:
    """file, doc_id, first (ids before it in its file), n_tokens and ids_crc32 of each record.

    Without ``seed``, entries are read as they are stored, neighbours in one go. With it, they
    are dealt and permuted by a hash, and each record is fetched from its own offset. Every
    length and checksum is tested; ids_crc32 is over the ids as 32-bit little-endian integers.
    """
    schema = "file int, doc_id long, first long, n_tokens long, ids_crc32 long"
    if seed is not None:
        order = F.xxhash64(F.lit(seed), "path", "offset")
        index = index.withColumn("_order", order).repartition("_order").sortWithinPartitions("_order").drop("_order")

    def fetch(entries: list[tuple]) -> Iterator[list[tuple[int, bytes]]]:
        """Frames with their file numbers, in groups of some MB."""
        opened, handle, group, held = None, None, [], 0
        run: list[tuple] = []

        def read() -> list[tuple[int, bytes]]:
            nonlocal opened, handle
            file, path, offset, _ = run[0]
            if path != opened:
                if handle is not None:
                    handle.close()
                files, place = files_of(path)
                opened, handle = path, files.open_input_file(place)
            data = handle.read_at(sum(e[3] for e in run), offset)
            out, at = [], 0
            for e in run:
                out.append((file, data[at : at + e[3]]))
                at += e[3]
            return out

        for entry in entries:
            if run and (entry[1] != run[-1][1] or entry[2] != run[-1][2] + run[-1][3]):
                group += read()
                run.clear()
            run.append(entry)
            held += entry[3]
            if held >= READ_BYTES:
                group += read()
                run.clear()
                yield group
                group, held = [], 0
        if run:
            group += read()
        if group:
            yield group
        if handle is not None:
            handle.close()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = list(zip(*(batch.column(c).to_pylist() for c in ("file", "path", "offset", "length")), strict=True))
            for group in fetch(entries):
                rows = []
                for (file, _), record in zip(group, unframe([d for _, d in group]), strict=True):
                    doc_id, first, flags = struct.unpack_from(_FIELDS, record)
                    ids = np.frombuffer(record, "<u4" if flags & _WIDE else "<u2", offset=struct.calcsize(_FIELDS))
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((file, None if flags & _NULL_ID else doc_id, first, len(ids), crc))
                kinds = [pa.int32(), *[pa.int64()] * 4]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "first", "n_tokens", "ids_crc32"])

    return index.mapInArrow(work, schema)


def token_records(docs: DataFrame, path: str | Path, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the records of ``docs`` to a new shared folder and reads them back: doc_id, start
    (ids of all documents before it), n_tokens (with the end id) and ids_crc32.

    Starts add the ids of the files before, of which there are as many rows as files.
    """
    folder = folder or new_folder(docs.sparkSession, "records")
    read = stored(read_records(write_records(docs, path, folder, end_id)), "records-read")
    files = read.groupBy("file").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    firsts = stored(files.select("file", F.coalesce(before, F.lit(0)).alias("before")), "files")
    placed = join_small(read, firsts, ["file"], spread=F.col("first"))
    return placed.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
