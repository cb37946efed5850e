"""Alignment of two tokenizers' tokens of the same bytes.

Both tokenizers cut a text's bytes into tokens. Offsets where both have a token's end are
shared cuts; between neighbouring ones lie the groups. They are found by divide and conquer:
in an interval, the first token's end near the middle that the other tokenizer also has, found
by bisecting its ends, divides the interval in two; an interval without one is a group. All
intervals of a batch of texts are worked on together, level by level.

Tokens that end together are linked: one is the tail of the other, so the pairs of ids that can
ever be linked are listed from the two vocabularies alone, and counts over the whole corpus
fit in one array of that length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeledger.llm.arrow import list_column
from gradeledger.llm.store import stored
from gradeledger.llm.workers import begin, keeps

#: Characters of text that are tokenized and aligned together, about.
SLICE = 1 << 19
#: Characters from which one text is tokenized in parts.
LONG = 1 << 20

# How the byte-level vocabulary cuts texts; the mark that stands for a space in pieces, and the form of byte pieces.
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"
#: Characters whose classes differ between Unicode versions, or might.
_UNUSUAL = re.compile("[^\x00-\u024f\u2000-\u206f]")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
#: A space between two ASCII letters: neither tokenizer has a token across its front.
_PART_END = re.compile("(?<=[a-zA-Z]) (?=[a-zA-Z])")


def byte_of_sign() -> dict[str, int]:
    """The byte that each printable sign of a byte-level vocabulary stands for."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in {*own}]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of each id, and the pairs of ids that may be linked."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        signs = byte_of_sign()
        a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        file = json.loads(byte_level)
        added = {t["content"] for t in file["added_tokens"]}
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = token.encode() if token in added else bytes(signs[c] for c in token)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            plain = b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace(SPACE_MARK, " ").encode()
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else plain)
        self.bytes = a_bytes, b_bytes
        # ids ascend in the order of merges, so they are ranks
        ranks = {a_bytes[i]: i for t, i in file["model"]["vocab"].items() if t not in added}
        self.quick = tiktoken.Encoding("a", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
        self.lengths = [np.array([len(x) for x in t], np.int64) for t in self.bytes]
        self.pairs = self._pairs()  # ascending a * width + b
        self.width = len(b_bytes)
        self.b_of_pair = self.pairs % self.width
        numbers = [str(i) for i in range(max(len(a_bytes), len(b_bytes)))]
        table = [(n + sign).encode() for n in numbers for sign in ",|;"]
        lengths = np.array([len(t) for t in table], np.int64)
        self.table = np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths

    def _pairs(self) -> np.ndarray:
        """Pairs of which one's bytes are the tail of the other's (or equal)."""
        a_bytes, b_bytes = self.bytes
        found = set()
        for x, y, swap in ((a_bytes, b_bytes, False), (b_bytes, a_bytes, True)):
            by_bytes: dict[bytes, list[int]] = {}
            for j, t in enumerate(y):
                by_bytes.setdefault(t, []).append(j)
            for i, t in enumerate(x):
                for at in range(len(t)):
                    for j in by_bytes.get(t[at:], ()):
                        found.add((j, i) if swap else (i, j))
        return np.array(sorted(a * len(b_bytes) + b for a, b in found), np.int64)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; long texts in parts, where no token crosses."""
        parts, whole = [], []
        for i, text in enumerate(texts):
            own = _parts(text)
            parts += own
            whole += [i] * len(own)
        a = [self.ids_a(" " + p) for p in parts]
        b = [np.array(ids, np.int64) for ids in self.b.encode(parts, num_threads=1)]
        if len(parts) == len(texts):
            return a, b
        ends = np.searchsorted(whole, np.arange(len(texts) + 1))
        joined = lambda x: [np.concatenate(x[ends[i] : ends[i + 1]]) for i in range(len(texts))]
        return joined(a), joined(b)

    def ids_a(self, text: str) -> np.ndarray:
        """Ids by the byte-level vocabulary. The quicker library gives the same for characters
        whose classes are old; texts with others go to the vocabulary's own."""
        if _UNUSUAL.search(text):
            made = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        else:
            made = self.quick.encode_ordinary(text)
        return np.array(made, np.int64)

    def covers(self, text: str, ids: np.ndarray, side: int) -> bool:
        """Whether the tokens' bytes are those of a space and the text."""
        known = self.bytes[side]
        return b"".join([known[i] for i in ids.tolist()]) == b" " + text.encode()


def _parts(text: str) -> list[str]:
    """A text cut at some spaces, which go: both tokenizers put one in front of each part."""
    if len(text) < LONG:
        return [text]
    out, start = [], 0
    while len(text) - start > LONG:
        end = _PART_END.search(text, start + LONG // 2)
        if end is None:
            break
        out.append(text[start : end.start()])
        start = end.end()
    return [*out, text[start:]]


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices into ``a_ends`` of the ends that ``b_ends`` has too, ascending.

    Both are ascending offsets in one string of all texts; text i has the first's tokens
    ``starts[i]`` to ``starts[i + 1]`` and its end is shared. Each interval [low, high) of the first
    tokenizer's tokens ends at a shared cut; its inner ends are tried from the middle outwards.
    """
    low, high = starts[:-1], starts[1:]
    some = high > low
    low, high = low[some], high[some]
    cuts = [high - 1]
    while len(low):
        inner = high - 1 > low  # an end besides the last
        low, high = low[inner], high[inner]
        middle = (low + high - 1) // 2
        found = np.full(len(low), -1, np.int64)
        open_ = np.arange(len(low))
        step = 0
        while len(open_):
            for sign in (1, -1) if step else (1,):
                at = middle[open_] + sign * step
                valid = (at >= low[open_]) & (at < high[open_] - 1)
                at, who = at[valid], open_[valid]
                place = np.searchsorted(b_ends, a_ends[at])
                hit = b_ends[np.minimum(place, len(b_ends) - 1)] == a_ends[at]
                found[who[hit]] = at[hit]
                open_ = open_[found[open_] < 0]
            step += 1
            reach = (middle[open_] + step < high[open_] - 1) | (middle[open_] - step >= low[open_])
            open_ = open_[reach]
        cut = found >= 0
        low, high, found = low[cut], high[cut], found[cut]
        cuts.append(found)
        low, high = np.concatenate([low, found + 1]), np.concatenate([found + 1, high])
    return np.sort(np.concatenate(cuts))


def align(words: Tokenizers, texts: list[str | None]) -> list[tuple[int, int, int, str, np.ndarray]]:
    """n_a, n_b, n_groups, groups_sha256 and the numbers of the linked pairs, for each text."""
    nothing = (0, 0, 0, "", np.zeros(0, np.int64))
    out: list[tuple] = [nothing] * len(texts)
    given = [i for i, t in enumerate(texts) if t]
    all_a, all_b = words.tokens([texts[i] for i in given])
    rows, a_ids, b_ids = [], [], []
    for i, a, b in zip(given, all_a, all_b, strict=True):
        if words.covers(texts[i], b, 1) and words.covers(texts[i], a, 0):
            rows.append(i)
            a_ids.append(a)
            b_ids.append(b)
    if not rows:
        return out
    a_starts = np.concatenate([[0], np.cumsum([len(x) for x in a_ids])])
    b_starts = np.concatenate([[0], np.cumsum([len(x) for x in b_ids])])
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    a_ends, b_ends = np.cumsum(words.lengths[0][a]), np.cumsum(words.lengths[1][b])
    a_last = shared_cuts(a_ends, b_ends, a_starts)  # of each group
    b_last = np.searchsorted(b_ends, a_ends[a_last])
    pairs = np.searchsorted(words.pairs, a[a_last] * words.width + b[b_last])
    # the text of all groups: first the a tokens of a group, then its b tokens
    n_a, n_b = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.repeat(b_last + 1 - n_b, n_a)] = a * 3
    codes[np.arange(len(b)) + np.repeat(a_last + 1, n_b)] = b * 3
    codes[a_last + b_last + 1 - n_b] += 1
    codes[a_last + b_last + 1] += 2
    data, starts, lengths = words.table
    groups = np.searchsorted(a_last, a_starts - 1, "right")  # before each text
    for n, i in enumerate(rows):
        own = codes[a_starts[n] + b_starts[n] : a_starts[n + 1] + b_starts[n + 1]]
        sizes = lengths[own]
        ends = np.cumsum(sizes)
        line = data[np.repeat(starts[own] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()
        mine = pairs[groups[n] : groups[n + 1]]
        out[i] = (len(a_ids[n]), len(b_ids[n]), len(mine), sha256(line[:-1]).hexdigest(), mine)
    return out


_LOADED: dict[str, Tokenizers] = {}
keeps("align", _LOADED.clear)


def _load(byte_level: str, pieces: bytes) -> Tokenizers:
    """One pair of tokenizers per worker process."""
    key = sha256(byte_level.encode() + pieces).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(byte_level, pieces)
    return _LOADED[key]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows together up to about ``SLICE`` characters."""
    sizes = np.array([len(t) if t else 0 for t in batch.column("text").to_pylist()], np.int64)
    part = np.cumsum(sizes) // SLICE
    firsts = np.flatnonzero(np.diff(part, prepend=-1))
    for first, last in zip(firsts, [*firsts[1:], batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


def link_counts(links: DataFrame, width: int) -> np.ndarray:
    """How many links hold each pair: one row per task and pair, then summed; at most ``width``
    rows, which the two vocabularies fix, come to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, np.int64)
        for batch in batches:
            column = batch.column("links")
            a, b = column.offsets[0].as_py(), column.offsets[-1].as_py()
            counts += np.bincount(column.values.slice(a, b - a).to_numpy(zero_copy_only=False), minlength=width)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["pair", "n"])

    rows = links.select("links").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(width, np.int64)
    for r in rows.collect():
        out[r.pair] = r.n
    return out


def alignments(docs: DataFrame, byte_level: str | Path, pieces: str | Path) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, groups_sha256 and links (numbers of the
    linked pairs in ``Tokenizers.pairs``, in order), as stored.

    ``byte_level`` and ``pieces`` are the two vocabulary files, read on the driver and sent to
    the workers. Null and empty texts, and those whose tokens' bytes are not a space and the
    text, have none. Repeated rows and null ids stay rows; further columns are ignored; an
    empty table gives no rows. Texts above ``LONG`` characters are tokenized in parts.
    """
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes()))
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("align")
        words = _load(*sent.value)
        for batch in (s for b in batches if b.num_rows for s in _slices(b)):
            made = align(words, batch.column("text").to_pylist())
            columns = [pa.array(c, k) for c, k in zip(list(zip(*made, strict=True))[:4], [pa.int64()] * 3 + [pa.string()], strict=True)]
            links = list_column([m[4] for m in made], np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, links], [c.split()[0] for c in schema.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(work, schema), "alignments")


def aligned(docs: DataFrame, byte_level: str | Path, pieces: str | Path) -> DataFrame:
    """``alignments`` with counts over the whole corpus: doc_id, n_a, n_b, n_groups, n_links,
    n_best (links whose pair is counted as often as the most frequent pair of its b id),
    count_sum (of the counts over the links) and groups_sha256."""
    made = alignments(docs, byte_level, pieces)
    words = Tokenizers(Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes())
    counts = link_counts(made, len(words.pairs))
    most = np.zeros(words.width, np.int64)
    np.maximum.at(most, words.b_of_pair, counts)
    sent = docs.sparkSession.sparkContext.broadcast((counts, counts == most[words.b_of_pair]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in batches:
            column = batch.column("links")
            ends = column.offsets.to_numpy().astype(np.int64)
            links = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
            ends -= ends[0]
            totals = [np.concatenate([[0], np.cumsum(x[links], dtype=np.int64)]) for x in (best, counts)]
            sums = [pa.array(t[ends[1:]] - t[ends[:-1]]) for t in totals]
            n_links = pa.array(np.diff(ends))
            columns = [*batch.select(names[:4]).columns, n_links, *sums, batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)
    return made.mapInArrow(work, schema)
