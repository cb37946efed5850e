"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

The vocabulary file is a byte-level BPE whose words end in a mark (lower case, white space
dropped). A text is cut at its special tokens, then at white space; each run is normalised
(NFC, lower case), cut into pieces (clitics, letters, single digits, other signs) and each
piece is encoded:

* an Aho-Corasick automaton gives every token at every position in one pass;
* from the left, the longest token is taken that is compatible with the one before it and
  doesn't end where the rest is known to fail; if there is none, the last token is given up
  for its next shorter one. A position that failed once fails for ever, so time is linear;
* two tokens are compatible if no merge would have joined them across their border before
  both were complete. Verdicts are kept in a table.

A sequence whose neighbours are all compatible is the one that merging in rank order gives.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from hashlib import sha256
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.llm.arrow import list_column
from gradeledger.llm.runs import Runs
from gradeledger.llm.workers import begin, keeps

#: Pairs of tokens, and pieces, that a worker remembers at most.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 100
#: Documents worked on at once, and ids decoded at once.
ROWS = 1_000
DECODE_IDS = 1 << 20

# The cutting pattern of the vocabulary, the mark of a word's end, and white
# space as Unicode has it (Python's split also takes U+001C to U+001F).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
SPACES = "\t\n\v\f\r \x85\xa0  -     　"

_PIECE = regex.compile(PIECES.replace(r"\s", SPACES))
_END = 0x10000  # added to the last character of a piece: one symbol with the word's end


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself, or the next free one above 255."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    signs, free = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in signs:
            signs[b], free = chr(free), free + 1
    return [signs[b] for b in range(256)]


class Vocabulary(Runs):
    """Tables of one vocabulary file. Tokens are numbered by rank: signs, then merges."""

    def __init__(self, content: str):
        super().__init__()
        file = json.loads(content)
        ids: dict[str, int] = file["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.signs = byte_signs()
        names = [*self.signs, *(s + WORD_END for s in self.signs)]
        self.forms = [*self.signs, *(chr(ord(s) + _END) for s in self.signs)]
        self.parts: list[tuple[int, int] | None] = [None] * len(names)
        rank = {name: r for r, name in enumerate(names)}
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b = rank[left], rank[right]
            rank[left + right] = self.merged[a, b] = len(names)
            names.append(left + right)
            self.forms.append(self.forms[a] + self.forms[b])
            self.parts.append((a, b))
        self.ids = np.array([ids[n] for n in names], "<u4")
        self.lengths = [len(f) for f in self.forms]
        texts = {i: t for t, i in [*ids.items(), *self.special.items()]}
        size = max(texts) + 1
        self.token_table = offset_table([(texts.get(i, "") + " ").encode() for i in range(size)])
        self.number_table = offset_table([f"{i} ".encode() for i in range(size)])
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.compatible: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for r, form in enumerate(self.forms):
            if self.parts[r] is None or self.joins(*self.parts[r], r):
                self.automaton.add_word(form, r)
        self.automaton.make_automaton()

    def border_merge(self, a: int, b: int) -> int | None:
        """The merge that joins a and b, or parts of them, across their border; or None.

        Walks back in time: of the two tokens at the border, the one made last is undone
        until a merge of both is found that comes before the ones undone. Of equal merges
        the left one comes first.
        """
        a_by = b_by = len(self.forms)
        while True:
            m = self.merged.get((a, b))
            if m is not None and m < a_by and m <= b_by:
                return m
            if self.parts[a] is None and self.parts[b] is None:
                return None
            if self.parts[b] is None or (self.parts[a] is not None and a > b):
                a_by, a = a, self.parts[a][1]
            else:
                b_by, b = b, self.parts[b][0]

    def joins(self, a: int, b: int, into: int) -> bool:
        """Whether the parts of a merge really come to it: nothing joins them otherwise."""
        return self.border_merge(a, b) == into

    def fits(self, a: int, b: int) -> bool:
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) >= REMEMBERED:
                self.compatible.clear()
            known = self.compatible[a, b] = self.border_merge(a, b) is None
        return known

    def piece(self, text: str) -> list[int]:
        """Ranks of the tokens of one piece."""
        signs = [self.signs[b] for b in text.encode("utf-8", "surrogatepass")]
        signs[-1] = chr(ord(signs[-1]) + _END)
        form = "".join(signs)
        n, lengths, fits = len(form), self.lengths, self.fits
        at: list[list[int]] = [[] for _ in range(n)]
        for end, r in self.automaton.iter(form):
            at[end - lengths[r] + 1].append(r)  # ascending length
        out: list[int] = []
        left = [len(at[0])]  # candidates not tried yet, for each token taken and the next one
        failed = bytearray(n + 1)
        pos = 0
        while pos < n:
            k = left[-1] - 1
            while k >= 0:
                r = at[pos][k]
                if not failed[pos + lengths[r]] and (not out or fits(out[-1], r)):
                    break
                k -= 1
            if k >= 0:
                left[-1] = k
                out.append(r)
                pos += lengths[r]
                left.append(len(at[pos]) if pos < n else 0)
            else:
                failed[pos] = 1
                left.pop()
                pos -= lengths[out.pop()]
        return out

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one piece; two generations of pieces are remembered, as of runs."""
        known = self.pieces.get(piece)
        if known is None:
            known = self.older_pieces.get(piece)
            if known is None:
                known = self.ids[self.piece(piece)].tobytes()
            if len(piece) <= LONGEST_REMEMBERED:
                if len(self.pieces) >= REMEMBERED:
                    self.older_pieces, self.pieces = self.pieces, {}
                self.pieces[piece] = known
        return known

    def run(self, text: str) -> bytes:
        """Ids of a run without white space, as 32-bit little-endian integers."""
        if self.cut is not None and self.cut.search(text):
            parts = enumerate(self.cut.split(text))
            return b"".join(
                self._plain(p) if i % 2 == 0 else np.array([self.special[p]], "<u4").tobytes() for i, p in parts
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return b"".join(map(self.piece_ids, _PIECE.findall(text.lower())))

    def learn(self, runs: list[str]) -> None:
        self.known.update((r, self.run(r)) for r in runs)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens with one space between, in UTF-8."""
        return look_up(self.token_table, ids)[:-1]

    def numbers(self, ids: np.ndarray) -> bytes:
        """The ids in decimal with one space between."""
        return look_up(self.number_table, ids)[:-1]


def offset_table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries as one array of bytes, the start of each, and its length."""
    lengths = np.array([len(e) for e in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(lengths) - lengths, lengths


def look_up(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> bytes:
    data, starts, lengths = table
    out = []
    for i in range(0, len(ids), DECODE_IDS):
        own = ids[i : i + DECODE_IDS]
        n = lengths[own]
        ends = np.cumsum(n)
        out.append(data[np.repeat(starts[own] - ends + n, n) + np.arange(ends[-1])].tobytes())
    return b"".join(out)


_LOADED: dict[str, Vocabulary] = {}
keeps("bpe", _LOADED.clear)


def vocabulary(content: str) -> Vocabulary:
    """One set of tables per worker process."""
    key = sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(content)
    return _LOADED[key]


def encode_decode(docs: DataFrame, path: str | Path, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per document: doc_id, n_tokens and the ``outputs`` wanted.

    ``ids`` (array of the token ids), ``ids_sha256`` (digest of the decimal ids joined by one
    space), ``decoded`` (the ids decoded again, tokens joined by one space) and
    ``decoded_sha256``. ``path`` is the vocabulary file, read on the driver; its content, a
    few MB, is sent to the workers, which keep tables and runs seen between tasks.

    A null text counts as empty: no ids, decoded "". Repeated rows and null ids stay rows;
    further columns are ignored; an empty table gives no rows.
    """
    kinds = {"ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    schema = "doc_id long, n_tokens long" + "".join(f", {o} {kinds[o]}" for o in outputs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        words = vocabulary(content.value)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            all_ids = [np.frombuffer(ids, "<u4") for ids in words.encode(batch.column("text"))]
            made = [batch.column("doc_id"), pa.array([len(i) for i in all_ids], pa.int64())]
            texts = [words.decode(i) for i in all_ids] if {"decoded", "decoded_sha256"} & {*outputs} else []
            for o in outputs:
                if o == "ids":
                    made.append(list_column(all_ids, np.int32))
                elif o == "ids_sha256":
                    made.append(pa.array([sha256(words.numbers(i)).hexdigest() for i in all_ids], pa.string()))
                elif o == "decoded":
                    made.append(pa.array([t.decode() for t in texts], pa.string()))
                else:
                    made.append(pa.array([sha256(t).hexdigest() for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "n_tokens", *outputs])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)
