"""Ids of texts by way of their runs: a vocabulary that drops white space, and whose tokens never
cross it, gives a text the ids of its runs of other characters."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Runs of text that a worker remembers at most, twice, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 100

_ODD_SPACE = "[\x1c-\x1f]"  # white space to Arrow and Python, not to the vocabulary
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")


class Runs:
    """Encodes texts, learning each run once.

    Two generations of runs are remembered: those not met lately go first. A subclass gives
    ``learn``, which puts the ids of new runs, little-endian integers of ``kind``, into ``known``.
    """

    kind = "<u4"

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, runs: list[str]) -> None:
        raise NotImplementedError

    def _of_runs(self, runs: list[str]) -> list[bytes]:
        """The ids of distinct runs."""
        out = list(map(self.known.get, runs))
        missing = [r for r, ids in zip(runs, out, strict=True) if ids is None]
        again = {r: self.older[r] for r in missing if r in self.older}
        self.known.update(again)
        new = [r for r in missing if r not in again]
        self.learn(new)
        if missing:
            out = list(map(self.known.__getitem__, runs))
        for run in new:
            if len(run) > LONGEST_REMEMBERED:
                del self.known[run]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty.

        Runs are made distinct, looked up once each, and their ids gathered by run number.
        """
        texts = pc.fill_null(texts, "")
        if pc.any(pc.match_substring_regex(texts, _ODD_SPACE)).as_py():
            split = pa.array([list(filter(None, _SPACE.split(t))) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(texts)
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(split.values)
        made = self._of_runs(coded.dictionary.to_pylist())
        size = np.dtype(self.kind).itemsize
        # white space at a text's ends makes empty runs, which have no ids
        lengths = np.fromiter(map(len, made), np.int64, len(made)) // size
        starts, of_word = np.cumsum(lengths) - lengths, coded.indices.to_numpy()
        n = lengths[of_word]
        done = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(made), self.kind)
        flat = ids[np.repeat(starts[of_word] - done[:-1], n) + np.arange(done[-1])].tobytes()
        cuts = (done[ends] * size).tolist()
        return [flat[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
