"""Files of token records against the tokenizers library, on odd rows and damaged files."""

import struct
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gradeledger.llm import runs
from gradeledger.llm.crc32c import crc32c, masked
from gradeledger.llm.queries import QUERIES, table
from gradeledger.llm.records import RunEncoder, frames, read_records, token_records, unframe, write_records

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def plain_crc(message):
    c = 0xFFFFFFFF
    for b in message:
        c ^= b
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def brute(rows):
    """doc_id, start, n_tokens, ids_crc32 by the library on whole texts."""
    library = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_checksum():
    assert crc32c([b"123456789"]).tolist() == [0xE3069283]
    messages = [bytes(range(256))[: 4 + i] * (1 + i % 40) for i in range(0, 200, 7)]
    assert crc32c(messages).tolist() == [plain_crc(m) for m in messages]
    assert crc32c([]).tolist() == []


def test_frames_and_damage():
    made = [b"a" * 20, b"bc" * 4000, bytes(21)]
    data = frames(made)
    assert unframe(data) == made
    length, of_length = struct.unpack("<QI", data[1][:12])
    assert length == 8000 and of_length == masked(crc32c([data[1][:8]]))[0]
    for at in (0, 9, 100, len(data[1]) - 1):
        bad = bytearray(data[1])
        bad[at] ^= 1
        with pytest.raises(ValueError, match="1 records are damaged"):
            unframe([data[0], bytes(bad), data[2]])


@pytest.mark.parametrize("text", [
    "Ünï é ́x  İΣΣ", "a\x1cb\x1f c\x85d\xa0e　f g", "x<|endoftext|> <|startoftext|>y", "一丁 \U0001f600‍!?'s it's",
    "word " * 3000, "w" * 5000, "", " \n\t", "a \x01 b\x01c \x01", "\x01", "x \x02y'\x01",
])
def test_runs_give_the_library_ids(text):
    ours = RunEncoder(Path(VOCABULARY).read_text(encoding="utf-8"))
    library = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    for _ in range(2):  # the second time from memory
        assert np.frombuffer(ours.encode(pa.array([None, text, ""]))[1], ours.kind).tolist() == library
    assert all(len(r) <= runs.LONGEST_REMEMBERED for r in ours.known)


def test_forgotten_runs(monkeypatch):
    monkeypatch.setattr(runs, "REMEMBERED", 3)
    ours = RunEncoder(Path(VOCABULARY).read_text(encoding="utf-8"))
    library = Tokenizer.from_file(VOCABULARY)
    for text in ("a b c d e f", "a b x", "x y z a", "f e d c b a") * 2:
        assert np.frombuffer(ours.encode(pa.array([None, text, ""]))[1], ours.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_rows(spark, odd, no_docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(tuple(r) for r in token_records(odd, VOCABULARY).collect())
    assert got == sorted(brute(sorted(rows, key=lambda r: (r[0], r[1] or ""))))
    assert token_records(no_docs, VOCABULARY).count() == 0


def test_null_and_repeated_ids(spark):
    """Null ids come first; one id that most rows share goes to several files, in one order."""
    rows = [(None, "z"), (None, None), (3, "last"), *[(2, f"text {i % 50}") for i in range(300)], (1, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = token_records(docs, VOCABULARY)
    assert got.where("doc_id is null").agg({"start": "max"}).first()[0] <= 2
    rest = sorted((r.start, r.doc_id, r.n_tokens) for r in got.where("doc_id is not null").collect())
    assert [d for _, d, _ in rest] == [1, *[2] * 300, 3]
    assert all(a[0] + a[2] == b[0] for a, b in zip(rest, rest[1:], strict=False))
    assert sorted(got.collect(), key=repr) == sorted(token_records(docs.repartition(2), VOCABULARY).collect(), key=repr)


def test_shuffled_reads_and_files(spark, odd, tmp_path):
    """The same records in any order; files bear the ids in ascending order, nothing between frames."""
    folder = f"file://{tmp_path}/r"
    index = write_records(odd, VOCABULARY, folder)
    by_name = lambda df: sorted(map(tuple, df.collect()))
    assert by_name(read_records(index)) == by_name(read_records(index, seed=7))
    entries = sorted((e.file, e.offset, e.length, e.path) for e in index.collect())
    ids = []
    for path in dict.fromkeys(e[3] for e in entries):
        data = Path(path.removeprefix("file://")).read_bytes()
        own = [(o, n) for _, o, n, p in entries if p == path]
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) == len(data)
        ids += [struct.unpack_from("<q", r)[0] for r in unframe([data[o : o + n] for o, n in own])]
    assert ids == sorted(r.doc_id for r in odd.collect())


def test_damaged_file_is_an_error(spark, odd, tmp_path):
    index = write_records(odd, VOCABULARY, str(tmp_path))
    path = Path(max(tmp_path.glob("records-*"), key=lambda p: p.stat().st_size))
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 4
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        read_records(index).collect()


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_query_equals_the_library(spark):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    got = sorted(tuple(r) for r in QUERIES["op11_token_records"](spark, SF).collect())
    assert got == sorted(brute(rows))


def test_plain_runs_are_asked_without_marks():
    """Runs whose bytes are known need no mark between them; all have the library's ids."""
    library = Tokenizer.from_file(VOCABULARY)
    words = RunEncoder(Path(VOCABULARY).read_text(encoding="utf-8"))
    asked = []

    class Recorder:
        def encode_batch_fast(self, texts, **more):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **more)

    words.tokenizer = Recorder()
    plain = ["it's", "Words,", "</w>", "a</w>b", "</w>", "12,5%", "\u0130stanbul", "\u023a\u00c9", "\u00adx", "<", "|>", "..." * 50, "w" * 300]
    odd = ["", "<|endoftext|>", "x<|startoftext|>y", "e\u0301", "\u0301e", "\u03a3\u03a3", "\u4e2d\u6587", "\x01", "a\x01b", "\x7f", "\u212a"]
    for some in (plain, odd, [*plain, *odd], [f"{p}{o}" for p in plain for o in odd]):
        words.known.clear()
        words.learn(list(dict.fromkeys(some)))
        for run in some:
            want = np.array(library.encode(run, add_special_tokens=False).ids, words.kind).tobytes()
            assert words.known[run] == want, run
        if some is plain:
            assert not any("\x01" in text for text in asked)
