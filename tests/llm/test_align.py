"""Alignment of two tokenizers against a plain form, on odd texts, long texts and no rows."""

import re
from collections import Counter
from functools import cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gradeledger.llm import align as module
from gradeledger.llm.align import Tokenizers, align, aligned, shared_cuts
from gradeledger.llm.queries import BYTE_LEVEL, PIECES, QUERIES, table

SF = "/root/testdata/sf0.001"


@cache
def libraries():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@cache
def words():
    return Tokenizers(Path(BYTE_LEVEL).read_text(encoding="utf-8"), Path(PIECES).read_bytes())


def bytes_of_a(ids):
    own = [b for r in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(r[0], r[1] + 1)]
    rest = [b for b in range(256) if b not in own]
    table = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    return [bytes(table[c] for c in libraries()[0].id_to_token(i)) for i in ids]


def bytes_of_b(ids):
    pieces = [libraries()[1].id_to_piece(i) for i in ids]
    return [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]


def brute_groups(text):
    """The groups as (a ids, b ids), by sets of ends."""
    if not text:
        return []
    a = libraries()[0].encode(" " + text, add_special_tokens=False).ids
    b = libraries()[1].encode(text)
    forms = bytes_of_a(a), bytes_of_b(b)
    if any(b"".join(f) != b" " + text.encode() for f in forms):
        return []
    ends = [np.cumsum([len(x) for x in f]).tolist() for f in forms]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return groups


def brute(rows):
    made = [(i, brute_groups(t)) for i, t in rows]
    pairs = Counter((x[-1], y[-1]) for _, groups in made for x, y in groups)
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    out = []
    for i, groups in made:
        links = [(x[-1], y[-1]) for x, y in groups]
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links), sha256(line.encode()).hexdigest() if line else "",
        ))
    return sorted(out, key=repr)


TEXTS = [
    "Hello world", " leading", "trailing ", "two  spaces\n\nand\tlines \r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁mark", "a▁b",
    "é é 中文 \U0001f469‍\U0001f467 مرحبا", "x", " ", "\n", "don't we'LL 12345.678e-9", "internationalisation antidisestablishmentarianism",
    "\x00\x01\x7f", "ﬁ ² ㈠", " nbsp　wide", "z" * 400, "0" * 300, "!?" * 200,
]


@pytest.mark.parametrize("text", TEXTS)
def test_groups(text):
    n_a, n_b, n_groups, digest, links = align(words(), [None, text, ""])[1]
    groups = brute_groups(text)
    assert (n_a, n_b, n_groups) == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups))
    line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert digest == (sha256(line.encode()).hexdigest() if line else "")
    assert [divmod(int(p), words().width) for p in words().pairs[links]] == [(x[-1], y[-1]) for x, y in groups]


def test_the_quicker_library_gives_the_same_ids():
    rng = np.random.default_rng(5)
    signs = [*" \n\t\r'abesTZ0٣9.,!?-—–’“é", "ß", "Ā", "ɏ", "\u2003", "\u00a0", "'s", "'ll", "  ", "the", "ation"]
    for _ in range(300):
        text = " " + "".join(rng.choice(signs, int(rng.integers(1, 60))))
        assert words().ids_a(text).tolist() == libraries()[0].encode(text, add_special_tokens=False).ids
    every = " ".join(chr(c) + chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070)])
    assert words().quick.encode_ordinary(every) == libraries()[0].encode(every, add_special_tokens=False).ids


def test_cuts_are_all_shared_ends():
    rng = np.random.default_rng(0)
    for density in (0.02, 0.3, 0.9):
        a_ends, b_ends, starts, at = [], [], [0], 0
        for size in [1, 2, *rng.integers(1, 300, 40)]:
            for ends in (a_ends, b_ends):
                ends += sorted({*(at + 1 + np.flatnonzero(rng.random(size) < density)), at + size})
            at += size
            starts.append(len(a_ends))
        a_ends, b_ends = np.array(a_ends), np.array(b_ends)
        cuts = shared_cuts(a_ends, b_ends, np.array(starts))
        assert a_ends[cuts].tolist() == sorted({*a_ends.tolist()} & {*b_ends.tolist()})


def test_every_possible_pair_is_listed():
    forms = words().bytes
    rng = np.random.default_rng(1)
    known = {*words().pairs.tolist()}
    for a in rng.integers(0, len(forms[0]), 300):
        tails = {i for i, f in enumerate(forms[1]) if f and (forms[0][a].endswith(f) or f.endswith(forms[0][a]))}
        assert {int(a) * words().width + i in known for i in tails} <= {True}


def test_long_texts_in_parts(monkeypatch):
    """Parts give the ids of the whole, with digits, signs and runs of spaces between."""
    text = " ".join(f"word{i} it's, {i}  odd\nLines é e" for i in range(400)) + " z" * 50
    whole = align(words(), [text])[0]
    monkeypatch.setattr(module, "LONG", 500)
    assert len(module._parts(text)) > 10
    parts = align(words(), ["x", text, "a b"])[1]
    assert whole[:4] == parts[:4] and whole[4].tolist() == parts[4].tolist()


@pytest.mark.parametrize("slice_", [50, 1 << 20])
def test_odd_rows(spark, odd, no_docs, monkeypatch, slice_):
    monkeypatch.setattr(module, "SLICE", slice_)
    texts = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id")], "doc_id long, text string")
    docs = odd.unionByName(texts, allowMissingColumns=True).withColumns({"links": odd.n * 0, "pair": odd.n, "groups_sha256": odd.key})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = aligned(docs, BYTE_LEVEL, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert aligned(no_docs, BYTE_LEVEL, PIECES).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_query_equals_plain_form(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, QUERIES["op13_token_alignment"](spark, SF).collect()), key=repr) == brute(rows)
