"""Each operator on nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import math
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradeledger.llm import gru, jaccard, licenses
from gradeledger.llm.bpe import Vocabulary, encode_decode
from gradeledger.llm.chat import maximal_conversations
from gradeledger.llm.components import components
from gradeledger.llm.fingerprint import Fingerprint, fingerprints
from gradeledger.llm.importance import classify, keep_sampled, kth_largest
from gradeledger.llm.jaccard import MAPS, _in_full, _tokens_again, bit_map, differing_bits, document_sets, fold, jaccard_components, one_per_group, signatures
from gradeledger.llm.licenses import scan
from gradeledger.llm.lm import RUN, WARM, lexicon, score, training_runs, word_counts
from gradeledger.llm.mixing import draws, mix, split_units, targets
from gradeledger.llm.rules import host_verdicts, judge, keep_good
from gradeledger.llm.store import join_small
from gradeledger.llm.warc import export, parse, read_archive, round_trip, write_archive

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def ids_of(vocabulary, text):
    return np.frombuffer(vocabulary.encode(pa.array([text]))[0], "<u4")


def words(text):
    return (text or "").encode().lower().split()


def brute_components(rows, width, num, den):
    """Component of each row by all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: math.inf)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize(("width", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_jaccard_join(odd, no_docs, width, num, den):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(tuple(r) for r in jaccard_components(odd, width, num, den).collect())
    assert got == brute_components(rows, width, num, den)
    assert jaccard_components(no_docs, width, num, den).count() == 0


def test_jaccard_join_of_near_copies(spark, monkeypatch):
    """Groups of edited copies in which nearly every token is frequent."""
    monkeypatch.setattr("gradeledger.llm.jaccard.RARE", 3)
    rng = np.random.default_rng(1)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(int(rng.integers(12, 160)))]
        for _ in range(12):
            own = list(base)
            for _ in range(int(rng.integers(0, 3))):
                own[int(rng.integers(0, len(own)))] = f"e{rng.integers(0, 9)}"
            rows.append((len(rows), " ".join(own[: len(own) - int(rng.integers(0, 2))])))
    got = sorted(tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, 100).collect())
    assert got == brute_components(rows, 3, 80, 100)


def test_jaccard_pairs_of_many_shared_signatures_are_met_seldom(spark):
    """Near copies share nearly all signatures; each pair is met, but not once for each of them."""
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join([*words[:k], "other", *words[k + 1 :]]) for k in range(0, 300, 25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = document_sets(docs, 3, 80, 100).withColumn("nid", F.col("doc_id"))
    live = nodes.selectExpr("explode(sequence(nid % 3, 40)) AS sig", "nid", "nid AS comp")
    met = [tuple(r) for r in _in_full(live, nodes.select("nid", "n", *MAPS), 80, 100).collect()]
    assert set(met) == {(a, b) for a in range(12) for b in range(a + 1, 12)}
    assert len(met) <= 3 * len(set(met))


def test_jaccard_rounds_end_when_pivots_settle_nothing(spark, monkeypatch):
    """Unlike documents under one signature cost one pivot round, not all of them."""
    texts = [" ".join(f"d{i}w{k}" for k in range(30)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = document_sets(docs, 3, 90, 100).withColumn("nid", F.col("doc_id"))
    buckets, real, rounds = nodes.selectExpr("1L AS sig", "nid"), jaccard.stored, []
    monkeypatch.setattr(jaccard, "stored", lambda df, name="stage": rounds.append(name) or real(df, name))
    links = jaccard._linked(buckets, nodes, jaccard._Verifier(docs, nodes, 3, 90, 100), 90, 100)
    assert links.count() == 0 and rounds.count("live") == 2


@pytest.mark.parametrize("named", [True, False])
def test_jaccard_join_of_repeated_near_copies(spark, monkeypatch, named):
    """Near copies whose every row occurs twice, with ids and without."""
    monkeypatch.setattr("gradeledger.llm.jaccard.RARE", 3)
    rng = np.random.default_rng(7)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(int(rng.integers(40, 160)))]
        for _ in range(12):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, len(own)))] = f"e{rng.integers(0, 9)}"
            rows += [(len(rows) // 2 if named or group % 2 else None, " ".join(own))] * 2
    far = 1 << 40  # stands for null, which is no one's smallest id
    want = brute_components([(far if i is None else i, t) for i, t in rows], 3, 80, 100)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_components(frame, 3, 80, 100).na.fill(far).collect()
    assert sorted(tuple(r) for r in got) == want
    nodes = spark.createDataFrame([(0, 4, *rows[-1])], "nid long, n long, doc_id long, text string")
    sid = document_sets(frame.where(F.col("doc_id") == rows[-1][0]), 3, 80, 100).select("doc_id", "sid").distinct()
    assert _tokens_again(frame, nodes.join(sid, "doc_id"), 3).count() == 1


def test_one_per_group(odd, no_docs):
    kept = one_per_group(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect())
    least = {(i, c) for i, _, c in brute_components([(r.doc_id, r.text) for r in odd.collect()], 5, 80, 100)}
    assert ids == sorted({i for i, c in least if i == c})
    assert one_per_group(no_docs).count() == 0


def test_bit_maps_bound_differences():
    rng = np.random.default_rng(2)
    for size in (10, 80, 300, 900):
        x = np.unique(rng.integers(-(2**63), 2**63, size))
        y = np.union1d(x[: size * 8 // 9], rng.integers(-(2**63), 2**63, size // 3))
        k = min(len(bit_map(x)), len(bit_map(y)))
        assert 0 < differing_bits(fold(bit_map(x), k), fold(bit_map(y), k)) <= len(np.setxor1d(x, y))
    assert signatures(10, np.arange(10), np.zeros(0, np.int64), np.zeros(0, np.int64), 9, 10).tolist() == [0, 1]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    comp = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in comp:
        groups[r.comp].add(r.node)
    assert sorted(map(len, groups.values())) == [40, 61]


def test_join_small_splits_hot_keys(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        split = join_small(left, right, ["k"], how, spread=F.col("id"), limit=0)
        assert split.count() == left.join(right, "k", how).count()


def test_quality_rules(odd, no_docs):
    got = {r.doc_id: r for r in judge(odd).collect()}
    assert len(got) == odd.count() - 1 and judge(no_docs).count() == 0
    for r in odd.collect():
        w, o = [x.decode() for x in (r.text or "").encode().split()], got[r.doc_id]
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert (o.n_words, o.word_chars, o.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert o.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "") and o.n_dup_lines == len(lines) - len(set(lines))
        assert o.base_failed == (len(w) < 50 or 2 * len(covered) > len(w)) and not (o.kept and o.base_failed)
    kept = keep_good(odd)
    assert kept.columns == odd.columns and keep_good(no_docs).count() == 0
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_host_rates_shrink(spark):
    """A host with one bad document stays near the mean, one with many does not."""
    rows = [("small", True)] + [("bad", True)] * 90 + [("bad", False)] * 10 + [("fine", False)] * 400 + [(f"mid{i % 30}", i % 7 == 0) for i in range(3000)]
    frame = spark.createDataFrame([(h, f, 0, 0) for h, f in rows], "host string, base_failed boolean, hard int, mild int")
    got = {r.host: r for r in host_verdicts(frame).collect()}
    assert got["bad"].verdict == "poor" and got["fine"].verdict == "good" and got["small"].verdict != "poor"


def test_fingerprints(odd, no_docs):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()))
    got = sorted(fingerprints(odd).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(rows) and fingerprints(no_docs).count() == 0
    for i, (r, (doc_id, text)) in enumerate(zip(got, rows, strict=True)):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, changed = Fingerprint.of(text.encode()), Fingerprint.of(edited.encode())
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (doc_id, len(text), sha256(edited.encode()).hexdigest())
        assert r.fingerprint == own.text() and r.edited_fingerprint == changed.text()
        assert r.near_edited == own.likeness(changed) and r.near_next == own.likeness(Fingerprint.of(following.encode()))


def test_fingerprints_across_buckets(spark, monkeypatch):
    monkeypatch.setattr("gradeledger.llm.fingerprint.BUCKET", 5)
    docs = spark.createDataFrame([(i * i % 101, f"text {i} " * 5) for i in range(50)], "doc_id long, text string").dropDuplicates(["doc_id"])
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r.edited_sha256 for r in fingerprints(docs).collect()}
    for i, (doc_id, text) in enumerate(rows):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + rows[(i + 1) % len(rows)][1][:quarter]
        assert got[doc_id] == sha256(edited.encode()).hexdigest()


def test_fingerprint_is_homomorphic():
    a, b = b"first\nsecond", b"third\nfourth paragraph"
    assert Fingerprint.of(a) + Fingerprint.of(b) == Fingerprint.of(b"third\nsecond\nfirst\nfourth paragraph")
    assert Fingerprint.of(a + b"\n" + b) - Fingerprint.of(b) == Fingerprint.of(a) != Fingerprint.of(b)
    assert Fingerprint.read(Fingerprint.of(a).text()) == Fingerprint.of(a)


def test_fingerprints_of_much_repeated_paragraphs():
    """A place that adds up beyond 16 bits doesn't wrap."""
    few, many = (Fingerprint.of(b"one paragraph\n" * k) for k in (33_000, 65_000))
    x, y = 33_000, 65_000  # both are multiples of one vector, but for the empty paragraph
    assert abs(few.likeness(many) - 2 * x * y / (x * x + y * y)) < 1e-3
    assert Fingerprint.read(many.text()) == many and many - few == Fingerprint.of(b"one paragraph\n" * 31_999 + b"one paragraph")


def test_mixing(odd, no_docs):
    got = draws(odd).collect()
    assert len(got) == odd.count() and draws(no_docs).count() == 0 and mix(no_docs).count() == 0
    assert all(len(r.copies) <= 3 for r in got)
    again = {(r.doc_id, tuple(r.copies)) for r in draws(odd.orderBy(F.desc("doc_id")).repartition(3)).collect()}
    assert again == {(r.doc_id, tuple(r.copies)) for r in got}
    mixed = mix(odd)
    assert mixed.columns == odd.columns
    taken = Counter(r.doc_id for r in mixed.collect())
    want = Counter()
    for r in got:
        want[r.doc_id] += len(r.copies)
    assert taken == +want


def test_mixing_targets():
    assert targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    got = targets([10, 1000, 0], [5, 2, 1])
    assert got[0] == 30 and got[1] == 980 and got[2] == 0
    quota = split_units([40, 3, 0, 100], 8, 1)
    assert quota.sum(1).tolist() == [40, 3, 0, 100] and quota.sum(0).max() - quota.sum(0).min() <= 3 and quota.min() >= 0


def test_mix_comes_near_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 400)), f"s{min(int(rng.integers(0, 9)), 5)}") for i in range(4000)]
    got = draws(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, goal = Counter(), {}
    for r in got:
        taken[r.source] += r.size * len(r.copies)
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= 0.001 * goal[s] + 20 for s in goal)


def test_lm_scores(odd, no_docs):
    rows = [(r.doc_id, [*words(r.text), b""]) for r in odd.collect()]
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(counts.values()), len(counts)
    got = defaultdict(list)
    for r in score(odd).collect():
        got[r.doc_id].append(r)
    assert score(no_docs).count() == 0
    for i, t in rows:
        r = got[i][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 10 == 0, len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel_tol=1e-9)
        assert r.score < 0


def test_lm_trains_on_every_token(odd):
    """Each text's symbols and its end come once, in order, besides those that warm up."""
    counts = word_counts(odd)
    own, frequencies = lexicon(counts)
    want = Counter(tuple(own.read(words(r.text))[0].tolist()) for r in odd.collect())
    got = Counter()
    runs = [(r.symbols, r.skip) for r in training_runs(odd.coalesce(1), own).collect()]
    text: list = []
    for symbols, skip in runs:
        assert symbols[0] == gru.SYMBOLS or text[len(text) - skip :] == symbols[1 : 1 + skip] and skip == WARM
        text += symbols[1 + skip :]
        if text[-1] == gru.SYMBOLS - 1:
            got[tuple(text)] += 1
            text = []
    assert got == want and not text and len(runs) > 2 * 30_000 // RUN
    assert sum(len(s) - 1 - k for s, k in runs) == frequencies.sum()


def test_gru_learns_past_the_first_windows():
    """What comes only far into a run is learnt, unless it is there to warm up."""
    text = np.concatenate([[gru.SYMBOLS], np.tile([3, 4], 30), np.tile([50, 60], 900)])
    p = gru.initial(np.ones(gru.SYMBOLS), 1)
    tail = lambda q: float(np.subtract(*gru.document_scores(q, [text[1:], text[1:1001]])))
    learnt, none = (gru.train(p, [text] * 3 + [text[:9]], np.full(4, k), 0.02) for k in (0, len(text)))
    assert tail(learnt) > tail(p) + 1000 and tail(none) == tail(p)


def test_gru_gradients_and_windows():
    rng = np.random.default_rng(4)
    p = {k: v.astype(np.float64) for k, v in gru.initial(np.ones(gru.SYMBOLS), 1).items()}
    x, y = rng.integers(0, gru.SYMBOLS, (2, 5, 3))
    h = rng.standard_normal((3, gru.HIDDEN)) * 0.1
    loss, grads, _ = gru.gradients(p, x, y, np.ones((5, 3)), h)
    for k in p:
        at = tuple(int(rng.integers(0, s)) for s in p[k].shape) if k != "x" else (int(x[0, 0]), 2)
        old = p[k][at]
        p[k][at] = old + 1e-3
        up = gru.gradients(p, x, y, np.ones((5, 3)), h)[0]
        p[k][at] = old - 1e-3
        down = gru.gradients(p, x, y, np.ones((5, 3)), h)[0]
        p[k][at] = old
        assert math.isclose((up - down) / 2e-3, grads[k][at], rel_tol=0.02, abs_tol=2e-3)
    p = gru.initial(np.ones(gru.SYMBOLS), 1)
    docs = [rng.integers(0, gru.SYMBOLS, n) for n in (200, 3, 77, 0)]
    assert np.allclose(gru.document_scores(p, docs, window=16), gru.document_scores(p, docs, rows=1, window=500), atol=1e-2)


def test_chat(spark):
    turns = [
        (1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (2, 2, "user", "c"), (3, 0, "user", "a"),
        (4, 0, "user", "a"), (4, 1, "bot", "b"), (4, 2, "user", "c"), (5, 0, "user", None), (6, 0, "user", ""), (6, 5000, "bot", "z"),
        (2, 2, "user", "c"), (None, 0, "user", "n"), (7, None, None, "x"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("position", F.lit(1))
    got = sorted(maximal_conversations(frame).collect(), key=lambda r: (r.conv_id or -1, r.part))
    assert [(r.conv_id, r.n_turns, r.n_logged, r.part) for r in got] == [(None, 1, 1, 0), (2, 3, 2, 0), (5, 1, 1, 0), (6, 2, 1, 0), (6, 2, 1, 1), (7, 1, 1, 0)]
    assert got[1].text == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in [("user", "a"), ("bot", "b"), ("user", "c")])
    assert maximal_conversations(frame.limit(0)).count() == 0


def test_bpe(odd, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(VOCABULARY))
    got = {r.doc_id: r for r in encode_decode(odd, VOCABULARY, ("ids", "ids_sha256", "decoded", "decoded_sha256")).collect()}
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        o = got[r.doc_id]
        assert (o.ids, o.decoded, o.n_tokens) == (ids, decoded, len(ids))
        assert o.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest() and o.decoded_sha256 == sha256(decoded.encode()).hexdigest()
    assert encode_decode(no_docs, VOCABULARY).count() == 0


def test_bpe_equals_library_on_odd_strings():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(str(VOCABULARY)), Vocabulary(open(VOCABULARY, encoding="utf-8").read())
    # code points that no Unicode version has assigned differ between libraries
    signs = st.one_of(st.characters(min_codepoint=1, max_codepoint=0x17F), st.sampled_from("ΣσςİßéÀ́　\x1c中文字ไทย🙂'sab"))

    @settings(max_examples=300, deadline=None)
    @given(st.text(signs, max_size=60))
    def same(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text).tolist() == ids
        assert own.decode(ids_of(own, text)).decode() == library.decode(ids, skip_special_tokens=False)

    same()
    for text in ("a" * 5000, "ab" * 3000, "thethethe" * 200, "!?" * 999):
        assert ids_of(own, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_warc(spark, tmp_path):
    big = "<p>WARC/1.1\r\n\r\n" + "x" * 200
    rows = [(3, "u3", big), (1, "u1", big), (2, None, big), (4, "u4", None), (5, "u5", "small"), (6, "u6", "small"), (7, "u7", ""), (None, "u8", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = {r.page_id: r for r in round_trip(pages).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("revisit", 1), None: ("revisit", 1),
        4: ("response", None), 5: ("response", None), 6: ("response", None), 7: ("response", None),
    }
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), sha256(data).hexdigest())
    write_archive(pages, str(tmp_path / "a"))
    archive = read_archive(spark, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 3
    export(archive, str(tmp_path / "files"))
    read = [x for f in (tmp_path / "files").glob("part-*") for x in parse(f.read_bytes())]
    assert sorted(b for _, b in read if b) == sorted([big.encode(), b"small", b"small"]) and len(read) == 8
    assert round_trip(pages.limit(0)).count() == 0


def test_damaged_payload_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    write_archive(pages, str(tmp_path / "a"))
    spark.createDataFrame([(sha256(b"text").hexdigest(), bytearray(b"test"))], "digest string, payload binary").write.mode("overwrite").parquet(str(tmp_path / "a" / "payloads"))
    with pytest.raises(Exception, match="missing or damaged"):
        read_archive(spark, str(tmp_path / "a")).collect()


def test_importance(spark, odd, no_docs):
    good = [(i, " ".join(f"plain{(i * 7 + j) % 50}" for j in range(60))) for i in range(200)]
    junk = [(1000 + i, " ".join(f"x{i}*** {j}$$$" for j in range(40))) for i in range(40)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string").withColumn("key", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(1000, 0, 0), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in classify(docs, labels).where("kept").collect()}
    assert len(kept & {i for i, _ in good}) >= 195 and not kept & {i for i, _ in junk}
    stage = keep_sampled(docs, labels)
    assert stage.columns == docs.columns and {r.doc_id for r in stage.collect()} == kept
    none = classify(odd, labels.limit(0)).collect()
    assert len(none) == odd.count() and {r.doc_id for r in none if not r.kept} == {3, 4, 5}
    assert classify(no_docs, labels).count() == 0 and keep_sampled(no_docs, labels).count() == 0


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(5).standard_normal(500)] + [0.5] * 20
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 100, 519, 520):
        assert kth_largest(frame, "x", k) == sorted(values, reverse=True)[k - 1]


def test_license_scan(spark, odd, no_docs):
    mit = "Released under the MIT License."
    rows = [
        (1, "a/b/f", "words of text\n" + mit), (2, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (3, "a/b/c/d", "nothing here " * 20),
        (4, "z/x", "nothing"), (5, None, None), (6, "a/b/LICENSE", mit), (7, "ab/x", ""), (8, "a/g", "a licence is not the point of this text at all"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, p string, text string").withColumn("license", F.lit("clash"))
    got = {r.doc_id: (r.license, r.origin, r.license_dir) for r in scan(docs, F.col("p")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("Apache-2.0", "own", None), 3: ("MIT", "inherited", "a/b"), 4: (None, "none", None), 5: (None, "none", None),
        6: ("MIT", "own", None), 7: (None, "none", None), 8: ("Apache-2.0", "inherited", "a"),
    }
    assert scan(no_docs, F.col("source")).count() == 0 and scan(odd, F.col("source")).count() == odd.count()


def test_full_license_texts(spark):
    """Whole license files have their license and speak for their directory, wrapped anyhow."""
    folder = Path(licenses.__file__).parent / "license_texts"
    rows, want = [], {}
    for i, file in enumerate(sorted(folder.glob("*.txt"))):
        text = f"Copyright (c) 2020 Someone Else\n\n{file.read_text('utf-8')}"
        text = " ".join(text.split()) if i % 2 else text.replace("\n", "\r\n")
        rows += [(10 * i, f"{file.stem}/LICENSE", text), (10 * i + 1, f"{file.stem}/src/x", "nothing here " * 20), (10 * i, f"{file.stem}/LICENSE", text)]
        want |= {10 * i: (file.stem, "own", None), 10 * i + 1: (file.stem, "inherited", file.stem)}
    rows += [(900, "o/essay", "the license and the software of this work " * 80), (901, "o/x", "nothing")]
    want |= {900: (None, "none", None), 901: (None, "none", None)}
    got = scan(spark.createDataFrame(rows, "doc_id long, p string, text string"), F.col("p")).collect()
    assert {r.doc_id: (r.license, r.origin, r.license_dir) for r in got} == want and len(got) == len(rows)


def test_stages_leave_columns_of_any_name_alone(spark):
    """Columns that bear names the stages use themselves."""
    rows = [(i, f"word{i} " * 5 + " ".join(f"w{j}" for j in range(60)), "en", f"src{i % 3}", 1, f"mine{i}", i * 7, "t", 0.5, True) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _host string, _noise long, _text string, noise double, verdict boolean")
    docs = docs.withColumn("row", F.col("doc_id")).withColumn("host", F.lit("h"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    given = {r.doc_id: r for r in docs.collect()}
    for stage in (keep_good(docs), keep_sampled(docs, labels)):
        assert stage.columns == docs.columns
        kept = stage.collect()
        assert kept and all(r == given[r.doc_id] for r in kept)


@pytest.mark.parametrize("numbered", [10_000, 100])
def test_mix_of_repeated_rows(spark, monkeypatch, numbered):
    """Half of a source is one row: some of its copies are taken, near the target."""
    monkeypatch.setattr("gradeledger.llm.mixing.NUMBERED", numbered)
    one = " ".join(f"w{j}" for j in range(20))
    rows = [(7, one, "b")] * 1500 + [(100 + i, " ".join(f"x{j}" for j in range(5 + i % 20)), "b") for i in range(1500)]
    rows += [(5000 + i, " ".join(f"y{j}" for j in range(30)), "a") for i in range(800)] + [(6000 + i, "z " * 9, "c") for i in range(300)]
    for weights in ((5, 2, 1), (1, 4, 2)):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
        drawn = draws(docs, weights).select("source", "size", "target", F.size("copies").alias("n")).collect()
        assert len(drawn) == len(rows)
        for source in "abc":
            own = [r for r in drawn if r.source == source]
            room = 30 if numbered > 1500 else 30 + 20 * 16
            assert abs(sum(r.size * r.n for r in own) - own[0].target) <= room
            assert max(r.n for r in own) <= 3


def test_scores_do_not_depend_on_packing(spark, monkeypatch, tmp_path):
    """The same documents in other files, read by other tasks: several shards, equal scores."""
    monkeypatch.setattr("gradeledger.llm.lm.RUNS", 20)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}ab{int(x) % 5}" for x in rng.integers(0, 80, int(rng.integers(5, 200))))) for i in range(150)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string")
    found = []
    for files in (1, 7):
        docs.repartition(files).write.parquet(str(tmp_path / str(files)))
        made = score(spark.read.parquet(str(tmp_path / str(files)))).orderBy("doc_id", "score").collect()
        found.append([(r.doc_id, r.n_tokens, r.score) for r in made])
    assert [f[:2] for f in found[0]] == [f[:2] for f in found[1]]
    assert np.allclose([f[2] for f in found[0]], [f[2] for f in found[1]], rtol=1e-6)


def test_sampled_documents_travel_with_one_copy_of_their_text(spark, odd):
    labels = spark.createDataFrame([(0, 1), (11, 0)], "doc_id long, quality int")
    mapped = keep_sampled(odd, labels)._jdf.queryExecution().optimizedPlan()
    while "MapInArrow" not in mapped.nodeName():
        mapped = mapped.children().head()
    sent = mapped.children().head().output()
    assert [sent.apply(i).name() for i in range(sent.size())] == ["noise", "row"]


def test_common_words_of_a_license_text_are_not_enough(spark, monkeypatch):
    """A document with half of a text's words, but the light ones, is not counted word by word."""
    _, counts = max(licenses.full_texts(), key=lambda t: len(t[1]))
    light = sorted(counts, key=lambda w: (counts[w], w))[: len(counts) // 2]
    rows = [(1, "a/x", " ".join(counts.elements())), (2, "b/x", " ".join(light)), (3, "c/x", None)]
    real, counted = licenses.stored, []

    def stored(df, name="stage"):
        out = real(df, name)
        if name == "files":
            counted.append(out.select("key").distinct().count())
        return out

    monkeypatch.setattr(licenses, "stored", stored)
    got = scan(spark.createDataFrame(rows, "doc_id long, p string, text string"), F.col("p")).collect()
    assert counted == [1]
    assert {r.doc_id: r.license is not None for r in got} == {1: True, 2: False, 3: False}


def test_share_of_a_text_is_never_too_small(spark):
    squares = {"a": 0.5, "b": 0.24, "c": 0.2, "d": 0.05, "e": 0.01}
    sets = [list(squares)[i:j] for i in range(5) for j in range(i + 1, 6)]
    rows = spark.createDataFrame([(s,) for s in sets], "s array<string>")
    bar = licenses.FILE_THRESHOLD**2
    for r in rows.withColumn("bound", licenses._share(F.col("s"), squares)).collect():
        total = sum(squares[w] for w in r.s)
        assert r.bound >= total or (r.bound == 0 and total < bar)
