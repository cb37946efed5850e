"""Document log-likelihoods by a recurrent language model over word classes.

log10 P(text) is the sum over its tokens of log10 P(class | all tokens before), which a gated
recurrent network gives, and log10 P(word | class), from corpus counts. A word's class is its
ending (its last bytes without the punctuation behind them); the most frequent endings have
classes of their own, the rest share one, the end of a text has one. The class softmax is
itself factored into groups and members.

1. Words of all training documents are counted (partial counts in tasks, then a shuffle).
2. All symbols of all training documents train the network. A text is cut into consecutive
   runs; the state is carried through a run, and a run that doesn't begin its text is warmed
   up by the symbols before. Runs are dealt to shards by a hash of the document, the run's
   place and its symbols; each shard makes one pass from the same parameters, in an order that
   its runs fix, and the results are averaged, weighted by symbols. So training grows with
   the corpus, and files, tasks and cores have no part in the result.
3. All documents are scored whole. Counts of the ``HEAD`` most frequent words are at hand in
   every task; the others' counts come by a join on the word's hash, after each task has
   summed a document's repeats.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from gradeledger.llm import gru
from gradeledger.llm.arrow import list_column, list_rows, raw_texts, word_hashes
from gradeledger.llm.store import stored

#: Words whose counts every task has, at most (about 100 bytes each in a worker).
HEAD = 1 << 16
#: Words that a task counts before it passes the sums on.
FLUSH = 150_000
#: Documents worked on at once.
ROWS = 1_000
#: Symbols of one training run at most, and before it to warm its state up.
RUN, WARM = 64 * gru.WINDOW, 2 * gru.WINDOW
#: Runs per shard (about), and Adam's rate.
RUNS, RATE = 4_000, 0.04
SEED = 6
#: Bytes of an ending, and what may follow it.
ENDING, TRAILING = 3, b".,;:!?\"')"
END, OTHER = gru.SYMBOLS - 1, gru.SYMBOLS - 2
ADD = 0.1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS))


def tokens(raw: bytes | None) -> list[bytes]:
    """Words, A-Z lower-cased; the end of the text (an empty word) is added by the callers."""
    return raw.lower().split() if raw else []


def ending(word: bytes) -> bytes:
    return (word.rstrip(TRAILING) or word)[-ENDING:]


def held_out() -> Column:
    """crc32 of the id as text, modulo 10, is 0; never for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts, with one end (the empty word) for each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, ["word", "n"])

        for batch in _slices(batches):
            for raw in raw_texts(batch, "text"):
                counts.update(tokens(raw))
                counts[b""] += 1
                if len(counts) > FLUSH:
                    yield flush()
        yield flush()

    return train.select("text").mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """What every task needs: frequent words, endings' classes, and the classes' totals."""

    def __init__(self, head: list[tuple[bytes, int]], endings: list[bytes], in_class: np.ndarray, distinct: np.ndarray):
        self.number = {w: i for i, (w, _) in enumerate(head)}
        self.classes_of = {e: i for i, e in enumerate(endings)}
        self.head_log = np.log10(np.array([n for _, n in head], float) + ADD)
        self.head_class = np.array([self.symbol(w) for w, _ in head], np.int64)
        self.class_log = np.log10(in_class + ADD * (distinct + 1))

    def symbol(self, word: bytes) -> int:
        return self.classes_of.get(ending(word), OTHER) if word else END

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols of the words and the end, numbers of the frequent ones, and the others."""
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        frequent = number >= 0
        rest = [words[i] for i in np.flatnonzero(~frequent)]
        symbols = np.full(len(words) + 1, END)
        symbols[:-1][frequent] = self.head_class[number[frequent]]
        symbols[:-1][~frequent] = np.fromiter(map(self.symbol, rest), np.int64, len(rest))
        return symbols, number[frequent], rest


def lexicon(counts: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """The lexicon, and the tokens of each class. At most HEAD words, and a row for each class,
    come to the driver."""
    head = counts.where("word <> X''").orderBy(F.desc("n"), "word").limit(HEAD).collect()
    strip = "".join(chr(c) for c in TRAILING)
    plain = F.expr("decode(word, 'ISO-8859-1')")
    stem = F.rtrim(plain, F.lit(strip))
    short = F.when(F.length(stem) > 0, stem).otherwise(plain)
    end = F.substring(short, -ENDING, ENDING)
    own = counts.where("word <> X''").groupBy(end.alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    own = stored(own, "endings")
    top = own.orderBy(F.desc("n"), "e").limit(OTHER).collect()
    totals = own.select(F.sum("n"), F.sum("v")).first()
    ends = counts.where("word = X''").select(F.sum("n")).first()[0] or 0
    n, v = np.zeros(gru.SYMBOLS), np.zeros(gru.SYMBOLS)
    n[: len(top)], v[: len(top)] = [r["n"] for r in top], [r["v"] for r in top]
    n[OTHER], v[OTHER] = (totals[0] or 0) - n.sum(), (totals[1] or 0) - v.sum()
    n[END], v[END] = ends, min(ends, 1)
    endings = [r["e"].encode("latin-1") for r in top]
    return Lexicon([(bytes(r["word"]), r["n"]) for r in head], endings, n, v), n


def training_runs(train: DataFrame, words: Lexicon) -> DataFrame:
    """(symbols, skip, place): the runs of each text, which together have all its symbols and its
    end once. ``symbols`` are the symbol before, ``skip`` symbols that warm up, and up to RUN
    more; ``place`` is a hash of document, place in the text and symbols."""
    shared = train.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        runs: list[np.ndarray] = []
        skips: list[int] = []
        places: list[int] = []

        def flush() -> pa.RecordBatch:
            made = [list_column(runs, np.int16), pa.array(skips, pa.int32()), pa.array(np.array(places, np.uint64).view(np.int64))]
            runs.clear()
            skips.clear()
            places.clear()
            return pa.RecordBatch.from_arrays(made, ["symbols", "skip", "place"])

        for batch in _slices(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch, "text"), strict=True):
                symbols = np.concatenate([[gru.SYMBOLS], own.read(tokens(raw))[0]]).astype(np.int16)
                for at in range(1, len(symbols), RUN):
                    skips.append(min(at - 1, WARM))
                    runs.append(symbols[at - 1 - skips[-1] : at + RUN])
                    places.append(xxh3_64_intdigest(f"{doc_id} {at} ".encode() + runs[-1].tobytes()))
                    if len(runs) >= ROWS:
                        yield flush()
        yield flush()

    return train.select("doc_id", "text").mapInArrow(work, "symbols array<short>, skip int, place long")


def train_network(runs: DataFrame, frequencies: np.ndarray) -> dict[str, np.ndarray]:
    """Parameter mixing over ``runs``, a stored table. Parameters (some ten thousand numbers)
    are averaged on the executors. A task holds one shard's runs at a time."""
    params = gru.initial(frequencies, SEED)
    total = runs.count()
    if not total:
        return params
    shards = max(1, round(total / RUNS))
    dealt = runs.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")).repartition(shards, "shard")
    dealt = dealt.sortWithinPartitions("shard", "place", "skip")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: list[np.ndarray] = []
        skips: list[np.ndarray] = []
        shard = None

        def learn() -> pa.RecordBatch:
            skip = np.concatenate(skips)
            learnt = sum(map(len, samples)) - len(samples) - int(skip.sum())
            flat = gru.pack(gru.train(params, samples, skip, RATE)) * learnt
            samples.clear()
            skips.clear()
            made = [pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), learnt))]
            return pa.RecordBatch.from_arrays(made, ["i", "sum", "w"])

        for batch in batches:
            own = batch.column("shard").to_numpy()
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            for first, last in zip(firsts, [*firsts[1:], batch.num_rows], strict=True):
                if samples and own[first] != shard:
                    yield learn()
                shard, part = own[first], batch.slice(first, last - first)
                samples += [np.array(s) for s in list_rows(part, "symbols")]
                skips.append(part.column("skip").to_numpy())
        if samples:
            yield learn()

    mixed = dealt.mapInArrow(work, "i long, sum double, w long").groupBy("i").agg((F.sum("sum") / F.sum("w")).alias("v"))
    flat = np.zeros(len(gru.pack(params)))
    for i, v in mixed.collect():
        flat[i] = v
    return gru.unpack(flat, params)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10 probabilities of the whole text, its end included).

    Learns from the documents that aren't held out. Null and empty texts are the end alone. A
    null id is never held out. Repeated rows each count and stay; further columns are ignored;
    an empty table gives no rows. Without any training document every word is unknown.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    train = docs.where(~held_out())
    counts = stored(word_counts(train), "counts")
    totals = counts.select(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    words, frequencies = lexicon(counts)
    params = train_network(stored(training_runs(train, words), "runs"), frequencies)
    end_count = int(frequencies[END])
    shared = docs.sparkSession.sparkContext.broadcast((words, params))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, network = shared.value
        for batch in _slices(batches):
            symbols, n_tokens, logs, within, known = [], [], [], [], []
            rest_row, rest_hash, rest_n = [], [], []
            for at, raw in zip(batch.column("row").to_pylist(), raw_texts(batch, "text"), strict=True):
                s, numbers, rest = own.read(tokens(raw))
                symbols.append(s)
                n_tokens.append(len(s))
                logs.append(own.head_log[numbers].sum() + np.log10(end_count + ADD))
                known.append(len(numbers) + (end_count > 0))
                within.append(own.class_log[s].sum())
                if rest:
                    hashes, times = np.unique(word_hashes(rest), return_counts=True)
                    rest_row.append(np.full(len(hashes), at))
                    rest_hash.append(hashes.view(np.int64))
                    rest_n.append(times)
            likely = gru.document_scores(network, symbols) / np.log(10) - np.array(within)
            n, m = len(symbols), sum(map(len, rest_row))
            none = lambda kind, k: pa.nulls(k, kind)
            both = lambda values, kind, after: pa.concat_arrays([pa.array(values, kind), after])
            joined = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [both(batch.column("row").to_pylist(), pa.int64(), joined(rest_row)),
                 both(batch.column("doc_id").to_pylist(), pa.int64(), none(pa.int64(), m)),
                 both(n_tokens, pa.int64(), none(pa.int64(), m)), both(known, pa.int64(), none(pa.int64(), m)),
                 both(logs, pa.float64(), none(pa.float64(), m)), both(likely, pa.float64(), none(pa.float64(), m)),
                 pa.concat_arrays([none(pa.int64(), n), joined(rest_hash)]),
                 pa.concat_arrays([none(pa.int64(), n), joined(rest_n)])],
                ["row", "doc_id", "n_tokens", "known", "logs", "likely", "hash", "times"],
            )

    schema = "row long, doc_id long, n_tokens long, known long, logs double, likely double, hash long, times long"
    made = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(work, schema)
    made = stored(made, "scored")
    hashed = counts.where("word <> X''").withColumn("hash", _hash_words("word")).select("hash", "n")
    rest = made.where("hash is not null").select("row", "hash", "times").join(hashed, "hash", "left")
    rest = rest.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("rest_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rest_known"),
    )
    rows = made.where("hash is null").drop("hash", "times").join(rest, "row", "left")
    logs = F.col("logs") + F.coalesce("rest_logs", F.lit(0.0))
    n, v = totals["n"], totals["v"]
    return rows.select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(n + ADD * (v + 1)))).alias("base_score"),
        (logs + F.col("likely")).alias("score"),
    )


def _hash_words(column: str) -> Column:
    @F.pandas_udf("long")
    def hashed(words):
        return words.map(lambda w: xxh3_64_intdigest(w) - (1 << 64 if xxh3_64_intdigest(w) >> 63 else 0))

    return hashed(column)
