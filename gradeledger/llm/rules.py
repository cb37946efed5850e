"""Quality rules whose verdict depends on the host, with shrunk failure rates.

Every document is measured by built-in expressions on its own row and held against rules.
Failures are summed by host; a host's rate is drawn to that of all hosts by a beta prior
whose mean and weight are estimated from the hosts themselves (moments of a beta-binomial),
so hosts with few documents stay near the mean. Host verdicts are joined back:

* ``poor`` hosts (rate at or above POOR): nothing is kept;
* ``plain`` hosts: documents that fail no rule are kept;
* ``good`` hosts (rate at or below the mean of all): one failed rule outside the base rules
  is forgiven, if it is one of the mild ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeledger.llm.store import join_small, stored
from gradeledger.llm.words import SEPARATORS, without, words

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: Shrunk rate from which on a host is poor.
POOR = 0.5
#: Rules beside the base: name, whether mild, and the condition of failing.
RULES: list[tuple[str, bool, Callable[[Callable[[str], Column]], Column]]] = [
    ("symbols", False, lambda m: 10 * m("n_symbols") > 2 * m("n_words")),
    ("word_length", False, lambda m: ~m("word_chars").between(2 * m("n_words"), 15 * m("n_words"))),
    ("lines", True, lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines"))),
    ("repeats", True, lambda m: 10 * m("n_repeat_words") > 3 * m("n_words")),
]


def repeated_words(w: Column) -> Column:
    """Words in 3-word windows found twice or more, the first included.

    Windows are 64-bit hashes. Where all differ, which is the rule, nothing is sorted.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            same = F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda k: F.get(s, k).h.eqNullSafe(F.get(s, k - 1).h) | F.get(s, k).h.eqNullSafe(F.get(s, k + 1).h),
            )
            at = F.transform(same, lambda k: F.get(s, k).i)
            return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

        return _let(ordered, count)

    repeated = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(repeated)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def measure(text: Column) -> Column:
    """The measures of a text as one struct. Parts are computed once: what is used several
    times is bound, so the optimizer can't copy it into loops over words."""

    def counts(t: Column, w: Column, lines: Column) -> Column:
        found = {
            "n_words": F.size(w),
            "word_chars": F.length(without(t, SEPARATORS)),
            "n_symbols": F.length(t) - F.length(without(t, SYMBOLS)),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(w),
        }
        return F.struct(*(c.cast("long").alias(name) for name, c in found.items()))

    def parts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(without(x, SEPARATORS)) > 0)
        return F.struct(t.alias("t"), words(t).alias("w"), lines.alias("l"))

    bound = _let(F.coalesce(text.cast("string"), F.lit("")), parts)
    return _let(bound, lambda p: counts(p.t, p.w, p.l))


def failures(m: Callable[[str], Column]) -> dict[str, Column]:
    """base_failed, and the numbers of hard and mild rules failed, from measures by name."""
    fails = {name: condition(m).cast("int") for name, _, condition in RULES}
    return {
        "base_failed": (m("n_words") < LEAST_WORDS) | (100 * m("n_repeat_words") > 50 * m("n_words")),
        "hard": sum((fails[n] for n, mild, _ in RULES if not mild), F.lit(0)),
        "mild": sum((fails[n] for n, mild, _ in RULES if mild), F.lit(0)),
    }


def host_verdicts(judged: DataFrame) -> DataFrame:
    """(host, n, failed, rate, verdict): a row for each host, null hosts apart."""
    hosts = stored(
        judged.where("host is not null").groupBy("host").agg(
            F.count("*").alias("n"), F.sum((F.col("base_failed") | (F.col("hard") + F.col("mild") > 0)).cast("long")).alias("failed")
        ), "hosts",
    )
    total = hosts.select(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("failed").alias("f"), F.sum(F.col("n").cast("double") ** 2).alias("nn")
    ).first()
    mean, weight = 0.0, 1.0
    if total["n"]:
        mean = total["f"] / total["n"]
        spread = hosts.select(F.sum(F.col("n") * (F.col("failed") / F.col("n") - mean) ** 2)).first()[0]
        room = total["n"] - total["nn"] / total["n"] - (total["k"] - 1)
        if 0 < mean < 1 and room > 0:
            within = (spread / (mean * (1 - mean)) - (total["k"] - 1)) / room
            weight = 1 / min(max(within, 1e-6), 0.5) - 1  # alpha + beta
    rate = (F.col("failed") + mean * weight) / (F.col("n") + weight)
    verdict = F.when(rate >= POOR, "poor").when(rate <= mean, "good").otherwise("plain")
    return hosts.withColumns({"rate": rate, "verdict": verdict})


def _kept(base: Column, hard: Column, mild: Column, verdict: Column) -> Column:
    return ~base & (verdict != "poor") & (hard == 0) & (mild <= F.when(verdict == "good", 1).otherwise(0))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, host, the measures, base_failed, the numbers of hard and
    mild rules failed, the host's rate and verdict, and kept.

    Null and empty texts have no words and fail the base rules. A null source is no host: such
    documents are judged by their own rules alone (verdict ``plain``). Repeated rows each
    count and stay. Further columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("source").alias("host"), measure(F.col("text")).alias("q")).select("doc_id", "host", "q.*")
    judged = stored(rows.withColumns(failures(F.col)), "judged")
    verdicts = stored(host_verdicts(judged).select("host", "rate", "verdict"), "verdicts")
    joined = join_small(judged, verdicts, ["host"], spread=F.col("doc_id"))
    joined = joined.withColumn("verdict", F.coalesce("verdict", F.lit("plain")))
    return joined.withColumn("kept", _kept(*(F.col(c) for c in ("base_failed", "hard", "mild", "verdict"))))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, their columns unchanged.

    Texts are measured twice, once for the hosts and once for the rows, instead of being
    shuffled to meet their verdicts.
    """
    fails = lambda q: F.struct(*(c.alias(n) for n, c in failures(lambda name: q[name]).items()))
    narrow = docs.select(F.col("source").alias("host"), _let(measure(F.col("text")), fails).alias("f")).select("host", "f.*")
    verdicts = stored(host_verdicts(narrow).select("host", "verdict"), "verdicts")
    # the caller's columns travel as one, so that none can bear a name used here
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("source").alias("host"))
    rows = join_small(rows, verdicts, ["host"], spread=F.col("row.doc_id"))
    verdict = F.coalesce("verdict", F.lit("plain"))
    kept = _let(_let(measure(F.col("row.text")), fails), lambda f: _kept(f.base_failed, f.hard, f.mild, verdict))
    return rows.where(kept).select("row.*")
