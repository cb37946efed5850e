"""The registered queries of the pipeline operators, and their DuckDB SQL where there is one."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeledger.llm.align import aligned
from gradeledger.llm.bpe import encode_decode
from gradeledger.llm.chat import BLOCK, END, START, maximal_conversations
from gradeledger.llm.fingerprint import fingerprints
from gradeledger.llm.importance import classify
from gradeledger.llm.jaccard import jaccard_components
from gradeledger.llm.licenses import TEMPLATES, THRESHOLD, WORD, scan, template_words
from gradeledger.llm.lm import score
from gradeledger.llm.mixing import draws
from gradeledger.llm.records import token_records
from gradeledger.llm.rules import judge
from gradeledger.llm.search import search
from gradeledger.llm.warc import round_trip

#: The vocabulary file of the queries that encode.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: The two vocabularies of the alignment query.
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROOT = Path(__file__).resolve().parents[2]
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, unless they can import it already."""
    context = spark.sparkContext
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(p and Path(p).resolve() == ROOT for p in places) or "gradeledger.zip" in str(context._python_includes):
        return
    archive = Path(tempfile.mkdtemp()) / "gradeledger.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in (ROOT / "gradeledger").rglob("*.py"):
            z.write(path, path.relative_to(ROOT))
    context.addPyFile(str(archive))
    sys.path[:] = [p for p in sys.path if p != str(archive)]


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in the directory <source>/<lang>."""
    return scan(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "verdict", "kept"]
    return judge(table(spark, sf_dir, "documents")).select(*columns)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draws(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.size("copies")).alias("taken")
    return drawn.select("doc_id", "size", "source_size", "target", taken)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_conversations(table(spark, sf_dir, "conversations"))


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = ("ids_sha256", "decoded_sha256")
    return encode_decode(table(spark, sf_dir, "documents"), VOCABULARY, digests)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(table(spark, sf_dir, "documents"), VOCABULARY)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


_WORDS = r"regexp_extract_all(lower_text, '[^\x20\x09-\x0D]+')"

OP4_SQL = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_WORDS} AS w
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
          FROM documents)
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
    FROM w
), n AS (
    SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
    WHERE 100 * k >= 90 * (na.n + nb.n - k)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM n
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id
FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n
"""

OP2_SQL = r"""
WITH w AS (
    SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), again AS (
    SELECT doc_id, i FROM windows JOIN (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)
), covered AS (
    SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM again) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.d, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        (10 * n_symbols > 2 * n_words)::INT + (word_chars NOT BETWEEN 2 * n_words AND 15 * n_words)::INT AS hard,
        (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT + (10 * n_repeat_words > 3 * n_words)::INT AS mild
    FROM m
), h AS (
    SELECT source, count(*)::DOUBLE AS n, sum((base_failed OR hard + mild > 0)::INT)::DOUBLE AS failed FROM f WHERE source IS NOT NULL GROUP BY source
), a AS (
    SELECT sum(failed) / sum(n) AS mean, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room, count(*) - 1 AS k FROM h
), v AS (
    SELECT sum(n * (failed / n - mean) ** 2) AS spread, any_value(mean) AS mean, any_value(room) AS room, any_value(k) AS k FROM h, a
), p AS (
    SELECT mean, CASE WHEN mean > 0 AND mean < 1 AND room > 0
        THEN 1 / least(greatest((spread / (mean * (1 - mean)) - k) / room, 1e-6), 0.5) - 1 ELSE 1 END AS weight FROM v
), r AS (
    SELECT source, (failed + mean * weight) / (n + weight) AS rate, mean FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    CASE WHEN rate >= 0.5 THEN 'poor' WHEN rate <= mean THEN 'good' ELSE 'plain' END AS verdict,
    NOT base_failed AND coalesce(rate < 0.5, true) AND hard = 0 AND mild <= CASE WHEN rate < 0.5 AND rate <= mean THEN 1 ELSE 0 END AS kept
FROM f LEFT JOIN r USING (source)
"""

OP7_SQL = f"""
WITH t AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), n AS (
    SELECT *, row_number() OVER w AS position, row_number() OVER (PARTITION BY conv_id) AS any_row,
        list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS prefix
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), m AS (
    SELECT conv_id, max(position) AS n_turns FROM n GROUP BY conv_id
), whole AS (
    SELECT prefix, n_turns, min(conv_id) AS conv_id, count(*) AS n_logged
    FROM n JOIN m USING (conv_id) WHERE position = n_turns GROUP BY prefix, n_turns
), proper AS (
    SELECT DISTINCT prefix FROM n JOIN m USING (conv_id) WHERE position < n_turns
), kept AS (
    SELECT conv_id, n_turns, n_logged FROM whole WHERE prefix NOT IN (SELECT prefix FROM proper)
), parts AS (
    SELECT conv_id, n_turns, n_logged, turn // {BLOCK} AS block,
        string_agg('{START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{END}' || chr(10), '' ORDER BY position) AS text
    FROM n JOIN kept USING (conv_id) GROUP BY ALL
)
SELECT conv_id, n_turns, n_logged, (row_number() OVER (PARTITION BY conv_id ORDER BY block) - 1)::INT AS part, text FROM parts
"""

OP9_SQL = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
    SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM d GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH q AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), d AS (
    SELECT doc_id, {_TERMS} AS w FROM documents
), n AS (
    SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0
), s AS (
    SELECT count(*) AS total, sum(n)::BIGINT AS length FROM n
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
    SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), m AS (
    SELECT doc_id, 100 - 90 + (90 * n * total) // length AS m FROM n, s
), sc AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM sc WHERE score > 0 QUALIFY rank <= 10
"""

_TEMPLATE_ROWS = ", ".join(f"({i}, '{w}', {c})" for i, w, c in template_words())
_NAME_ROWS = ", ".join(f"({i}, '{name}')" for i, (name, _) in enumerate(TEMPLATES))

OP1_SQL = f"""
WITH tw(template, word, c) AS (VALUES {_TEMPLATE_ROWS}), names(template, license) AS (VALUES {_NAME_ROWS}),
d AS (
    SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, concat_ws('/', source, lang) AS dir,
        lower(coalesce(text, '')) AS t, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents
), total AS (SELECT count(*) AS n FROM d),
df AS (
    SELECT word, count(*) AS f FROM (SELECT DISTINCT doc_id, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM tw) GROUP BY word
), idf AS (
    SELECT word, ln((1 + n) / (1 + coalesce(f, 0))) + 1 AS idf FROM (SELECT DISTINCT word FROM tw) LEFT JOIN df USING (word), total
), norm AS (
    SELECT template, sqrt(sum((c * idf) ** 2)) AS len FROM tw JOIN idf USING (word) GROUP BY template
), vec AS (
    SELECT template, word, c * idf / len AS weight FROM tw JOIN idf USING (word) JOIN norm USING (template)
), lines AS (
    SELECT doc_id, i AS line, regexp_extract_all(ls[i], '{WORD}') AS w
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d))
), tok AS (
    SELECT doc_id, line, word, count(*) AS tf FROM (SELECT doc_id, line, unnest(w) AS word FROM lines) GROUP BY ALL
), wt AS (
    SELECT doc_id, line, word, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM tok LEFT JOIN idf USING (word), total
), ln_ AS (
    SELECT doc_id, line, sqrt(sum(w * w)) AS len FROM wt GROUP BY ALL
), dots AS (
    SELECT doc_id, line, template, sum(w * weight) AS dot FROM wt JOIN vec USING (word) GROUP BY ALL
), sc AS (
    SELECT doc_id, line, template, dot / len AS score FROM dots JOIN ln_ USING (doc_id, line) WHERE dot / len >= {THRESHOLD}
), one AS (
    SELECT doc_id, line, template, round(score, 9) AS score FROM sc
    QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY round(score, 9) DESC, template) = 1
), best AS (
    SELECT doc_id, score, template FROM one QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) = 1
), counted AS (
    SELECT doc_id, count(*) AS k, sum(len(w)) AS lw FROM one JOIN lines USING (doc_id, line) GROUP BY doc_id
), own AS (
    SELECT d.doc_id, path, dir, license, score, coalesce(k, 0) AS k, lw, len(w) AS n
    FROM d LEFT JOIN best USING (doc_id) LEFT JOIN counted USING (doc_id) LEFT JOIN names USING (template)
), of_dir AS (
    SELECT dir AS ldir, license AS dlicense FROM own WHERE license IS NOT NULL AND 2 * lw >= n
    QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
), near AS (
    SELECT x.dir, ldir, dlicense FROM (SELECT DISTINCT dir FROM own) x
    JOIN of_dir ON x.dir = ldir OR ldir = '' OR starts_with(x.dir, ldir || '/')
    QUALIFY row_number() OVER (PARTITION BY x.dir ORDER BY length(ldir) DESC) = 1
)
SELECT doc_id, path, coalesce(license, dlicense) AS license, round(score, 4) AS score, k AS n_license_lines,
    CASE WHEN license IS NOT NULL THEN 'own' WHEN dlicense IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
    CASE WHEN license IS NULL THEN ldir END AS license_dir
FROM own LEFT JOIN near USING (dir)
"""

QUERIES: dict[str, Query] = {
    "op1_license_scans": op1_license_scans,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_chat_formatting": op7_chat_formatting,
    "op9_warc": op9_warc,
    "op2_quality_rules": op2_quality_rules,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op5_source_mixing": op5_source_mixing,
    "op8_bpe_encoding": op8_bpe_encoding,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_token_records": op11_token_records,
    "op12_ranked_search": op12_ranked_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op1_license_scans": OP1_SQL,
    "op7_chat_formatting": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op2_quality_rules": OP2_SQL,
    "op4_ngram_jaccard_join": OP4_SQL,
    "op12_ranked_search": OP12_SQL,
}


def run(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return QUERIES[name](spark, sf_dir)

    return query
