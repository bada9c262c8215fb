"""The registered queries of the training-data operators and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.lines import bound, dedup_lines
from tidemark.llm.maxscore import quantised, top_k
from tidemark.llm.mixing import plan_mix
from tidemark.llm.periods import periodic_runs
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import quality_rules
from tidemark.llm.secrets import secret_scan
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.substrings import dedup_substrings
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_files import read_token_files, with_crc32, write_token_files
from tidemark.llm.warc import page_of, read_archives, write_archives
from tidemark.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, select: str | None = None):
    """Register a query over a folder of tables, with its SQL if there is one."""

    def wrap(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: build(configure(spark), folder)
        if select is not None:
            ORACLES[name] = select
        return build

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS_SQL = rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS seq
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS least FROM g) WHERE least < doc_id),
m AS (SELECT w.doc_id, w.i, w.word, max(r.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS last
      FROM w LEFT JOIN r USING (doc_id, i)),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (last >= i - 12) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY i) FILTER (last IS NULL OR last < i - 12), '') AS kept
      FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op1_substring_dedup", SUBSTRINGS_SQL)
def _substrings(spark, folder):
    found = dedup_substrings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS seq
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS n FROM g) WHERE n > 1),
m AS (SELECT w.doc_id, w.i, max(r.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS last
      FROM w LEFT JOIN r USING (doc_id, i)),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM m WHERE last >= i - 4 GROUP BY doc_id),
l AS (SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws, pos
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM d)),
j AS (SELECT doc_id, length(array_to_string(ws, '')) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth,
             2 * length(regexp_replace(line, '[^!-/:-@\[-`{{-~]', '', 'g')) > 3 * len(ws)
             OR len(list_filter(ws, lambda x: x IN ('|', '»', '›', '>', '/'))) * 4 >= greatest(len(ws), 1)
             OR len(ws) <= 15 AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                'all rights reserved|cookie policy|privacy policy|terms of use|terms of service|click here|read more|share this|sign in|log in|subscribe to|lorem ipsum|enable javascript') AS failed
      FROM l WHERE len(ws) > 0),
lines AS (SELECT doc_id, count(*) FILTER (nth > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (failed), 0) AS lost FROM j GROUP BY doc_id),
b AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 30 * word_chars AS kept
FROM f
"""


@query("op2_quality_rules", QUALITY_SQL)
def _quality(spark, folder):
    judged = quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def hex_digits(fingerprint: str):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


@query("op7_simhash_near_dedup")
def _simhash(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id")


LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
           FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT *, line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS win FROM n
      WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY win ORDER BY doc_id, k) AS nth FROM w
                             WHERE win IS NOT NULL) WHERE nth > 1),
c AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM r),
m AS (SELECT l.doc_id, l.line, l.pos, n.k, c.k IS NOT NULL AS gone FROM l LEFT JOIN n USING (doc_id, pos)
      LEFT JOIN c ON c.doc_id = l.doc_id AND c.k = n.k),
a AS (SELECT doc_id, count(k) AS n_lines, count(*) FILTER (gone) AS n_removed,
             string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents LEFT JOIN a USING (doc_id)
"""


@query("op5_line_dedup", LINES_SQL)
def _lines(spark, folder):
    found = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("dedup_lines").alias("n_lines"),
        F.size("dedup_removed").cast("long").alias("n_removed"),
        F.sha2("dedup_text", 256).alias("kept_sha256"),
    )


MIX_SQL = rf"""
WITH u AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5, len({WORDS_SQL})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS no FROM u GROUP BY source),
k AS (SELECT *, [5, 2, 1][(no - 1) % 3 + 1] AS weight, source_size * 2 AS cap FROM s),
f AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(cap) OVER o - cap AS filled,
             sum(weight) OVER () - sum(weight) OVER o + weight AS open_weight
      FROM k WINDOW o AS (ORDER BY cap::DOUBLE / weight::DOUBLE, no)),
g AS (SELECT *, (cap * open_weight)::DOUBLE <= weight::DOUBLE * (budget - filled::DOUBLE) AS is_full FROM f),
h AS (SELECT *, budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)::DOUBLE AS rest, sum(weight) FILTER (NOT is_full) OVER () AS rest_weight FROM g),
t AS (SELECT source, source_size, budget, CASE WHEN is_full THEN cap::DOUBLE ELSE weight::DOUBLE * rest / rest_weight::DOUBLE END AS target FROM h),
p AS (SELECT u.*, source_size, target, budget, md5(concat_ws(':', '0', coalesce(doc_id::VARCHAR, ''), text_md5)) AS place
      FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place ROWS UNBOUNDED PRECEDING)::BIGINT AS so_far FROM p),
q AS (SELECT *, (turn * source_size + so_far)::DOUBLE / target AS finish FROM (SELECT *, unnest([0, 1]) AS turn FROM c WHERE target > 0)),
r AS (SELECT doc_id, sum(size) OVER (ORDER BY finish, place, turn ROWS UNBOUNDED PRECEDING) AS reached, budget FROM q),
n AS (SELECT doc_id, count(*) AS copies FROM r WHERE reached <= budget GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(copies, 0)::BIGINT * size AS taken FROM p LEFT JOIN n USING (doc_id)
"""


@query("op6_source_mixing", MIX_SQL)
def _mixing(spark, folder):
    plan = plan_mix(table(spark, folder, "documents"))
    each = plan.select("*", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("nth"))
    return each.select("doc_id", "size", "source_size", "target", "taken")


#: Tokens that fit a training context.
TOKEN_LIMIT = 1024


@query("op4_token_counts")
def _token_counts(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts(table(spark, folder, "documents").select("doc_id", "text"), path)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query("op8_sentencepiece")
def _sentencepiece(spark, folder):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, folder, "documents").select("doc_id", "text"), path)
    return encoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


TOP_K_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op9_maxscore_top_k", TOP_K_SQL)
def _top_k(spark, folder):
    vectors = quantised(table(spark, folder, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op10_token_files")
def _token_files(spark, folder):
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return with_crc32(read_token_files(spark, path))


ARCHIVES_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
             min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


@query("op3_warc_archives", ARCHIVES_SQL)
def _archives(spark, folder):
    path = scratch_path(spark, "archives")
    write_archives(table(spark, folder, "pages"), path)
    records = read_archives(spark, path)
    return records.select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to")
    )


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """The text of every tenth document, by the crc32 of its id, with words from some place on repeating a stretch of it."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        facts = F.struct(words.alias("words"), n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))

        def build(x: Column) -> Column:
            taken = F.transform(
                F.sequence(F.lit(0).cast("long"), x["n"] - 1),
                lambda i: F.get(x["words"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int")),
            )
            return F.array_join(taken, " ")

        return bound(facts, build)

    chosen = (h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(chosen, bound(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), repeated)).otherwise(text)


@query("op11_periodic_runs")
def _periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_runs(F.col("text"), F.col("doc_id")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    found = found.select("doc_id", "runs", "collapsed_text", best.alias("best"), F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").alias("lines"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def counted_words(docs: DataFrame, least_letters: int = 6, least_times: int = 5) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased; of some, chosen by document and run, a letter is left out."""
    upper = "".join(map(chr, range(65, 91)))
    runs = F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z\u00C0-\u00FF]{%d,}" % least_letters), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    low = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % 199 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    words = low.select(word.alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


SPELLING_SQL = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) AS t
                       FROM (SELECT unnest(range(256)) AS i)),
o AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
e AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM o WHERE length(run) >= 6 GROUP BY id, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
             lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]), 4294967295)) AS h FROM e, crc),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
s AS (SELECT DISTINCT x.word, x.n, w.word AS other, w.n AS other_n FROM x JOIN w ON w.word = x.cut),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
      UNION ALL SELECT * FROM s UNION ALL SELECT other, other_n, word, n FROM s),
k AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS rank FROM p),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
             CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM w LEFT JOIN k ON k.word = w.word AND rank = 1),
r AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
SELECT f.word, form, (SELECT arg_max(root, step) FROM r WHERE r.word = f.word) AS root, n, n_near, form_n FROM f
"""


@query("op13_spelling_variants", SPELLING_SQL)
def _spelling(spark, folder):
    return spelling_variants(counted_words(table(spark, folder, "documents")))


@query("op12_secret_scan")
def _secrets(spark, folder):
    found = secret_scan(table(spark, folder, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")

    def of(*kinds: str) -> Column:
        return F.filter("secrets", lambda x: x["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(of("assign", "access", "hex")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
