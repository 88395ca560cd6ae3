"""Registered queries of the numbered operators: thin calls that read the
tables, apply the operator and derive the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, conversations, crosstok, decontam, hmm, licenses, linededup, pieces, quality, rules, simhash, suffixes, toxicity
from kestrel.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder of the session, package on the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op2_simhash_near_dedup")
def op2(spark, sf_dir):
    """Near-duplicate classes of all documents: 3-word shingles, 2 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@register("op8_byte_bpe")
def op8(spark, sf_dir):
    """Byte-level BPE round trip of all documents, multilingual 50k vocabulary."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k, least(len(w), 10) AS n
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, iw.item_id FROM dw JOIN iw USING (n, k)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@register("op10_benchmark_decontamination", OP10_SQL)
def op10(spark, sf_dir):
    """Documents that hold windows of ten words of benchmark items."""
    found = decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.contaminated_rows(found)


@register("op1_quality_bradley_terry")
def op1(spark, sf_dir):
    """Quality score of every document, learnt from the labels outside the hold-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scores(docs, model)


@register("op5_toxicity_counterfactual")
def op5(spark, sf_dir):
    """Toxicity score of every document, learnt from the labels outside the hold-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(docs, model)


OP3_SQL = r"""
WITH l AS (SELECT doc_id, i, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS solid FROM
           (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents) WHERE len(w) > 1)),
s AS (SELECT doc_id, i, (('0x' || substr(md5(line), 1, 15))::BIGINT) % 2147483647 AS h, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
      FROM l WHERE solid),
r AS (SELECT *, CASE WHEN j = 1 THEN 2147483648 ELSE (h * 48271 + lag(h) OVER d) % 2147483647 END AS r
      FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, coalesce(r < lead(r) OVER d AND r <= lag(r) OVER d, false) AS ends FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM e),
p AS (SELECT l.doc_id, l.i, l.line, l.solid, coalesce(last_value(c.pos IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.i), 0) AS pos
      FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.i = l.i),
k AS (SELECT doc_id, pos, min(i) FILTER (WHERE solid) AS a, max(i) FILTER (WHERE solid) AS b, count(*) AS n,
             count(*) FILTER (WHERE solid) AS solid FROM p GROUP BY doc_id, pos),
x AS (SELECT p.doc_id, p.pos, any_value(k.n) AS n, string_agg(p.line, chr(10) ORDER BY p.i) AS chunk
      FROM p JOIN k ON p.doc_id = k.doc_id AND p.pos = k.pos AND p.i BETWEEN k.a AND k.b WHERE k.solid >= 2 GROUP BY p.doc_id, p.pos),
m AS (SELECT doc_id, pos, n, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) AS place FROM x),
g AS (SELECT doc_id, count(*) AS removed_chunks, sum(n)::BIGINT AS removed_lines FROM m WHERE place > 1 GROUP BY doc_id),
t AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.i) AS text
      FROM p LEFT JOIN m ON p.doc_id = m.doc_id AND p.pos = m.pos AND m.place > 1 WHERE m.place IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CASE WHEN g.doc_id IS NULL THEN d.text ELSE coalesce(t.text, '') END AS text,
       coalesce(removed_chunks, 0)::BIGINT AS removed_chunks, coalesce(removed_lines, 0)::BIGINT AS removed_lines
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@register("op3_line_dedup", OP3_SQL)
def op3(spark, sf_dir):
    """All documents without the multi-line chunks that occurred before."""
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnsRenamed({"_n_chunks": "removed_chunks", "_n_lines": "removed_lines"})


@register("op9_quality_rules")
def op9(spark, sf_dir):
    """Verdicts of the base rule and the risk-controlled rules on all documents, per language."""
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_license_scan")
def op4(spark, sf_dir):
    """Licence phrases, tags and expressions in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op7_hmm_language_model")
def op7(spark, sf_dir):
    """Log10 probabilities of all documents under the hidden Markov model and the unigram."""
    return hmm.score(table(spark, sf_dir, "documents"))


@register("op6_suffix_array_dedup")
def op6(spark, sf_dir):
    """Documents that share passages of 50 words or more, with the passages' places."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


@register("op11_sentencepiece")
def op11(spark, sf_dir):
    """SentencePiece round trip of all documents, 32k pieces with byte fallback."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


@register("op12_cross_tokenizer_alignment")
def op12(spark, sf_dir):
    """Byte-level BPE against SentencePiece pieces on all documents: groups and linked id pairs."""
    return crosstok.alignment(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"),
                              vocabulary_path("piece_bpe_32k.model"))


@register("op13_conversation_repair")
def op13(spark, sf_dir):
    """All conversations, damaged as the contract says and repaired; ids that lost all rows included."""
    turns = table(spark, sf_dir, "conversations")
    fixed = conversations.repair(conversations.damage(turns)).withColumnRenamed("conv_id", "_found")
    zero, nothing = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    ids = turns.select("conv_id").distinct()
    return ids.join(fixed, F.col("conv_id").eqNullSafe(F.col("_found")), "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in conversations.SUMMARY],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
