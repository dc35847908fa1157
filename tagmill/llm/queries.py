"""The registered queries of this subpackage over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from zlib import crc32

import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

from .automaton import token_counts
from .binary_codes import near_vectors
from .bpe_table import encode_by_table
from .mixing import mix_sources
from .packing import pack_documents
from .periods import periodic_runs, strongest
from .preferences import conversation_turns, format_preferences, swapped_last_answers
from .records import token_records
from .simhash import simhash_components
from .suffixes import repeated_spans
from .topk import top_k
from .toxicity import is_held_out, with_toxicity
from .variants import SHORTEST, letter_runs, spelling_variants

QUERIES: dict = {}
SQL: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op9_best_fit_packing(spark, sf):
    packed = pack_documents(table(spark, sf, "documents"), BYTE_VOCABULARY, limit=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op1_bpe_table(spark, sf):
    both = encode_by_table(table(spark, sf, "documents"), WORD_VOCABULARY)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_token_records(spark, sf):
    records = token_records(table(spark, sf, "documents"), WORD_VOCABULARY, end_id=1)
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_simhash(spark, sf):
    groups = simhash_components(table(spark, sf, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


SQL["op8_exact_top_k"] = """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_dot_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op8_exact_top_k(spark, sf):
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


SQL["op3_embedding_dedup"] = """
    WITH RECURSIVE whole AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM whole a JOIN whole b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98),
    reach AS (
      SELECT vec_id AS a, vec_id AS b FROM embeddings
      UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT vec_id, CAST((SELECT count(*) FROM links WHERE links.a = vec_id) AS BIGINT) AS n_links,
           component_id, vec_id = component_id AS kept
    FROM embeddings JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = vec_id"""


@query
def op3_embedding_dedup(spark, sf):
    return near_vectors(table(spark, sf, "embeddings"), threshold=0.98)


@query
def op4_token_counts(spark, sf):
    counted = token_counts(table(spark, sf, "documents"), WORD_VOCABULARY)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op2_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    scored = with_toxicity(docs, labels.select("doc_id", "toxic"))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_suffix_dedup(spark, sf):
    spans = repeated_spans(table(spark, sf, "documents"))
    return spans.select(F.col("id").alias("doc_id"), "begin", "end", "kept")


def _rendered_sql(turns: str) -> str:
    return f"""coalesce(list_aggregate(list_transform({turns}, lambda t:
        '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10)),
        'string_agg', ''), '')"""


def _spans_sql(turns: str) -> str:
    size = "coalesce(length(t.role), 0) + coalesce(length(t.text), 0) + 24"
    return f"""coalesce(list_aggregate(list_filter(list_transform({turns}, lambda t, i:
        CASE WHEN t.role = 'assistant' THEN
          CAST(coalesce(list_sum(list_transform({turns}[1:i - 1], lambda t: {size})), 0) + 22 AS BIGINT) || '-' ||
          CAST(list_sum(list_transform({turns}[1:i], lambda t: {size})) AS BIGINT) END),
        lambda s: s IS NOT NULL), 'string_agg', ','), '')"""


SQL["op10_preferences"] = f"""
    WITH conv AS (
      SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
             max(CASE WHEN role = 'assistant' THEN n END) AS last
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n FROM conversations)
      GROUP BY conv_id),
    pair AS (
      SELECT a.conv_id,
             CASE WHEN a.last IS NULL THEN a.turns ELSE a.turns[1:a.last] END AS chosen,
             CASE WHEN a.last IS NULL THEN a.turns WHEN b.last IS NULL THEN a.turns[1:a.last - 1]
                  ELSE list_concat(a.turns[1:a.last - 1], [b.turns[b.last]]) END AS rejected
      FROM conv a LEFT JOIN conv b ON b.conv_id = xor(a.conv_id, 1)),
    met AS (
      SELECT *, CAST(len(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
                lambda i: chosen[1:i] = rejected[1:i])) AS INTEGER) AS common_turns FROM pair)
    SELECT conv_id, common_turns, {_rendered_sql('chosen[1:common_turns]')} AS prompt,
           {_rendered_sql('chosen[common_turns + 1:]')} AS chosen_text,
           {_rendered_sql('rejected[common_turns + 1:]')} AS rejected_text,
           {_spans_sql('chosen[common_turns + 1:]')} AS chosen_spans,
           {_spans_sql('rejected[common_turns + 1:]')} AS rejected_spans
    FROM met"""


@query
def op10_preferences(spark, sf):
    turns = conversation_turns(table(spark, sf, "conversations"))
    pairs = format_preferences(swapped_last_answers(turns))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["begin"], s["end"])), ",")

    return pairs.select(
        "conv_id", "common_turns", "prompt", "chosen_text", "rejected_text",
        listed("chosen_spans").alias("chosen_spans"), listed("rejected_spans").alias("rejected_spans"),
    )


def slipped(key, run):
    """The run of letters, or the run without one letter, as the checksum of key and run says."""
    mark = F.crc32(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), run))
    at = (mark % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(mark % 31 == 0, cut).otherwise(run)


SQL["op11_spelling_variants"] = """
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
    run AS (
      SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
      WHERE length(run) >= 7 GROUP BY ALL),
    marked AS (
      SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
          lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c) - 64] END))),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) AS h
      FROM run, crc),
    word AS (
      SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM marked)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cut AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM word, unnest(range(1, length(word) + 1)) AS u(i)),
    near AS (
      SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT cut.word, w.word FROM cut JOIN word w ON cut.rest = w.word
      UNION SELECT w.word, cut.word FROM cut JOIN word w ON cut.rest = w.word),
    best AS (
      SELECT near.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS form, max(w.n) AS form_n
      FROM near JOIN word w ON w.word = near GROUP BY near.word),
    formed AS (
      SELECT word.word, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
      FROM word LEFT JOIN best ON best.word = word.word),
    way AS (
      SELECT word, word AS root, form AS further FROM formed
      UNION ALL SELECT way.word, formed.word, formed.form FROM way JOIN formed ON formed.word = way.further)
    SELECT formed.word, form, root, n, n_near, form_n
    FROM formed JOIN way ON way.word = formed.word AND way.further IS NULL"""


@query
def op11_spelling_variants(spark, sf):
    runs = table(spark, sf, "documents").select("doc_id", F.explode(letter_runs("text")).alias("run"))
    words = runs.where(F.length("run") >= SHORTEST).select(slipped("doc_id", F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return spelling_variants(counts)


def planted_period(key: str | None, text: str | None) -> str | None:
    """The text; those whose keys the contract names end in repeats of some of their words."""
    mark = 1 if key is None else crc32(key.encode())
    words = text.encode().split() if text and mark % 10 == 0 else []
    if not words:
        return text
    turn, n = mark // 10, len(words)
    first = turn % n
    period = 1 + (n - first) // (3 + turn % 8)
    return b" ".join(words[:first] + [words[first + i % period] for i in range(n - first)]).decode()


@query
def op12_periodic_runs(spark, sf):
    @F.pandas_udf("string")
    def planted(keys: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([planted_period(k, t) for k, t in zip(keys, texts)], dtype=object)

    docs = table(spark, sf, "documents")
    docs = docs.select("doc_id", planted(F.col("doc_id").cast("string"), "text").alias("text"))
    found = periodic_runs(docs).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_mixed_sources(spark, sf):
    taken = mix_sources(table(spark, sf, "documents")).taken()
    return taken.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")
