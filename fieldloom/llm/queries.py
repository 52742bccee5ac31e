"""One query for each operator of this subpackage, over its whole table, and SQL for those that have any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontam, langid, licenses, lines, packing, simhash, simple8b, substrings
from .shared import written


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    formatted, _ = written(chat.windows(rows, budget=512, history=2, history_budget=128), "chat")
    return chat.digests(formatted)


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"), licenses.catalog(spark))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.predict(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_read(spark, sf_dir, "documents"), min_words=13)
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k
        from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) > 12)),
firsts as (select k, min(doc_id) as least from win group by k),
gone as (select distinct win.doc_id, i + unnest(range(0, 13)) as j from win join firsts using (k) where least < win.doc_id),
each as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as j from w),
kept as (select doc_id, string_agg(word, ' ' order by j) as t, count(*) as n from each anti join gone using (doc_id, j) group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)
"""

def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_index(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.remove_similar_lines(_read(spark, sf_dir, "documents"), similarity=0.8)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_ann": op1_ann,
    "op2_chat": op2_chat,
    "op3_licenses": op3_licenses,
    "op4_langid": op4_langid,
    "op5_substrings": op5_substrings,
    "op6_token_ids": op6_token_ids,
    "op7_lines": op7_lines,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_decontam": op10_decontam,
}

ORACLE_SQL = {
    "op1_ann": ann.neighbours_sql(),
    "op2_chat": chat.digests_sql(),
    "op3_licenses": licenses.SCAN_SQL,
    "op5_substrings": OP5_SQL,
    "op10_decontam": decontam.contaminated_sql(),
}
