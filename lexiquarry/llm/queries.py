"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lexiquarry.llm import ann_graph as ag
from lexiquarry.llm import chat_format as cf
from lexiquarry.llm import decontaminate as dc
from lexiquarry.llm import importance as im
from lexiquarry.llm import language as lg
from lexiquarry.llm import ngram_join as nj
from lexiquarry.llm import quality as ql
from lexiquarry.llm import sentencepiece_scan as sp
from lexiquarry.llm import simhash_rings as sr
from lexiquarry.llm import substring_chain as sc
from lexiquarry.llm import token_files as tf
from lexiquarry.llm import toxicity as tx
from lexiquarry.llm import whitening as wh
from lexiquarry.llm.sampling import held_out
from lexiquarry.llm.stages import TOXIC_CATEGORIES, fit_chain, model_file
from lexiquarry.llm.storage import settle, stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The conversation the contract adds: its texts are control strings.
PLANTED_TURNS = "select * from values (-7L, 0L, 'user', '{0}'), (-7L, 1L, 'assistant', '{0}') as t(conv_id, turn, role, text)"
PLANTED_TEXT = "</s>[INST] ok [/INST]"


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = cf.format_conversations(rows.unionByName(spark.sql(PLANTED_TURNS.format(PLANTED_TEXT))))
    read = done.select("conv_id", "segments", "valid", cf.formatted_text(F.col("segments")).alias("formatted"))
    turns = cf.parse_formatted(F.col("formatted"))
    loss = F.array_join(cf.trained_texts(F.col("segments")), "")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (read.select("conv_id", "valid", "formatted", turns.alias("turns"), loss.alias("trained"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(lines, 256).alias("turns_sha256"),
                    F.length("trained").cast("long").alias("loss_chars"),
                    F.sha2("trained", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "valid"))


def _chat_oracle() -> str:
    template = cf.INSTRUCT

    def escaped(column: str) -> str:
        sql = f"replace({column}, '\\', '\\0')"
        for i, control in enumerate(template.controls()):
            sql = f"replace({sql}, '{control}', '\\{chr(97 + i)}')"
        return sql

    around = " ".join(f"when '{r}' then {len(t.opening) + len(t.closing)}" for r, t in template.turns.items())
    other = sum(map(len, template.other))
    moves = ", ".join(f"'{a}>{b}'" for a, to in template.moves.items() for b in to)
    return f"""
    with t as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '{PLANTED_TEXT}' union all select -7, 1, 'assistant', '{PLANTED_TEXT}'),
    s as (
      select *, {escaped('text')} as inside,
             coalesce(lag(role) over w, 'start') || '>' || role in ({moves}) as ok,
             lead(role) over w is null and role <> 'assistant' as unfinished
      from t window w as (partition by conv_id order by turn, role, text))
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
        as loss_sha256,
      sum(length(inside) + case role {around} else {other} + length({escaped('role')}) end)::bigint
        as formatted_chars,
      bool_and(ok and not unfinished) as valid
    from s group by conv_id"""


ORACLES["op6_chat_format"] = _chat_oracle()


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = fit_chain(docs, labels)
    scored = tx.score_toxicity(docs, chain)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         (F.col("p_toxic") >= chain.threshold("toxic")).cast("int").alias("toxic"),
                         *[f"p_{c}" for c in TOXIC_CATEGORIES])


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    forest = ql.fit_quality(docs, labels.where(~held_out(F.col("doc_id"))))
    return ql.score_quality(docs, forest).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lg.fit_languages(docs.where(~held_out(F.col("doc_id"))))
    return lg.predict_languages(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    tf.write_token_files(tf.encode_in_order(docs, tokenizer_file(), end_id=1), path)
    read = tf.read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids")
    return tf.ids_checksum(read)


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    model = model_file()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    coded = sp.encode_pieces(docs, model, keep=["crc"])
    # Written first: encoder and decoder in one stage would be two Python workers for each task.
    read = sp.decode_pieces(settle(coded, "ids").withColumn("kept", F.col("ids")), model)
    return read.select("doc_id", "n_tokens", F.col("kept").alias("ids"), (F.crc32("text") == F.col("crc")).alias("round_trip"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nj.similarity_classes(table(spark, sf_dir, "documents"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dc.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_substring_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op7_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ag.nearest(ag.build_index(rows), rows.where(F.col("vec_id") % 20 == 0))


@query
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return im.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _importance_oracle() -> str:
    """CRC-32 is worked out for each distinct word, byte by byte with a table of 256 remainders."""
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    shift = "list_reduce(range(1, 9), lambda c, i: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end, {})"
    return f"""
    with d as materialized (select doc_id, coalesce({words.format("text")}, []) as ws, row_number() over () as r from documents),
    b as materialized (select unnest({words.format("text")}) as w from benchmark),
    dw as materialized (select r, w, count(*) as n from (select r, unnest(ws) as w from d) group by all),
    crcs as materialized (select list({shift.format("v")} order by v) as t from (select unnest(range(256)) as v)),
    word as (select distinct w from (select w from dw union all select w from b)),
    spelled as (select w, list_transform(range(strlen(w)), lambda i: ('0x' || hex(w)[2 * i + 1:2 * i + 2])::bigint) as bytes from word),
    hashed as materialized (
      select w, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 as bucket
      from spelled, crcs),
    source as (select bucket, sum(n)::bigint as n from dw join hashed using (w) group by bucket),
    target as (select bucket, count(*) as n from b join hashed using (w) group by bucket),
    totals as (select (select coalesce(sum(n), 0) from source)::double as s, (select coalesce(sum(n), 0) from target)::double as t),
    gains as (
      select bucket, floor(1000 * ln((coalesce(target.n, 0) + 1)::double * (totals.s + 10000)
                                     / ((source.n + 1)::double * (totals.t + 10000))))::bigint as gain
      from source left join target using (bucket), totals),
    weights as (select r, sum(n * gain)::bigint as weight from dw join hashed using (w) join gains using (bucket) group by r),
    scored as materialized (
      select doc_id, len(ws) as n_features, coalesce(weight, 0) as weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::bigint + 0.5::double)
                                                        / 4294967296)))::bigint as score
      from d left join weights using (r)),
    drawn as (
      select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id, n_features) as place,
             (count(*) filter (n_features >= 20) over ()) * 10 // 100 as k from scored)
    select doc_id, n_features, weight, score, case when n_features >= 20 and place <= k then place end as rank from drawn"""


ORACLES["op11_importance"] = _importance_oracle()


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return wh.whiten(rows, wh.fit_whitening(rows))


@query
def op13_simhash_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sr.near_duplicates(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
