"""The registered query of each operator: its operator over the whole
table with production parameters, and the digest columns derived from
the operator's output."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import chat, classifier, common, covertree, cws, idcodec, minhash, mixing, neighbours, packing, phrases, secrets, suffix, turns
from tagloom.llm.common import documents
from tagloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.against_next(documents(spark, sf_dir, "doc_id", "text"))


def op2_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    idcodec.write_ids(documents(spark, sf_dir, "doc_id", "text"), path)
    docs = idcodec.documents_of(idcodec.read_ids(spark, path))
    start = idcodec.file_starts(spark, path) + F.col("start")
    return docs.select("doc_id", start.alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = common.written(documents(spark, sf_dir, "doc_id", "source", "text")
                           .select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-rows")
    weights = mixing.cyclic_weights(mixing.source_sizes(sized, "source", "size"))
    # a long document is due fewer copies than a short one of its source
    sized = sized.withColumn("chance", F.when(F.col("size") > 0, 1 / F.sqrt("size")))
    return mixing.mix(sized, weights, weight_col="chance").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def held_out(doc_id: str):
    """Documents whose labels are never learnt."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = classifier.fit(docs, _table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    return classifier.score(docs, model).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(common.written(chat.format_chats(rows.unionByName(extra)), "chats"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    found = common.written(secrets.candidates(docs, keep=("doc_id",)), "secret-found")
    spans = secrets.scan(found)
    kinds = [f"n_{k}" for k in secrets.ORDER]
    return (found.select("row", "doc_id").join(spans, "row", "left")
            .select("doc_id", *(F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in [*kinds, "n_example"]),
                    F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans")))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir, "doc_id", "text"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "window", "step_id")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations")
    rows, report = turns.repair(turns.damage(convs))
    return turns.digests(convs, rows, report)


def op12_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir, "text", "lang"))


QUERIES = {
    "op1_weighted_sampling": op1_weighted_sampling,
    "op2_token_id_files": op2_token_id_files,
    "op3_source_mix": op3_source_mix,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_minhash": op5_minhash,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_chat_format": op7_chat_format,
    "op8_secret_scan": op8_secret_scan,
    "op9_cover_tree": op9_cover_tree,
    "op10_packing": op10_packing,
    "op11_turn_repair": op11_turn_repair,
    "op12_posting_lists": op12_posting_lists,
    "op13_phrase_mining": op13_phrase_mining,
}

SQL: dict[str, str] = {
    "op13_phrase_mining": """
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents where text is not null),
words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
sizes as (select lang, w, unnest(range(1, 6)) as k from words),
places as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from sizes where len(w) >= k),
counts as (
    select lang, p, cast(count(*) as bigint) as c from (select lang, w[i:i + k - 1] as p from places)
    group by lang, p having count(*) >= 100),
inner_parts as (
    select lang, part, max(c) as c from (
        select lang, unnest([p[:len(p) - 1], p[2:]]) as part, c from counts where len(p) > 2)
    group by lang, part),
alone as (
    select counts.* from counts left join inner_parts on counts.lang = inner_parts.lang and counts.p = inner_parts.part
    where len(p) > 1 and (inner_parts.c is null or 100 * inner_parts.c < 100 * counts.c)),
cuts as (select lang, p, c, unnest(range(1, len(p))) as k from alone),
scored as (
    select cuts.lang, cuts.p, cuts.c as a, cuts.k, l.c as l, r.c as r, t.n,
        (cast(1000 as hugeint) * cuts.c * t.n) // (cast(l.c as hugeint) * r.c) as score
    from cuts join totals t on t.lang = cuts.lang
    join counts l on l.lang = cuts.lang and l.p = cuts.p[:k]
    join counts r on r.lang = cuts.lang and r.p = cuts.p[k + 1:]),
least as (select *, row_number() over (partition by lang, p order by score, k) as cut from scored),
ranked as (
    select lang, array_to_string(p, ' ') as phrase, a, l, r, n, cast(score as bigint) as score from least where cut = 1),
top as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked)
select lang, rank, phrase, a, l, r, n, score from top where rank <= 2000
""",
}
