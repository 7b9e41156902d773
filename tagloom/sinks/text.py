"""Plain-text outputs: component lines, token chunk files, record dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.tokens import blank_split
from tagloom.operators.components import isolated_groups
from tagloom.operators.indexing import dense_id, weighted_offsets
from tagloom.session import drop_scratch, path_exists

# Fixed value: tokens per chunk file (the writer starts a new file once
# a file already holds more than 200 tokens).
TOKENS_PER_CHUNK = 201


def token_chunks(tokens: DataFrame, order_cols: list, token_col: str = "tag",
                 per_chunk: int = TOKENS_PER_CHUNK) -> DataFrame:
    """``(chunk, text)``: tokens in order, ``per_chunk`` per chunk, each
    followed by one blank. Every group holds at most ``per_chunk`` rows."""
    idx = dense_id(tokens.select(*order_cols, token_col), order_cols, "_i")
    return _chunks(idx, token_col, per_chunk)


def document_token_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          per_chunk: int = TOKENS_PER_CHUNK) -> DataFrame:
    """``token_chunks`` of every document's blank-split tokens, in
    (document id, position) order."""
    return _array_chunks(docs.select(id_col, F.col(text_col).alias("_src")), id_col, blank_split("_src"), per_chunk)


def list_token_chunks(rows: DataFrame, id_col: str, list_col: str,
                      per_chunk: int = TOKENS_PER_CHUNK) -> DataFrame:
    """``token_chunks`` of token lists, in (id, list position) order."""
    return _array_chunks(rows.select(id_col, F.col(list_col).alias("_src")), id_col, F.col("_src"), per_chunk)


def _array_chunks(rows: DataFrame, id_col: str, tokens, per_chunk: int, start: int = 0,
                  before: DataFrame | None = None) -> DataFrame:
    """Chunks of the token arrays that ``tokens`` gives on column ``_src``.

    The rows are range-partitioned by id once and carry their source along;
    a row's first token has the global index ``_off`` (running total of
    token counts). Knowing it, each row cuts its own tokens into the pieces
    that fall into each chunk (array slices, no row per token, no join),
    and a chunk joins its pieces (at most ``per_chunk``) in offset order.
    ``start`` is the index of the first token; ``before`` holds pieces
    ``(_off, chunk, s)`` of chunks begun earlier.
    """
    P = F.lit(per_chunk)
    sized = rows.withColumn("_n", F.size(tokens)).filter(F.col("_n") > 0)
    cut = (weighted_offsets(sized, [id_col], "_n", "_off").withColumn("_off", F.col("_off") + F.lit(start).cast("long"))
           .withColumn("_t", tokens)
           .withColumn("_c", F.sequence(F.floor(F.col("_off") / P),
                                        F.floor((F.col("_off") + F.col("_n") - 1) / P))))

    def piece(c):
        lo = F.greatest(c * P - F.col("_off"), F.lit(0))
        hi = F.least((c + 1) * P - F.col("_off"), F.col("_n"))
        return F.struct(c.alias("chunk"), F.array_join(F.slice("_t", lo + 1, hi - lo), " ").alias("s"))

    pieces = cut.select("_off", F.inline(F.transform("_c", piece)))
    if before is not None:
        pieces = pieces.unionByName(before)
    return (pieces.groupBy(F.col("chunk").cast("bigint").alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct("_off", "s"))).alias("_l"))
            .select("chunk", F.concat(F.array_join(F.transform("_l", lambda x: x["s"]), " "),
                                      F.lit(" ")).alias("text")))


def _chunks(idx: DataFrame, token_col: str, per_chunk: int) -> DataFrame:
    return (idx.withColumn("chunk", F.floor(F.col("_i") / F.lit(per_chunk)).cast("bigint"))
            .groupBy("chunk")
            .agg(F.array_sort(F.collect_list(F.struct("_i", F.col(token_col).alias("t")))).alias("_l"))
            .select("chunk", F.concat(F.array_join(F.transform("_l", lambda x: x["t"]), " "),
                                      F.lit(" ")).alias("text")))


def write_token_chunks(chunks: DataFrame, path: str, mode: str = "overwrite", folders: bool = False) -> None:
    """Chunk rows (``chunk, text``) as JSON lines in part files. With
    ``folders`` each chunk gets a text folder of its own (``chunk=N``): for
    few chunks only, since it makes one file per 201 tokens."""
    if folders:
        chunks.write.mode(mode).partitionBy("chunk").text(path)
    else:
        chunks.write.mode(mode).json(path)


_TAIL = "run long, chunk long, held long, text string"


def append_token_chunks(docs: DataFrame, path: str, run: int, id_col: str = "doc_id", text_col: str = "text",
                        per_chunk: int = TOKENS_PER_CHUNK) -> None:
    """Append the documents' tokens, in (id, position) order, to the chunks
    under ``path``: the open chunk of the run before is filled first.

    A run writes its chunks, then its tail (last chunk, tokens held in it,
    its text), which commits it; ``read_token_chunks`` ignores a run without
    a tail. A failed run, or the last one, is repeated under its number and
    replaces itself; an earlier one cannot be. A run without tokens carries
    the tail on. The driver sees one tail row; ``per_chunk`` must not change.
    """
    spark = docs.sparkSession
    tails = _tails(spark, path)
    if tails.filter(F.col("run") > run).limit(1).count():
        raise ValueError(f"a run after {run} is committed already")
    last = tails.filter(F.col("run") < run).orderBy(F.desc("run")).limit(1).collect()
    chunk, held, text = (last[0]["chunk"], last[0]["held"], last[0]["text"]) if last else (-1, per_chunk, "")
    tail_at, chunks_at = f"{path}/tails/run={run}", f"{path}/chunks/run={run}"
    drop_scratch(spark, tail_at)
    begun = spark.createDataFrame([(chunk * per_chunk, chunk, text[:-1])] if held < per_chunk else [], "_off long, chunk long, s string")
    start = chunk * per_chunk + held
    _array_chunks(docs.select(id_col, F.col(text_col).alias("_src")), id_col, blank_split("_src"), per_chunk, start,
                  begun).write.mode("overwrite").parquet(chunks_at)
    # every token ends with a blank, and holds none
    blanks = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    end = spark.read.schema("chunk long, text string").parquet(chunks_at).agg(
        F.max_by(F.struct("chunk", blanks.cast("long").alias("held"), "text"), "chunk").alias("t"))
    kept = F.struct(F.lit(chunk).cast("long").alias("chunk"), F.lit(held).cast("long").alias("held"), F.lit(text).alias("text"))
    end.select(F.coalesce("t", kept).alias("t")).select("t.*").coalesce(1).write.mode("overwrite").parquet(tail_at)


def _tails(spark: SparkSession, path: str) -> DataFrame:
    at = f"{path}/tails"
    if not path_exists(spark, at):
        return spark.createDataFrame([], _TAIL)
    return spark.read.schema(_TAIL).option("basePath", at).parquet(at)


def read_token_chunks(spark: SparkSession, path: str, per_chunk: int = TOKENS_PER_CHUNK) -> DataFrame:
    """``(chunk, text)`` of all committed runs. An open chunk that a later
    run took over is read from that run only (one small row per run says
    so, joined; no row is compared with another)."""
    tails = _tails(spark, path).select("run", F.col("chunk").alias("_last"), "held")
    newest = tails.agg(F.max("run").alias("r")).first()["r"]
    if newest is None:
        return spark.createDataFrame([], "chunk long, text string")
    at = f"{path}/chunks"
    chunks = spark.read.schema("run long, chunk long, text string").option("basePath", at).parquet(at)
    taken_over = (F.col("run") < newest) & (F.col("chunk") == F.col("_last")) & (F.col("held") < per_chunk)
    return chunks.join(tails, "run").filter(~taken_over).select("chunk", "text")


def write_components(components: DataFrame, path: str, max_members_per_line: int = 10000) -> None:
    """One text line per component (big ones over several lines)."""
    lines = isolated_groups(components, max_members_per_line)
    lines.orderBy("component", "chunk").select("members").write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist records (JSON lines by default; parquet also fine)."""
    df.write.mode("overwrite").format(fmt).save(path)
