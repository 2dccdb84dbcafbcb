"""Token counts from flat token files without an index.

A stream is one long run of token ids in which every document ends with a separator id; nothing says where
documents begin. It is read in blocks of equal size. Each block is searched for separators with one array comparison
and reports its inner lengths, the tokens before its first and behind its last separator. A prefix scan
over the blocks (sums and greatest positions, first inside groups of ``GROUP`` blocks, then over the groups) gives
each block the number of its first document and the tokens carried into it, which stitches documents that
cross blocks, or span many.

Defined cases: an empty document has 0 tokens; tokens behind the last separator of a stream are one more document,
marked unfinished; a stream without tokens has no document. As documents, null and empty texts are empty documents, repeated rows are
documents each, a very long text is tokenised as one value and spans as many blocks as it needs, and no order of equal ids matters, as rows are
told apart by their place. Columns other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakemill.llm.frames import Scratch

BLOCK_TOKENS = 1 << 16
GROUP = 4096
SEPARATOR = 50256  # the id that is free in the rank file
RANK_FILE = "byte_bpe_50k.tiktoken"
WIDTHS = {2: "<u2", 4: "<u4"}


def flat_blocks(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(stream, block, tokens) of the flat files under ``path``; a stream is a file, ids are little-endian."""
    size = width * block_tokens
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))
    cut = files.select(F.col("path").alias("stream"), "content", F.posexplode(starts).alias("block", "at"))
    return cut.select("stream", F.col("block").cast("long"), F.substring("content", (F.col("at") + 1).cast("int"), F.lit(size)).alias("tokens"))


def _ranks(path: str | None) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    with open(path or public_tokenizers.path(RANK_FILE), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, public_tokenizers.PATTERN


def token_streams(work: Scratch, docs: DataFrame, rank_file: str | None = None, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Tokenise texts into flat streams, one per task: (stream, block, tokens), and (stream, ordinal, doc_id) of what went in.

    The second table holds no positions: where documents end is only in the tokens.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_ranks(rank_file))
    names = ["stream", "block", "tokens", "ordinals", "doc_ids"]

    def run(batches):
        import tiktoken

        ranks, pattern = shared.value
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        stream, block, pending, held, ordinal = str(TaskContext.get().partitionId()), 0, [], 0, 0

        def rows(blocks, ordinals, ids):
            n = len(blocks)
            return pa.RecordBatch.from_arrays([
                pa.array([stream] * (n + 1)), pa.array([*range(block - n, block), None], pa.int64()), pa.array([*blocks, None], pa.binary()),
                pa.array([None] * n + [ordinals], pa.int64()), pa.array([None] * n + [ids], pa.list_(pa.int64()))], names=names)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            full = []
            for text in texts:
                found = np.array([*encoding.encode_ordinary(text or ""), SEPARATOR], "<u2")
                pending.append(found)
                held += len(found)
                if held >= block_tokens:
                    whole = np.concatenate(pending)
                    cut = held - held % block_tokens
                    full += [whole[i:i + block_tokens].tobytes() for i in range(0, cut, block_tokens)]
                    pending, held = [whole[cut:]], held - cut
            block += len(full)
            yield rows(full, ordinal, ids)
            ordinal += len(ids)
        if held:
            block += 1
            yield rows([np.concatenate(pending).tobytes()], ordinal, [])

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "stream string, block bigint, tokens binary, ordinals bigint, doc_ids array<bigint>")
    table = work.staged(made, "token-streams")
    inputs = table.filter("doc_ids IS NOT NULL").select("stream", "ordinals", F.posexplode("doc_ids").alias("pos", "doc_id"))
    return table.filter("tokens IS NOT NULL").select("stream", "block", "tokens"), inputs.select(
        "stream", (F.col("ordinals") + F.col("pos")).alias("ordinal"), "doc_id")


def _scanned_blocks(blocks: DataFrame, separator: int, width: int) -> DataFrame:
    kind = WIDTHS[width]

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for data in batch.column(2).to_pylist():
                tokens = np.frombuffer(data, kind)
                at = np.flatnonzero(tokens == separator)
                row = (len(tokens), len(at), int(at[0]) if len(at) else None, int(at[-1]) if len(at) else None, np.diff(at) - 1, at[:-1] + 1)
                for column, value in zip(out, row):
                    column.append(value)
            types = (*[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(out, types)]],
                names=["stream", "block", "size", "ends", "first", "last", "inner", "begin"])

    return blocks.select("stream", "block", "tokens").mapInArrow(
        run, "stream string, block bigint, size bigint, ends bigint, first bigint, last bigint, inner array<bigint>, begin array<bigint>")


def document_lengths(work: Scratch, blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """(stream, ordinal, start, n_tokens, finished) of every document of every stream."""
    found = work.staged(_scanned_blocks(blocks, separator, width).withColumn("group", F.floor(F.col("block") / GROUP)), "blocks")
    inside = Window.partitionBy("stream", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("stream").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))

    sums = found.groupBy("stream", "group").agg(F.sum("size").alias("g_size"), F.sum("ends").alias("g_ends"))
    sums = sums.select("stream", "group", zero(F.sum("g_size").over(across)).alias("g_at"), zero(F.sum("g_ends").over(across)).alias("g_ordinal"))
    placed = found.join(sums, ["stream", "group"]).withColumns({
        "at": F.col("g_at") + zero(F.sum("size").over(inside)), "ordinal": F.col("g_ordinal") + zero(F.sum("ends").over(inside))})
    placed = placed.withColumn("end", F.col("at") + F.col("last"))
    ends = placed.groupBy("stream", "group").agg(F.max("end").alias("g_end"))
    ends = ends.select("stream", "group", F.max("g_end").over(across).alias("g_before"))
    placed = placed.join(ends, ["stream", "group"]).withColumn(
        "open", F.coalesce(F.greatest(F.max("end").over(inside), F.col("g_before")) + 1, F.lit(0).cast("long")))

    lengths = F.concat(F.array(F.col("at") + F.col("first") - F.col("open")), "inner")
    starts = F.concat(F.array("open"), F.transform("begin", lambda x: x + F.col("at")))
    rows = placed.filter("ends > 0").select("stream", "ordinal", F.posexplode(F.arrays_zip(lengths.alias("n"), starts.alias("s"))).alias("i", "d"))
    finished = rows.select("stream", (F.col("ordinal") + F.col("i")).alias("ordinal"), F.col("d.s").alias("start"), F.col("d.n").alias("n_tokens"), F.lit(True).alias("finished"))
    tails = placed.groupBy("stream").agg(
        F.sum("size").alias("size"), F.sum("ends").alias("ordinal"), F.coalesce(F.max("end") + 1, F.lit(0).cast("long")).alias("start"))
    unfinished = tails.filter("size > start").select("stream", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("finished"))
    return finished.unionAll(unfinished)


def token_counts(spark: SparkSession, docs: DataFrame, rank_file: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, stream, ordinal, start, n_tokens) per row of ``docs``, counted from flat streams of their tokens."""
    work = Scratch(spark)
    blocks, inputs = token_streams(work, docs, rank_file, block_tokens)
    return inputs.join(document_lengths(work, blocks), ["stream", "ordinal"]).select("doc_id", "stream", "ordinal", "start", "n_tokens")
