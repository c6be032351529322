"""Concatenate and cut: all ids in one line, cut every ``length`` (operator 6).

Pass one encodes each input split and writes its ids with the number of ids before each document in
its split. The splits' totals, one row each, give the splits' offsets by prefix sums. Pass two reads
the ids again and cuts at multiples of ``length``. A window that one task holds whole is done there;
the pieces of a window that lies across two tasks' rows leave as boundary records and meet in a group
of at most ``length`` ids. Only the last window of all is shorter and would be padded.

Null text: empty, the end id alone. Null and repeated ``doc_id``: every row is packed on its own. An
empty table gives no sequences. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, offsets, small, texts
from wardline.llm.tokens import encoder

LENGTH = 2048

_PIECE = pa.struct(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")]
)
_FRAGMENT = pa.schema(
    [("sequence_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("input_ids", pa.binary()), ("pieces", pa.list_(_PIECE))]
)
_FRAGMENT_DDL = (
    "sequence_id bigint, offset bigint, n_tokens bigint, input_ids binary, pieces array<struct<doc_id: bigint, "
    "start: bigint, length: bigint, ids_crc32: bigint, doc_tokens: bigint, offset: bigint>>"
)


def encode_blocks(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """Pass one: ``block, before, doc_id, n_tokens, ids`` (little-endian) in the order of the input splits."""
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def encode(batches):
        block, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = list(encoder(held.value).each(batch.column(1).to_pylist(), end_id))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            arrays = [pa.array(np.full(len(found), block)), pa.array(starts), batch.column(0), pa.array(sizes)]
            arrays.append(pa.array([x.astype(x.dtype.newbyteorder("<")).tobytes() for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["block", "before", "doc_id", "n_tokens", "ids"])

    ddl = "block bigint, before bigint, doc_id bigint, n_tokens bigint, ids binary"
    return scratch.table(texts(docs, id_col, text_col).mapInArrow(encode, ddl), "ids")


def _cut(length: int, dtype: str, whole: bool):
    """Pass two over rows ``doc_id, place, n_tokens, ids``: whole windows, or else boundary records."""

    def cut(batches):
        window: list[tuple[dict, np.ndarray]] = []  # pieces of the window under way, gapless
        out: list[dict] = []
        reached = -1

        def flush():
            if not window:
                return
            size = sum(len(ids) for _, ids in window)
            if (size == length) == whole:
                first = window[0][0]
                ids = np.concatenate([ids for _, ids in window])
                pieces = [{k: v for k, v in piece.items() if k != "sequence_id"} for piece, _ in window]
                out.append({"sequence_id": first["sequence_id"], "offset": first["offset"], "n_tokens": size, "input_ids": ids.tobytes(), "pieces": pieces})
            window.clear()

        for batch in batches:
            for doc, place, total, body in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                ids = np.frombuffer(body, dtype).astype("<u4")
                if place != reached:
                    flush()
                reached, done = place + total, 0
                while done < total:
                    sequence, offset = divmod(place + done, length)
                    some = ids[done : done + length - offset]
                    if window and window[0][0]["sequence_id"] != sequence:
                        flush()
                    piece = {"sequence_id": sequence, "doc_id": doc, "start": done, "length": len(some), "ids_crc32": zlib.crc32(some), "doc_tokens": total, "offset": offset}
                    window.append((piece, some))
                    done += len(some)
                    if offset + len(some) == length:
                        flush()
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, _FRAGMENT)
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_pylist(out, _FRAGMENT)

    return cut


def pack(
    docs: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``sequence_id, n_tokens, input_ids`` (little-endian uint32), ``pieces`` per sequence.

    ``pieces`` says which ids of which document stand where: ``doc_id, start, length, ids_crc32,
    doc_tokens, offset``.
    """
    dtype = np.dtype(encoder(tokenizer).dtype).newbyteorder("<").str
    ids = encode_blocks(docs, scratch, tokenizer, end_id, id_col, text_col)
    totals = scratch.table(ids.groupBy("block").agg(F.sum("n_tokens").alias("n")).coalesce(1), "totals")
    bases = small(offsets(totals, "block", "n"), totals.count())
    placed = ids.join(bases, "block").select("doc_id", (F.col("base") + F.col("before")).alias("place"), "n_tokens", "ids")

    whole = placed.mapInArrow(_cut(length, dtype, True), _FRAGMENT_DDL).drop("offset")
    partial = placed.mapInArrow(_cut(length, dtype, False), _FRAGMENT_DDL)
    ordered = F.sort_array(F.collect_list(F.struct("offset", "n_tokens", "input_ids", "pieces")))  # length ids at most
    joined = partial.groupBy("sequence_id").agg(ordered.alias("parts"))
    met = joined.select(
        "sequence_id",
        F.aggregate("parts.n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.aggregate("parts.input_ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("input_ids"),
        F.flatten("parts.pieces").alias("pieces"),
    )
    return whole.unionByName(met)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece, with its sequence."""
    each = sequences.select("sequence_id", F.explode("pieces").alias("p"))
    return each.select("p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens", "sequence_id", "p.offset")
