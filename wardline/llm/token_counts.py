"""Token counts from pre-token frequencies (operator 3).

Texts are read in blocks of some MB. A block leaves as one row: its distinct pre-tokens, and for each
document which of them it has and how often. Pre-tokens of all blocks are dealt out by value, and each
distinct one goes to the tokenizer library once; its number of tokens is joined back to the blocks that
hold it, and a document's count is the sum of frequency times number. Token ids are never kept. What a
common pre-token costs is one row per block, however many documents have it.

A pre-token is what lies between ASCII white space, cut once more between an ASCII letter and a mark
after it (``llm/tokens.py`` says why counts add up over such pieces).

Null text: empty, 0 bytes and 0 tokens. Null and repeated ``doc_id``: one row out per row in. An empty
table gives no rows. Other columns are ignored. A very long text makes a block of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, texts
from wardline.llm.scan import slices
from wardline.llm.tokens import encoder

#: Bytes of text in a block.
BLOCK_BYTES = 32 << 20

#: Pre-tokens handed to the library at a time.
COUNT_ROWS = 8192

LIMIT = 2048

_BLOCK = pa.schema(
    [("block", pa.int64()), ("words", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64()))]
    + [("n_bytes", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("times", pa.binary())]
)
_BLOCK_DDL = "block bigint, words array<binary>, doc_ids array<bigint>, n_bytes array<bigint>, n_words array<bigint>, times binary"

_STEP, _MOST = 0xFFFF, 0xFF


def pack_frequencies(doc: np.ndarray, word: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[bytes, np.ndarray]:
    """Compressed (step to the next word, times) pairs and how many each document has.

    ``doc, word`` ascend. Steps take two bytes and times one: a longer step is made of steps with no
    times, more times of pairs with no step.
    """
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    step = np.where(first, word, word - np.concatenate([[0], word[:-1]]) if len(word) else word)
    hops, again = step // _STEP, (times - 1) // _MOST
    each = hops + 1 + again
    n_pairs = int(each.sum())
    at = np.cumsum(each) - each + hops  # where the pair itself stands
    steps, counts = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
    place = np.arange(n_pairs) - np.repeat(np.cumsum(each) - each, each)
    steps[place < np.repeat(hops, each)] = _STEP
    steps[at] = step - hops * _STEP
    counts[place > np.repeat(hops, each)] = _MOST
    counts[at] = times - again * _MOST
    body = steps.astype("<u2").tobytes() + counts.astype(np.uint8).tobytes()
    return zlib.compress(body, 1), np.bincount(doc, weights=each, minlength=n_docs).astype(np.int64)


def unpack_frequencies(packed: bytes, n_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word and the times of each pair, document by document."""
    body, total = zlib.decompress(packed), int(n_pairs.sum())
    steps = np.frombuffer(body, "<u2", total).astype(np.int64)
    run = np.cumsum(steps)
    ends = np.cumsum(n_pairs)
    before = np.concatenate([[0], run])[ends - n_pairs]
    return run - np.repeat(before, n_pairs), np.frombuffer(body, np.uint8, total, 2 * total).astype(np.int64)


def _frequencies(definition):
    """Documents -> a row of ``_BLOCK`` per block."""

    def block_row(block: int, names: list, bodies: list[bytes]) -> pa.RecordBatch:
        tool = encoder(definition.value)
        hashes, docs, often, firsts = [], [], [], {}
        for start, stop in slices(bodies, 2 << 20):
            words, counts = tool.pieces(bodies[start:stop])
            distinct, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            for h, i in zip(distinct.tolist(), first.tolist(), strict=True):
                if h not in firsts:
                    firsts[h] = words.piece(i)
            pairs = np.repeat(np.arange(stop - start), counts) * max(1, len(distinct)) + inverse
            pairs, times = np.unique(pairs, return_counts=True)
            doc, word = np.divmod(pairs, max(1, len(distinct)))
            hashes.append(distinct[word])
            docs.append((doc + start).astype(np.int32))
            often.append(times.astype(np.int32))
        # Pairs ascend by document and hash, and the block's words are numbered in the order of their hashes.
        vocabulary = np.array(sorted(firsts), np.uint64)
        doc, times = np.concatenate(docs), np.concatenate(often).astype(np.int64)
        word = np.searchsorted(vocabulary, np.concatenate(hashes))
        packed, n_words = pack_frequencies(doc, word, times, len(bodies))
        row = {"block": block, "words": [firsts[h] for h in vocabulary.tolist()], "doc_ids": names}
        row |= {"n_bytes": [len(b) for b in bodies], "n_words": n_words, "times": packed}
        return pa.RecordBatch.from_pylist([row], _BLOCK)

    def blocks(batches):
        task, made, size = TaskContext.get().partitionId(), 0, 0
        names: list = []
        bodies: list[bytes] = []
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bodies and size + len(body) > BLOCK_BYTES:
                    yield block_row(task << 32 | made, names, bodies)
                    made, size, names, bodies = made + 1, 0, [], []
                names.append(name), bodies.append(body)
                size += len(body)
        if bodies:
            yield block_row(task << 32 | made, names, bodies)

    return blocks


def _pieces(definition):
    """Rows ``word, block, at`` in order of the word -> ``block, at, n``; the library sees each word once."""

    def count(batches):
        rows: list[pa.RecordBatch] = []
        last: tuple[bytes | None, int] = (None, 0)

        def settle():
            nonlocal last
            table = pa.Table.from_batches(rows)
            rows.clear()
            words = table.column("word").to_pylist()
            fresh = [w for w, before in zip(words, [last[0], *words], strict=False) if w != before]
            sizes = iter([len(ids) for ids in encoder(definition.value).encode_pieces(fresh)])
            n = []
            for w in words:
                if w != last[0]:
                    last = (w, next(sizes))
                n.append(last[1])
            table = table.drop_columns("word").append_column("n", pa.array(n, pa.int32()))
            yield from table.combine_chunks().to_batches()

        for batch in batches:
            rows.append(batch)
            if sum(map(len, rows)) >= COUNT_ROWS:
                yield from settle()
        if rows:
            yield from settle()

    return count


def _sum(batches):
    """Rows ``doc_ids, n_bytes, n_words, times, numbers`` -> the documents' counts."""
    names = ["doc_id", "n_bytes", "n_tokens"]
    for batch in batches:
        for i in range(batch.num_rows):
            docs, n_bytes, n_words, times, numbers = (batch.column(k)[i] for k in range(5))
            pairs = np.array(n_words.as_py(), np.int64)
            word, often = unpack_frequencies(times.as_py(), pairs)
            each = numbers.values.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(each[word] * often)])
            ends = np.cumsum(pairs)
            arrays = [pa.array(docs.as_py(), pa.int64()), pa.array(n_bytes.as_py(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sums[ends] - sums[ends - pairs])], names)


def count_tokens(
    docs: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document."""
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a fixed size
    blocks = scratch.table(texts(docs, id_col, text_col).mapInArrow(_frequencies(held), _BLOCK_DDL), "blocks")
    words = blocks.select(F.posexplode("words").alias("at", "word"), "block").select("word", "block", "at")
    # Dealt out and sorted by word, so equal words follow each other in one task.
    dealt = words.repartition("word").sortWithinPartitions("word")
    counted = dealt.mapInArrow(_pieces(held), "block bigint, at int, n int")
    # Words of a block lie in one order, so its numbers are a dense array: at most a block's vocabulary.
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "n"))), lambda x: x["n"])
    numbers = counted.groupBy("block").agg(ordered.alias("numbers"))
    joined = blocks.drop("words").join(numbers, "block", "left")
    none = F.array().cast("array<int>")
    rows = joined.select("doc_ids", "n_bytes", "n_words", "times", F.coalesce("numbers", none).alias("numbers"))
    out = rows.mapInArrow(_sum, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
