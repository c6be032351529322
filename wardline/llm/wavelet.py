"""Token ids as wavelet matrices: one compressed file per shard (operator 1).

Documents are dealt out by ranges of ``doc_id`` and encoded in that order. A shard holds the ids of
consecutive documents as bit planes, highest bit first; after each plane the ids are dealt stably
into those with a 0 and those with a 1. With a count of ones per 512 bits this answers, without
decoding, which id stands at a place (access), how often an id occurs before a place (rank) and where
its k-th occurrence lies (select). A shard is one row of one Parquet file, its planes, ranks and
document directory are binary columns compressed with zstd, so the readers fetch what they need.

Null text: empty, its only id is the end id. Null ``doc_id``: first in the order. Rows that repeat a
``doc_id`` are all kept, ordered by a hash of the text. An empty table gives no shards. Other columns are ignored.
A document is never cut, so one longer than a shard gets a shard of its own size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, offsets, prepare, small, texts
from wardline.llm.scan import slices
from wardline.llm.tokens import encoder

#: Ids of a shard; about 2 bytes each in its file.
SHARD_TOKENS = 1 << 21

_SUPER = 512  # bits per entry of the rank directory


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, packed: bytes, ranks: bytes, n: int):
        self.n = n
        self._bytes = np.frombuffer(packed, np.uint8)
        self._ranks = np.frombuffer(ranks, "<u4")

    @staticmethod
    def build(bits: np.ndarray) -> tuple[bytes, bytes]:
        """The packed bits, and the number of ones before each block of 512."""
        packed = np.packbits(bits, bitorder="little")
        blocks = np.add.reduceat(bits, np.arange(0, len(bits), _SUPER), dtype=np.int64) if len(bits) else np.zeros(0)
        ranks = np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")
        return packed.tobytes(), ranks.tobytes()

    def bits(self) -> np.ndarray:
        return np.unpackbits(self._bytes, count=self.n, bitorder="little")

    def bit(self, i: int) -> int:
        return int(self._bytes[i >> 3] >> (i & 7)) & 1

    def ones(self, i: int) -> int:
        """Ones among the first i bits."""
        block = i // _SUPER
        some = self._bytes[block * (_SUPER // 8) : (i + 7) // 8]
        return int(self._ranks[block]) + int(np.unpackbits(some, bitorder="little")[: i - block * _SUPER].sum())

    def find(self, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit of that value."""
        before = self._ranks.astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * _SUPER, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        some = np.unpackbits(self._bytes[block * (_SUPER // 8) : (block + 1) * (_SUPER // 8)], bitorder="little")
        some = some[: self.n - block * _SUPER]
        return block * _SUPER + int(np.flatnonzero(some == bit)[k - int(before[block])])


class WaveletMatrix:
    """Ids below 2**len(planes) in succinct form."""

    def __init__(self, planes: list[tuple[bytes, bytes]], n: int):
        self.n = n
        self.planes = [Plane(packed, ranks, n) for packed, ranks in planes]
        self.zeros = [n - p.ones(n) for p in self.planes]

    @staticmethod
    def build(ids: np.ndarray, bits: int) -> list[tuple[bytes, bytes]]:
        planes, left = [], np.ascontiguousarray(ids)
        for level in reversed(range(bits)):
            bit = ((left >> level) & 1).astype(np.uint8)
            planes.append(Plane.build(bit))
            one = bit.view(bool)
            left = np.concatenate([left[~one], left[one]])
        return planes

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.bit(i), plane.ones(i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        start, depth = 0, len(self.planes)
        if token >> depth:
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            low, high = plane.ones(start), plane.ones(end)
            if token >> (depth - 1 - level) & 1:
                start, end = zeros + low, zeros + high
            else:
                start, end = start - low, end - high
        return start, end

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of the token among the first ``end`` ids (default: all)."""
        start, stop = self._range(token, self.n if end is None else end)
        return stop - start

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence, from 0."""
        start, stop = self._range(token, self.n)
        if not 0 <= k < stop - start:
            raise IndexError(k)
        at, depth = start + k, len(self.planes)
        for level in reversed(range(depth)):
            bit = token >> (depth - 1 - level) & 1
            at = self.planes[level].find(bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.rank(token))]

    def decode(self) -> np.ndarray:
        """All ids in order: the deals of the planes undone from the lowest bit up."""
        out = np.zeros(self.n, np.uint32)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            one = plane.bits().view(bool)
            before = np.empty_like(out)
            before[~one] = out[:zeros]
            before[one] = out[zeros:] | np.uint32(1 << level)
            out = before
        return out


def _schema(bits: int) -> pa.Schema:
    fields = [("part", pa.int64()), ("shard", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]
    fields += [("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64()))]
    fields += [(f"{kind}{level:02d}", pa.binary()) for level in range(bits) for kind in ("plane", "ranks")]
    return pa.schema(fields)


def _ddl(bits: int) -> str:
    planes = ", ".join(f"{kind}{level:02d} binary" for level in range(bits) for kind in ("plane", "ranks"))
    head = "part bigint, shard bigint, n_tokens bigint, n_docs bigint, first_doc bigint"
    return f"{head}, doc_ids array<bigint>, doc_tokens array<bigint>, {planes}"


def write_shards(
    docs: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    end_id: int | None = 1,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode all documents in ascending ``doc_id`` and write the shards; the result reads them back.

    ``tokenizer`` is the text of a tokenizers file. ``part`` and ``shard`` give the order of shards.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(tokenizer)  # a fixed size
    bits = max(1, (encoder(tokenizer).vocabulary - 1).bit_length())
    schema = _schema(bits)

    def build(batches):
        part, shard = TaskContext.get().partitionId(), 0
        names: list = []
        sizes: list[int] = []
        ids: list[np.ndarray] = []

        def flush():
            all_ids = np.concatenate(ids)
            row = {"part": part, "shard": shard, "n_tokens": len(all_ids), "n_docs": len(names), "first_doc": names[0]}
            row |= {"doc_ids": list(names), "doc_tokens": list(sizes)}
            for level, (plane, ranks) in enumerate(WaveletMatrix.build(all_ids, bits)):
                row |= {f"plane{level:02d}": plane, f"ranks{level:02d}": ranks}
            return pa.RecordBatch.from_pylist([row], schema)

        held_tokens = 0
        for batch in batches:
            batch_ids = batch.column(0).to_pylist()
            for name, some in zip(batch_ids, encoder(held.value).each(batch.column(1).to_pylist(), end_id), strict=True):
                if names and held_tokens + len(some) > shard_tokens:
                    yield flush()
                    shard, held_tokens = shard + 1, 0
                    names.clear(), sizes.clear(), ids.clear()
                names.append(name), sizes.append(len(some)), ids.append(some)
                held_tokens += len(some)
        if names:
            yield flush()

    # The hash splits an id with very many rows; whole texts would be sampled to the driver.
    read = texts(docs, id_col, text_col).withColumn("mark", F.xxhash64("body"))
    ranged = read.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "body")
    return scratch.table(ranged.select("doc_id", "body").mapInArrow(build, _ddl(bits)), "shards", maxRecordsPerFile=1)


def _matrix(batch: pa.RecordBatch, i: int) -> WaveletMatrix:
    planes = [n[5:] for n in batch.schema.names if n.startswith("plane")]
    read = [(batch.column(f"plane{p}")[i].as_py(), batch.column(f"ranks{p}")[i].as_py()) for p in planes]
    return WaveletMatrix(read, batch.column("n_tokens")[i].as_py())


def shard_bases(shards: DataFrame) -> DataFrame:
    """``part, shard, shard_start``: the ids of all shards before, by prefix sums within and over parts."""
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    heads = shards.select("part", "shard", "n_tokens")
    parts = offsets(heads.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n")
    local = heads.withColumn("within", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return local.join(parts, "part").select("part", "shard", (F.col("base") + F.col("within")).alias("shard_start"))


def read_digests(shards: DataFrame) -> DataFrame:
    """Decode every shard: ``part, shard, doc_id, local_start, n_tokens, ids_crc32`` per document."""

    def digest(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _matrix(batch, i).decode().astype("<u4")
                sizes = np.array(batch.column("doc_tokens")[i].as_py(), np.int64)
                ends = np.cumsum(sizes)
                view = memoryview(ids).cast("B")
                starts = ends - sizes
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(sizes)
                part = [batch.column("part")[i].as_py()] * n
                shard = [batch.column("shard")[i].as_py()] * n
                docs = pa.array(batch.column("doc_ids")[i].as_py(), pa.int64())
                arrays = [pa.array(part, pa.int64()), pa.array(shard, pa.int64()), docs]
                arrays += [pa.array(x, pa.int64()) for x in (starts, sizes, crcs)]
                names = ["part", "shard", "doc_id", "local_start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    ddl = "part bigint, shard bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"
    return shards.mapInArrow(digest, ddl)


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """``part, shard, token, n``: occurrences of a few tokens by rank alone, nothing is decoded."""

    def count(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                matrix, at = _matrix(batch, i), (batch.column("part")[i].as_py(), batch.column("shard")[i].as_py())
                rows = [{"part": at[0], "shard": at[1], "token": t, "n": matrix.rank(t)} for t in tokens]
                fields = [(n, pa.int64()) for n in ("part", "shard", "token", "n")]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    return shards.mapInArrow(count, "part bigint, shard bigint, token bigint, n bigint")


def token_places(shards: DataFrame, token: int) -> DataFrame:
    """``part, shard, place``: where a token stands within each shard, by select."""

    def find(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = _matrix(batch, i)
                part, shard = batch.column("part")[i].as_py(), batch.column("shard")[i].as_py()
                for at in range(0, matrix.rank(token), 10_000):
                    stop = min(at + 10_000, matrix.rank(token))
                    places = [matrix.select(token, k) for k in range(at, stop)]
                    arrays = [pa.array([x] * len(places), pa.int64()) for x in (part, shard)]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(places, pa.int64())], ["part", "shard", "place"])

    return shards.mapInArrow(find, "part bigint, shard bigint, place bigint")


def token_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the shards, read them back: ``doc_id, start, n_tokens, ids_crc32`` per document."""
    shards = write_shards(docs, Scratch(prepare(spark), "wavelet"), tokenizer, end_id)
    bases = shard_bases(shards)
    # One narrow row per shard of some 2M ids; counting reads no plane.
    joined = read_digests(shards).join(small(bases, shards.count()), ["part", "shard"])
    return joined.select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
