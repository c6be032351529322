"""Cross-tokenizer alignment by external spill counting (operator 12).

Two tokenizers cut the same bytes. Places where tokens of both end cut them into groups, and the two tokens that end there
are linked. How often an id pair is linked in the whole corpus is counted outside of memory:

1. Each input split encodes its texts and gathers (pair, document) records. After ``RUN_LINKS`` links they are sorted by pair,
   dealt by the low digits of the second tokenizer's id into ``RADIX`` blocks, compressed with zstd, and written: a run.
   A block has its distinct pairs with their totals in the run (``pairs``), and beside it the documents of each pair (``docs``).
2. The blocks of one radix digit are merged by a heap, ``FAN_IN`` runs at a time, in as many levels as that takes. Pairs come
   second id first, so the last level knows a pair's count and, at the end of each second id, its highest.
3. As that level goes, it streams back to each of its blocks the counts of the pairs in it; so does each level to the one below it.
   A run with its answers adds up what its documents get.

Only distinct pairs of a run meet in a merge. So a pair that a third of all links hold is one number per run, and its documents
stay spread over their runs. Runs, blocks and answers are tables in the shared folder.

Texts that are null, empty, or whose tokens' joined bytes are not a blank and the text have no tokens: zeros, and '' as digest.
Null and repeated ``doc_id``: every row is a document of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch
from wardline.llm.scan import slices

RADIX_BITS = 8
RADIX = 1 << RADIX_BITS
FIRST_BITS = 20  # of an id of the first tokenizer
DOC_BITS = 16  # of a document's number in its run
RUN_LINKS = 1 << 21
FAN_IN = 256

#: Pieces kept by one worker.
TABLE_PIECES = 300_000

#: Texts that the piece table may cut by itself: characters whose classes no library disputes.
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: The byte-level pre-tokenizer's pattern (fixed by its format), for such texts.
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\t\n\r A-Za-z0-9À-ÖØ-öø-ÿ]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)

_RUNS = (
    "run bigint, radix int, pairs binary, docs binary, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string"
)
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def byte_of_letter() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class FirstTokenizer:
    """A byte-level tokenizers file; texts of plain characters are cut into pieces that are encoded once."""

    def __init__(self, definition: str, limit: int = TABLE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(definition)
        self._library.no_padding()
        self._library.no_truncation()
        self._library.encode_special_tokens = True
        letters = byte_of_letter()
        by_id = {i: t for t, i in self._library.get_vocab(with_added_tokens=True).items()}
        self.bytes = [bytes(letters.get(c, 0) for c in by_id.get(i, "")) for i in range(max(by_id) + 1)]
        self._table: dict[str, list[int]] = {}
        self._limit = limit

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self._table) > self._limit:
            self._table.clear()
        cut = [_PIECES.findall(t) if _PLAIN.fullmatch(t) else None for t in texts]
        table = self._table
        unknown = [p for p in set(chain.from_iterable(c for c in cut if c is not None)) if p not in table]
        whole = [t for t, c in zip(texts, cut, strict=True) if c is None]
        found = self._library.encode_batch(unknown + whole, add_special_tokens=False)
        for piece, e in zip(unknown, found, strict=False):
            table[piece] = e.ids
        rest = iter(found[len(unknown) :])
        return [next(rest).ids if c is None else list(chain.from_iterable(map(table.__getitem__, c))) for c in cut]


class SecondTokenizer:
    """A sentencepiece model that puts a blank before the text by itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for i in range(self._library.get_piece_size()):
            piece = self._library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self._library.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._library.encode(texts, num_threads=1)


class Aligner:
    """Aligns both tokenizers' tokens of texts."""

    def __init__(self, definition: str, model: bytes):
        self.first, self.second = FirstTokenizer(definition), SecondTokenizer(model)
        if len(self.first.bytes) > 1 << FIRST_BITS:
            raise ValueError(f"ids of the first tokenizer must have at most {FIRST_BITS} bits")
        self._sizes = [np.array([len(b) for b in t.bytes], np.int64) for t in (self.first, self.second)]
        most = max(len(self.first.bytes), len(self.second.bytes))
        self._shown = [f"{i}{mark}" for i in range(most) for mark in ",|;"]

    def align(self, texts: list[str]):
        """Per text (n_a, n_b, n_groups, digest); then the linked ids a and b of all texts, and whose they are."""
        spaced = [" " + t for t in texts]
        both = [self.first.encode(spaced), self.second.encode(texts)]
        for i, text in enumerate(spaced):
            body = text.encode()
            if not texts[i] or any(b"".join(map(t.bytes.__getitem__, ids[i])) != body for t, ids in zip((self.first, self.second), both, strict=True)):
                both[0][i] = both[1][i] = []
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in both]
        ids = [np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in zip(both, counts, strict=True)]
        # Texts stand one after another; both tokenizers cover the same bytes of each.
        ends = [np.cumsum(size[i]) for size, i in zip(self._sizes, ids, strict=True)]
        total = int(ends[0][-1]) if len(ends[0]) else 0
        marks = [np.zeros(total + 1, bool) for _ in range(2)]
        for mark, end in zip(marks, ends, strict=True):
            mark[end] = True
        common = marks[0] & marks[1]
        last = [common[end] for end in ends]  # the token ends its group
        group = [np.cumsum(x) - x for x in last]
        behind = [np.concatenate([[0], np.flatnonzero(x) + 1]) for x in last]  # tokens before each group, and all
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        order[np.arange(len(ids[0])) + behind[1][group[0]]] = 3 * ids[0] + last[0]
        order[np.arange(len(ids[1])) + behind[0][group[1] + 1]] = 3 * ids[1] + 2 * last[1]
        bounds = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
        shown = order.tolist()
        rows = []
        owners = np.repeat(np.arange(len(texts)), counts[0])[last[0]]
        groups = np.bincount(owners, minlength=len(texts))
        for i in range(len(texts)):
            text = "".join(map(self._shown.__getitem__, shown[bounds[i] : bounds[i + 1]]))[:-1]
            rows.append((int(counts[0][i]), int(counts[1][i]), int(groups[i]), hashlib.sha256(text.encode()).hexdigest() if text else ""))
        return rows, ids[0][last[0]], ids[1][last[1]], owners


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(definition: str, model: bytes) -> Aligner:
    """The worker's aligner, kept between tasks."""
    key = hash((definition, model))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(definition, model)
    return _ALIGNERS[key]


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length in one zstd frame."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpacked(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // sum(np.dtype(d).itemsize for d in dtypes)
    out, at = [], 0
    for d in dtypes:
        out.append(np.frombuffer(raw, d, n, at))
        at += n * np.dtype(d).itemsize
    return out


def _pairs(keys: np.ndarray, totals: np.ndarray) -> bytes:
    """A block's distinct pairs, ascending, and their totals."""
    return _packed(np.diff(keys, prepend=0).astype("<i8"), totals.astype("<i8"))


def _read_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, totals = _unpacked(blob, "<i8", "<i8")
    return np.cumsum(steps), totals


def _blocks(records: np.ndarray):
    """(radix, pairs, docs) of a run's records: radix digit, rest of b, a, document, from high bits to low."""
    records, times = np.unique(records, return_counts=True)
    pair = records >> DOC_BITS
    radix = pair >> (64 - RADIX_BITS - DOC_BITS - 1)
    cuts = np.searchsorted(radix, np.arange(RADIX + 1))
    for digit in range(RADIX):
        some = slice(cuts[digit], cuts[digit + 1])
        if cuts[digit] == cuts[digit + 1]:
            continue
        keys, first, n = np.unique(pair[some], return_index=True, return_counts=True)
        keys &= (1 << (64 - RADIX_BITS - DOC_BITS - 1)) - 1
        totals = np.add.reduceat(times[some], first)
        which = np.repeat(np.arange(len(keys)), n)
        place = records[some] & ((1 << DOC_BITS) - 1)
        yield digit, _pairs(keys, totals), _packed(which.astype("<u4"), place.astype("<u4"), times[some].astype("<u4"))


def _record(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
    key = ((b >> RADIX_BITS) << FIRST_BITS) | a
    return ((b & (RADIX - 1)) << (64 - RADIX_BITS - 1)) | (key << DOC_BITS) | place


def write_runs(docs: DataFrame, scratch: Scratch, definition: str, model: bytes, id_col: str, text_col: str, run_links: int) -> DataFrame:
    """Pass one: blocks (``run, radix, pairs, docs``) and documents (``run, place, doc_id`` and their own figures)."""
    context = docs.sparkSession.sparkContext
    held = context.broadcast(definition), context.broadcast(model)
    schema = pa.schema(
        [("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary()), ("place", pa.int32()), ("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups")]
        + [("groups_sha256", pa.string())]
    )

    def runs(batches):
        aligner = _aligner(held[0].value, held[1].value)
        run, place, links, records = TaskContext.get().partitionId() << 32, 0, 0, []

        def blocks():
            some = np.concatenate(records) if records else np.zeros(0, np.int64)
            records.clear()
            for digit, pairs, of_docs in _blocks(some):
                yield pa.RecordBatch.from_pylist([{"run": run, "radix": digit, "pairs": pairs, "docs": of_docs}], schema)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, stop in slices([t.encode() for t in texts]):
                rows, a, b, owner = aligner.align(texts[start:stop])
                if links and (links + len(a) > run_links or place + len(rows) > 1 << DOC_BITS):
                    yield from blocks()
                    run, place, links = run + 1, 0, 0
                records.append(_record(a, b, owner + place))
                named = [
                    {"run": run, "place": place + i, "doc_id": ids[start + i], "n_a": n_a, "n_b": n_b, "n_groups": n, "groups_sha256": sha}
                    for i, (n_a, n_b, n, sha) in enumerate(rows)
                ]
                place, links = place + len(rows), links + len(a)
                yield pa.RecordBatch.from_pylist(named, schema)
        yield from blocks()

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return scratch.table(read.mapInArrow(runs, _RUNS), "runs", compression="uncompressed")


def merged(blocks: list[tuple[np.ndarray, np.ndarray]]):
    """(second id's rest, [(pair, count, block numbers)]) over all blocks, by a heap, second ids ascending."""
    streams = [zip(keys.tolist(), repeat(i), totals.tolist(), strict=False) for i, (keys, totals) in enumerate(blocks)]
    side, found = None, []
    for key, block, n in heapq.merge(*streams):
        if key >> FIRST_BITS != side:
            if found:
                yield side, found
            side, found = key >> FIRST_BITS, []
        if found and found[-1][0] == key:
            found[-1][1] += n
            found[-1][2].append(block)
        else:
            found.append([key, n, [block]])
    if found:
        yield side, found


def _merge(table: pa.Table) -> pa.Table:
    """One block of all blocks of a radix digit and group."""
    keys, counts = [], []
    for _, pairs in merged([_read_pairs(p) for p in table["pairs"].to_pylist()]):
        keys += [p[0] for p in pairs]
        counts += [p[1] for p in pairs]
    row = {"run": table["part"][0].as_py(), "radix": table["radix"][0].as_py(), "pairs": _pairs(np.array(keys, np.int64), np.array(counts, np.int64))}
    return pa.Table.from_pylist([row], pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary())]))


_ANSWERS = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary())])


def _answer_all(table: pa.Table) -> pa.Table:
    """The last level: to each block the counts of its pairs, and whether they are the highest of their second id."""
    counts, best = [[[] for _ in range(len(table))] for _ in range(2)]
    for _, pairs in merged([_read_pairs(p) for p in table["pairs"].to_pylist()]):
        highest = max(p[1] for p in pairs)
        for _, n, blocks in pairs:
            for block in blocks:
                counts[block].append(n)
                best[block].append(n == highest)
    blobs = [_packed(np.array(c, "<i8"), np.array(h, "u1")) for c, h in zip(counts, best, strict=True)]
    return pa.Table.from_arrays([table["run"], table["radix"], pa.array(blobs, pa.binary())], schema=_ANSWERS)


def _answer_below(blocks: pa.Table, above: pa.Table) -> pa.Table:
    """A lower level: the group's block has all pairs of its members, and their counts."""
    known, _ = _read_pairs(above["pairs"][0].as_py())
    counts, best = _unpacked(above["counts"][0].as_py(), "<i8", "u1")
    blobs = []
    for pairs in blocks["pairs"].to_pylist():
        at = np.searchsorted(known, _read_pairs(pairs)[0])
        blobs.append(_packed(counts[at], best[at]))
    return pa.Table.from_arrays([blocks["run"], blocks["radix"], pa.array(blobs, pa.binary())], schema=_ANSWERS)


def answers(blocks: DataFrame, scratch: Scratch, n_runs: int, fan_in: int, level: int = 0) -> DataFrame:
    """``run, radix, counts`` for ``run, radix, pairs``: merged up to one block per digit, then answered downwards."""
    ddl = "run bigint, radix int, counts binary"
    if n_runs <= fan_in:
        return scratch.table(blocks.groupBy("radix").applyInArrow(_answer_all, ddl), f"answers{level}", compression="uncompressed")
    parts = -(-2 * n_runs // fan_in)  # runs are hashed to groups, so these are planned half full
    dealt = blocks.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(parts)))
    up = dealt.groupBy("radix", "part").applyInArrow(_merge, "run bigint, radix int, pairs binary")
    up = scratch.table(up, f"merged{level}", compression="uncompressed")
    top = answers(up, scratch, parts, fan_in, level + 1)
    above = up.join(top, ["run", "radix"]).withColumnRenamed("run", "part")
    down = dealt.groupBy("radix", "part").cogroup(above.groupBy("radix", "part")).applyInArrow(_answer_below, ddl)
    return scratch.table(down, f"answers{level}", compression="uncompressed")


def _add_up(rows: pa.Table, found: pa.Table) -> pa.Table:
    """A run's documents with what their pairs add."""
    place = np.array([p is not None for p in rows["place"].to_pylist()])
    docs, blocks = rows.filter(pa.array(place)), rows.filter(pa.array(~place))
    sums = np.zeros((2, len(docs)), np.int64)
    counts = dict(zip(found["radix"].to_pylist(), found["counts"].to_pylist(), strict=True))
    for digit, blob in zip(blocks["radix"].to_pylist(), blocks["docs"].to_pylist(), strict=True):
        which, at, times = _unpacked(blob, "<u4", "<u4", "<u4")
        n, best = _unpacked(counts[digit], "<i8", "u1")
        np.add.at(sums[0], at, times * best[which].astype(np.int64))
        np.add.at(sums[1], at, times * n[which])
    sums = sums[:, docs["place"].to_numpy()]
    columns = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]
    names = [f.split()[0] for f in _RESULT.split(", ")]
    return pa.Table.from_arrays([*columns, pa.array(sums[0]), pa.array(sums[1]), docs["groups_sha256"]], names=names)


def align(
    docs: DataFrame,
    scratch: Scratch,
    definition: str,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    run_links: int = RUN_LINKS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    runs = write_runs(docs, scratch, definition, model, id_col, text_col, run_links)
    blocks = runs.filter(F.col("radix").isNotNull())
    n_runs = blocks.select("run").distinct().count()
    found = answers(blocks.select("run", "radix", "pairs"), scratch, n_runs, fan_in)
    wanted = runs.drop("pairs")
    return wanted.groupBy("run").cogroup(found.groupBy("run")).applyInArrow(_add_up, _RESULT)


def default_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()
