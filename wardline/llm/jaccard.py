"""Documents that share most of their word shingles, exactly (operator 5).

Words are what lies between ASCII white space, A-Z in lower case; a document's set holds the 64-bit
hashes of its distinct shingles of ``WORDS`` words. Equal sets are one node from the start.

1. One pass over the texts gives each document its set's size and identity and a bitmap signature of
   ``BITS`` bits, and counts all shingles in ``SKETCH`` counters, whatever the corpus' size.
2. Shingles are put in one order for all sets, by their counter and then by hash, so frequent ones
   come last, and a set leaves a row for each of its first fifth: two sets of the wanted similarity
   share one of these (prefix filter). Shingles that share a counter change the work, never the result.
3. Rows of a shingle fall into tiles by size band; a set can link within its band and the next. In
   each tile all sets are held against a few leaders. Bit counts of the signatures bound the overlap
   from above (each differing bit is a shingle that only one side has); what passes is decided by
   intersecting the sorted shingle arrays, made again from the texts of those sets alone.
4. Sets of one tile that are linked by now need no more comparing. Tiles that still hold several
   components, and a set of their own band, are joined with themselves across components, again behind the bit counts, so no link
   between components is lost. A pair shares several shingles; it leaves the join under the smallest
   one that both hold among ``HEADS`` of their first fifth (where there is none, under each early one).
   Since only components are wanted, copies and near copies are not expanded into pairs.

A set with under ``WORDS`` words holds the whole sequence as one shingle. Null, empty and blank texts
have empty sets and link with nothing; each is its own component. Null ``doc_id``: the component is
the smallest id that is not null, if any. Repeated rows: one row out per row in. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, texts
from wardline.llm.graph import components
from wardline.llm.scan import Words, join, lower, mix, slices, stream

WORDS = 5
#: The least similarity, as a fraction.
SIMILAR = (4, 5)

#: Bits of a signature, in 64-bit words.
BITS = 1024

#: Counters of shingles (4 MB a task), merged in blocks.
SKETCH, SKETCH_BLOCK = 1 << 20, 1 << 14

#: Shingles of a set's prefix, smallest hashes first, that tell under which one a pair leaves the join.
HEADS = 16

#: Words of 64 bits, at most, in a filter of hashes (8 MB of bits); false hits cost work only.
FILTER_WORDS = 1 << 20

_U = np.uint64
_FACTORS = stream(31, WORDS)
_SET = stream(32, 1)[0]


def shingle_sets(bodies: list[bytes], words: int = WORDS):
    """The sorted distinct shingle hashes of each text."""
    for start, stop in slices(bodies):
        buffer, at = join(bodies[start:stop])
        found = Words(lower(buffer))
        ends = np.cumsum(found.counts(at))
        hashes = found.hashes
        with np.errstate(over="ignore"):
            n = max(0, len(hashes) - words + 1)
            whole = mix(sum((hashes[k : k + n] * _FACTORS[k] for k in range(words)), np.zeros(n, _U)))
            first = 0
            for end in ends.tolist():
                if end - first >= words:
                    yield np.unique(whole[first : end - words + 1])
                elif end > first:
                    part = hashes[first:end]
                    yield mix((part * _FACTORS[: len(part)]).sum(keepdims=True, dtype=_U) + _U(len(part)))
                else:
                    yield hashes[:0]
                first = end


def identity(found: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    with np.errstate(over="ignore"):
        total = mix(found ^ _SET).sum(keepdims=True, dtype=_U) + _U(len(found)) * _SET
        return int(mix(total).view(np.int64)[0])


def signature(found: np.ndarray) -> list[int]:
    bits = np.zeros(BITS, np.uint8)
    bits[(found >> _U(40)).astype(np.int64) % BITS] = 1
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def prefix_size(n: int) -> int:
    num, den = SIMILAR
    return n + (-num * n // den) + 1


_SET_ROW = pa.schema(
    [("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bits", pa.list_(pa.int64()))]
    + [("block", pa.int32()), ("counts", pa.binary())]
)
_SET_DDL = "doc_id bigint, mark bigint, n bigint, node bigint, bits array<bigint>, block int, counts binary"


def _sets(batches):
    """Step 1; the last rows of a task have no ``n`` but ``counts``, the counters of a ``block``."""
    seen: set[int] = set()
    keys: list[np.ndarray] = []
    held = 0
    counters = np.zeros(SKETCH, np.uint32)

    def count():
        if keys:
            np.add(counters, np.bincount((np.concatenate(keys) % _U(SKETCH)).astype(np.int64), minlength=SKETCH), out=counters, casting="unsafe")
            keys.clear()

    for batch in batches:
        rows = []
        columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2).to_pylist())
        for doc, mark, found in zip(*columns, strict=True):
            node = identity(found)
            rows.append({"doc_id": doc, "mark": mark, "n": len(found), "node": node, "bits": signature(found)})
            if len(found) and node not in seen:
                seen.add(node)
                keys.append(found)
                held += len(found)
        yield pa.RecordBatch.from_pylist(rows, _SET_ROW)
        if held > 2_000_000:
            count()
            held = 0
        if len(seen) > 500_000:
            seen.clear()
    count()
    for block in range(SKETCH // SKETCH_BLOCK):
        part = counters[block * SKETCH_BLOCK : (block + 1) * SKETCH_BLOCK]
        if part.any():
            yield pa.RecordBatch.from_pylist([{"block": block, "counts": part.astype("<u4").tobytes()}], _SET_ROW)


def _merged(batches):
    """Counters of the same block, added up."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(counts, "<u4")
            total[block] = total[block] + part if block in total else part.astype(np.int64)
    for block, counts in total.items():
        level = np.minimum(255, np.floor(8 * np.log2(1.0 + counts))).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "levels": pa.array([level.tobytes()], pa.binary())})


def _levels(sets: DataFrame) -> np.ndarray:
    """How frequent the shingles of each counter are, on a scale of 256 steps: 1 MB, however large the corpus."""
    parts = sets.filter("counts is not null").select("block", "counts").repartition("block")
    found = parts.mapInArrow(_merged, "block int, levels binary").toArrow()
    levels = np.zeros(SKETCH, np.uint8)
    for block, part in zip(found.column("block").to_pylist(), found.column("levels").to_pylist(), strict=True):
        levels[block * SKETCH_BLOCK : (block + 1) * SKETCH_BLOCK] = np.frombuffer(part, np.uint8)
    return levels


_PREFIX_DDL = "key bigint, node bigint, n int, place int, heads array<bigint>"


def _prefixes(held):
    """Step 2: ``key, node, n, place`` for the first shingles of each set in the common order; the first row also has ``heads``."""

    def prefixes(batches):
        levels = held.value
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, sizes, places, heads = [], [], [], [], []
            for found in shingle_sets(batch.column(0).to_pylist()):
                node = identity(found)
                if not len(found) or node in seen:
                    continue
                seen.add(node)
                order = np.argsort(levels[(found % _U(SKETCH)).astype(np.int64)], kind="stable")
                first = found[order[: prefix_size(len(found))]]
                keys.append(first)
                nodes.append(np.full(len(first), node))
                sizes.append(np.full(len(first), len(found)))
                places.append(np.arange(len(first)))
                heads.append(np.sort(first)[:HEADS].view(np.int64).tolist())
                heads.extend([None] * (len(first) - 1))
            if len(seen) > 500_000:
                seen.clear()
            if keys:
                arrays = [np.concatenate(keys).view(np.int64), np.concatenate(nodes)]
                arrays += [np.concatenate(x).astype(np.int32) for x in (sizes, places)]
                columns = [pa.array(x) for x in arrays] + [pa.array(heads, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "place", "heads"])

    return prefixes


def _least_overlap(n_a: Column, n_b: Column) -> Column:
    """Whether an overlap ``o`` reaches the similarity: ``o * (num + den) >= num * (n_a + n_b)``."""
    num, den = SIMILAR
    return F.lit(num) * (n_a + n_b) / F.lit(num + den)


def _early(n_a: Column, n_b: Column, place_a: Column, place_b: Column) -> Column:
    """A shared shingle at these places may be the first one of a pair that links.

    Such a pair shares ``least`` shingles, so the first stands among the first ``n - least + 1`` of either.
    """
    least = _least_overlap(n_a, n_b)
    return (n_a - place_a >= least) & (n_b - place_b >= least)


def _may_link(a: str, b: str) -> Column:
    """Bit counts and sizes allow the similarity."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = reduce(Column.__add__, [F.bit_count(F.get(f"{a}.bits", F.lit(k)).bitwiseXOR(F.get(f"{b}.bits", F.lit(k)))) for k in range(BITS // 64)])
    most = F.least(n_a, n_b, F.floor((n_a + n_b - differ) / 2))
    return most >= _least_overlap(n_a, n_b)


def _intersect(batches):
    """Pairs with both texts -> the pairs that link."""
    num, den = SIMILAR
    near: dict[int, np.ndarray] = {}  # sets of the batch before; pairs come in the order of one side
    for batch in batches:
        left, right = [], []
        before, near = near, {}

        def made(node, body):
            if node not in near:
                near[node] = before[node] if node in before else next(shingle_sets([body]))
            return near[node]

        columns = (batch.column(k).to_pylist() for k in range(4))
        for a, b, body_a, body_b in zip(*columns, strict=True):
            one, two = made(a, body_a), made(b, body_b)
            both = len(np.intersect1d(one, two, assume_unique=True))
            if den * both >= num * (len(one) + len(two) - both):
                left.append(a), right.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def _maybe_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose 64-bit hash may be one of ``wanted``, a stored table, by a filter of bits.

    It is broadcast as at most ``FILTER_WORDS`` narrow rows and spares the others a shuffle.
    """
    words = min(FILTER_WORDS, max(1 << 10, 1 << (wanted.count() // 4).bit_length()))
    word = F.shiftright(F.pmod(column, F.lit(64 * words)), 6)
    bit = F.expr(f"shiftleft(1L, cast(pmod({column}, {64 * words}L) & 63 as int))")
    hits = wanted.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__hits"))
    some = rows.withColumn("__word", word).join(F.broadcast(hits), "__word")
    return some.filter(bit.bitwiseAND(F.col("__hits")) != 0).drop("__word", "__hits")


def _verified(pairs: DataFrame, bodies: DataFrame, homes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Exact intersection of the candidate pairs ``a, b``.

    ``bodies`` has ``mark, body``, ``homes`` one ``mark`` per ``node``. A text is shuffled once by its mark, then
    once for each pair it is the ``b`` of and once for all it is the ``a`` of.
    """
    pairs = scratch.table(pairs, f"{name}-pairs")

    def marks(side: str) -> DataFrame:
        return homes.select(F.col("node").alias(side), "mark")

    members = scratch.table(pairs.join(marks("b"), "b").select("mark", "a", "b"), f"{name}-members")
    hubs = scratch.table(pairs.select("a").distinct().join(marks("a"), "a").select("mark", "a"), f"{name}-hubs")
    wanted = scratch.table(members.select("mark").unionByName(hubs.select("mark")).distinct(), f"{name}-wanted")
    found = _maybe_in(bodies, "mark", wanted).select("mark", "body").dropDuplicates(["mark"])
    sides = found.join(members, "mark").select("a", "b", F.col("body").alias("body_b"))
    sides = sides.join(found.join(hubs, "mark").select("a", F.col("body").alias("body_a")), "a")
    linked = sides.select("a", "b", "body_a", "body_b").mapInArrow(_intersect, "a bigint, b bigint")
    return scratch.table(linked, f"{name}-links")


def grouped(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark`` (a hash of the text)``, n, root, component_id`` per document; ``root`` numbers the component."""
    read = texts(docs, id_col, text_col)
    marked = read.select("doc_id", F.xxhash64("body").alias("mark"), "body")
    found = scratch.table(marked.mapInArrow(_sets, _SET_DDL), "sets")
    listed = found.filter("n is not null").select("doc_id", "mark", "n", "node", "bits")
    each = [F.min("doc_id").alias("first_doc"), F.min("mark").alias("mark"), F.max("n").alias("n"), F.max("bits").alias("bits")]
    nodes = scratch.table(listed.filter("n > 0").groupBy("node").agg(*each), "nodes")
    bodies, homes = marked.select("mark", "body"), nodes.select("node", "mark")

    levels = scratch.spark.sparkContext.broadcast(_levels(found))
    rows = scratch.table(read.select("body").mapInArrow(_prefixes(levels), _PREFIX_DDL), "prefixes")
    heads = scratch.table(rows.filter("heads is not null").groupBy("node").agg(F.max("heads").alias("heads")), "heads")
    rows = rows.drop("heads")
    num, den = SIMILAR
    # A copy in another task has rows of its own; they meet the same leaders and are dropped from the open tiles.
    shared = rows.groupBy("key").agg(F.count("*").alias("times"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = scratch.table(shared.filter("lo != hi").select("key", "times"), "shared")
    band = F.floor(F.log("n") / F.log(F.lit(SIMILAR[1] / SIMILAR[0])) + 1e-9).cast("int")
    tiled = scratch.table(_maybe_in(rows, "key", shared).join(shared, "key").withColumn("band", band), "tiles")
    scratch.drop("prefixes")

    # Leaders of a tile: one set by number, and the one whose prefix the most others share, most likely
    # what near copies were made from.
    prefix = F.max(F.col("n") + F.floor(-F.lit(num) * F.col("n") / F.lit(den)) + 1)
    shares = tiled.groupBy("node").agg((F.sum("times") / prefix).alias("shares"))
    ranked = tiled.drop("times").join(shares, "node")
    leader = F.struct("node", "n", "place")
    picks = F.array(F.min(leader), F.max_by(leader, F.struct("shares", "node")))
    leaders = ranked.groupBy("key", "band").agg(F.array_distinct(picks).alias("leaders"))
    near = tiled.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    stars = near.join(leaders, ["key", "band"]).select(F.explode("leaders").alias("l"), "node", "n", "place")
    stars = stars.filter((F.col("l.node") != F.col("node")) & _early(F.col("l.n"), F.col("n"), F.col("l.place"), F.col("place")))
    stars = stars.select(F.col("l.node").alias("x"), "node")
    stars = stars.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    signed = nodes.select("node", "n", "bits")
    bounded = (
        stars.join(signed.alias("p"), F.col("a") == F.col("p.node"))
        .join(signed.alias("q"), F.col("b") == F.col("q.node"))
        .filter(_may_link("p", "q"))
        .select("a", "b")
    )
    links = _verified(bounded, bodies, homes, scratch, "stars")
    merged = components(links, scratch, "stars")

    labelled = tiled.join(merged, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Rows stand in the tile of their band and, as guests, in the next lower one. A tile needs comparing if it
    # has rows of its own and several components; a key has few bands, so its tiles fit one row.
    placed = F.array("band", F.col("band") - 1)
    held = labelled.select("key", "root", F.col("band").alias("home"), F.explode(placed).alias("band")).groupBy("key", "band")
    held = held.agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("home").alias("home"))
    mixed = held.filter("lo != hi and home = band").groupBy("key").agg(F.collect_list("band").alias("mixed"))
    unlike = labelled.join(mixed, "key").withColumn("home", F.col("band"))
    unlike = unlike.withColumn("band", F.explode(F.array_intersect(placed, "mixed"))).drop("mixed").dropDuplicates(["key", "band", "node"])
    both = scratch.table(unlike.join(signed.select("node", "bits"), "node").join(heads, "node"), "open")
    scratch.drop("shared", "tiles", "heads")
    # Both sides of the join are these same rows, shuffled once; a pair counts in the tile of its lower band only.
    crossing = both.alias("p").join(
        both.alias("q"),
        (F.col("p.key") == F.col("q.key"))
        & (F.col("p.band") == F.col("q.band"))
        & (F.col("p.node") < F.col("q.node"))
        & (F.col("p.root") != F.col("q.root"))
        & (F.least("p.home", "q.home") == F.col("p.band"))
        & _may_link("p", "q")
        & F.coalesce(
            F.array_min(F.array_intersect("p.heads", "q.heads")) == F.col("p.key"),
            _early(F.col("p.n"), F.col("q.n"), F.col("p.place"), F.col("q.place")),
        ),
    )
    crossing = crossing.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()
    more = _verified(crossing, bodies, homes, scratch, "rest")
    joined = components(links.unionByName(more), scratch, "all")

    whole = nodes.select("node", "first_doc").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = whole.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    homes = whole.join(named, "root").select("node", "root", "component_id")
    return listed.join(homes, "node", "left").select(
        "doc_id", "mark", "n", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    return grouped(docs, scratch, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest ``doc_id`` (none last, then by text) once; all blank texts."""
    found = scratch.table(grouped(docs, scratch, id_col, text_col), "groups").filter("n > 0")
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    best = found.groupBy("root").agg(F.min(name).alias("k")).select("k.doc_id", "k.mark")
    times = found.groupBy("doc_id", "mark").agg(F.count("*").alias("times"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    best = best.select(F.col("doc_id").alias("d"), F.col("mark").alias("m")).join(times, same).select("d", "m", "times")
    best = scratch.table(best, "best")
    rows = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__mark", F.xxhash64(F.col(text_col).cast("string").cast("binary")))
    match = F.col("__id").eqNullSafe(F.col("d")) & (F.col("__mark") == F.col("m"))
    blank = ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.filter(~blank).join(best.filter("times = 1"), match, "left_semi")
    again = best.filter("times > 1")
    if not again.isEmpty():  # repeated rows: one of them
        kept = kept.unionByName(rows.filter(~blank).join(again, match, "left_semi").dropDuplicates(["__id", "__mark"]))
    return kept.unionByName(rows.filter(blank)).drop("__id", "__mark")
