"""Near duplicates of vectors by iterative quantisation and multi-index Hamming tables (operator 8).

Vectors with one label are compared by cosine. Equal vectors are one class. On a bounded sample the
principal directions and a rotation of them are learned so that signs lose least (iterative
quantisation, ``rotations`` of them); a class's code is the signs of its rotated vector. Codes are cut
into substrings, one table each; codes that differ in at most one bit of some
substring meet there, at the first such table only. Substrings are as wide as the number of vectors of
the largest label asks for, ``TABLE_BITS`` at least, so that unlike vectors which meet by chance stay a fixed number
per vector however many there are; and there are as many tables, and rotations to fill them, as a pair at the limit needs
(`layout`). Pairs that meet, but whose whole codes differ in more bits than a pair at the limit's would, go no
further. Classes with the same code form a cell, cells
are kept in chunks of some ``CHUNK`` vectors, and the chunks of cells that meet are reranked with the
original vectors by matrix products in double precision. What leaves a pair of chunks is per vector:
its number of links there and the component it belongs to there, never the links themselves, so a
large group of near copies costs products but no rows.

No candidate is dropped; what may be missed is a pair whose codes differ by two bits or more in every
substring. At cosine 0.93 that is about one pair in 60 by the angle alone, and fewer above. Substrings cannot
be wider than the vectors are, so very many vectors of few dimensions have more chance meetings.

Null labels, null or zero vectors and vectors with null or non-finite components link with nothing.
Vectors of unlike lengths do not link; lengths other than the most common share one cell per label.
Null ``vec_id``: counted as a link of others, named by none. Repeated rows are vectors of their own
and link with each other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch
from wardline.llm.graph import components

COSINE = 0.93

#: The fit reads this many values at most: rows are taken by the order of a hash.
SAMPLE_VALUES = 1_000_000
#: Bits of a code, and the least width of a substring; one pair at the limit in ``MISSED`` may be missed.
BITS, TABLE_BITS, MISSED = 64, 16, 60
CHUNK = 256
TURNS = 40


@dataclass(frozen=True)
class Layout:
    """How codes are cut: ``n_codes`` codes of ``per_code`` substrings of ``table_bits`` bits.

    ``most_bits`` is how many bits the whole codes of a pair may differ in.
    """

    width: int
    table_bits: int
    n_codes: int
    most_bits: int

    @property
    def per_code(self) -> int:
        return max(1, min(BITS, self.width) // self.table_bits)

    @property
    def n_tables(self) -> int:
        return self.n_codes * self.per_code

    @property
    def names(self) -> list[str]:
        return [f"code{r}" for r in range(self.n_codes)]

    def substring(self, code: Column, table: int) -> Column:
        at = (table % self.per_code) * self.table_bits
        return F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << self.table_bits) - 1))

    def name(self, table: int) -> str:
        return f"code{table // self.per_code}"

    def meets(self, table: int, a: str, b: str) -> Column:
        """Substrings of one table differ by a bit at most."""
        return F.bit_count(self.substring(self._differ(self.name(table), a, b), table)) <= 1

    def alike(self, a: str, b: str) -> Column:
        """The whole codes differ in no more bits than a pair at the limit's."""
        return reduce(Column.__add__, [F.bit_count(self._differ(n, a, b)) for n in self.names]) <= self.most_bits

    @staticmethod
    def _differ(name: str, a: str, b: str) -> Column:
        return F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))


def layout(width: int, rows: int, least: float = COSINE) -> Layout:
    """The codes for vectors of ``width`` dimensions, ``rows`` of them in the largest label.

    A bit of a pair at the limit differs with the chance of its angle. Substrings of log2 of ``rows`` bits leave a fixed
    number of chance meetings per vector and table; the number of tables follows from how often a pair at the
    limit differs in one bit of a substring at most. The bound on whole codes lies six standard deviations above their
    mean; codes with more bits than dimensions are not independent, which widens it.
    """
    low = min(BITS, width)
    bits = max(1, min(low, max(TABLE_BITS, math.ceil(math.log2(max(rows, 1))))))
    differs = math.acos(least) / math.pi
    found = (1 - differs) ** bits + bits * differs * (1 - differs) ** (bits - 1)
    tables = math.ceil(math.log(MISSED) / -math.log1p(-min(found, 1 - 1e-9)))
    if bits < TABLE_BITS:  # every narrow code is whole in its table; keep as many as wide ones get
        tables = max(tables, 8)
    n_codes = -(-tables // max(1, low // bits))
    total = n_codes * low
    spread = math.sqrt(total * differs * (1 - differs) * max(1.0, total / (2 * low)))
    return Layout(width, bits, n_codes, math.ceil(total * differs + 6 * spread))


def fit(sample: np.ndarray, n_codes: int) -> np.ndarray:
    """Directions as columns: ``n_codes`` rotations of the leading principal directions.

    Vectors are not centred: signs then follow the angle between vectors whatever their mean, so a
    corpus that is mostly one group of near copies still gets equal codes for them.
    """
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    _, vectors = np.linalg.eigh(unit.T @ unit)
    leading = vectors[:, ::-1][:, :BITS]
    low = unit @ leading
    found = []
    for seed in range(n_codes):
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(low.shape[1],) * 2))[0]
        for _ in range(TURNS):
            signs = np.where(low @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(low.T @ signs)
            turn = left @ right
        found.append(leading @ turn)
    return np.concatenate(found, axis=1)


def _codes(model, n_codes: int):
    """``node, label, width, vector`` -> beside them one long per rotation."""

    def code(batches):
        directions = model.value
        per = directions.shape[1] // n_codes
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            words = np.zeros((len(vectors), n_codes), np.int64)
            fits = [i for i, v in enumerate(vectors) if len(v) == len(directions)]
            if fits:
                unit = np.array([vectors[i] for i in fits])
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                signs = (unit @ directions >= 0).reshape(len(fits), n_codes, per)
                wide = np.zeros((len(fits), n_codes, 64), np.uint8)
                wide[:, :, :per] = signs
                words[fits] = np.packbits(wide, axis=2, bitorder="little").view("<i8")[:, :, 0]
            arrays = [*batch.columns, *(pa.array(words[:, r]) for r in range(n_codes))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *(f"code{r}" for r in range(n_codes))])

    return code


def _rerank(least: float):
    """Two chunks of one label -> ``node, n_links, root`` for what links there."""

    def block(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for row in batch.to_pylist():
                a, b = row["left"], row["right"]
                one, two = (np.array([x["vector"] for x in side], np.float64) for side in (a, b))
                one, two = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (one, two))
                nodes_a, nodes_b = (np.array([x["node"] for x in side]) for side in (a, b))
                near = one @ two.T >= least
                if row["same"]:
                    np.fill_diagonal(near, False)
                copies_b = np.array([x["copies"] for x in b])
                copies_a = np.array([x["copies"] for x in a])
                roots_a, roots_b = nodes_a.copy(), nodes_b.copy()
                none = np.iinfo(np.int64).max
                while near.any():  # smallest node reached, along links
                    new_a = np.minimum(roots_a, np.where(near, roots_b, none).min(axis=1))
                    new_b = np.minimum(roots_b, np.where(near.T, new_a, none).min(axis=1))
                    if row["same"]:
                        new_a = new_b = np.minimum(new_a, new_b)
                    if (new_a == roots_a).all() and (new_b == roots_b).all():
                        break
                    roots_a, roots_b = new_a, new_b
                sides = [(nodes_a, near @ copies_b, roots_a)]
                if not row["same"]:
                    sides.append((nodes_b, near.T @ copies_a, roots_b))
                for nodes, links, roots in sides:
                    hit = links > 0
                    for k, values in enumerate((nodes, links, roots)):
                        out[k] += values[hit].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["node", "n_links", "root"])

    return block


def near_vectors(
    vectors: DataFrame,
    scratch: Scratch,
    least: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per vector."""
    spark = scratch.spark
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    # -0.0 and 0.0 are the same component; a class is a label and a vector
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    valid = F.coalesce(F.col("label").isNotNull() & finite & nonzero, F.lit(False))
    rows = scratch.table(rows.withColumn("vector", F.when(valid, plain)), "rows")

    usable = rows.filter("vector is not null")
    classes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    # A class without any id is a node by its hash; it gives its component no name.
    classes = scratch.table(classes.withColumn("node", F.coalesce("first_id", F.xxhash64("label", "vector"))), "classes")
    width = classes.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = width["width"] if width else 1
    shown = classes.filter(F.size("vector") == width).orderBy(F.xxhash64("node"), "node")
    sample = shown.select("vector").limit(max(1, SAMPLE_VALUES // width)).toArrow().column("vector")
    sample = np.array(sample.to_pylist(), np.float64).reshape(-1, width)
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    cut = layout(width, largest or 1, least)
    names = cut.names
    model = spark.sparkContext.broadcast(fit(sample, cut.n_codes) if len(sample) else np.zeros((width, cut.n_codes)))

    # width is part of the label from here on: unlike lengths never meet
    kept = classes.select("node", F.concat_ws("/", F.size("vector"), "label").alias("label"), "copies", "vector")
    ddl = "node bigint, label string, copies bigint, vector array<double>, " + ", ".join(f"{n} bigint" for n in names)
    coded = scratch.table(kept.mapInArrow(_codes(model, cut.n_codes), ddl), "codes")

    cells = coded.groupBy("label", *names).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n_chunks"), F.min("node").alias("cell"))
    cells = scratch.table(cells, "cells")
    numbered = coded.join(cells, ["label", *names]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("n_chunks")).cast("int"))
    member = F.struct("node", "copies", "vector")
    chunks = scratch.table(numbered.groupBy("cell", "chunk").agg(F.sort_array(F.collect_list(member)).alias("members")), "chunks")

    live = range(cut.n_tables)
    key = {t: cut.substring(F.col(cut.name(t)), t) for t in live}
    flips = [0] + [1 << i for i in range(cut.table_bits)]
    index = cells.select("*", F.explode(F.array(*[F.struct(F.lit(t).alias("table"), key[t].alias("key")) for t in live])).alias("e"))
    index = index.select("label", *names, "n_chunks", "cell", "e.table", "e.key")
    probes = index.withColumn("key", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda f: F.col("key").bitwiseXOR(f.cast("long")))))
    p, q = probes.alias("p"), index.alias("q")
    earlier = F.lit(False)
    for i, t in enumerate(live[1:], 1):
        before = reduce(Column.__or__, [cut.meets(s, "p", "q") for s in live[:i]])
        earlier = earlier | ((F.col("p.table") == t) & before)
    same_place = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("label", "table", "key")]
    met = p.join(q, reduce(Column.__and__, same_place) & (F.col("p.cell") < F.col("q.cell")) & cut.alike("p", "q") & ~earlier)
    met = met.select(F.col("p.cell").alias("a"), F.col("q.cell").alias("b"), F.col("p.n_chunks").alias("na"), F.col("q.n_chunks").alias("nb"))
    alone = cells.select(F.col("cell").alias("a"), F.col("cell").alias("b"), F.col("n_chunks").alias("na"), F.col("n_chunks").alias("nb"))
    pairs = met.unionByName(alone).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).filter("a != b or i <= j")
    sides = pairs.join(chunks.select(F.col("cell").alias("a"), F.col("chunk").alias("i"), F.col("members").alias("left")), ["a", "i"])
    sides = sides.join(chunks.select(F.col("cell").alias("b"), F.col("chunk").alias("j"), F.col("members").alias("right")), ["b", "j"])
    # a chunk alone with itself holds a single vector's worth of nothing
    sides = sides.select("left", "right", ((F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))).alias("same"))
    sides = sides.filter(~F.col("same") | (F.size("left") > 1))
    linked = scratch.table(sides.mapInArrow(_rerank(least), "node bigint, n_links bigint, root bigint"), "linked")

    counts = linked.groupBy("node").agg(F.sum("n_links").alias("others"))
    homes = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    named = classes.join(counts, "node", "left").join(homes, "node", "left")
    first = named.groupBy(F.coalesce("root", "node").alias("home")).agg(F.min("first_id").alias("component_id"))
    found = named.withColumn("home", F.coalesce("root", "node")).join(first, "home")
    found = found.select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(found, ["label", "vector"], "left")
    component = F.when(F.col("vector").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
