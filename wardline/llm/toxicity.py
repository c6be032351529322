"""Toxicity by weak supervision (operator 4).

1. From at most ``SAMPLE`` labelled documents per class (the bound of the fit; taken by the order of a
   hash, never from held-out rows) words and word beginnings are counted per class. Those far more
   frequent in toxic documents are the vocabulary.
   Entries that come up several times in a document count as entries of their own.
2. The strongest are dealt out to voters: lexicons (whole words) and patterns (beginnings), each a
   small set that votes toxic if a document has one of its entries and abstains else.
3. A generative model of the votes estimates by expectation maximisation how often each voter speaks
   in either class, starting from the labelled rates, which stay as a prior of ``TRUST`` documents. Voters
   that agree beyond what the class explains are correlated; a voter's evidence is divided by the number it is
   correlated with, weighted by how much.
4. A logistic classifier over the whole vocabulary is trained on the posterior labels, each class
   weighted to its share of the labelled rows.
5. Every document is scored in one pass: a sum over its distinct vocabulary entries.

Null and empty texts get the score of a text without evidence. Null ``doc_id``: scored, not held out.
Repeated rows: one row out per row in. Repeated labels of a document: the higher counts; null labels
count as none. Where no toxic or no clean row is labelled, every score is 0. An empty table gives no
rows. Other columns are ignored; ``labels``, ``lang`` and ``source`` are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, texts
from wardline.llm.scan import HashTable, Words, join, lower, slices

#: Labelled documents per class in the fit.
SAMPLE = 8000
THRESHOLD = 0.3

#: Entries of the vocabulary, entries a voter may hold, voters.
VOCABULARY, VOTER_ENTRIES, VOTERS = 4000, 6, 64
#: An entry is in so many toxic documents, and so many times likelier there; one that shares a voter, ``VOTER_RATIO`` times.
SUPPORT, RATIO, VOTER_RATIO = 4, 6.0, 60.0
BEGINNINGS = (3, 4, 5, 6, 7)
#: From so many occurrences in a document on, an entry counts as another one (``word-#2``).
OFTEN = (2, 4)
#: Documents' worth of weight that the labelled rates keep in the label model.
TRUST = 4000

_LETTERS = re.compile(r"[^\W\d_]+")


def entries(piece: str) -> list[str]:
    """Words of a piece (``=word``) and their beginnings (``word-``)."""
    out = []
    for word in _LETTERS.findall(piece.lower()):
        out.append("=" + word[:40])
        out += [word[:k] + "-" for k in BEGINNINGS if len(word) > k]
    return out


def often(times: Counter) -> set[str]:
    """The entries of a document, those that come up often also as such."""
    return set(times) | {f"{e}#{k}" for e, n in times.items() if n > 1 for k in OFTEN if n >= k}


class Reader:
    """Distinct vocabulary entries of documents; a distinct piece of text is taken apart once."""

    def __init__(self, vocabulary: dict[str, int], limit: int = 1_000_000):
        plain = sorted({e.split("#")[0] for e in vocabulary})
        self._plain = {e: i for i, e in enumerate(plain)}
        levels = ["", *(f"#{k}" for k in OFTEN)]
        self._levels = [np.array([vocabulary.get(e + level, -1) for e in plain], np.int64) for level in levels]
        self._limit = limit
        self._clear()

    def _clear(self) -> None:
        self._table = HashTable()
        self._bounds = np.zeros(1, np.int64)
        self._found = np.zeros(0, np.int64)

    def read(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``doc, entry`` pairs in order of the document, each once."""
        if self._table.size > self._limit:
            self._clear()
        buffer, at = join(bodies)
        words = Words(lower(buffer), marks=True)
        number = self._table.find(words.hashes)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            hashes, first = np.unique(words.hashes[unknown], return_index=True)
            found, sizes = [], []
            for i in unknown[first].tolist():
                piece = entries(words.piece(i).decode("utf-8", "replace"))
                known = [self._plain[e] for e in piece if e in self._plain]
                found += known
                sizes.append(len(known))
            self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(sizes)])
            self._found = np.concatenate([self._found, np.array(found, np.int64)])
            self._table.add(hashes)
            number[unknown] = self._table.find(words.hashes[unknown])
        starts = self._bounds[number]
        sizes = self._bounds[number + 1] - starts
        doc = np.repeat(np.repeat(np.arange(len(bodies)), words.counts(at)), sizes)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        plain = self._found[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        pairs, times = np.unique(doc * max(1, len(self._plain)) + plain, return_counts=True)
        doc, plain = np.divmod(pairs, max(1, len(self._plain)))
        docs, out = [], []
        for least, level in zip((1, *OFTEN), self._levels, strict=True):
            entry = level[plain] if len(level) else plain
            hit = (times >= least) & (entry >= 0)
            docs.append(doc[hit])
            out.append(entry[hit])
        doc, entry = np.concatenate(docs), np.concatenate(out)
        order = np.argsort(doc, kind="stable")
        return doc[order], entry[order]


def _count(wanted):
    """Sampled documents -> in how many of either class an entry is; ``wanted``: those to count, or all of toxic ones."""

    def count(batches):
        clean, toxic = Counter(), Counter()
        for batch in batches:
            for body, label in zip(batch.column("body").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                times: Counter = Counter()
                for piece, n in Counter(body.split()).items():
                    for e in entries(piece.decode("utf-8", "replace")):
                        times[e] += n
                found = often(times)
                if wanted is None:
                    toxic.update(found if label else ())
                elif not label:
                    clean.update(found & wanted.value.keys())
        seen = list(toxic.keys() | clean.keys())
        arrays = [pa.array(seen, pa.string()), *(pa.array([c[e] for e in seen], pa.int64()) for c in (clean, toxic))]
        yield pa.RecordBatch.from_arrays(arrays, ["entry", "clean", "toxic"])

    return count


def _entries_of(vocabulary):
    """Sampled documents -> their label and vocabulary entries."""

    def read(batches):
        reader = Reader(vocabulary.value)
        for batch in batches:
            lists: list[list[int]] = []
            bodies = batch.column("body").to_pylist()
            for start, stop in slices(bodies):
                doc, entry = reader.read(bodies[start:stop])
                lists += [x.tolist() for x in np.split(entry, np.searchsorted(doc, np.arange(1, stop - start)))]
            arrays = [batch.column("toxic"), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["toxic", "entries"])

    return read


@dataclass
class LabelModel:
    """P(vote | class) per voter, positive correlations between voters given the class, and the class share.

    Abstaining is no evidence by itself; where all voters abstain the class share is ``silent``.
    """

    if_toxic: np.ndarray
    if_clean: np.ndarray
    correlation: np.ndarray
    prior: float
    silent: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        share = 1 / np.maximum(1, self.correlation.sum(axis=1))
        base = np.where(votes.any(axis=1), self.prior, self.silent)
        odds = np.log(base / (1 - base)) + votes @ (np.log(self.if_toxic / self.if_clean) * share)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fit_label_model(votes: np.ndarray, label: np.ndarray, weight: np.ndarray, turns: int = 40) -> LabelModel:
    """Expectation maximisation over a 0/1 matrix of votes (0: the voter abstains).

    ``weight`` makes up for classes that are sampled unequally.
    """
    none = ~votes.any(axis=1)
    prior = float(np.clip(np.average(label, weights=weight), 1e-3, 0.9))
    silent = float(np.clip((weight[none & (label == 1)].sum() + 0.5) / (weight[none].sum() + 1), 1e-3, 0.9))
    toxic, clean = weight * (label == 1), weight * (label == 0)
    given_toxic = (toxic @ votes + 0.1) / (toxic.sum() + 0.2)
    given_clean = (clean @ votes + 0.1) / (clean.sum() + 0.2)
    model = LabelModel(given_toxic, given_clean, np.eye(votes.shape[1]), prior, silent)
    for _ in range(turns):
        belief = model.posterior(votes)
        high, low = belief * weight, (1 - belief) * weight
        left = votes - np.outer(belief, model.if_toxic) - np.outer(1 - belief, model.if_clean)
        cover = (left * weight[:, None]).T @ left
        size = np.sqrt(np.maximum(np.diag(cover), 1e-9))
        found = cover / np.outer(size, size)
        model.correlation = np.where(found >= 0.3, found, 0)
        np.fill_diagonal(model.correlation, 1)
        model.if_toxic = (high @ votes + TRUST * given_toxic) / (high.sum() + TRUST)
        model.if_clean = (low @ votes + TRUST * given_clean) / (low.sum() + TRUST)
    return model


def fit_classifier(doc, entry, n_docs: int, n_entries: int, target, weight, turns: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over 0/1 entries, by Adam with a small ridge."""
    beta, bias = np.zeros(n_entries), float(np.log(np.average(target, weights=weight) / (1 - np.average(target, weights=weight))))
    weight = weight / weight.sum()
    first, second = np.zeros(n_entries + 1), np.zeros(n_entries + 1)
    for turn in range(1, turns + 1):
        score = 1 / (1 + np.exp(-np.clip(bias + np.bincount(doc, beta[entry], n_docs), -60, 60)))
        error = (score - target) * weight
        slope = np.append(np.bincount(entry, error[doc], n_entries) + 1e-6 * beta, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        step = 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-10)
        beta, bias = beta - step[:-1], bias - float(step[-1])
    return beta, bias


@dataclass
class Model:
    vocabulary: dict[str, int]
    beta: np.ndarray
    bias: float

    def scores(self, reader: Reader, bodies: list[bytes]) -> np.ndarray:
        out = []
        for start, stop in slices(bodies):
            doc, entry = reader.read(bodies[start:stop])
            out.append(self.bias + np.bincount(doc, self.beta[entry], stop - start))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -60, 60))) if out else np.zeros(0)


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample of labelled rows that are not held out; None without both classes."""
    spark = scratch.spark
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    given = given.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    given = given.filter(~held_out(F.col("doc_id")))
    sizes = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    order = F.xxhash64("doc_id")
    chosen = [given.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(sample) for y in (0, 1)]
    chosen = scratch.table(chosen[0].unionByName(chosen[1]), "chosen")  # 2 * sample rows at most
    # Of several texts of one id the same one is taken in every run.
    found = texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
    bodies = found.agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("body"), "body")).alias("b")).select("doc_id", "toxic", "b.body")
    bodies = scratch.table(bodies.repartition("doc_id"), "sample")

    counts = bodies.mapInArrow(_count(None), "entry string, clean bigint, toxic bigint")
    counts = counts.groupBy("entry").agg(F.sum("toxic").alias("n")).filter(F.col("n") >= SUPPORT)
    listed = counts.orderBy(F.desc("n"), "entry").limit(20 * VOCABULARY).toArrow().to_pydict()
    in_toxic = dict(zip(listed["entry"], listed["n"], strict=True))
    held = spark.sparkContext.broadcast(in_toxic)
    rest = bodies.mapInArrow(_count(held), "entry string, clean bigint, toxic bigint").groupBy("entry").agg(F.sum("clean").alias("n"))
    rest = rest.toArrow().to_pydict()
    in_clean = dict(zip(rest["entry"], rest["n"], strict=True))
    n = {r["toxic"]: r["count"] for r in bodies.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return None

    def ratio(e: str) -> float:
        return ((in_toxic[e] + 0.3) / (n[1] + 1)) / ((in_clean.get(e, 0) + 0.3) / (n[0] + 1))

    strength = {e: np.log(ratio(e)) * np.sqrt(in_toxic[e]) for e in in_toxic if ratio(e) >= RATIO}
    ranked = sorted(strength, key=lambda e: (-strength[e], e))[:VOCABULARY]
    vocabulary = {e: i for i, e in enumerate(ranked)}

    # Voters: entries of one kind, strongest first. An entry whose word already votes is no new voter.
    # Where few reach VOTER_RATIO, the next by rank vote too, each alone, so the label model weighs each.
    voters: list[list[int]] = []
    for kind in (True, False):
        of_kind = [e for e in ranked if e.startswith("=") == kind]
        strong = [e for e in of_kind if ratio(e) >= VOTER_RATIO][: VOTERS // 2 * VOTER_ENTRIES]
        lone = (strong + [e for e in of_kind if ratio(e) < VOTER_RATIO])[: VOTERS // 4]
        voters += [[vocabulary[e]] for e in lone]
        others = strong[len(lone) :]
        step = max(1, -(-len(others) // (VOTERS // 4)))
        voters += [[vocabulary[e] for e in others[i : i + step]] for i in range(0, len(others), step)]

    # Which entries each document of the sample has: 2 * sample short rows at most.
    known = spark.sparkContext.broadcast(vocabulary)
    local = bodies.select("toxic", "body").mapInArrow(_entries_of(known), "toxic int, entries array<bigint>").toArrow()
    label = local.column("toxic").to_numpy()
    lists = local.column("entries").combine_chunks()
    doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    entry = lists.flatten().to_numpy().astype(np.int64)
    weight = np.where(label == 1, sizes[1] / n[1], sizes[0] / n[0])
    prior = sizes[1] / (sizes[0] + sizes[1])
    votes = np.zeros((len(label), len(voters)))
    has = np.zeros((len(label), max(1, len(ranked))), bool)
    has[doc, entry] = True
    for v, members in enumerate(voters):
        votes[:, v] = has[:, members].any(axis=1)
    target = fit_label_model(votes, label, weight).posterior(votes) if voters else np.full(len(label), prior)
    beta, bias = fit_classifier(doc, entry, len(label), max(1, len(ranked)), target, weight)
    return Model(vocabulary, beta, bias)


#: The worker's last model and its reader; the model is held, so no other one can be taken for it.
_READERS: list[tuple[Model, Reader]] = []


def reader(model: Model) -> Reader:
    if not _READERS or _READERS[0][0] is not model:
        _READERS[:] = [(model, Reader(model.vocabulary))]
    return _READERS[0][1]


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    read = texts(docs, id_col, text_col)
    if model is None:
        out = read.select("doc_id", F.lit(0.0).alias("score"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)  # VOCABULARY entries at most

        def score(batches):
            known = held.value
            for batch in batches:
                found = known.scores(reader(known), batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

        out = read.mapInArrow(score, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Fit and score all documents."""
    return scored(docs, train(docs, labels, scratch))


def without_toxic(docs: DataFrame, labels: DataFrame, scratch: Scratch, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, with all their columns."""
    model = train(docs, labels, scratch)
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches):
        known = held.value
        for batch in batches:
            bodies = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(known.scores(reader(known), bodies) < THRESHOLD, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
