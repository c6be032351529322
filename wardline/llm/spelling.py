"""Spelling variants by a bidirectional FM-index (operator 13).

Words are counted per input split in bounded tables and summed in a shuffle. Two words that differ by
one inserted, deleted or replaced code point agree in the first or in the second half of either of them, so
each half of a word is a key. A word stands under the halves that it would share with words one shorter, as
long, and one longer; it asks under its own halves. Keys are hashed to shards of a bounded number of words. A key with
more words than a shard may hold is dealt over several shards, and its questions go to each of them.

A shard is one task's index: the words between delimiters, as FM-index of the text and of its reverse, whose
suffix-rank intervals are kept in step, so that a pattern grows at either end. A question matches its half exactly, goes to the
delimiter at its end, and extends across the other half with one error: while no error has been made, every
next letter that the index holds there is tried as replacement and as insertion, and a letter of the word is left out.
What reaches the closing delimiter with its error made is a near word; its rank among the suffixes that
begin with the delimiter is its place in the sorted vocabulary. Only intervals that are not empty go on. A near word is reported
under the first half if it begins with it, otherwise under the second, so none is counted twice; per
question and shard one row leaves the task: how many near words, and the largest.

Null text: no words. Null ``doc_id``: the rule for deleted letters reads it as the empty text. Repeated rows count again. An
empty table gives no rows. Other columns are ignored. Words of any length are indexed whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, small
from wardline.llm.scan import lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH = 7
MIN_TIMES = 2
#: A form stands this many times as often as its variant, at least.
RATIO = 10
#: Every so many occurrences one letter is left out.
DROP_EVERY = 31

#: Words of a shard's index; its arrays take about 80 bytes per letter.
SHARD_WORDS = 50_000
#: Distinct words a task counts before it passes them on.
TABLE_WORDS = 400_000
#: Questions gathered, and letters (questions times the longest of them) searched at a time.
BATCH = 8192
BATCH_LETTERS = 1 << 16


def occurrences(doc_id, text: str) -> Counter:
    """Words of a text with letters left out by rule, and how often each stands there."""
    runs = Counter(RUN.findall(lower(text.encode("utf-8", "replace")).decode()))
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in runs.items():
        at = zlib.crc32(run.encode(), before)
        if at % DROP_EVERY == 0:
            at %= len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least ``MIN_LENGTH`` letters that stand ``MIN_TIMES`` times or more."""

    def count(batches):
        table: Counter = Counter()
        names = ["word", "n"]
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    table.update(occurrences(doc, text))
                if len(table) > TABLE_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], names)
                    table.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], names)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = read.mapInArrow(count, "word string, n bigint")
    return some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_TIMES)


class _Ranks:
    """Rank over a sequence of small symbols: how many equal, and how many smaller, before a place."""

    STEP = 32

    def __init__(self, symbols: np.ndarray, alphabet: int):
        n = len(symbols)
        blocks = n // self.STEP + 1
        padded = np.full(blocks * self.STEP, alphabet, np.uint8)
        padded[:n] = symbols
        self.rows = padded.reshape(blocks, self.STEP)
        counts = np.zeros((blocks + 1, alphabet + 1), np.int32)
        np.add.at(counts, (np.arange(n) // self.STEP + 1, symbols.astype(np.int64) + 1), 1)
        # below[b, c]: symbols smaller than c in the blocks before b
        self.below = np.cumsum(np.cumsum(counts, 0, dtype=np.int32), 1, dtype=np.int32)
        self.symbols = symbols
        self._places = np.arange(self.STEP, dtype=np.uint8)

    def at(self, symbol: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(equal, smaller) of each symbol before each place."""
        block = place // self.STEP
        rows, wanted = self.rows[block], symbol.astype(np.uint8)[:, None]
        before = self._places < (place % self.STEP).astype(np.uint8)[:, None]
        low = self.below[block, symbol]
        equal = ((rows == wanted) & before).view(np.uint8).sum(1, dtype=np.uint8)
        smaller = ((rows < wanted) & before).view(np.uint8).sum(1, dtype=np.uint8)
        return self.below[block, symbol + 1] - low + equal, low + smaller


class BidirectionalIndex:
    """Intervals of a pattern in the suffixes of the text and of its reverse, extended at either end.

    Words stand sorted, each with a delimiter on both sides; symbol 0 is the delimiter. States are three
    arrays: first row in the text's suffixes, first row in the reverse's, size.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        letters = sorted(set("".join(self.words)))
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.alphabet = len(letters) + 1
        encoded = [np.fromiter(map(self.code.__getitem__, w), np.uint8, len(w)) for w in self.words]
        # Reversed words sorted by themselves: a delimiter's rank in the reverse is of no use, so any order does.
        self._left = self._ranks(encoded)
        self._right = self._ranks([w[::-1] for w in encoded])
        text = self._text(encoded)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.alphabet))])
        self.size = len(text)

    @staticmethod
    def _text(encoded: list[np.ndarray]) -> np.ndarray:
        zero = np.zeros(1, np.uint8)
        return np.concatenate([zero] + [part for w in encoded for part in (w, zero)])

    def _ranks(self, encoded: list[np.ndarray]) -> _Ranks:
        text = self._text(encoded)
        order = _suffixes(text)
        return _Ranks(text[order - 1], self.alphabet)

    def all(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The empty pattern, n times."""
        zero = np.zeros(n, np.int64)
        return zero, zero.copy(), np.full(n, self.size, np.int64)

    def _step(self, ranks: _Ranks, lead, follow, size, symbol):
        equal, smaller = ranks.at(np.concatenate([symbol, symbol]), np.concatenate([lead, lead + size]))
        n = len(symbol)
        return self.first[symbol] + equal[:n], follow + smaller[n:] - smaller[:n], (equal[n:] - equal[:n]).astype(np.int64)

    def left(self, state, symbol):
        """The patterns with a symbol before them."""
        rows, reverse, size = state
        rows, reverse, size = self._step(self._left, rows, reverse, size, symbol)
        return rows, reverse, size

    def right(self, state, symbol):
        """The patterns with a symbol behind them."""
        rows, reverse, size = state
        reverse, rows, size = self._step(self._right, reverse, rows, size, symbol)
        return rows, reverse, size

    def next_symbols(self, state, to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state number, symbol) of all letters that stand beside each pattern."""
        rows, reverse, size = state
        lead, ranks = (reverse, self._right) if to_right else (rows, self._left)
        few = np.flatnonzero(size <= 4 * self.alphabet)
        many = np.flatnonzero(size > 4 * self.alphabet)
        total = int(size[few].sum())
        owner = np.repeat(few, size[few])
        place = np.arange(total) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + np.repeat(lead[few], size[few])
        pairs = np.unique(owner * self.alphabet + ranks.symbols[place])
        if len(many):  # every symbol is tried; those that are not there give empty intervals
            tried = (many[:, None] * self.alphabet + np.arange(1, self.alphabet)).ravel()
            pairs = np.concatenate([pairs, tried])
        owner, symbol = pairs // self.alphabet, pairs % self.alphabet
        letter = symbol > 0
        return owner[letter], symbol[letter]

    def near(self, words: list[str], by_first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(question, place of the near word in ``words`` of the index), each once.

        ``by_first``: the first half is exact and the rest may err; else the second half is exact, and near
        words that begin with the first half are left out.
        """
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        half = length // 2
        wide = int(length.max())
        # Symbols in the order in which the pattern grows; a letter that the index lacks is -1.
        letters = np.full((n, wide), -1, np.int64)
        for i, w in enumerate(words):
            found = [self.code.get(c, -1) for c in w]
            letters[i, : len(found)] = found if by_first else found[::-1]
        exact = half if by_first else length - half
        step = self.right if by_first else self.left
        back = self.left if by_first else self.right
        state, alive = self.all(n), np.arange(n)
        for j in range(int(exact.max())):
            due = exact[alive] > j
            symbol = letters[alive, j]
            keep = ~due | (symbol >= 0)
            state, alive, due, symbol = tuple(x[keep] for x in state), alive[keep], due[keep], symbol[keep]
            moved = step(tuple(x[due] for x in state), symbol[due])
            for old, new in zip(state, moved, strict=True):
                old[due] = new
            keep = state[2] > 0
            state, alive = tuple(x[keep] for x in state), alive[keep]
        state = back(state, np.zeros(len(alive), np.int64))
        keep = state[2] > 0
        clean, asked = tuple(x[keep] for x in state), alive[keep]
        at = exact[asked]
        # States without an error walk the rest of the word; those with one are carried beside them.
        zero = np.zeros(0, np.int64)
        erred, who, place = (zero, zero, zero), zero, zero
        found = []
        while len(asked) or len(who):
            new = []
            if len(asked):
                more = at < length[asked]
                owner, symbol = self.next_symbols(clean, by_first)
                to = step(tuple(x[owner] for x in clean), symbol)
                new.append((to, asked[owner], at[owner]))  # inserted
                own = letters[asked[owner], np.minimum(at[owner], wide - 1)]
                other = more[owner] & (own != symbol)
                new.append((tuple(x[other] for x in to), asked[owner][other], at[owner][other] + 1))  # replaced
                new.append((tuple(x[more] for x in clean), asked[more], at[more] + 1))  # left out
            if len(who):
                done = place == length[who]
                end = step(tuple(x[done] for x in erred), np.zeros(int(done.sum()), np.int64))
                hit = end[2] > 0
                found.append((who[done][hit], end[0][hit]))
                symbol = letters[who, np.minimum(place, wide - 1)]
                go = ~done & (symbol >= 0)
                new.append((step(tuple(x[go] for x in erred), symbol[go]), who[go], place[go] + 1))
            if len(asked):
                symbol = letters[asked, np.minimum(at, wide - 1)]
                go = more & (symbol >= 0)
                clean, asked, at = step(tuple(x[go] for x in clean), symbol[go]), asked[go], at[go] + 1
                keep = clean[2] > 0
                clean, asked, at = tuple(x[keep] for x in clean), asked[keep], at[keep]
            if new:
                erred = tuple(np.concatenate([s[k] for s, _, _ in new]) for k in range(3))
                who, place = np.concatenate([w for _, w, _ in new]), np.concatenate([p for _, _, p in new])
                keep = erred[2] > 0
                erred, who, place = tuple(x[keep] for x in erred), who[keep], place[keep]
                # The same pattern may be reached by several edits; its first rows tell it from longer ones.
                once = _distinct(who * (wide + 1) + place, erred[0] * (self.size + 1) + erred[1])
                erred, who, place = tuple(x[once] for x in erred), who[once], place[once]
            else:
                break
        if not found:
            return zero, zero
        # Row r of the suffixes that begin with the delimiter: row 0 is the last delimiter, row r + 1 the r-th word.
        pairs = np.unique(np.concatenate([w for w, _ in found]) * (self.size + 1) + np.concatenate([r for _, r in found]))
        question, word = pairs // (self.size + 1), pairs % (self.size + 1) - 1
        if not by_first:
            keep = [not self.words[w].startswith(words[q][: half[q]]) for q, w in zip(question.tolist(), word.tolist(), strict=True)]
            question, word = question[keep], word[keep]
        itself = np.array([self.words[w] == words[q] for q, w in zip(question.tolist(), word.tolist(), strict=True)], bool)
        return question[~itself], word[~itself]


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where each pair of the two arrays stands first."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    return order[np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))]


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Suffixes in order: sorted by their first eight symbols, then by twice as many each time."""
    n, step = len(text), 8
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(step, np.uint64)])  # the end is less than all
    key = np.zeros(n, np.uint64)
    for j in range(step):
        key = (key << np.uint64(8)) | padded[j : j + n]
    while True:
        order = np.argsort(key)
        new = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        step *= 2


def _half_key(first: bool, word: Column, size: Column) -> Column:
    """A half of ``size`` letters at the word's beginning or end, with its side."""
    half = F.substring(word, F.lit(1), size) if first else F.substring(word, F.length(word) - size + 1, size)
    return F.struct(F.lit(first).alias("first"), half.alias("half"))


def _entries(words: DataFrame) -> DataFrame:
    """``first, half, word, n``: words under the halves of the words they can be near to, and their own."""
    size = F.length("word")
    keys = []
    for other in (size - 1, size, size + 1):
        left = F.floor(other / 2).cast("int")
        keys += [_half_key(True, F.col("word"), left), _half_key(False, F.col("word"), (other - left).cast("int"))]
    return words.select("word", "n", F.explode(F.array_distinct(F.array(*keys))).alias("k")).select("k.first", "k.half", "word", "n")


def _questions(words: DataFrame) -> DataFrame:
    left = F.floor(F.length("word") / 2).cast("int")
    keys = F.array(_half_key(True, F.col("word"), left), _half_key(False, F.col("word"), (F.length("word") - left).cast("int")))
    return words.select("word", F.explode(keys).alias("k")).select("k.first", "k.half", "word")


def _search(batches):
    """Rows ``shard, kind, first, word, n`` sorted by shard and kind -> ``word, n_near, best_n, best``."""
    shard, held, index, waiting = None, {}, {}, {True: [], False: []}

    def answers(first: bool):
        asked = sorted(waiting[first], key=len)
        waiting[first] = []
        if asked and held[first]:
            if first not in index:
                index[first] = BidirectionalIndex(list(held[first]))
            start = 0
            for stop in range(1, len(asked) + 1):
                if stop == len(asked) or (stop + 1 - start) * len(asked[stop]) > BATCH_LETTERS:
                    yield from answer(first, asked[start:stop])
                    start = stop

    def answer(first: bool, asked: list[str]):
        question, word = index[first].near(asked, first)
        if not len(question):
            return
        times = np.array([held[first][index[first].words[w]] for w in word.tolist()], np.int64)
        # Largest first, then in code-point order, which is that of the index.
        order = np.lexsort((word, -times, question))
        question, word, times = question[order], word[order], times[order]
        begin = np.flatnonzero(np.concatenate([[True], question[1:] != question[:-1]]))
        counts = np.diff(np.concatenate([begin, [len(question)]]))
        arrays = [[asked[q] for q in question[begin].tolist()], counts, times[begin], [index[first].words[w] for w in word[begin].tolist()]]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types, strict=True)], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        for at, first, word, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if at != shard:
                yield from chain(answers(True), answers(False))
                shard, held, index = at, {True: {}, False: {}}, {}
            if n is not None:
                held[first][word] = n
                continue
            waiting[first].append(word)
            if len(waiting[first]) == BATCH:
                yield from answers(first)
    yield from chain(answers(True), answers(False))


def near_words(words: DataFrame, scratch: Scratch, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have near ones; the form is the most frequent of them."""
    entries, questions = _entries(words), _questions(words)
    by_key = entries.groupBy("first", "half").agg(F.count("*").alias("size"))
    large = scratch.table(by_key.filter(F.col("size") > shard_words).withColumn("pieces", F.ceil(F.col("size") / shard_words)), "large")
    large = small(large, large.count())
    shards = max(1, -(-4 * words.count() // shard_words))  # a word stands under four halves at most, on either side two
    on = ["first", "half"]
    # A large key's pieces are shards of their own, so a word that stands there under another key is not found twice.
    own = F.lit(shards) + F.pmod(F.xxhash64("first", "half", "piece"), F.lit(1 << 62))
    shard = F.when(F.col("pieces").isNotNull(), own).otherwise(F.pmod(F.xxhash64("first", "half"), F.lit(shards)))
    placed = entries.join(large, on, "left").withColumn("piece", F.pmod(F.xxhash64("word"), F.col("pieces")))
    asked = questions.join(large, on, "left").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1)))
    both = placed.select(shard.alias("shard"), "first", "word", "n").unionByName(
        asked.select(shard.alias("shard"), "first", "word", F.lit(None).cast("long").alias("n"))
    )
    # Only as many partitions as the session shuffles into: a task builds one shard's index after another.
    dealt = both.repartition("shard").sortWithinPartitions("shard", F.col("n").isNull())
    found = dealt.mapInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    largest = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    each = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), largest.alias("b"))
    return each.select("word", "n_near", F.col("b.best").alias("form"), (-F.col("b.less")).alias("form_n"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` for words with a form; each turn doubles the steps, and forms grow tenfold per step."""
    up, turn = forms.select("word", F.col("form").alias("root")), 0
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        jumped = up.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved"))
        table = scratch.table(jumped, f"roots{turn}")
        up, turn = table.select("word", "root"), turn + 1
        if table.filter("moved").isEmpty():
            return up


def variants(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: the words with their near words and the forms they vary."""
    words = scratch.table(vocabulary(docs, id_col, text_col), "words")
    near = near_words(words, scratch, shard_words)
    varies = F.col("form_n") >= ratio * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        F.when(varies, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(varies, F.col("form_n")).alias("form_n"),
    )
    known = scratch.table(known, "forms")
    roots = _roots(known.filter(F.col("form").isNotNull()), scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
