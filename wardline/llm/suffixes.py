"""Repeated byte strings, found exactly with two-stage suffix sorting (operator 9).

A string of ``LENGTH`` bytes that starts twice anywhere has the same least ``GRAM``-byte gram in both
places (its anchor: the gram with the smallest hash, the leftmost of equal ones). So each run of
starts that share an anchor becomes a segment, the bytes those strings cover, filed under the
anchor's hash, and equal strings always meet under one hash.

1. One pass finds the anchors; those that occur once in the corpus are dropped.
2. Documents that have others are cut into segments. Equal segments of a task leave once, with a count.
3. Segments under one hash that are not all equal are sorted by their suffixes, as far as a string of
   ``LENGTH`` bytes starts there and another segment has the same bytes around the anchor (equal strings have it at the
   same distance from their start): those smaller than their successors (type B) directly, all others
   induced from them by scanning the buckets of first bytes; the common prefixes of neighbours then tell which starts are repeated. A segment that
   itself occurs twice is repeated at every start.
4. The marked ranges go back to the documents and are cut out there.

The same with words in place of bytes (``WORD_UNITS``): a text is its sequence of words, whatever stands between them, and
what lies in a repeated run of ``length`` words is cut, from its first word to its last. A word is a run of
letters and digits, joined by hyphens and apostrophes; a character of a script without blanks is one too. Words are
told apart by 64-bit hashes, and are numbered anew in each sort, so that a suffix begins at a word.

A hash with more than ``GROUP_BYTES`` of unlike segments (a passage at whose edges very many documents
differ) is not gathered: its strings are compared by 64-bit fingerprints in a counted group-by, which
Spark combines before the shuffle. Both ways mark the same starts.

Null text: empty, nothing removed. Texts under ``LENGTH`` bytes lose nothing. Repeated rows are copies
of each other and lose what they share, so both lose all of ``LENGTH`` bytes and more. Null ``doc_id``
is an id like any other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, small
from wardline.llm.scan import join, mix, slices, stream

LENGTH = 400
GRAM = 64

#: Words of a passage, and of the grams that anchor it.
PASSAGE_WORDS = 51
PASSAGE_GRAM = 16

#: Bytes sorted at a time, and from how many one hash goes by fingerprints.
SORT_BYTES = 1 << 19
GROUP_BYTES = 2 << 20

#: Ranges of distances between a string's start and its anchor.
PARTS = 2

#: Texts are scanned in slices of fewer positions than the anchors' place bits can number.
_PLACE_BITS = 20
_SLICE = 1 << 19

#: Short texts are scanned end to end, so many bytes at a time.
_TOGETHER = 1 << 15

_U = np.uint64
_BYTE = stream(41, 256)
_BASE = int(stream(42, 1)[0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * _U(step)
        done, step = done + more, step * step % (1 << 64)
    return out


_UP = _powers(_BASE, _SLICE + (1 << 18))
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _SLICE + (1 << 18))


def _scale(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if n > len(_UP):
        return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    return _UP[:n], _DOWN[:n]


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """The hash of each string of ``size`` values, by prefix sums modulo 2**64."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * _UP[: len(values)], dtype=_U)])
        return mix((sums[size:] - sums[:n]) * _DOWN[:n])


class ByteUnits:
    """A text as its bytes."""

    width = 1

    def values(self, body: bytes) -> np.ndarray:
        return _BYTE.take(np.frombuffer(body, np.uint8))

    def joined(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The values of texts end to end, and where each begins; the last entry is the end."""
        return self.values(b"".join(bodies)), np.cumsum([0, *map(len, bodies)])

    def sequences(self, bodies: list[bytes]) -> list[bytes]:
        return bodies

    def sortable(self, segments: list[bytes]) -> tuple[list[bytes], int]:
        """Segments as byte strings to sort, and the bytes of one unit in them."""
        return segments, 1

    def stored(self, segment: bytes) -> np.ndarray:
        """The values of a sequence."""
        return self.values(segment)

    def ranges(self, bodies: list[bytes], runs: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        """Ranges of units as ranges of bytes, for each text."""
        return runs


class WordUnits:
    """A text as the 64-bit hashes of its words."""

    width = 8

    def words(self, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end byte of each word, and its hash."""
        first, end, hashes, _, at = self.joined_words([body])
        return first - at[0], end - at[0], hashes

    def joined_words(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and end byte of each word in the joined texts, its hash; of each text, the words and the bytes before it."""
        buffer, at = join(bodies)
        points = data = np.frombuffer(buffer, np.uint8)
        plain = buffer.isascii()
        if not plain:
            try:
                points = np.frombuffer(buffer.decode("utf-8").encode("utf-32-le"), np.uint32)
            except UnicodeDecodeError:
                return self.joined_words([body.decode("utf-8", "replace").encode("utf-8") for body in bodies])
        kind = _kinds().take(points)
        letter = kind == _LETTER
        # A hyphen or apostrophe between two letters belongs to the word.
        joins = np.flatnonzero(kind == _JOINER)
        letter[joins[(kind[joins - 1] == _LETTER) & (kind[joins + 1] == _LETTER)]] = True
        opens, closes = letter[1:] > letter[:-1], letter[1:] < letter[:-1]
        if not plain:  # no script without blanks is ASCII
            single = kind == _SINGLE
            opens, closes = opens | single[1:], closes | single[:-1]
        first, end = np.flatnonzero(opens) + 1, np.flatnonzero(closes) + 1
        if not plain:  # bytes that begin a code point
            places = np.flatnonzero((data & 0xC0) != 0x80)
            first, end = places[first], places[end]
        up, down = _scale(len(data))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, _U)
            np.cumsum(_BYTE.take(data) * up, out=sums[1:])
            hashes = mix((sums[end] - sums[first]) * down[first] + (end - first).astype(_U))
        return first, end, hashes, np.searchsorted(first, at), at

    def values(self, body: bytes) -> np.ndarray:
        return self.words(body)[2]

    def joined(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.joined_words(bodies)[2:4]

    def sequences(self, bodies: list[bytes]) -> list[bytes]:
        out = []
        for x, y in slices(bodies, _TOGETHER):
            values, bounds = self.joined(bodies[x:y])
            raw, cuts = values.astype("<u8").tobytes(), (bounds * 8).tolist()
            out += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def sortable(self, segments: list[bytes]) -> tuple[list[bytes], int]:
        sizes = [len(x) // 8 for x in segments]
        known, number = np.unique(np.frombuffer(b"".join(segments), "<u8"), return_inverse=True)
        wide = 2 if len(known) < 1 << 16 else 4
        raw = number.astype(f">u{wide}").tobytes()
        cuts = np.cumsum([0, *sizes]) * wide
        return [raw[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], wide

    def stored(self, segment: bytes) -> np.ndarray:
        return np.frombuffer(segment, "<u8")

    def ranges(self, bodies: list[bytes], runs: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
        out: list[list[tuple[int, int]]] = [[] for _ in bodies]
        some = [i for i, found in enumerate(runs) if found]
        for x, y in slices([bodies[i] for i in some], _TOGETHER):
            first, end, _, before, at = self.joined_words([bodies[i] for i in some[x:y]])
            for i, words, start in zip(some[x:y], before.tolist(), at.tolist(), strict=False):
                out[i] = [(int(first[words + a]) - start, int(end[words + b - 1]) - start) for a, b in _merged(runs[i])]
        return out


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges (from, to) without those that overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


BYTE_UNITS, WORD_UNITS = ByteUnits(), WordUnits()

_LETTER, _JOINER, _SINGLE = 1, 2, 3
#: Blocks of scripts without blanks, first and last code point: Thai and Lao, Burmese, Khmer, kana, Chinese characters.
_UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """What each code point is for words; made once per worker."""
    if not _KINDS:
        kinds = np.zeros(0x110000, np.uint8)
        kinds[[c for c in range(0x110000) if chr(c).isalnum() or unicodedata.combining(chr(c))]] = _LETTER
        kinds[[ord("-"), ord("'"), 0x2019]] = _JOINER
        for low, high in _UNSPACED:
            block = kinds[low : high + 1]
            block[block == _LETTER] = _SINGLE
        _KINDS.append(kinds)
    return _KINDS[0]


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` hashes in a row, the leftmost of equal ones."""
    low = _U((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=_U)
    size = 1
    while size < width:  # the least of ``size`` in a row, twice as many each time
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return (least & low).astype(np.int64)


def _anchor_runs(values: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """``key, first, last`` of the runs of ``starts`` that have one anchor."""
    hashes = window_hashes(values, gram)
    places = _least_places(hashes, length - gram + 1)[starts]
    change = np.flatnonzero(places[1:] != places[:-1])
    first = np.concatenate([[0], change + 1])
    return hashes[places[first]].view(np.int64), starts[first], starts[np.append(change, len(starts) - 1)]


def anchors(values: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``key, first, last`` arrays: the anchor's hash and the run of starts that have it."""
    found: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(values) - length + 1, _SLICE):
        some = values[at : at + _SLICE + length - 1]
        key, first, last = _anchor_runs(some, np.arange(len(some) - length + 1), length, gram)
        for out, part in zip(found, (key, first + at, last + at), strict=True):
            out.append(part)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def joined_anchors(values: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``text, key, first, last`` of texts that lie end to end; a string of ``length`` lies in one text."""
    if len(bounds) == 2:
        found = anchors(values, length, gram)
        return np.zeros(len(found[0]), np.int64), *found
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    total = int(sizes.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 4
    # Starts of two texts never share an anchor's place, so their runs part by themselves.
    starts = np.arange(total) + np.repeat(bounds[:-1] - (np.cumsum(sizes) - sizes), sizes)
    key, first, last = _anchor_runs(values, starts, length, gram)
    text = np.searchsorted(bounds, first, side="right") - 1
    return text, key, first - bounds[text], last - bounds[text]


def suffix_order(data: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """All places of ``data`` by what follows them, at least ``depth`` bytes deep: two-stage sorting.

    Type B suffixes are smaller than their successors, type A the others. Within the bucket of a first
    byte all of type A come before all of type B.

    With ``wanted``, a true value per place, only these are sorted, and those that they are induced from: the places that
    follow a type A place, up to the first of type B.
    """
    n = len(data)
    change = np.flatnonzero(np.append(data[1:] != data[:-1], True))  # a run's last place
    rises = np.append(data[change[:-1] + 1] > data[change[:-1]], True)  # the end counts as type B
    type_b = np.repeat(rises, np.diff(np.concatenate([[-1], change])))
    needed = np.ones(n, bool)
    if wanted is not None:
        places, all_b = np.flatnonzero(wanted), np.flatnonzero(type_b)
        reach = all_b[np.searchsorted(all_b, places)]
        needed = np.cumsum(np.bincount(places, minlength=n + 1) - np.bincount(reach + 1, minlength=n + 1))[:n] > 0
    induced = needed & ~type_b
    buffer = data.tobytes()
    sorted_b = np.array(sorted(np.flatnonzero(type_b & needed).tolist(), key=lambda p: buffer[p : p + depth]), np.int64)

    b_of = np.searchsorted(data[sorted_b], np.arange(257))  # sorted by first byte already
    a_parts: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Hand the type A predecessors of a scanned stretch to their buckets; those of this bucket are returned."""
        before = scanned[scanned > 0] - 1
        before = before[induced[before]]
        first = data[before]
        own = before[first == byte]
        rest, first = before[first != byte], first[first != byte]
        if len(rest):
            by = np.argsort(first, kind="stable")
            rest, first = rest[by], first[by]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for part, c in zip(np.split(rest, cuts), first[np.concatenate([[0], cuts])].tolist(), strict=True):
                a_parts[c].append(part)
        return own

    for byte in range(256):
        stretch = np.concatenate(a_parts[byte]) if a_parts[byte] else np.zeros(0, np.int64)
        while len(stretch):
            order.append(stretch)
            stretch = induce(stretch, byte)
        b_part = sorted_b[b_of[byte] : b_of[byte + 1]]
        if len(b_part):
            order.append(b_part)
            induce(b_part, byte)
    return np.concatenate(order) if n else np.zeros(0, np.int64)


def common_prefixes(data: np.ndarray, places: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Of each two neighbours in ``places``, the common prefix in whole steps of 8 bytes, ``limit`` at most.

    Every place must have ``limit`` bytes; a step that reaches beyond is not counted.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data), "<u8", padded, strides=(1,)).astype(_U)  # the 8 bytes from each place
    out = np.full(max(0, len(places) - 1), limit, np.int64)
    left, here, there = np.arange(len(out)), places[:-1], places[1:]
    for step in range(0, limit, 8):
        if step + 8 > limit:  # the last bytes of a length that is no multiple of 8
            shift = _U(8 * (step + 8 - limit))
            equal = (words[here] << shift) == (words[there] << shift)
        else:
            equal = words[here] == words[there]
        if not equal.all():
            out[left[~equal]] = step
            left, here, there = left[equal], here[equal], there[equal]
        here, there = here + 8, there + 8
    return out


def _anchor_places(segments: list[bytes], keys: list[int], length: int, gram: int, unit) -> list[int]:
    """Where the anchor lies in each segment: the first of the grams in all its strings that have the key as hash."""
    cores = [x[len(x) - length * unit.width : length * unit.width] for x in segments]
    out = []
    for x, y in slices(cores, _TOGETHER * unit.width):
        sizes = np.fromiter(map(len, cores[x:y]), np.int64) // unit.width
        at = np.cumsum(sizes) - sizes
        hashes = window_hashes(unit.stored(b"".join(cores[x:y])), gram).view(np.int64)
        met = np.flatnonzero(hashes == np.repeat(np.array(keys[x:y], np.int64), sizes)[: len(hashes)])
        before = np.array([len(s) // unit.width for s in segments[x:y]]) - length
        out += (met[np.searchsorted(met, at)] - at + before).tolist()
    return out


def shared_starts(segments: list[bytes], keys: list[int], length: int, gram: int, unit) -> list[list[tuple[int, int]]]:
    """For each distinct segment, the runs of starts whose string another one under its key may have too.

    Equal strings have their anchor at the same distance from the start. Distances are taken in ``PARTS`` ranges; all strings
    of a range have the units around the anchor in common that the nearest and the farthest of them both reach.
    """
    wide = -(-(length - gram + 1) // PARTS)
    asked, met = [], Counter()
    for i, (segment, key, place) in enumerate(zip(segments, keys, _anchor_places(segments, keys, length, gram, unit), strict=True)):
        last = len(segment) // unit.width - length
        for part in range((place - last) // wide, place // wide + 1):
            near = place - part * wide
            far = near - wide + 1
            name = key, part, segment[near * unit.width : (far + length) * unit.width]
            met[name] += 1
            asked.append((i, max(far, 0), min(near, last), name))
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for i, first, last, name in asked:
        if met[name] > 1:
            out[i].append((first, last))
    return out


def repeated_starts(segments: list[bytes], keys: list[int], counts: list[int], length: int = LENGTH, gram: int = GRAM, unit=BYTE_UNITS) -> list[list[tuple[int, int]]]:
    """For each distinct segment, the runs of starts whose string also starts elsewhere under its key."""
    out: list[list[tuple[int, int]]] = [[(0, len(x) // unit.width - length)] if n > 1 else [] for x, n in zip(segments, counts, strict=True)]
    shared = shared_starts(segments, keys, length, gram, unit)
    some = [i for i, runs in enumerate(shared) if runs]
    if not some:
        return out
    sorted_segments, wide = unit.sortable([segments[i] for i in some])
    depth = length * wide
    sizes = [len(s) for s in sorted_segments]
    firsts = np.cumsum([0, *(size + 1 for size in sizes)])
    data = np.frombuffer(b"\0".join(sorted_segments) + b"\0", np.uint8)
    valid = np.zeros(len(data), bool)
    for i, at in zip(some, firsts.tolist(), strict=False):
        for a, b in shared[i]:
            valid[at + a * wide : at + b * wide + 1 : wide] = True
    order = suffix_order(data, depth, valid)
    order = order[valid[order]]
    equal = common_prefixes(data, order, depth) >= depth
    marked = np.zeros(len(data), bool)
    marked[order[:-1][equal]] = True
    marked[order[1:][equal]] = True
    # The starts of all segments in a row, and an unmarked place before and after each segment's.
    starts = (np.array(sizes, np.int64) - depth) // wide + 1
    segment = np.repeat(np.arange(len(sizes)), starts)
    before = np.cumsum(starts + 1) - starts
    number = np.arange(len(segment)) + segment + 1
    row = np.zeros(len(segment) + len(sizes) + 1, np.int8)
    row[number] = marked[firsts[segment] + (number - before[segment]) * wide]
    change = np.diff(row)
    opens, closes = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1)
    of = np.searchsorted(before, opens, side="right") - 1
    for k, a, b in zip(of.tolist(), (opens - before[of]).tolist(), (closes - before[of]).tolist(), strict=True):
        if counts[some[k]] == 1:
            out[some[k]].append((a, b))
    return out


def _anchor_rows(length: int, gram: int, unit):
    def rows(batches):
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
            bodies = batch.column(2).to_pylist()
            for x, y in slices(bodies, _TOGETHER):
                text, *found = joined_anchors(*unit.joined(bodies[x:y]), length, gram)
                for out, values in zip(columns, (text + x, *found), strict=True):
                    out.append(values)
            row, *rest = (pa.array(np.concatenate(c), pa.int64()) for c in columns)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), *rest], ["doc_id", "mark", "key", "first", "last"])

    return rows


def _listed(column: pa.ListArray) -> tuple[list[int], list[pa.Array]]:
    """The length of each list of structs (null: 0), and the fields of all of them, end to end."""
    return column.value_lengths().fill_null(0).to_pylist(), column.flatten().flatten()


def _pairs(column: pa.ListArray):
    """Each list of two numbers as pairs."""
    sizes, fields = _listed(column)
    pairs = zip(*(x.to_pylist() for x in fields), strict=True)
    return [list(islice(pairs, n)) for n in sizes]


_SEGMENT = pa.schema(
    [("key", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("body", pa.binary()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("first", pa.int64())]
)
_SEGMENT_DDL = "key bigint, digest bigint, n bigint, size bigint, body binary, doc_id bigint, mark bigint, first bigint"


def _segment_rows(length: int, unit):
    """Documents with their anchors -> where each segment lies (no ``n``, no ``body``), and each task's distinct segments."""

    def rows(batches):
        counts: dict[tuple[int, int], int] = {}
        bodies: dict[tuple[int, int], bytes] = {}
        held = 0

        def table(n_rows, **columns):
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n_rows, f.type)) for f in _SEGMENT], schema=_SEGMENT)

        def distinct():
            listed = list(counts)
            for at in range(0, len(listed), 2000):
                some = listed[at : at + 2000]
                keys, digests = (pa.array(x, pa.int64()) for x in zip(*some, strict=True))
                whole = [bodies[s] for s in some]
                n, size = pa.array([counts[s] for s in some], pa.int64()), pa.array([len(b) for b in whole], pa.int64())
                yield table(len(some), key=keys, digest=digests, n=n, size=size, body=pa.array(whole, pa.binary()))

        for batch in batches:
            sizes, (keys, firsts, lasts) = _listed(batch.column(3))
            places = zip(keys.to_pylist(), firsts.to_pylist(), lasts.to_pylist(), strict=True)
            digests = []
            for whole, n_found in zip(unit.sequences(batch.column(2).to_pylist()), sizes, strict=True):
                for key, first, last in islice(places, n_found):
                    segment = whole[first * unit.width : (last + length) * unit.width]
                    digest = int.from_bytes(hashlib.blake2b(segment, digest_size=8).digest(), "little", signed=True)
                    name = key, digest
                    if name not in counts:
                        counts[name], bodies[name] = 0, segment
                        held += len(segment)
                    counts[name] += 1
                    digests.append(digest)
            if digests:
                row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield table(len(digests), key=keys, digest=pa.array(digests, pa.int64()), doc_id=batch.column(0).take(row), mark=batch.column(1).take(row), first=firsts)
            if held > 64 << 20:
                yield from distinct()
                counts.clear(), bodies.clear()
                held = 0
        yield from distinct()

    return rows


_MARK = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _sorted_groups(length: int, gram: int, unit):
    """Rows ``key, digest, n, body`` in order of key and digest -> repeated runs of starts per segment."""

    def rows(batches):
        group: list[list] = []  # key, digest, n, body; one key
        waiting: list[list] = []  # groups to be sorted together
        size = 0
        out: list[tuple[int, int, int, int]] = []

        def listed():
            columns = zip(*out, strict=True) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_MARK)

        def settle():
            nonlocal size
            if waiting:
                keys, _, counts, bodies = map(list, zip(*waiting, strict=True))
                for (key, digest, *_), runs in zip(waiting, repeated_starts(bodies, keys, counts, length, gram, unit), strict=True):
                    out.extend((key, digest, a, b) for a, b in runs)
                waiting.clear()
            size = 0

        def close():
            nonlocal size
            if len(group) == 1:
                key, digest, n, body = group[0]
                if n > 1:
                    out.append((key, digest, 0, len(body) // unit.width - length))
            else:
                waiting.extend(group)
                size += sum(len(g[3]) for g in group)
            group.clear()

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if group and group[-1][0] != row[0]:
                    close()
                    if size > SORT_BYTES:
                        settle()
                if group and group[-1][1] == row[1]:
                    group[-1][2] += row[2]
                else:
                    group.append(list(row))
            if out:
                yield listed()
                out.clear()
        if group:
            close()
        settle()
        yield listed()

    return rows


def _fingerprints(length: int, unit):
    """Segments -> a 64-bit fingerprint per start."""

    def rows(batches):
        for batch in batches:
            for key, digest, n, body in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                prints = window_hashes(unit.stored(body), length).view(np.int64)
                full = [np.full(len(prints), x) for x in (key, digest, n)]
                arrays = [pa.array(x) for x in (*full, np.arange(len(prints)), prints)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "digest", "n", "a", "print"])

    return rows


def remove(body: bytes, runs: list[tuple[int, int]], align: bool) -> tuple[bytes, int, int]:
    """What is left without the byte ranges, the bytes they cover and the stretches they form.

    With ``align`` a character that a range cuts goes as a whole (the counts are of the ranges).
    """
    kept, at, removed, spans, reach = [], 0, 0, 0, -1
    for a, b in sorted(runs):
        if a > reach:
            spans += 1
            reach = a
        removed += max(0, b - reach)
        reach = max(reach, b)
        if align:
            while a < len(body) and a > at and body[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(body) and body[b] & 0xC0 == 0x80:
                b += 1
        if a > at:
            kept.append(body[at:a])
        at = max(at, b)
    kept.append(body[at:])
    return b"".join(kept), removed, spans


def _cut(align: bool, unit):
    """Documents with repeated runs of starts -> their digest rows and what is kept; further columns pass.

    Runs of words in a column ``passages`` are counted, not cut.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    counts = ["n_passages", "n_passage_bytes"]

    def cut(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names]
            bodies = batch.column(1).to_pylist()
            for doc, body, ranges in zip(batch.column(0).to_pylist(), bodies, unit.ranges(bodies, _pairs(batch.column(2))), strict=True):
                kept, removed, spans = remove(body, ranges, align)
                for values, value in zip(out, (doc, len(body), removed, spans, kept), strict=True):
                    values.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            rest = dict(zip(batch.schema.names[3:], batch.columns[3:], strict=True))
            if "passages" in rest:
                found = [(len(r), sum(b - a for a, b in r)) for r in WORD_UNITS.ranges(bodies, _pairs(rest.pop("passages")))]
                rest |= {name: pa.array([f[k] for f in found], pa.int64()) for k, name in enumerate(counts)}
            yield pa.RecordBatch.from_arrays([*arrays, *rest.values()], [*names, *rest])

    return cut


def _same_doc():
    return F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))


def _repeated_runs(read: DataFrame, scratch: Scratch, length: int, gram: int, group_bytes: int, unit, prefix: str = "") -> DataFrame:
    """``doc_id, mark, body`` -> ``d, m, r``: a document's id and mark, and units of it (from, to) that repeated strings cover."""
    long = read.filter(F.octet_length("body") >= length)  # a word has a byte or more
    found = long.select("doc_id", "mark", "body").mapInArrow(_anchor_rows(length, gram, unit), "doc_id bigint, mark bigint, key bigint, first bigint, last bigint")
    found = scratch.table(found, f"{prefix}anchors")
    repeated = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    of_docs = (
        found.join(repeated, "key", "left_semi")
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("key", "first", "last")).alias("found"))
    )
    named = of_docs.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "found")
    cut = long.join(named, _same_doc()).select("doc_id", "mark", "body", "found")
    segments = scratch.table(cut.mapInArrow(_segment_rows(length, unit), _SEGMENT_DDL), f"{prefix}segments")
    scratch.drop(f"{prefix}anchors")
    bodies = segments.filter("n is not null").select("key", "digest", "n", "body")
    places = segments.filter("n is null").select("key", "digest", "doc_id", "mark", "first")

    large = segments.filter("n is not null").groupBy("key").agg(F.sum("size").alias("size")).filter(F.col("size") > group_bytes)
    large = scratch.table(large.select("key"), f"{prefix}large")
    n_large = large.count()
    sortable = bodies.join(small(large, n_large), "key", "left_anti") if n_large else bodies
    ordered = sortable.repartition("key").sortWithinPartitions("key", "digest")
    marks = ordered.mapInArrow(_sorted_groups(length, gram, unit), "key bigint, digest bigint, a bigint, b bigint")
    if n_large:
        prints = bodies.join(small(large, n_large), "key", "left_semi").select("key", "digest", "n", "body")
        prints = prints.mapInArrow(_fingerprints(length, unit), "key bigint, digest bigint, n bigint, a bigint, print bigint")
        twice = prints.groupBy("key", "print").agg(F.sum("n").alias("times")).filter("times > 1").select("key", "print")
        starts = prints.join(twice, ["key", "print"]).select("key", "digest", "a", F.col("a").alias("b")).distinct()
        marks = marks.unionByName(starts)
    marks = scratch.table(marks, f"{prefix}marks")
    return places.join(marks, ["key", "digest"]).select(
        F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.struct((F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b") + length).alias("b")).alias("r")
    )


def without_repeats(
    docs: DataFrame,
    scratch: Scratch,
    length: int = LENGTH,
    gram: int = GRAM,
    group_bytes: int = GROUP_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    unit: ByteUnits | WordUnits = BYTE_UNITS,
    passages: tuple[int, int] | None = None,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: the remaining bytes) per document.

    With ``carry`` the other columns of a row follow in the struct ``carried``, and cut characters go as a whole.
    With ``passages``, words of a passage and of its grams, ``n_passages`` and ``n_passage_bytes`` follow: maximal runs of
    words in the input that repeated passages cover, and their bytes from first word to last. They are not cut.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    other = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("carried")] if carry else []
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body"), *other).withColumn("mark", F.xxhash64("body"))
    read = whole.select("doc_id", "body", "mark")
    spans = _repeated_runs(read, scratch, length, gram, group_bytes, unit)
    if passages:
        # What the first sort needed goes before the second one begins.
        spans = scratch.table(spans, "spans")
        scratch.drop("segments", "large", "marks")
        words = _repeated_runs(read, scratch, *passages, group_bytes, WORD_UNITS, "word-")
        spans = spans.withColumn("word", F.lit(False)).unionByName(words.withColumn("word", F.lit(True)))
        runs = [F.collect_set(F.when(~F.col("word"), F.col("r"))).alias("runs"), F.collect_set(F.when(F.col("word"), F.col("r"))).alias("passages")]
    else:
        runs = [F.collect_set("r").alias("runs")]
    spans = spans.groupBy("d", "m").agg(*runs)
    more = (["passages"] if passages else []) + (["carried"] if carry else [])
    back = whole.join(spans, _same_doc(), "left").select("doc_id", "body", "runs", *more)
    kinds = f", carried {whole.schema['carried'].dataType.simpleString()}" if carry else ""
    kinds += ", n_passages bigint, n_passage_bytes bigint" if passages else ""
    return back.mapInArrow(_cut(carry, unit), f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary{kinds}")


def removal_digests(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``; with ``passages`` their two counts."""
    found = without_repeats(docs, scratch, **options)
    counts = [c for c in found.columns if c.startswith("n_passage")]
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), *counts)


def cleaned(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated strings cut out of the text, and ``n_chars``, if there, counted anew.

    A character that a cut would halve goes as a whole. Null text becomes empty.
    """
    found = without_repeats(docs, scratch, id_col=id_col, text_col=text_col, carry=True, **options)
    out = found.select("carried.*", F.col("kept").cast("string").alias(text_col))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
