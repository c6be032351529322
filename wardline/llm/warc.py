"""WARC archives and a merged index of their captures (operator 10).

Pages become WARC/1.1 records, each a gzip member of its own, so a record is read by seeking to its
offset. Archives end at ``FILE_BYTES`` of unpacked records, or after one record that is larger. Of the pages with one payload
(by SHA-256, from ``REVISIT_BYTES`` on) the one with the smallest ``page_id`` is a response, the others
are revisit records that refer to it.

The archives are then read back, as streams of pieces. Each is parsed into a capture run: its records'
index entries, sorted by URL key (host labels reversed, then path) and time, and stored. The merge is
external: ranges of keys are cut from all runs, each range is stored run by run in short blocks, and a task merges one range by
a loser tree over the blocks' streams, of which it holds one block per run. Where a range has more than ``WAYS`` runs, groups
of so many are merged and stored first, in as many levels as that takes. So the index is ordered within and across its partitions: the
capture history of a URL is a stretch of it.

Pages have no capture time; each gets one second per ``page_id`` after a fixed day unless a time column
is named. Null html: an empty payload. Null url: a record without a target, an empty key. Null
``page_id``: written without a number; it is a response only if its payload has no numbered page. Rows
that repeat the smallest ``page_id`` are all responses. An empty table gives no captures. Other
columns are ignored. A hot URL or payload is no problem: ranges are cut within a URL by time, number
and place in the archive, and the smallest number per payload is found with partial aggregates.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch

REVISIT_BYTES = 100

#: Unpacked bytes of records after which an archive file ends.
FILE_BYTES = 16 << 20

#: Runs that one merge reads, and index entries in a block of a run: a task holds as many blocks as runs.
WAYS, BLOCK = 256, 256

_END = b"\r\n\r\n"
_READ = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ENTRY = pa.schema(
    [("run", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64())]
    + [("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    + [("record_offset", pa.int64()), ("record_place", pa.int64()), ("record_bytes", pa.int64())]
)
_ENTRY_DDL = (
    "run string, place bigint, url_key string, captured string, page_id bigint, record_type string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, record_offset bigint, record_place bigint, record_bytes bigint"
)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None) -> DataFrame:
    """``value``: a WARC record per page, without the blank lines that end it."""
    seconds = F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(1_000_000_000)) + F.lit(1_577_836_800)
    time = F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(seconds)
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    read = read.withColumn("n_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    large = F.col("n_bytes") >= REVISIT_BYTES
    first = read.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"))
    # Small payloads meet nobody: they get keys of their own instead of sharing one.
    own = F.concat(F.lit("small-"), F.xxhash64("page_id", "url").cast("string"))
    placed = read.withColumn("key", F.when(large, F.col("digest")).otherwise(own)).join(
        first.select(F.col("digest").alias("key"), "first"), "key", "left"
    )
    repeats = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))

    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("n_bytes")), F.lit("\r\n"))
    block = F.when(repeats, F.lit("")).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
        line("WARC-Date", F.coalesce("captured", F.lit("1970-01-01T00:00:00Z"))),
        F.coalesce(F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"), F.lit(">\r\n")), F.lit("WARC-Record-ID: <urn:page:none>\r\n")),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("WARC-Payload-Length", F.col("n_bytes")),
        F.when(repeats, F.concat(F.lit(f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    return placed.select(F.concat(head, block).alias("value"))


def _member(data: bytes) -> bytes:
    """One gzip member; without a time or a name, so that a task that runs again writes the same bytes."""
    packer = zlib.compressobj(wbits=31)
    return packer.compress(data) + packer.flush()


def _packed(file_bytes: int):
    """Records -> archives: a member per record, each archive one value."""

    def pack(batches):
        members, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                record = value.as_py().encode() + _END
                if members and size + len(record) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["archive"])
                    members, size = [], 0
                members.append(_member(record))
                size += len(record)
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["archive"])

    return pack


def write_archives(pages: DataFrame, scratch: Scratch, file_bytes: int = FILE_BYTES, **columns) -> str:
    """Write gzip archives; returns their folder.

    Spark's text writer commits them: a row is a file, its bytes as they are. The line separator at its end is
    an empty gzip member, the usual mark that a file of members is whole.
    """
    path = f"{scratch.path}/archives"
    archives = records(pages, **columns).mapInArrow(_packed(file_bytes), "archive binary")
    options = {"lineSep": _member(b"").decode("latin-1"), "encoding": "ISO-8859-1", "maxRecordsPerFile": 1}
    archives.select(F.col("archive").cast("string")).write.options(**options).text(path)
    return path


def _inflated(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """The bytes of all members of a gzip file, in pieces, each with its member's offset in the file.

    Raises unless the last member is whole.
    """
    at = 0
    while at < len(archive):
        member, inflate, pending = at, zlib.decompressobj(31), b""
        while not inflate.eof:
            if not pending:
                pending = archive[at : at + _READ]
                at += len(pending)
                if not pending:
                    raise ValueError("archive ends within a gzip member")
            try:
                more = inflate.decompress(pending, 1 << 20)
            except zlib.error as e:
                raise ValueError(f"archive is damaged: {e}") from e
            pending = inflate.unconsumed_tail
            if more:
                yield member, more
        at -= len(inflate.unused_data)


def parse(archive: bytes) -> Iterator[tuple[int, int, int, dict[str, str], bytes]]:
    """Each record of a gzip archive: its member's offset in the file, its place in the unpacked member, its
    unpacked length, headers and block.

    The records may lie in a member each (their place is 0 then), or several in one, as other writers leave
    them. Raises on a broken record and on a file that was cut, within its last checksum too.
    """
    pieces, data, base = _inflated(archive), bytearray(), 0
    members: deque[tuple[int, int]] = deque()  # where a member begins, unpacked, and in the file

    def more() -> bool:
        member, piece = next(pieces, (0, b""))
        if piece and (not members or members[-1][1] != member):
            members.append((base + len(data), member))
        data.extend(piece)
        return bool(piece)

    def fill(size: int) -> None:
        while len(data) < size:
            if not more():
                raise ValueError("archive ends within a record")

    while data or more():
        stop = data.find(b"\r\n\r\n")
        while stop < 0:
            seen = max(0, len(data) - 3)
            fill(len(data) + 1)
            stop = data.find(b"\r\n\r\n", seen)
        first, *lines = data[:stop].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {base}: {first[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        size = stop + 4 + int(headers["Content-Length"]) + 4
        fill(size)
        block = bytes(data[stop + 4 : size - 4])
        if data[size - 4 : size] != _END:
            raise ValueError(f"record at {base} has a wrong length")
        while len(members) > 1 and members[1][0] <= base:
            members.popleft()
        yield members[0][1], base - members[0][0], size, headers, block
        del data[:size]
        base += size


def record_at(file, offset: int, place: int, size: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record of an open archive, reading no more of it than that record."""
    file.seek(offset)
    inflate, data = zlib.decompressobj(31), bytearray()
    while len(data) < place + size:
        if inflate.eof:  # a record that goes on in the next member
            rest, inflate = inflate.unused_data, zlib.decompressobj(31)
        else:
            rest = inflate.unconsumed_tail
        rest = rest or file.read(_READ)
        if not rest:
            raise ValueError("archive ends within a record")
        data += inflate.decompress(rest, place + size - len(data))
    _, _, _, headers, block = next(parse(_member(bytes(data[place : place + size]))))
    return headers, block


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then the rest: ``org,example)/en``."""
    if not url:
        return ""
    _, mark, rest = url.partition("://")
    rest = rest if mark else url
    at = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:at].lower().split("."))) + ")" + rest[at:]


def _number(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if text in ("", "none") else int(text)


def _entry(run: str, offset: int, place: int, size: int, headers: dict[str, str], block: bytes) -> dict:
    digest, length = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["WARC-Payload-Length"])
    if headers["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
            raise ValueError(f"{run}: payload of {headers['WARC-Record-ID']} is damaged")
    return {
        "run": run,
        "place": 0,
        "url_key": url_key(headers.get("WARC-Target-URI")),
        "captured": headers["WARC-Date"],
        "page_id": _number(headers["WARC-Record-ID"]),
        "record_type": headers["WARC-Type"],
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": _number(headers.get("WARC-Refers-To")),
        "record_offset": offset,
        "record_place": place,
        "record_bytes": size,
    }


def order_key(entry: dict) -> tuple:
    """The order of the index: URL key as UTF-8, time, page number (none first), archive, place."""
    page = entry["page_id"]
    return entry["url_key"].encode(), entry["captured"], page is not None, page or 0, entry["run"], entry["place"]


def capture_runs(spark, path: str) -> DataFrame:
    """Parse every archive into a run: its entries in order, ``place`` counting them."""

    def runs(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                run = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                entries = [_entry(run, *record) for record in parse(batch.column(1)[i].as_py())]
                entries.sort(key=lambda e: (*order_key(e)[:4], e["record_offset"], e["record_place"]))
                for place, entry in enumerate(entries):
                    entry["place"] = place
                if entries:
                    yield pa.RecordBatch.from_pylist(entries, _ENTRY)

    return _archives(spark, path).select("path", "content").mapInArrow(runs, _ENTRY_DDL)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, a replay costs log k comparisons."""

    def __init__(self, runs: list[Iterable], key):
        self._runs, self._key = [iter(r) for r in runs], key
        self._heads: list = [None] * len(runs)
        self._keys: list = [None] * len(runs)
        for i in range(len(runs)):
            self._advance(i)
        self._play_all()

    def add(self, run: Iterable) -> None:
        """One more run, in the place of one that has ended if there is any; not while `until` is read."""
        ended = next((i for i, head in enumerate(self._heads) if head is None), len(self._runs))
        if ended == len(self._runs):
            for held in (self._runs, self._heads, self._keys):
                held.append(None)
        self._runs[ended] = iter(run)
        self._advance(ended)
        self._play_all()

    def _advance(self, i: int) -> None:
        self._heads[i] = next(self._runs[i], None)
        self._keys[i] = None if self._heads[i] is None else (self._key(self._heads[i]), i)

    def _beats(self, a: int, b: int) -> bool:
        return self._keys[b] is None or (self._keys[a] is not None and self._keys[a] < self._keys[b])

    def _play_all(self) -> None:
        self._k = len(self._runs)
        self._losers = [-1] * self._k
        self._winner = self._play(1) if self._k else -1

    def _play(self, node: int) -> int:
        if node >= self._k:
            return node - self._k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self._losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator:
        return self.until(None)

    def until(self, stop) -> Iterator:
        """What comes before the key ``stop``; all, if it is None."""
        while self._k and self._heads[self._winner] is not None:
            at = self._winner
            if stop is not None and self._keys[at][0] >= stop:
                return
            yield self._heads[at]
            self._advance(at)
            node = (at + self._k) // 2
            while node:
                if self._beats(self._losers[node], at):
                    at, self._losers[node] = self._losers[node], at
                node //= 2
            self._winner = at


_ORDER = ["url_key", "captured", "page_id", "run", "place"]
_BLOCK_DDL = f"{', '.join(c for c in _ENTRY_DDL.split(', ') if c.split()[0] in _ORDER)}, way bigint, part bigint, entries binary"
_BLOCK = pa.schema([*(f for f in _ENTRY if f.name in _ORDER), ("way", pa.int64()), ("part", pa.int64()), ("entries", pa.binary())])


def _blocks(size: int):
    """The entries of a range, run after run -> blocks of one run, each under its first entry's key."""

    def blocks(batches):
        held: list[dict] = []

        def block():
            entries = pa.RecordBatch.from_pylist(held, _ENTRY)
            with pa.BufferOutputStream() as sink:
                with pa.ipc.new_stream(sink, _ENTRY) as writer:
                    writer.write_batch(entries)
                packed = sink.getvalue().to_pybytes()
            return pa.RecordBatch.from_pylist([{**held[0], "entries": packed}], _BLOCK)

        for batch in batches:
            for entry in batch.to_pylist():
                if held and (entry["way"] != held[0]["way"] or len(held) == size):
                    yield block()
                    held = []
                held.append(entry)
        if held:
            yield block()

    return blocks


def merged(blocks: Iterable, key) -> Iterator:
    """One sorted stream from sorted blocks that come in the order of their first members.

    A block is opened once the merge has come to its first member. Blocks of one run follow upon each other,
    so no more are open than there are runs.
    """
    tree = LoserTree([], key)
    for block in blocks:
        first = key(block[0])
        yield from tree.until(first)
        tree.add(block)
    yield from tree


def _merge(batches):
    """Blocks in the order of their first entries, part after part -> one sorted stream of each part."""

    def stored():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.column("part")[i].as_py(), batch.column("entries")[i].as_py()

    out: list[dict] = []
    for _, blocks in groupby(stored(), lambda b: b[0]):
        opened = (pa.ipc.open_stream(packed).read_all().to_pylist() for _, packed in blocks)
        for entry in merged(opened, order_key):
            out.append(entry)
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, _ENTRY)
                out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _ENTRY)


def merged_index(runs: DataFrame, scratch: Scratch, n_runs: int, ways: int = WAYS, block: int = BLOCK) -> DataFrame:
    """All runs in one order, partition after partition; a partition holds one key range of narrow rows."""
    if ways < 4:
        raise ValueError("a merge of fewer than four runs at a time would not end")
    level, way = 0, F.xxhash64("run")
    while n_runs > ways:
        # Runs are hashed to groups, so groups are planned half full; each becomes one longer run.
        n_groups = -(-2 * n_runs // ways)
        group = F.pmod(F.xxhash64(F.lit(level), way), F.lit(n_groups)).cast("long")
        runs = scratch.table(_merged_ranges(runs, way, group, block), f"merged{level}")
        level, way, n_runs = level + 1, group, n_groups
    return _merged_ranges(runs, way, F.lit(0).cast("long"), block)


def _merged_ranges(runs: DataFrame, way: Column, part: Column, block: int) -> DataFrame:
    """Each part's runs, ``way`` by ``way``, as one sorted stream, cut into ranges of keys."""
    numbered = runs.select("*", way.alias("way"), part.alias("part"))
    ranged = numbered.repartitionByRange("part", *_ORDER).sortWithinPartitions("part", "way", *_ORDER)
    blocks = ranged.mapInArrow(_blocks(block), _BLOCK_DDL)
    return blocks.sortWithinPartitions("part", *_ORDER).mapInArrow(_merge, _ENTRY_DDL)


def _archives(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def captures(pages: DataFrame, scratch: Scratch, file_bytes: int = FILE_BYTES, ways: int = WAYS, block: int = BLOCK, **columns) -> DataFrame:
    """Write the archives, read them back, merge their runs: the index in global order."""
    path = write_archives(pages, scratch, file_bytes, **columns)
    runs = scratch.table(capture_runs(scratch.spark, path), "runs")
    return merged_index(runs, scratch, _archives(scratch.spark, path).select("path").count(), ways, block)
