"""Exact deduplication by grace hashing over complete content.

Each task puts its records into an open-addressing table that compares whole
texts. A table that outgrows its memory is dealt by hash bits to spill files,
and each file is treated the same way with the next bits. Tasks first do this
to their own input, so that a text goes through the shuffle once a task at
most, however many copies it has.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from array import array
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import batched, chain, count

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.arrays import LOWER
from larkspur.session import cut

#: Bytes of distinct content a task holds before it spills, and files it spills to.
TABLE_BYTES = 64 << 20
FILES = 16
#: Hash bits a level of spilling uses; after the last level a table may grow.
BITS, HASH_BITS = 4, 128


class ContentTable:
    """Open addressing with linear probing; equal means equal bytes, not equal hashes."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.members: list[list] = []
        self.bytes = 0

    def place(self, hashed: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        slot = (hashed >> 64) & mask
        while (entry := self.slots[slot]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return slot
            slot = (slot + 1) & mask
        return slot

    def add(self, hashed: int, content: bytes, members: list) -> None:
        slot = self.place(hashed, content)
        entry = self.slots[slot]
        if entry >= 0:
            self.members[entry] += members
            return
        self.slots[slot] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.members.append(members)
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for i, h in enumerate(self.hashes):
                slot = (h >> 64) & mask
                while self.slots[slot] >= 0:
                    slot = (slot + 1) & mask
                self.slots[slot] = i

    def find(self, hashed: int, content: bytes) -> list | None:
        entry = self.slots[self.place(hashed, content)]
        return self.members[entry] if entry >= 0 else None

    def __iter__(self) -> Iterator[tuple[bytes, list]]:
        return zip(self.contents, self.members)

    def entries(self) -> Iterator[tuple[int, bytes, list]]:
        return zip(self.hashes, self.contents, self.members)


def hashed(records: Iterable[tuple[bytes, object]]) -> Iterator[tuple[int, bytes, list]]:
    return ((xxhash.xxh3_128_intdigest(content), content, [member]) for content, member in records)


def groups(records: Iterable[tuple[int, bytes, list]], limit: int = TABLE_BYTES, files: int = FILES, level: int = 0) -> Iterator[tuple[bytes, list]]:
    """(content, members) of each distinct content of (hash, content, members) records.

    The spill files are the task's own scratch: nameless, read by the task that wrote them, gone with it.
    """
    table, spilled = ContentTable(), []
    last = (level + 1) * BITS >= HASH_BITS // 2
    try:
        for h, content, members in records:
            if not spilled:
                table.add(h, content, members)
                if table.bytes > limit and not last and len(table.contents) > 1:
                    spilled = [tempfile.TemporaryFile(buffering=1 << 16) for _ in range(files)]
                    for entry in table.entries():
                        _spill(spilled, level, *entry)
                    table = ContentTable()
            else:
                # copies in a spilled bucket meet again when the bucket is read
                _spill(spilled, level, h, content, members)
        yield from table
        for i, file in enumerate(spilled):
            file.seek(0)
            yield from groups(_read(file), limit, files, level + 1)
            file.close()
            spilled[i] = None
    finally:
        for file in spilled:
            if file is not None:
                file.close()


def _spill(files: list, level: int, h: int, content: bytes, members: list) -> None:
    """Append a record: hash, size of the content, count and width of the members, then both."""
    numbers = array("q", chain.from_iterable(members)).tobytes()
    head = h.to_bytes(16, "little") + struct.pack("<qqq", len(content), len(members), len(members[0]))
    files[(h >> (level * BITS)) % len(files)].write(head + content + numbers)


def _read(file) -> Iterator[tuple[int, bytes, list]]:
    while head := file.read(40):
        size, n, width = struct.unpack("<qqq", head[16:])
        content, numbers = file.read(size), array("q", file.read(8 * n * width))
        yield int.from_bytes(head[:16], "little"), content, list(batched(numbers, width))


def _one_by_one(records: Iterable[tuple[int, bytes, tuple]], limit: int, files: int = FILES, level: int = 0) -> Iterator[tuple]:
    """What ``_local`` gives out: rows as they come, and each distinct text once at the end, with the row that stays and the number of copies.

    A record's member is (0, has id, id, row, 0, 0), or what is known of a text whose rows are out already: (1, has id, id, row, uid, copies). The table holds
    that much a text, whatever the number of its copies.
    """
    table, spilled = ContentTable(), []
    last = (level + 1) * BITS >= HASH_BITS // 2
    try:
        for h, content, member in records:
            if spilled:
                _spill(spilled, level, h, content, [member])
                continue
            known, has, id, row, uid, copies = member
            entry = table.find(h, content)
            if entry is None:
                entry = [[1, has, id, row, uid if known else row, 0], hashlib.sha256(content).hexdigest()]
                table.add(h, content, entry)
            held, digest = entry
            if not known:
                yield id if has else None, row, held[4], digest, None, None, None, None, None
            held[1:4] = max(held[1:4], [has, id, row])
            held[5] += copies if known else 1
            if table.bytes > limit and not last and len(table.contents) > 1:
                spilled = [tempfile.TemporaryFile(buffering=1 << 16) for _ in range(files)]
                for k, text, (summary, _) in table.entries():
                    _spill(spilled, level, k, text, [tuple(summary)])
                table = ContentTable()
        for content, ((_, has, id, row, uid, copies), digest) in table:
            yield None, None, uid, digest, content.decode(), bool(has), id, row, copies
        for i, file in enumerate(spilled):
            file.seek(0)
            yield from _one_by_one(((h, content, members[0]) for h, content, members in _read(file)), limit, files, level + 1)
            file.close()
            spilled[i] = None
    finally:
        for file in spilled:
            if file is not None:
                file.close()


def _local(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each distinct text of the task, with the text and what is to be known of its copies."""
    number = count(TaskContext.get().partitionId() << 33)

    def records():
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = (text or "").encode().translate(LOWER)
                yield xxhash.xxh3_128_intdigest(content), content, (0, int(id is not None), id or 0, next(number), 0, 0)

    rows, size = [], 0
    for row in _one_by_one(records(), limit):
        rows.append(row)
        size += 200 + len(row[4] or "")
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), LOCAL)], schema=LOCAL)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), LOCAL)], schema=LOCAL)


LOCAL = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("uid", pa.int64()), ("text_sha256", pa.string()), ("content", pa.string()),
     ("has", pa.bool_()), ("id", pa.int64()), ("last", pa.int64()), ("copies", pa.int64())]
)


def _merged(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The tasks' distinct texts put together: for each, the row that stays and the number of copies."""

    def records():
        for batch in batches:
            content = batch.column(0).to_pylist()
            for text, *member in zip(content, *(batch.column(i).to_pylist() for i in range(1, 6))):
                yield text.encode(), tuple(member)

    out = []
    for _, members in groups(hashed(records()), limit):
        has, id, row = max(m[:3] for m in members)
        copies = sum(m[3] for m in members)
        out += [(m[4], id if has else None, row, copies) for m in members]
        if len(out) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), MERGED)], schema=MERGED)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), MERGED)], schema=MERGED)


MERGED = pa.schema([("uid", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])


def deduplicate(df: DataFrame, id: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, text_sha256) per row of ``df``; ids are integers.

    Texts are equal when identical after A-Z is lower-cased; null counts as empty. Of equal texts the row with the
    largest id stays, and of repeated rows one; null ids are smaller than all others. An empty table gives an empty
    one, and other columns are not read. ``limit`` is the memory of a task's table in bytes, besides one text, which may be very long, and what is
    about to be given out; the result does not depend on it.
    """
    docs = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    local = cut(
        docs.mapInArrow(
            partial(_local, limit=limit),
            "doc_id long, row long, uid long, text_sha256 string, content string, has boolean, id long, last long, copies long",
        )
    )
    texts = local.where("content IS NOT NULL").select("content", "has", "id", "last", "copies", "uid")
    merged = texts.repartition(F.xxhash64("content")).mapInArrow(partial(_merged, limit=limit), "uid long, keep_id long, keep_row long, group_size long")
    return local.where("content IS NULL").select("doc_id", "row", "uid", "text_sha256").join(merged, "uid").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
