"""Suffix-array dedup of 50-byte strings: cut what also starts in a document with a smaller doc_id.

A byte goes if any LENGTH-byte string that covers it also starts in an earlier document; strings are judged on the
input and never cross documents. All strings of the corpus cannot be sorted at once, so they are split without loss:

1. Every string has an anchor, its GRAM-byte piece of least hash. Equal strings have equal anchors at equal places, so
   an anchor stands for all strings around it that have it (its context, 50 to 76 bytes), one for 14 bytes of text.
   Tasks send (gram hash, context hash, document, place), one for each different context.
2. Anchors meet by gram hash. Contexts that are equal whole are settled: all but the smallest document's are cut. Grams
   with several contexts are contested, and the first document of each context sends the context itself.
3. Contested contexts are suffix-sorted from the anchor on: merge sort, comparing by binary search over prefix
   polynomial hashes. Neighbours in the order give the common extensions to the right, the same search those to the
   left, and both the strings that two contexts share. Every match is compared byte by byte before it counts.
4. A gram with more than CROWD contexts (the edges of a passage that very many documents hold) is not gathered in one
   task: its strings meet one by one, by two hashes of the string, each task sending a string once.

Tasks send their arrays packed, a few rows per bucket. Equal contexts are settled by 96 bits of hashes (48 of the
gram, 48 of the context), crowded strings by 128.

Null texts are empty. Rows without doc_id stay whole and are not searched. Equal rows are cut alike; of rows that
repeat a doc_id with different texts only one (of the smallest text hash) takes part, the others stay whole. Texts of
any length: long ones are read in overlapping pieces. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import PrefixHashes, U, scrambled, shuffle_width, slices, stored
from marketflow.llm.suffixes import Text

LENGTH = 50
GRAM = 24
CROWD = 64
CHUNK = 1 << 17
FLUSH = 1 << 18  # anchors or strings that a task holds before it sends them
BUCKET_BYTES = 64 << 20  # text per bucket
BLOCK = 1 << 18  # anchors, or bytes of contexts, of a bucket that are solved at once
LOW48 = U((1 << 48) - 1)
SETTLED, CONTESTED, CROWDED = 0, 1, 2
PACKED = "bucket int, kind int, data binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head = a.dtype.str.encode().ljust(8) + len(a).to_bytes(8, "little")
        parts.append(head + a.view(np.uint8).reshape(len(a), -1).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = np.dtype(raw[at : at + 8].decode().strip()), int.from_bytes(raw[at + 8 : at + 16], "little")
        size = n * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at + 16).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += 16 + size
    return out


def joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _slide(a: np.ndarray, width: int, f) -> np.ndarray:
    """f over every run of `width` elements."""
    size = 1
    while 2 * size <= width:
        a = f(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return f(a[: len(a) - rest], a[rest:]) if rest else a


def anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, piece, first start, number of starts, place of the gram) of every anchor.

    Pieces begin:end lie in `data` one after the other; starts and places count from the beginning of `data`.
    """
    n, grams = len(data), LENGTH - GRAM + 1
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    prefix = PrefixHashes(data)
    h = scrambled(prefix.every(GRAM)) | U(1)
    least = _slide(h, grams, np.minimum)
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        least[max(a, b - LENGTH + 1) : b] = 0  # no string of one document starts here
    edge = np.zeros(grams, np.uint64)
    best = _slide(np.concatenate((edge[1:], least, edge[1:])), grams, np.maximum)
    p = np.flatnonzero(best[: len(h)] == h)
    own, at = h[p], np.searchsorted(end, p, side="right")
    around = np.concatenate((edge, h, edge))
    left, right = np.full(len(p), grams - 1, np.int64), np.full(len(p), grams - 1, np.int64)
    for k in range(grams - 1, 0, -1):  # grams to the left and right that are not less
        np.putmask(left, around[p + (grams - k)] < own, k - 1)
        np.putmask(right, around[p + (grams + k)] < own, k - 1)
    low, high = np.maximum(begin[at], p - left), np.minimum(p + right - grams + 1, end[at] - LENGTH)
    shape = (p - low).astype(np.uint64) * U(64) + (high - low).astype(np.uint64)
    context = scrambled(prefix.of(low, high + LENGTH) + scrambled(shape + U(1)))
    return own, context, at, low, high - low + 1, p


def pieces(text: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, first own place, end of own places) of overlapping pieces; most texts are one."""
    margin = 2 * LENGTH
    for at in range(0, max(1, len(text)), CHUNK):
        yield max(0, at - margin), min(len(text), at + CHUNK + margin), at, at + CHUNK


def anchored(docs: Iterable[tuple[int, bytes]]) -> Iterator[list[np.ndarray]]:
    """(gram hash, context hash, doc_id, first start, starts, gram place) of documents, starts counted in the document."""
    held, size = [], 0

    def close():
        data = np.frombuffer(b"".join(t[a:b] for _, t, a, b, _, _ in held), np.uint8)
        length = np.array([b - a for _, _, a, b, _, _ in held])
        end = np.cumsum(length)
        begin = end - length
        h, c, piece, low, n, p = anchors(data, begin, end)
        shift = np.array([a for _, _, a, _, _, _ in held])[piece] - begin[piece]
        own = np.array([(x, y) for *_, x, y in held])[piece]
        mine = (p + shift >= own[:, 0]) & (p + shift < own[:, 1])
        ids = np.array([d for d, *_ in held], np.int64)[piece]
        return [x[mine] for x in (h & LOW48, c & LOW48, ids, (low + shift).astype(np.int32), n.astype(np.int16), (p - low).astype(np.int8))]

    for doc_id, text in docs:
        for a, b, x, y in pieces(text):
            held.append((doc_id, text, a, b, x, y))
            size += b - a
            if size >= CHUNK:
                yield close()
                held, size = [], 0
    if held:
        yield close()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Whether a row of sorted keys differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def settle(h, c, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by (h, c, doc); in it: first of h, first of (h, c), whether an earlier document has (h, c), contexts of h."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(h) else order
    some = order[tied]
    order[tied] = some[np.lexsort((doc[some], c[some], h[some]))]
    h, c, doc = h[order], c[order], doc[order]
    new_h, new_c = _starts(h), _starts(h, c)
    owner = doc[np.flatnonzero(new_c)][np.cumsum(new_c) - 1] if len(doc) else doc
    group = np.cumsum(new_h) - 1
    return order, new_h, new_c, doc > owner, np.bincount(group, new_c).astype(np.int64)[group] if len(doc) else group


def _marks(kind: int, docs: int, doc: np.ndarray, start: np.ndarray, n: np.ndarray, place: np.ndarray, h: np.ndarray) -> Iterator[tuple]:
    """Rows that bring findings to their documents' buckets."""
    home = doc % docs
    order = np.argsort(home, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
        if len(part):
            yield int(home[part[0]]), kind, pack(doc[part], start[part], n[part], place[part], h[part])


def _homes(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each gram hash; without its last bit, as that is always set."""
    return ((h >> U(1)) % U(buckets)).astype(np.int64)


def _dealt(buckets: int, keys: np.ndarray, kind: int, *arrays: np.ndarray) -> Iterator[tuple]:
    home = _homes(keys, buckets)
    order = np.argsort(home, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
        if len(part):
            yield int(home[part[0]]), kind, pack(*[a[part] for a in arrays])


# kinds of rows on the way to a bucket of hashes; those of findings, SETTLED to CROWDED, only pass through
ANCHORS, CONTEXTS, STRINGS = 3, 4, 5


def _sent_anchors(parts: list[list[np.ndarray]], docs: int, buckets: int) -> Iterator[tuple]:
    """Settle inside the task what can be, and send one row for each context that is left."""
    h, c, doc, start, n, place = joined(parts)
    order, _, _, later, contexts = settle(h, c, doc)
    h, c, doc, start, n, place = (x[order] for x in (h, c, doc, start, n, place))
    yield from _marks(SETTLED, docs, doc[later], start[later], n[later], place[later], h[later])
    crowd = contexts > CROWD
    mine = crowd & ~later
    yield from _marks(CROWDED, docs, doc[mine], start[mine], n[mine], place[mine], h[mine])
    send = ~later & (~crowd | _starts(h))
    flag = crowd[send].astype(np.int8)
    yield from _dealt(buckets, h[send], ANCHORS, *[x[send] for x in (h, c, doc, start, n, place)], flag)


def _shares(parts: list[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The rows of `parts`, about BLOCK at a time; all rows of a gram hash, their first array, come together."""
    shares = -(-sum(len(p[0]) for p in parts) // BLOCK)
    for k in range(shares):
        yield joined([[a[mine] for a in p] for p in parts for mine in [(p[0] >> U(24)) % U(shares) == k]])


def _met_anchors(parts: list[list[np.ndarray]], docs: int) -> Iterator[tuple]:
    for share in _shares(parts):
        yield from _settled_anchors(share, docs)


def _settled_anchors(share: list[np.ndarray], docs: int) -> Iterator[tuple]:
    h, c, doc, start, n, place, flag = share
    order, new_h, _, later, contexts = settle(h, c, doc)
    h, doc, start, n, place, flag = (x[order] for x in (h, doc, start, n, place, flag))
    group = np.cumsum(new_h) - 1
    flagged = np.bincount(group, flag)[group] > 0
    plain = flag == 0  # the task of a flagged row sends its documents itself
    for kind, which in (
        (SETTLED, plain & later),
        (CONTESTED, plain & ~later & (contexts > 1) & ~flagged & (contexts <= CROWD)),
        (CROWDED, plain & ~later & (flagged | (contexts > CROWD))),
    ):
        yield from _marks(kind, docs, doc[which], start[which], n[which], place[which], h[which])


def shared_strings(contexts: bytes, size: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each string of each context, in order: whether an earlier document's context has it at the same anchor.

    Contexts lie in `contexts` one after the other; context i has size[i] - LENGTH + 1 strings and its gram at place[i].
    """
    text = Text(np.frombuffer(contexts, np.uint8))
    end = np.cumsum(size)
    begin = end - size
    gram = begin + place
    order = text.sort(gram, end)
    x = order[:-1]
    y = order[1:]
    right = text.common_right(gram[x], gram[y], np.minimum(end[x] - gram[x], end[y] - gram[y]))
    strings = size - LENGTH + 1
    offset = np.cumsum(strings) - strings
    change = np.zeros(int(strings.sum()) + 1, np.int64)
    for step in range(1, len(order)):
        # pairs `step` apart in the order share the least of the extensions between; under a whole gram none do
        if step > 1:
            right = np.minimum(right[:-1], right_one[step - 1 :])
        else:
            right_one = right
        alike = np.flatnonzero(right >= GRAM)
        if not len(alike):
            break
        a, b = order[alike], order[alike + step]
        early, late = np.where(doc[a] < doc[b], a, b), np.where(doc[a] < doc[b], b, a)
        far = right[alike]
        near = text.common_left(gram[early], gram[late], np.minimum(place[early], place[late]))
        k = np.flatnonzero((doc[early] != doc[late]) & (near + far >= LENGTH))
        early, late, near, far = early[k], late[k], near[k], far[k]
        same = _equal(text.data, gram[early] - near, gram[late] - near, near + far)
        late, near, far = late[same], near[same], far[same]
        first = offset[late] + place[late] - near
        np.add.at(change, first, 1)
        np.add.at(change, first + near + far - LENGTH + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Byte by byte comparison of the slices of n bytes at a and b."""
    if not len(n):
        return np.zeros(0, bool)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.logical_and.reduceat(data[np.repeat(a, n) + at] == data[np.repeat(b, n) + at], np.cumsum(n) - n)


def _runs(flags: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of set flags with equal keys."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = _starts(*[k[at] for k in keys]) | _starts(at - np.arange(len(at)))
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def _met_contexts(parts: list[list[np.ndarray]], docs: int) -> Iterator[tuple]:
    """Contexts meet those of their own gram only, so the grams are solved a few at a time."""
    doc, start, n, place, h, data = joined(parts)
    size = n.astype(np.int64) + LENGTH - 1
    begin = np.cumsum(size) - size
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(_starts(h[order]))
    block = (np.cumsum(size[order]) - size[order])[first] // BLOCK
    for rows in np.split(order, first[1:][np.diff(block) > 0]):
        ends = np.cumsum(size[rows])
        at = np.repeat(begin[rows] + size[rows] - ends, size[rows]) + np.arange(ends[-1])
        yield from _solved_contexts(docs, data[at].tobytes(), size[rows], *[x[rows] for x in (doc, start, n, place, h)])


def _solved_contexts(docs: int, data: bytes, size, doc, start, n, place, h) -> Iterator[tuple]:
    shared = shared_strings(data, size, doc, place.astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first, length = _runs(shared, row)
    r = row[first]
    yield from _marks(SETTLED, docs, doc[r], (start[r] + inside[first]).astype(np.int32), length.astype(np.int16), place[r], h[r])


def _sent_strings(parts: list[list[np.ndarray]], docs: int, buckets: int) -> Iterator[tuple]:
    h, c, doc, start = joined(parts)
    order, _, _, later, _ = settle(h, c, doc)
    h, c, doc, start = (x[order] for x in (h, c, doc, start))
    one = np.ones(len(h), np.int16)
    zero = one.astype(np.int8)
    yield from _marks(SETTLED, docs, doc[later], start[later], one[later], zero[later], h[later])
    send = ~later
    yield from _dealt(buckets, h[send], STRINGS, *[x[send] for x in (h, c, doc, start)])


def _met_strings(parts: list[list[np.ndarray]], docs: int) -> Iterator[tuple]:
    h, c, doc, start = joined(parts)
    order, _, _, later, _ = settle(h, c, doc)
    h, doc, start = (x[order][later] for x in (h, doc, start))
    one = np.ones(len(h), np.int16)
    yield from _marks(SETTLED, docs, doc, start, one, one.astype(np.int8), h)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "kind", "data"])


def _meeting(sent: DataFrame, docs: int, buckets: int) -> DataFrame:
    """Findings from rows that meet by bucket; rows that are findings already pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = {ANCHORS: _met_anchors, CONTEXTS: _met_contexts, STRINGS: _met_strings}
        key, held = None, []
        for batch in slices(batches):
            for bucket, kind, data in zip(*[batch.column(c).to_pylist() for c in ("bucket", "kind", "data")], strict=True):
                if kind < ANCHORS:
                    yield _batch([(bucket, kind, data)])
                    continue
                if key != (bucket, kind) and held:
                    yield _batch(list(solve[key[1]](held, docs)))
                    held = []
                key = (bucket, kind)
                held.append(unpack(data))
        if held:
            yield _batch(list(solve[key[1]](held, docs)))

    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, PACKED)


def _compressed(docs: DataFrame) -> DataFrame:
    """(key, data): texts compressed before they are dealt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pressing = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            data = [pressing.compress(t or b"") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(data, pa.binary())], ["doc_id", "key", "data"])

    return docs.select("doc_id", "key", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, key long, data binary")


def _with_findings(docs: DataFrame, findings: DataFrame, width: int, make: Callable, schema: str) -> DataFrame:
    """Run `make()(findings, rows)` in each bucket of documents: its findings first, then its (doc_id, key, text) rows."""
    texts = _compressed(docs).select(
        F.pmod(F.coalesce("key", "doc_id", F.lit(0)), F.lit(width)).cast("int").alias("bucket"), F.lit(9).alias("kind"), "doc_id", "key", "data"
    )
    marks = findings.select("bucket", "kind", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("key"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening = zstandard.ZstdDecompressor()

        def buckets():
            at, marks, rows = None, {}, []
            for batch in slices(batches):
                for bucket, kind, doc_id, key, data in zip(*[batch.column(c).to_pylist() for c in ("bucket", "kind", "doc_id", "key", "data")], strict=True):
                    if bucket != at:
                        if at is not None:
                            yield marks, rows
                        at, marks, rows = bucket, {}, []
                    if kind == 9:
                        rows.append((doc_id, key, opening.decompress(data)))
                        if len(rows) >= 200:
                            yield marks, rows
                            rows = []
                    else:
                        marks.setdefault(kind, []).append(unpack(data))
            if at is not None:
                yield marks, rows

        yield from make(buckets())

    dealt = marks.unionByName(texts).repartition(width, "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(run, schema)


class _ByDocument:
    """Findings of one kind, looked up by document."""

    def __init__(self, parts: list[list[np.ndarray]]):
        arrays = joined(parts)
        order = np.argsort(arrays[0], kind="stable")
        self.arrays = [a[order] for a in arrays]

    def of(self, doc_id: int) -> list[np.ndarray]:
        a, b = np.searchsorted(self.arrays[0], [doc_id, doc_id + 1])
        return [x[a:b] for x in self.arrays[1:]]


def _looked_up(buckets):
    """(marks by kind, rows) with the marks of a bucket sorted once."""
    last, sorted_ = None, {}
    for marks, rows in buckets:
        if marks is not last:
            last, sorted_ = marks, {k: _ByDocument(v) for k, v in marks.items()}
        yield sorted_, rows


def cut_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(documents with key, findings, number of document buckets): every run of starts whose strings are repeats."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mixed = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"), F.sum(F.octet_length("text")).alias("bytes"))
    mixed = stored(mixed)
    total = mixed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    several = mixed.where("lo != hi").select("doc_id", "lo")
    if several.isEmpty():
        keyed = rows.withColumn("key", F.col("doc_id"))
    else:
        keyed = rows.join(several, "doc_id", "left").select(
            "doc_id", "text", F.when(F.col("lo").isNull() | (F.col("lo") == F.xxhash64("text")), F.col("doc_id")).alias("key")
        )
    buckets = max(shuffle_width(spark), -(-total // BUCKET_BYTES))
    width = buckets

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for batch in slices(batches):
                yield from zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True)

        held, n = [], 0
        for part in anchored(texts()):
            held.append(part)
            n += len(part[0])
            if n >= FLUSH:
                yield _batch(list(_sent_anchors(held, width, buckets)))
                held, n = [], 0
        if n:
            yield _batch(list(_sent_anchors(held, width, buckets)))

    whole = keyed.where(F.col("key").isNotNull() & (F.octet_length("text") >= LENGTH)).select("key", F.col("text").cast("binary").alias("text"))
    found = stored(_meeting(whole.mapInArrow(send, PACKED), width, buckets))

    def contested(groups):
        def contexts(marks, key, text, out, strings):
            if CONTESTED in marks:
                start, n, place, h = marks[CONTESTED].of(key)
                for s, k, p, x in zip(start.tolist(), n.tolist(), place.tolist(), h.tolist(), strict=True):
                    out.append((key, s, k, p, x, text[s : s + k + LENGTH - 1]))
            if CROWDED in marks:
                start, n, _, _ = marks[CROWDED].of(key)
                if len(start):
                    begin = int(start.min())
                    data = np.frombuffer(text, np.uint8)[begin : int((start + n).max()) + LENGTH]
                    at = np.unique(np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int64)
                    plain = PrefixHashes(data).of(at - begin, at - begin + LENGTH)
                    turned = PrefixHashes(np.bitwise_xor(data, 0x5A)).of(at - begin, at - begin + LENGTH)
                    strings.append([scrambled(plain), scrambled(turned + U(1)), np.full(len(at), key, np.int64), at.astype(np.int32)])

        def close(out, strings):
            rows = []
            if out:
                doc, start, n, place, h = (np.array([r[i] for r in out], t) for i, t in enumerate((np.int64, np.int32, np.int16, np.int8, np.uint64)))
                home = _homes(h, buckets)
                order = np.argsort(home, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                    data = np.frombuffer(b"".join(out[i][5] for i in part.tolist()), np.uint8)
                    rows.append((int(home[part[0]]), CONTEXTS, pack(*[x[part] for x in (doc, start, n, place, h)], data)))
            if strings:
                rows += list(_sent_strings(strings, width, buckets))
            return _batch(rows)

        out, strings = [], []
        for marks, rows in _looked_up(groups):
            for _, key, text in rows:
                if key is not None and len(text) >= LENGTH:
                    contexts(marks, key, text, out, strings)
            if len(out) >= FLUSH // 8 or sum(len(s[0]) for s in strings) >= FLUSH:
                yield close(out, strings)
                out, strings = [], []
        yield close(out, strings)

    # a document's text may stand in several equal rows; one is enough here
    sent = _with_findings(keyed, found.where(F.col("kind") != SETTLED), width, contested, PACKED)
    more = stored(_meeting(sent, width, buckets))
    return keyed, found.where(F.col("kind") == SETTLED).union(more), width


def cut(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, spans) for each row; spans are the removed byte ranges."""
    keyed, findings, width = cut_spans(docs)

    def finish(groups):
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(span)]
        for marks, rows in _looked_up(groups):
            out = []
            for doc_id, key, text in rows:
                spans = []
                if key is not None and SETTLED in marks:
                    start, n, _, _ = marks[SETTLED].of(key)
                    order = np.argsort(start, kind="stable")
                    first, last = start[order].astype(np.int64), (start[order] + n[order] + LENGTH - 1).astype(np.int64)
                    if len(first):
                        last = np.maximum.accumulate(last)
                        new = np.concatenate(([True], first[1:] > last[:-1]))
                        begin = np.flatnonzero(new)
                        spans = list(zip(first[begin].tolist(), last[np.append(begin[1:], len(first)) - 1].tolist(), strict=True))
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((doc_id, len(text), len(text) - len(kept), len(spans), kept, [{"start": a, "end": b} for a, b in spans]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>"
    return _with_findings(keyed, findings, width, finish, schema)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document as the registered query returns it."""
    return cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
