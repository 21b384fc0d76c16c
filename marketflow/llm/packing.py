"""Best-fit packing: documents as token ids, cut at the sequence length and packed with few open bins.

Tokens: the tokenizer's pattern never reaches across blanks, so a text is cut there and each distinct chunk is encoded
once. A lower-case word of ASCII and Latin-1 letters, with or without one stop behind it, goes straight to the
tokenizer's model; all other chunks go through the whole tokenizer (tested against whole texts). `END` follows each document. A document of more than `length` ids is cut into
pieces of `length`; its last piece may be shorter. Other documents are one piece.

Packing is bounded-space online best-fit. Pieces are dealt to tasks of about `PER_TASK` by a hash, so that every task
meets the same mixture of sizes, and arrive in the order of that hash, the longest of each `WINDOW` first. Open bins
are kept by free space: bit f of an integer is set if a bin with f free places is open, so the tightest bin that holds
a piece is the lowest set bit at or above its length. If nothing holds it, a new bin opens; if `OPEN_BINS` are open
already, the fullest closes first. A task ends with a few bins partly filled, which is all that is lost; the number of
tasks follows from the number of pieces. A repeated task gives the same bins.

Only lengths and places are shuffled unless `with_ids` is asked for, which `sequences` needs. Null and empty texts are
the end token alone. Every row is packed, also rows that repeat a doc_id or have none. Columns other than doc_id and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import stored

LENGTH = 4096  # ids in a sequence
END = 1  # id after each document
OPEN_BINS = 2048
WINDOW = 4096  # pieces that arrive together, longest first
PER_TASK = 16384  # pieces a task packs, about
CHUNKS = 1_000_000  # chunks a worker remembers; beyond that it forgets them all and starts again
LATIN = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]  # lower-case letters of two bytes, C3 9F to C3 BF

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STOPS = b".,;:!?"
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


class Encoder:
    """Ids of whole texts, by chunks. A chunk is known by a number; its ids stand at that place of a flat array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in LATIN}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def __call__(self, texts: list[bytes | None], end: int = END) -> list[np.ndarray]:
        """The ids of each text and the end token, as little-endian 32-bit numbers."""
        return [self._encoded(t or b"", end) for t in texts]

    def _encoded(self, text: bytes, end: int) -> np.ndarray:
        if len(self.known) > CHUNKS or len(self.ids) > 8 * CHUNKS:
            self._forget()
        chunks = text.translate(_LOWER).split()
        self._learn(set(chunks).difference(self.known))
        number = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        ends = np.frombuffer(self.ends, np.int64)
        start, size = ends[number], ends[number + 1] - ends[number]
        last = np.cumsum(size)
        n = int(last[-1]) if len(last) else 0
        out = np.full(n + 1, end, "<u4")
        if n:
            out[:n] = np.frombuffer(self.ids, np.uint32)[np.repeat(start - last + size, size) + np.arange(n)]
        return out

    def _learn(self, chunks: set[bytes]) -> None:
        """Give numbers to new chunks and append their ids."""
        odd = []
        for c in chunks:
            word = c[:-1] if c[-1] in _STOPS else c
            if _PLAIN.fullmatch(word):
                text = word.decode()
                ids = [t.id for t in self.model.tokenize(text if word.isascii() else text.translate(self.letters))]
                if len(word) < len(c):
                    ids += [t.id for t in self.model.tokenize(chr(c[-1]))]
                self._add(c, ids)
            else:
                odd.append(c)
        encoded = self.tokenizer.encode_batch([c.decode("utf-8", "replace") for c in odd], add_special_tokens=False)
        for c, e in zip(odd, encoded, strict=True):
            self._add(c, e.ids)

    def _add(self, chunk: bytes, ids: list[int]) -> None:
        self.known[chunk] = len(self.known)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))


_ENCODERS: dict[str, Encoder] = {}  # of this worker process


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on demand, the ids of every piece. `path` names a tokenizer file."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    added = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    added |= {"ids": pa.list_(pa.int32())} if with_ids else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from marketflow.llm.packing import encoder

        encode = encoder(path)
        for batch in batches:
            row, cuts = [], []
            for i, ids in enumerate(encode(batch.column("text").to_pylist())):
                for piece, start in enumerate(range(0, len(ids), length)):
                    cut = ids[start : start + length]
                    row.append(i)
                    cuts.append((piece, start, len(cut), zlib.crc32(cut.tobytes()), *([cut.astype(np.int32)] if with_ids else [])))
            columns = list(zip(*cuts, strict=True)) or [()] * len(added)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(list(c), t) for c, t in zip(columns, added.values(), strict=True))],
                ["doc_id", *added],
            )

    types = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(run, types)


class Bins:
    """Open bins by free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.open, self.mask, self.made = length, most, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """Number and offset of the bin that takes an item."""
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            free, found = self.length, self.made
            self.made += 1
        if free > size:
            self.bins[free - size].append(found)
            self.mask |= 1 << (free - size)
            self.open += 1
        return found, self.length - free

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        found = stack.pop()
        self.open -= 1
        if not stack:
            self.mask &= ~(1 << free)
        return found


def packed(cut: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, per_task: int = PER_TASK) -> DataFrame:
    """Pieces with `sequence_id` and `offset`. `cut` must be stored: it is counted before it is packed."""
    tasks = max(1, -(-cut.count() // per_task))
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.repartition(tasks, mixed).sortWithinPartitions(mixed, "doc_id", "piece", "ids_crc32", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, first = Bins(length, open_bins), TaskContext.get().partitionId() << 40
        for window in _windows(batches):
            sizes = window.column("length").to_numpy()
            places = np.empty((len(sizes), 2), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                places[i] = bins.place(int(sizes[i]))
            added = [pa.array(places[:, 0] + first), pa.array(places[:, 1])]
            yield pa.RecordBatch.from_arrays([*window.columns, *added], [*window.schema.names, "sequence_id", "offset"])

    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return dealt.mapInArrow(run, T.StructType([*cut.schema.fields, *added]))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of WINDOW rows, whatever the batch size of the session."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, WINDOW - rows)
            held, rows, batch = [*held, part], rows + part.num_rows, batch.slice(part.num_rows)
            if rows == WINDOW:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def pack(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place; the pieces are stored once, as they are counted and packed."""
    return packed(stored(pieces(docs, path, length, with_ids)), length)


def sequences(places: DataFrame) -> DataFrame:
    """sequence_id and its ids, for training; `places` comes from `pack` with ids. A group holds one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return places.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
