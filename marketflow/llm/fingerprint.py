"""Document fingerprints: a Merkle tree over sections, paragraphs and their leaves.

A section begins at a heading (a line that starts with #), after a blank line, and after a paragraph whose hash ends
in four zero bits, so that long texts without headings branch too. A paragraph is a line. Its leaves are sentences;
what runs on is cut every LEAF characters from the sentence's start (the first LEAF characters of a text every FINE). A leaf's hash covers its characters, a
paragraph's the hashes of its leaves, a section's those of its paragraphs, the root's those of its sections. Equal
texts have equal roots, and where roots differ, the differing branches locate the edit (`changed`).

A fingerprint is text: root, then sections between `;`, paragraphs between `,`, eight hex digits for each leaf. The
likeness of two fingerprints is the share of leaves that they have in common, 2 * common / (both), as multisets; it
is 1 only for equal roots. Two empty texts are alike.

`with_edits` compares each text with an edited one, whose last quarter of code points is replaced by the beginning of
the next document by ascending doc_id (after the last: the first). The next document is found without a global
window: documents are dealt into ranges whose lower bounds are doc_ids that exist, and the first document of each
range is dealt to the range before as well. Rows that repeat a doc_id follow in text order, nulls first. Null texts
count as empty. Rows without doc_id come before all others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import shuffle_width

LEAF = 32
FINE = 4
_SENTENCE = re.compile(r"[^.!?;:|]*[.!?;:|]+\s*|[^.!?;:|]+")


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def leaves(paragraph: str) -> list[str]:
    """Sentences, cut every LEAF characters."""
    out = []
    for s in _SENTENCE.findall(paragraph):
        out += [s] if len(s) <= LEAF else [s[i : i + LEAF] for i in range(0, len(s), LEAF)]
    return out


def first_leaves(paragraph: str) -> list[str]:
    """Of a text's first paragraph the first LEAF characters are cut every FINE, so that short texts compare by degrees."""
    return [paragraph[i : i + FINE] for i in range(0, min(LEAF, len(paragraph)), FINE)] + leaves(paragraph[LEAF:])


def tree(text: str) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, list[bytes]]]]]]:
    """(root, sections), a section being (hash, paragraphs) and a paragraph (hash, leaves)."""
    sections: list[list] = []
    fresh = True
    for i, line in enumerate(text.split("\n") if text else []):
        found = [_hash(s.encode("utf-8", "surrogatepass")) for s in (leaves(line) if i else first_leaves(line))]
        paragraph = (_hash(b"p" + b"".join(found)), found)
        if fresh or line.startswith("#"):
            sections.append([])
        sections[-1].append(paragraph)
        fresh = not line.strip() or paragraph[0][0] & 15 == 0
    closed = [(_hash(b"s" + b"".join(p[0] for p in s)), s) for s in sections]
    return _hash(b"r" + b"".join(s[0] for s in closed)), closed


def encode(root: bytes, sections) -> str:
    inner = ";".join(",".join("".join(h[:4].hex() for h in p[1]) for p in s[1]) for s in sections)
    return f"{root.hex()}:{inner}"


def fingerprint(text: str | None) -> str:
    return encode(*tree(text or ""))


def _bag(inner: str) -> Counter:
    return Counter(p[i : i + 8] for s in inner.split(";") for p in s.split(",") for i in range(0, len(p), 8))


def likeness(a: str, b: str) -> float:
    """Share of common leaves of two fingerprints, 0 to 1."""
    (root_a, _, x), (root_b, _, y) = a.partition(":"), b.partition(":")
    if root_a == root_b:
        return 1.0
    p, q = _bag(x), _bag(y)
    both = p.total() + q.total()
    common = sum(min(n, q[h]) for h, n in p.items() if h in q)
    return min(2 * common / both, 1 - 1 / (both + 1)) if both else 0.0


def changed(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of each paragraph of the first text that the second does not have."""
    known = {p for s in b.partition(":")[2].split(";") for p in s.split(",")}
    sections = a.partition(":")[2].split(";")
    return [(i, j) for i, s in enumerate(sections) for j, p in enumerate(s.split(",")) if p not in known]


def with_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = shuffle_width(spark)
    places = F.percentile_approx("doc_id", [i / width for i in range(1, width)], 10 * width) if width > 1 else F.array()
    stats = rows.agg(places.alias("bounds"), F.min("doc_id").alias("least"), F.count(F.when(F.isnull("doc_id"), 1)).alias("nulls")).first()
    bounds = np.array(sorted(set(stats.bounds or []) - {stats.least}), np.int64)  # lower bounds of ranges 1, 2, ...
    last = len(bounds)
    first_id = None if stats.nulls else stats.least

    @F.arrow_udf("array<struct<bucket:int,ahead:boolean>>")
    def dealt(ids: pa.Array) -> pa.Array:
        out = []
        for i in ids.to_pylist():
            home = 0 if i is None else int(np.searchsorted(bounds, i, side="right"))
            targets = [{"bucket": home, "ahead": False}]
            if home and i == bounds[home - 1]:
                targets.append({"bucket": home - 1, "ahead": True})
            if i == first_id:
                targets.append({"bucket": last, "ahead": True})
            out.append(targets)
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int32()), ("ahead", pa.bool_())])))

    placed = rows.withColumn("to", F.explode(dealt("doc_id")))
    # An `ahead` row comes after all rows of its range; in the last range the first document of all does.
    order = ["bucket", "ahead", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ranged = placed.select("to.bucket", "to.ahead", "doc_id", "text").repartitionByRange(width, "bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        held = None  # the row that waits for the next one
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")]
            for bucket, ahead, doc_id, text in zip(*columns, strict=True):
                if held is not None and held[0] != bucket:
                    held = None
                if ahead and held is None:
                    continue
                text = text or ""
                mark = fingerprint(text)
                if held is not None:
                    _, before, old, old_mark = held
                    n = len(old)
                    cut = n // 4
                    edited = old[: n - cut] + text[:cut]
                    edited_mark = fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, n, digest, old_mark, edited_mark, likeness(old_mark, edited_mark), likeness(old_mark, mark)))
                held = None if ahead else (bucket, doc_id, text, mark)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ranged.mapInArrow(run, schema)
