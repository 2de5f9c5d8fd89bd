"""Document fingerprints: a digest of how often hashed triplets of bytes occur, and its likeness to others.

Every window of five bytes gives six triplets that begin with its first byte; each counts in one of
256 buckets. A bucket is told by the quarter of all buckets that it lies in, two bits, and the
length by one byte. Two digests differ by the steps between their buckets, against what buckets in
chance order would differ by: likeness is 1 for equal digests and 0 for unrelated ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.llm.common import cut

BUCKETS, WINDOW = 256, 5
#: Places in a window that stand beside its first byte in a triplet.
PAIRS = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))
#: A triplet's hash is the upper byte of this sum, modulo 2^16: a multiplier for each place, and one for the pair's number.
MULTIPLIERS, PAIR = (40503, 25717, 60493), 9973
#: What one, two and three quarters between two buckets count.
STEPS = np.array([0, 1, 2, 6])
#: Steps of length, four to a doubling, that make a difference of one.
LENGTHS = 64
#: Bytes of a text whose triplets are counted at once.
_CHUNK = 1 << 18
_WEIGHTS = np.array([[STEPS[abs(i - j)] for j in range(4)] for i in range(4)])


def bucket_counts(text: bytes) -> np.ndarray:
    """Triplets in each bucket. A text of one to four bytes is filled up with zeros; an empty one has none."""
    if text and len(text) < WINDOW:
        text = text.ljust(WINDOW, b"\0")
    b = np.frombuffer(text, np.uint8)
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(b) - WINDOW + 1), _CHUNK):
        part = b[at : at + _CHUNK + WINDOW - 1].astype(np.uint16)
        n = len(part) - WINDOW + 1
        first, second, third = (part * np.uint16(m) for m in MULTIPLIERS)
        sums = [first[:n] + second[j : j + n] + third[k : k + n] + np.uint16(i * PAIR % 65536) for i, (j, k) in enumerate(PAIRS)]
        out += np.bincount(np.concatenate(sums) >> np.uint16(8), minlength=BUCKETS)
    return out


def length_code(n: int) -> int:
    """Four codes for each doubling of a length in bytes; 0 for none."""
    if not n:
        return 0
    doublings = n.bit_length() - 1
    return 1 + 4 * doublings + ((n << 2 >> doublings) & 3)


def fingerprint(text: str | None) -> str:
    """130 hexadecimal digits: length, then two bits for each bucket. Null is empty."""
    data = (text or "").encode("utf-8", "replace")
    counts = bucket_counts(data)
    low, middle, high = np.sort(counts)[[63, 127, 191]]
    codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    four = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return f"{length_code(len(data)):02x}{four.astype(np.uint8).tobytes().hex()}"


def _codes(digest: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(digest[2:]), np.uint8)
    return (packed[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for those that differ by as much as chance or more."""
    if a == b:
        return 1.0
    x, y = _codes(a), _codes(b)
    steps = int(STEPS[np.abs(x.astype(int) - y)].sum())
    chance = int(np.bincount(x, minlength=4) @ _WEIGHTS @ np.bincount(y, minlength=4))
    apart = BUCKETS * steps / chance if chance else 1.0
    return 1.0 - min(1.0, apart + abs(int(a[:2], 16) - int(b[:2], 16)) / LENGTHS)


def fingerprints(texts: Column) -> Column:
    """Digests of a column of texts."""

    def each(column: pd.Series) -> pd.Series:
        return column.map(fingerprint)

    return F.pandas_udf(each, "string")(texts)


def likenesses(a: Column, b: Column) -> Column:
    """Likeness of two columns of digests; null where one is."""

    def each(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(p, q) if isinstance(p, str) and isinstance(q, str) else None for p, q in zip(x, y)], dtype=float)

    return F.pandas_udf(each, "double")(a, b)


def edited(text: str, after: str) -> str:
    """A text whose last quarter gives way to as much of the beginning of the next one."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


_MEASURED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _measured(text: str, digest: str, after: str, after_digest: str) -> tuple:
    other = edited(text, after)
    other_digest = digest if other == text else fingerprint(other)
    return len(text), hashlib.sha256(other.encode("utf-8", "replace")).hexdigest(), digest, other_digest, likeness(digest, other_digest), likeness(digest, after_digest)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def fingerprint_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's digest beside that of its edited text and that of the next document.

    Documents follow each other by id, null ids first; those of one id by a hash of their texts, and
    repeated rows one after the other. The next of the last is the first. Null texts are empty; one
    document is its own next; no documents, no rows. Other columns are passed over.

    One shuffle sorts all by ranges. A task reads its range as a stream, one document behind; only
    the first and the last document of each range are written with their texts, and meet afterwards.
    """
    kind = docs.schema[id].dataType
    # ids that very many rows share are dealt by hash of text, and equal rows by their places
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("place")]
    sorted_ = (
        docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("id", "text", F.spark_partition_id().alias("range"))
    )
    schema = f"id {kind.simpleString()}, range int, edge int, text string, {_MEASURED}"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, types = None, None
        for batch in batches:
            types = types or pa.schema([("id", batch.schema.field("id").type), ("range", pa.int32()), ("edge", pa.int32()), ("text", pa.string()), ("n_chars", pa.int64()), *((n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
            out = []
            for i in range(batch.num_rows):
                key, said, place = (batch.column(c)[i].as_py() for c in range(3))
                digest = fingerprint(said)
                if before is None:
                    out.append((key, place, 1, said, None, None, digest, None, None, None))
                else:
                    out.append((before[0], place, 0, None, *_measured(before[1], before[2], said, digest)))
                before = (key, said, digest, place)
            if out:
                yield _table(out, types)
        if before is not None:
            yield _table([(before[0], before[3], 2, before[1], None, None, before[2], None, None, None)], types)

    found = cut(sorted_.mapInArrow(measure, schema))
    ranges = sorted(r["range"] for r in found.where("edge = 1").select("range").collect())  # at most one row a task
    columns = [c.split()[0] for c in _MEASURED.split(", ")]
    done = found.where("edge = 0").select(F.col("id").alias(id), *columns)
    if not ranges:
        return done
    after = docs.sparkSession.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1])), "range int, next int")
    firsts = found.where("edge = 1").select(F.col("range").alias("next"), F.col("text").alias("after"), F.col("fingerprint").alias("after_digest"))
    pairs = found.where("edge = 2").select("id", "range", "text", "fingerprint").join(after, "range").join(firsts, "next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, *_measured(*rest)) for key, *rest in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield _table(rows, pa.schema([("id", batch.schema.field("id").type), *((n, pa.int64() if n == "n_chars" else pa.float64() if n.startswith("near") else pa.string()) for n in columns)]))

    last = pairs.select("id", "text", "fingerprint", "after", "after_digest").mapInArrow(finish, f"id {kind.simpleString()}, {_MEASURED}")
    return done.unionByName(last.withColumnRenamed("id", id))
