"""Near duplicates by SimHash: fingerprints that are close meet at anchors.

near_duplicates links 64-bit fingerprints within a few bits; its anchors are the words of a
covering code, so every such pair meets. similar_groups links texts by the similarity of their
shingles; fingerprints of 1,024 bits stand for them, anchors are the axes of rotated blocks, and
the texts themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.llm.common import components, cut

SHINGLE = 4
THRESHOLD = 4
SEED = 42
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 18
#: Similar texts: words of a shingle, and shared shingles by all shingles of both from which on texts link.
WIDE_SHINGLE = 5
SIMILARITY = 0.8
#: Longs of a wide fingerprint. Of its 1,024 bits texts of similarity 0.8 differ in 155, with a
#: deviation of 11.5; of its first 64 in 9.7, with one of 2.9. Three and three and a half are let through.
WIDE = 16
MOST_BITS, MOST_FIRST = 190, 20
#: Rotations, each with two anchors of 512 that make a key. Texts of similarity 0.8 share a key with
#: probability 0.147, so that of 40 rotations none brings them together once in 580 pairs; at 0.9 once in 400,000.
ROTATIONS = 40
_BLOCK = 512
#: Texts under one key up to which all are paired at once.
FEW = 16
_TURN = np.random.default_rng(SEED).integers(0, 2, (ROTATIONS, _BLOCK)).astype(np.float32) * 2 - 1
_SPREAD = np.random.default_rng(SEED + 1).integers(1, 1 << 63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: First bit and width of the three parts of a fingerprint: of up to four differing bits, one
#: part at least holds one or none.
_PARTS = ((0, 21), (21, 21), (42, 22))
#: A part's low bits are a word of the perfect Hamming code of length 15, its other bits stand as they are.
_HAMMING = 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text; 0 where it has no words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[-n:] if len(words) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _CHUNK):
        hashes = np.array([digest(whole[s:e], SEED) for s, e in zip(first[lo : lo + _CHUNK], last[lo : lo + _CHUNK])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """Add the fingerprint as a long that holds the 64 bits."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([fingerprint(x if isinstance(x, str) else None, shingle) for x in texts], np.uint64)
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(name, run(F.col(text)))


def _part(fp: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def _pair_masks() -> list[list[int]]:
    """By syndrome: what two bits to flip to reach each code word at distance two."""
    return [
        [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, _HAMMING + 1) if s and i < (i ^ s)] for s in range(_HAMMING + 1)
    ]


def _anchors(fp: Column, part: int) -> tuple[Column, Column]:
    """The anchor within distance one of a part (the covering radius), and all within two (that
    radius and the one bit by which the part may differ)."""
    at, width = _PARTS[part]
    value = _part(fp, at, width)
    syndrome = F.lit(0)
    for j in range(4):
        mask = sum(1 << (i - 1) for i in range(1, _HAMMING + 1) if i >> j & 1)
        syndrome = syndrome + F.bit_count(value.bitwiseAND(F.lit(mask))) % 2 * (1 << j)
    single = F.element_at(F.array(F.lit(0), *[F.lit(1 << i) for i in range(_HAMMING)]), syndrome + 1)
    home = value.bitwiseXOR(single.cast("long"))
    pairs = F.element_at(F.array(*[F.array(*[F.lit(m) for m in row]).cast("array<long>") for row in _pair_masks()]), syndrome + 1)
    free = F.array(*[F.lit(1 << i).cast("long") for i in range(_HAMMING, width)])
    key = lambda c: c * len(_PARTS) + part
    near = F.concat(F.array(home), F.transform(pairs, lambda m: value.bitwiseXOR(m)), F.transform(free, lambda m: home.bitwiseXOR(m)))
    return key(home), F.transform(near, key)


def _star_links(nodes: DataFrame, threshold: int) -> DataFrame:
    """Cheap first links: each fingerprint with the smallest one that has an equal part."""
    keyed = nodes.select("fp", F.explode(F.array(*[_part(F.col("fp"), a, w) * len(_PARTS) + i for i, (a, w) in enumerate(_PARTS)])).alias("key"))
    centres = cut(keyed.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return keyed.join(centres, "key").where((F.col("fp") != F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= threshold)).select(F.col("fp").alias("a"), "b")


def covering_links(nodes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of groups that hold fingerprints within the threshold; nodes: fp, group.

    Each fingerprint is at home at the one anchor within the covering radius, and is replicated
    to every anchor within that radius plus what its part may differ by; only those that meet at
    an anchor are compared. A pair inside one group is known already and is not returned, so a
    large group of copies costs comparisons but no rows.
    """
    if threshold > THRESHOLD:
        raise ValueError("three parts of a fingerprint cover four differing bits at most")
    fp = F.col("fp")
    homes = nodes.select("group", "fp", F.explode(F.array(*[_anchors(fp, p)[0] for p in range(len(_PARTS))])).alias("key"))
    replicas = nodes.select(F.col("group").alias("other"), fp.alias("near"), F.explode(F.concat(*[_anchors(fp, p)[1] for p in range(len(_PARTS))])).alias("key"))
    return (
        replicas.join(homes, "key")
        .where((F.col("near") > F.col("fp")) & (F.col("group") != F.col("other")) & (F.bit_count(F.col("near").bitwiseXOR(F.col("fp"))) <= threshold))
        .select(F.col("group").alias("a"), F.col("other").alias("b"))
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row (doc_id, fp, component_id) for each row of docs.

    Fingerprints within the threshold link; component_id is the smallest doc_id reachable. Texts
    that are null, empty or without words have fingerprint 0, linked like any other. Rows with a
    null doc_id are linked too and never name a component unless all ids in it are null. Repeated
    rows stay.
    """
    prints = cut(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", shingle).select("doc_id", "fp"))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    first = cut(components(_star_links(nodes, threshold)))
    grouped = cut(nodes.join(first, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("group")))
    second = components(cut(covering_links(grouped.select("fp", "group"), threshold).distinct()))
    joined = grouped.join(second, F.col("group") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "group").alias("group"))
    joined = cut(joined)
    names = cut(joined.groupBy("group").agg(F.min("least").alias("component_id")))
    named = cut(joined.join(names, "group").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str | None, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a whole text in order: words without ASCII white
    space, letters A-Z lowered; a shorter text is one shingle, one without words none."""
    words = text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1) if words else 0
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)), np.uint64, n))


def copy_key(text: str) -> Column:
    """One key for all texts of the same words, so of the same shingles."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.md5(F.trim(F.regexp_replace(lowered, r"[ \t\n\x0B\f\r]+", " ")).cast("binary"))


def _wide_sums(hashes: np.ndarray) -> np.ndarray:
    """For each bit of a wide fingerprint, by how many the shingles with a one outnumber the others."""
    ones = np.zeros(64 * WIDE, np.int64)
    for lo in range(0, len(hashes), 4096):
        h = hashes[lo : lo + 4096, None] * _SPREAD
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        ones += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return (2 * ones - len(hashes)).astype(np.float32)


def _rotated(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row."""
    n, size = x.shape
    step = 1
    while step < size:
        y = x.reshape(n, size // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return x


def anchor_keys(sums: np.ndarray) -> np.ndarray:
    """A key for each rotation of each row: the nearest of the 512 signed axes of each half of a
    block. Blocks are the halves of the sums in turn, with signs of their own."""
    keys = np.empty((len(sums), ROTATIONS), np.int32)
    half = _BLOCK // 2
    for v in range(ROTATIONS):
        block = v % 2 * _BLOCK
        turned = _rotated(sums[:, block : block + _BLOCK] * _TURN[v]).reshape(-1, 2, half)
        at = np.abs(turned).argmax(axis=2)
        axis = 2 * at + (np.take_along_axis(turned, at[:, :, None], axis=2)[:, :, 0] < 0)
        keys[:, v] = (v << 18) + axis[:, 0] * _BLOCK + axis[:, 1]
    return keys


def _wide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        out: list[tuple] = []
        for lo in range(0, len(texts), 128):
            sets = [shingle_set(t) for t in texts.iloc[lo : lo + 128]]
            sums = np.stack([_wide_sums(h) for h in sets])
            prints = np.packbits(sums > 0, axis=1).view(np.int64)
            out += zip(map(len, sets), list(prints), list(anchor_keys(sums)))
        yield pd.DataFrame(out, columns=["n", "fp", "keys"])


def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    def of(x: str | None, y: str | None) -> bool:
        x, y = shingle_set(x), shingle_set(y)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= SIMILARITY * (len(x) + len(y) - both)

    return pd.Series([of(x, y) for x, y in zip(a, b)], dtype=bool)


def _apart(longs: range) -> Column:
    """Bits in which these longs of the fingerprints of x and y differ."""
    return sum((F.bit_count(F.col(f"x.f{i}").bitwiseXOR(F.col(f"y.f{i}"))) for i in longs), F.lit(0))


def _sizes_allow() -> Column:
    return F.least("x.n", "y.n") >= SIMILARITY * F.greatest("x.n", "y.n")


def _texts(ids: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """A text (id, text) for each of the distinct ids."""
    return docs.select("copy", "text").join(nodes.select("id", "copy").join(ids, "id"), "copy").dropDuplicates(["id"]).select("id", "text")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts have the similarity."""
    pairs = cut(pairs.select("a", "b").distinct())
    texts = cut(_texts(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), nodes, docs))
    sides = [texts.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"]
    return cut(pairs.join(sides[0], "a").join(sides[1], "b").where(F.pandas_udf(_similar, "boolean")("text_a", "text_b")).select("a", "b"))


def _sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingle_set(t).view(np.int64) for t in texts], index=texts.index, dtype=object)


def _linked(rest: DataFrame, may: Column, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) under one key whose texts have the similarity, of those for which may holds;
    rest: key, x (id, ...); may is symmetric in x and y and false for a text with itself.

    A text that may have a partner comes to the keys where it may with its whole set of shingles,
    and the join decides by the sets: what does not link makes no row, however many texts are almost
    alike, and a pair is decided at the first of the keys that it shares.
    """
    other = rest.select(F.col("key").alias("at"), F.col("x").alias("y"))
    rows = cut(rest.join(other, (F.col("key") == F.col("at")) & may, "left_semi"))
    keys = rows.groupBy("x.id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    sets = _texts(keys.select("id"), nodes, docs).select("id", F.pandas_udf(_sets, "array<long>")("text").alias("set"))
    whole = cut(rows.join(cut(keys.join(sets, "id")), F.col("x.id") == F.col("id")).select("key", "x", "keys", "set"))
    other = whole.select(F.col("key").alias("at"), F.col("x").alias("y"), F.col("keys").alias("other_keys"), F.col("set").alias("other_set"))
    first = F.get(F.array_intersect("keys", "other_keys"), F.lit(0)) == F.col("key")
    both = F.size(F.array_intersect("set", "other_set"))
    # shared >= SIMILARITY * (all - shared) in whole numbers, whatever the rounding of the share
    alike = both >= SIMILARITY / (1 + SIMILARITY) * (F.size("set") + F.size("other_set")) - 1e-6
    decided = F.when((F.col("x.id") < F.col("y.id")) & may, F.when(first, alike).otherwise(False)).otherwise(False)
    return cut(whole.join(other, (F.col("key") == F.col("at")) & decided).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups (id, group) after links (a, b) between their members."""
    ends = [groups.select(F.col("id").alias(s), F.col("group").alias(f"g{s}")) for s in "ab"]
    found = components(links.join(ends[0], "a").join(ends[1], "b").select(F.col("ga").alias("a"), F.col("gb").alias("b")))
    return cut(groups.join(found, F.col("group") == F.col("node"), "left").select("id", F.coalesce("component", "group").alias("group")))


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in two groups."""
    ends = [groups.select(F.col("id").alias(s), F.col("group").alias(f"g{s}")) for s in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").where("ga <> gb")


def similar_groups(docs: DataFrame) -> DataFrame:
    """One row (copy, group) for each distinct copy of docs (copy, text, ...).

    Texts of similarity SIMILARITY or more link, and group is what links reach. Fingerprints meet
    at the anchors nearest to them. Under a key of few texts all are paired, under others each with
    one of them; of what the fingerprints allow, the closest pair of each text is decided first by
    the whole sets of shingles, then what still lies in two groups. In the end all texts are compared
    under the keys of many texts that hold several groups, and only what links makes a row: texts that
    are almost similar cost comparisons, but no rows, and none is left out. Texts without words are alike.
    """
    longs = range(WIDE)
    nodes = cut(
        docs.select("copy", F.pandas_udf(_wide, "n long, fp array<long>, keys array<int>")("text").alias("w")).groupBy("copy").agg(F.first("w").alias("w"))
        .select(F.monotonically_increasing_id().alias("id"), "copy", "w.n", *[F.get("w.fp", F.lit(i)).alias(f"f{i}") for i in longs], "w.keys")
    )
    prints = nodes.select("id", "n", *[f"f{i}" for i in longs])
    keyed = cut(nodes.select(F.explode("keys").alias("key"), F.struct("id", "n", "f0").alias("x")))
    hot = cut(
        keyed.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("x.id"), "x")).alias("least")).where(F.col("size") > FEW)
        .select("key", F.col("least.x").alias("y"))
    )
    near = (F.bit_count(F.col("x.f0").bitwiseXOR(F.col("y.f0"))) <= MOST_FIRST) & _sizes_allow()
    few, many = keyed.join(hot, "key", "left_anti"), cut(keyed.join(hot, "key"))
    pairs = few.join(few.withColumnRenamed("x", "y"), "key").where((F.col("x.id") < F.col("y.id")) & near)
    pairs = pairs.select("x.id", F.col("y.id").alias("other")).unionByName(many.where((F.col("x.id") != F.col("y.id")) & near).select("x.id", F.col("y.id").alias("other"))).distinct()
    bits = _apart(longs)
    close = cut(
        pairs.join(prints.select("id", F.struct("n", *[f"f{i}" for i in longs]).alias("x")), "id")
        .join(prints.select(F.col("id").alias("other"), F.struct("n", *[f"f{i}" for i in longs]).alias("y")), "other")
        .select(F.col("id").alias("a"), F.col("other").alias("b"), bits.alias("bits")).where(F.col("bits") <= MOST_BITS)
    )
    best = close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "bits")).groupBy("a").agg(F.min(F.struct("bits", "b")).alias("m"))
    alone = nodes.select("id", F.col("id").alias("group"))
    groups = _joined(alone, _verified(best.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")), nodes, docs))
    groups = _joined(groups, _verified(_across(close, groups), nodes, docs))
    # a text meets its group and fingerprint once, with all its keys (ROTATIONS at most), not once under each
    held = cut(many.groupBy("x.id").agg(F.collect_list("key").alias("hot")).join(groups, "id"))
    several = held.select(F.explode("hot").alias("key"), "group").groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least <> most").select("key")
    rest = held.join(prints, "id").select(F.explode("hot").alias("key"), F.struct("id", "group", "n", *[f"f{i}" for i in longs]).alias("x"))
    rest = cut(rest.join(several, "key"))
    groups = _joined(groups, _linked(rest, (F.col("x.group") != F.col("y.group")) & near & (bits <= MOST_BITS), nodes, docs))
    return groups.join(nodes.select("id", "copy"), "id").select("copy", "group")
