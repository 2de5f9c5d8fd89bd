"""Queries of the text operators on empty tables and against brute force."""

import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from questlog.llm import langid, quality, queries, simhash

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int", "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_every_query_on_empty_tables(spark, empty, name):
    found = queries.QUERIES[name](spark, empty)
    rows = found.collect()
    # the conversation that op3 adds itself is all there is
    assert [r["conv_id"] for r in rows] == ([-7] if name.startswith("op3") else []) and found.columns


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_of_the_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(["ba", "Ko", "ti", "é", "ru"], 3))
    texts = [None, "", " \n", "one", "One", "a b c", "A  b\tc d", "x" * 5000, "repeat again " * 400]
    for _ in range(25):
        base = [word() for _ in range(int(rng.integers(30, 400)))]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 6):
            other = list(base)
            for at in rng.integers(0, len(base), edits):
                other[at] = word()
            texts.append("  ".join(other))
    rows = [(i * 3 + 5, t, None, None, None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, TABLES["documents"]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    prints = {i: simhash_of(t) for i, t, *_ in rows}
    group = {i: i for i in prints}
    while True:
        new = {i: min(group[j] for j in prints if bin(prints[i] ^ prints[j]).count("1") <= 4) for i in prints}
        if new == group:
            break
        group = new
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op10_simhash_near_dedup"](spark, str(tmp_path)).collect()}
    assert got == {i: (f"{prints[i]:016x}", group[i]) for i in prints}
    assert len(set(group.values())) < len(set(prints.values()))


def test_network_is_a_plain_convolution():
    """Every filter over every place of the whole text, chunk by chunk, without look-ups or padding tricks."""
    rng = np.random.default_rng(3)
    filters, width = quality.FILTERS, quality.WIDTH
    net = quality.Network(
        rng.normal(size=(width, 256, filters)).astype(np.float32), rng.normal(size=filters).astype(np.float32), rng.normal(size=(2 * filters, 8)).astype(np.float32),
        rng.normal(size=8).astype(np.float32), rng.normal(size=8).astype(np.float32), 0.3,
    )
    texts = [None, "", "a", "short text", "é" * 300, "x" * quality.CHUNK, "y" * (quality.CHUNK + width - 1), "z" * (quality.CHUNK + width), "".join(map(chr, rng.integers(32, 900, 3000)))]

    def plain(text):
        data = (text or "").encode()
        places = max(1, len(data) - width + 1)
        data = data.ljust(-(-places // quality.CHUNK) * quality.CHUNK + width - 1, b"\0")
        tops = []
        for at in range(0, places, quality.CHUNK):
            each = [sum(net.taps[j, data[p + j]] for j in range(width)) for p in range(at, at + quality.CHUNK)]
            tops.append(np.tanh(np.max(each, axis=0) + net.bias))
        x = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0)])
        return 1 / (1 + np.exp(-(np.tanh(x @ net.weight + net.offset) @ net.out + net.last)))

    assert np.allclose(quality.score(net, texts), [plain(t) for t in texts], atol=1e-4)


def test_language_sample_is_of_whole_rows(spark):
    """At most so many rows of each language, whole, copies once, long ones last."""
    rng = np.random.default_rng(2)
    make = lambda parts, n: " ".join("".join(rng.choice(parts, 3)) for _ in range(n))
    aa, bb = ["ba", "ko", "ti"], ["schw", "ung", "ö"]
    rows = [("aa", make(aa, 60)) for _ in range(200)] + [("aa", "copy of a text")] * 500 + [("aa", make(aa, 20_000))] + [("bb", make(bb, 9_000))] + [("cc", ""), ("cc", None), (None, "none")]
    df = spark.createDataFrame([(i, t, k, None, None) for i, (k, t) in enumerate(rows)], TABLES["documents"])
    taken = {}
    kept, langid.train = langid.train, lambda samples: taken.update(samples)
    try:
        langid.fit(df, sample_rows=5)
        first = dict(taken)
        langid.fit(df.repartition(7), sample_rows=5)
    finally:
        langid.train = kept
    assert taken == first and set(taken) == {"aa", "bb"}
    texts = taken["aa"].split("\n")
    assert len(texts) == 5 == len(set(texts)) and set(texts) <= {t for k, t in rows if k == "aa"} and max(map(len, texts)) < langid.LONG_ROW
    assert taken["bb"] == rows[-4][1]  # the only one, however long


def test_unknown_long_texts_stay(spark, tmp_path):
    """A language that nobody labelled is parsed as badly as noise, and is not dropped for it."""
    rng = np.random.default_rng(5)
    make = lambda parts, n: " ".join("".join(rng.choice(parts, 3)) for _ in range(n))
    rows = [(i, make(["ba", "ko", "ti"], 80), "aa", None, None) for i in range(20)] + [(100, "".join(map(chr, rng.integers(0x3041, 0x3090, 4000))), None, None, None), (101, "12 34 !", None, None, None), (102, None, None, None, None)]
    got = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, TABLES["documents"]), str(tmp_path))
    assert {r["doc_id"] for r in got.collect()} == {*range(20), 100}


def similar(a, b):
    x, y = simhash.shingle_set(a), simhash.shingle_set(b)
    both = len(np.intersect1d(x, y))
    return both >= simhash.SIMILARITY * (len(x) + len(y) - both)


def test_groups_of_similar_texts_at_the_threshold(spark):
    """Pairs of similarity just above 0.8, the hardest; nearly all are found, and none below."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(["ba", "ko", "ti", "ru", "le", "mi"], 4))
    pairs = []
    while len(pairs) < 250:
        base = [word() for _ in range(int(rng.integers(120, 400)))]
        other = list(base)
        for at in rng.choice(np.arange(5, len(base) - 5, 6), max(1, round(len(base) * rng.uniform(0.018, 0.026))), replace=False):
            other[at] = word()
        if similar(" ".join(base), " ".join(other)):
            pairs.append((" ".join(base), " ".join(other)))
    texts = [t for p in pairs for t in p]
    df = spark.createDataFrame([(f"{i:04d}", t) for i, t in enumerate(texts)], "copy string, text string")
    group = {int(r["copy"]): r["group"] for r in simhash.similar_groups(df).collect()}
    found = sum(group[2 * i] == group[2 * i + 1] for i in range(len(pairs)))
    assert len(group) == len(texts) and found >= 0.97 * len(pairs)
    assert len(set(group.values())) >= len(pairs)  # no two bases have come together
