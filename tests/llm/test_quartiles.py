import hashlib

from questlog.llm import quartiles, queries

SCHEMA = "doc_id long, text string, n_chars long, fingerprint string, range int"


def brute(text):
    """The digest by its definition, triplet by triplet."""
    data = (text or "").encode()
    data = data.ljust(5, b"\0") if data and len(data) < 5 else data
    counts = [0] * 256
    for i in range(len(data) - 4):
        for n, (j, k) in enumerate(quartiles.PAIRS):
            m = quartiles.MULTIPLIERS
            counts[(data[i] * m[0] + data[i + j] * m[1] + data[i + k] * m[2] + n * quartiles.PAIR) % 65536 // 256] += 1
    q = sorted(counts)
    codes = [(c > q[63]) + (c > q[127]) + (c > q[191]) for c in counts]
    return f"{quartiles.length_code(len((text or '').encode())):02x}" + "".join("0123456789abcdef"[codes[i] * 4 + codes[i + 1]] for i in range(0, 256, 2))


TEXTS = [None, "", "a", "abcd", "abcde", "é", "The quick brown fox jumps over the lazy dog. " * 20, "日本語 " * 50]


def test_digest_against_brute_force(monkeypatch):
    for t in TEXTS:
        assert quartiles.fingerprint(t) == brute(t)
    whole = quartiles.fingerprint(TEXTS[6])
    monkeypatch.setattr(quartiles, "_CHUNK", 7)  # long texts are counted in chunks
    assert quartiles.fingerprint(TEXTS[6]) == whole
    assert [quartiles.length_code(n) for n in (0, 1, 2, 3, 4, 5, 6, 7, 8, 1023, 1024)] == [0, 1, 5, 7, 9, 10, 11, 12, 13, 40, 41]


def test_likeness_is_bounded_and_symmetric():
    digests = [quartiles.fingerprint(t) for t in TEXTS]
    for a in digests:
        for b in digests:
            x = quartiles.likeness(a, b)
            assert 0.0 <= x <= 1.0 and x == quartiles.likeness(b, a) and (x == 1.0) == (a == b)
    words = [f"word{i * 7919 % 1000} goes" for i in range(300)]
    near = quartiles.likeness(quartiles.fingerprint(" ".join(words)), quartiles.fingerprint(" ".join(words[:280])))
    far = quartiles.likeness(quartiles.fingerprint(" ".join(words)), quartiles.fingerprint("Über Fluß und Straße. " * 200))
    assert near > 0.7 > 0.3 > far
    assert quartiles.likeness(quartiles.fingerprint(""), quartiles.fingerprint("something")) == 0.0


def test_neighbours_against_brute_force(spark):
    rows = [(5, "five " * 30), (2**60, "last document of all, and a long one " * 9), (None, "no id at all"), (7, None), (8, ""), (8, "same id"), (8, "same id"), (3, "x"), (4, "äöü " * 40)]
    rows += [(100 + i, f"document {i} " * (i % 5 + 1)) for i in range(60)]
    df = spark.createDataFrame([(i, t, 1, "clash", 3) for i, t in rows], SCHEMA)
    hashes = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 4
        other = t[: len(t) - n] + after[:n]
        a, b, c = brute(t), brute(other), brute(after)
        want.append((i, len(t), hashlib.sha256(other.encode()).hexdigest(), a, b, quartiles.likeness(a, b), quartiles.likeness(a, c)))
    for parts in (1, 7):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
        got = [tuple(r) for r in quartiles.fingerprint_neighbours(df.repartition(parts)).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_document_none_and_columns(spark, tmp_path):
    one = spark.createDataFrame([(1, "alone with itself", 1, "", 1)], SCHEMA)
    r = quartiles.fingerprint_neighbours(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"alone with it" + b"alon").hexdigest()
    one.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    empty = queries.QUERIES["op13_document_fingerprints"](spark, str(tmp_path))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_columns_of_digests(spark):
    df = spark.createDataFrame([("abc abc", "abc abd"), ("x", None)], "a string, b string")
    got = df.select(quartiles.fingerprints(df.a).alias("a"), quartiles.fingerprints(df.b).alias("b"))
    out = got.select("a", "b", quartiles.likenesses(got.a, got.b).alias("l")).collect()
    assert out[0]["a"] == brute("abc abc") and out[0]["l"] == quartiles.likeness(brute("abc abc"), brute("abc abd")) and out[1]["b"] == brute(None)
