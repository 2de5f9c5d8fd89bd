import hashlib
import itertools
import math
import re
import time
from collections import Counter

import numpy as np

from questlog.llm import chat, egojoin, langid, lm, packing, pii, quality, queries, secrets, simhash, winnow
from questlog.llm.common import components

TEXTS = [None, "", "   \n", "!!! 123", "The cat sat on the mat with a hat", "the CAT sat on the mat with a hat", "x" * 30000, "pässword = 'äöü' ελ"]


def docs(spark, texts):
    """With null, repeated and clashing columns beside."""
    return spark.createDataFrame([(i, t, None, None, None, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, score double")


def test_components(spark):
    links = spark.createDataFrame([(5, 3), (3, 9), (7, 8), (1, 1), (9, 5)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(3, 3), (5, 3), (9, 3), (7, 7), (8, 7)}
    assert components(links.limit(0)).count() == 0


def test_secrets_against_brute_force(spark):
    key = "9f3b2c7d1e8a4f60b5c9d2e7f1a3b4c8"
    texts = [*TEXTS, f"password: token: abcdefgh1 x {key}", 'api_key="abc12345" AKIAABCDEFGHIJKL12 AKIASHORT', "token==abcdefgh", f"ä {key}{key} Zm9vYmFyQmF6MTIzNDU2Nzg5MFh5WlFw/+A", "example" + key]

    def brute(t):
        out = [("assign", m.start(), m.end()) for m in re.finditer(secrets.ASSIGN, t, re.A) if len(m[2]) >= 8]
        out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        for kind, (pattern, _, least) in secrets.CLASSES.items():
            for m in re.finditer(pattern, t):
                if any(re.search(a, m[0]) for a in secrets.ALLOWED):
                    continue
                for i in range(len(m[0]) - secrets.WINDOW + 1):
                    c = Counter(m[0][i : i + secrets.WINDOW]).values()
                    if -sum(x / secrets.WINDOW * math.log2(x / secrets.WINDOW) for x in c) >= least - 1e-9:
                        s = m.start() + i
                        if out and out[-1][0] == kind and out[-1][2] >= s:
                            out[-1] = (kind, out[-1][1], s + secrets.WINDOW)
                        else:
                            out.append((kind, s, s + secrets.WINDOW))
        return sorted(out, key=lambda x: (x[1], secrets.KINDS.index(x[0]), x[2]))

    found = secrets.scan_secrets(docs(spark, texts))
    for r in found.collect():
        assert [tuple(s) for s in r["secrets"]] == brute(r["text"] or ""), r["text"]
    assert found.where("size(secrets) > 0").count() >= 3
    assert key not in secrets.redact(found, "secrets").where("doc_id = 8").first()["text"]


def test_winnowing_against_brute_force(spark):
    rng = np.random.default_rng(1)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 30, n)]
    items = [word(14), word(10), word(10), ["w1", "W2"], ["w3"]]
    texts = [" ".join(x) for x in [word(60), word(20) + items[0][2:13] + word(3), items[1][:9], items[1] + items[2], word(5)]]
    bench = spark.createDataFrame([*enumerate(map(" ".join, items)), (9, None), (8, ""), (7, "w3")], "item_id long, text string")
    index = {}
    for r in bench.collect():
        w = re.findall(r"[a-z0-9]+", (r["text"] or "").lower())
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            index.setdefault(tuple(w[j : j + n]), set()).add(str(r["item_id"]))
    got = {r["doc_id"]: r for r in winnow.decontaminate(docs(spark, texts + TEXTS), bench).collect()}
    assert len(got) == len(texts + TEXTS)
    for i, t in enumerate(texts + TEXTS):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if (t or "").isascii() else None
        if w is None:
            continue
        hit, ids = set(), set()
        for a, n in itertools.product(range(len(w)), {len(k) for k in index}):
            if len(w[a : a + n]) == n and tuple(w[a : a + n]) in index:
                hit |= set(range(a, a + n))
                ids |= index[tuple(w[a : a + n])]
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(ids), bool(hit)), t
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_simhash_covering_finds_every_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, int(rng.integers(1, 7)), replace=False)) for b in base for _ in range(3)]
    prints = np.unique(np.array([*map(int, base), *near], np.uint64))
    signed = prints.view(np.int64).tolist()
    nodes = spark.createDataFrame([(x, x) for x in signed], "fp long, group long")
    got = {(r["a"], r["b"]) for r in simhash.covering_links(nodes).distinct().collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert got == want and len(want) > 50
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, TEXTS)).collect()}
    assert len(found) == len(TEXTS) and [found[i]["component_id"] for i in (0, 1, 2, 4, 5)] == [0, 0, 0, 4, 4]


def test_grid_order_join_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 8))
    x[40:80] = x[:40] + rng.normal(size=(40, 8)) * 0.25
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(200, None, 0), (201, [0.0] * 8, 0), (202, [1.0] * 8, None), (203, [float("nan")] * 8, 1), (204, x[0].tolist(), 0), (205, [1.0, None], 0), (206, [1.0] * 3, 0)]
    got = {r["vec_id"]: r for r in egojoin.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    fine = [(i, v, k) for i, v, k in rows if i < 200 or i == 204]
    links = {i: sum(1 for j, w, m in fine if j != i and m == k and cos(v, w) >= 0.93) for i, v, k in fine}
    assert len(got) == len(rows) and sum(links.values()) > 20
    assert all(got[i]["n_links"] == links.get(i, 0) for i in got)
    assert got[204]["component_id"] == got[0]["component_id"] == 0 and got[202]["kept"]


def test_language_by_cross_parsing(spark):
    rng = np.random.default_rng(4)
    make = lambda parts, n: " ".join("".join(rng.choice(parts, 3)) for _ in range(n))
    kinds = {"aa": ["ba", "ko", "ti"], "bb": ["schw", "ung", "ö"], "cc": ["eau", "é", "oi"]}
    model = langid.train({k: make(v, 300) for k, v in kinds.items()})
    texts = [make(v, 40) for v in kinds.values()]
    got = langid.detect_language(docs(spark, texts + TEXTS), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:3]] == list(kinds)
    assert [r["lang_pred"] for r in got[3:7]] == ["und"] * 4 and all(0 <= r["score"] <= 1 for r in got)
    # phrases of one text, found by plain search for the longest match
    sample = "".join(map(chr, langid._fold("abab cab").tolist()))
    text, at, phrases = "abcabx", 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at, phrases = at + n, phrases + 1
    assert langid.parse_costs(langid.train({"x": "abab cab"}), [text])[0][0, 0] == phrases


def test_pii(spark):
    text = "mail a.b@c.de, 10.0.0.256 10.0.0.1 card 4111 1111 1111 1111 call +49 (30) 1234567 iban DE89370400440532013000 é"
    found = pii.find(text)
    assert [k for k, *_ in found] == ["email", "ip", "card", "phone", "iban"] and pii.find(None) == []
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for t in ("a@b@c.de", "x@y.z@w.v", "@a.b", "a@b.c.", "..@a.b@c.d é@x.y"):
        assert list(pii._emails(t)) == [m.span() for m in pattern.finditer(t)]
    got = pii.find_pii(docs(spark, [text, *TEXTS])).collect()
    assert len(got) == len(TEXTS) + 1 and got[1]["pii"] == []


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "a\\<|end|>\n<", "", None, "<\\|text|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(said)] + [(2, None, None, "x"), (None, 1, "assistant", "y"), (1, 0, "user", said[0])]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.digest(made).collect()}
    ordered = sorted(rows[:5] + rows[7:], key=lambda r: r[1])
    assert got[1]["n_turns"] == 6 and set(got) == {1, 2, None}
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t or ''}\n" for _, _, r, t in ordered).encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256((said[1]).encode()).hexdigest()
    folded = chat.fold(chat.parse("{% if 1 == 1 %}a{{ 'b' | upper }}{% else %}c{% endif %}"))
    assert folded == [chat.Put(chat.Const("aB"))]
    for wrong in ("{{ x.__class__ }}", "{{ f() }}", "{% if x %}", "{{ x | eval }}"):
        try:
            chat.compile_template(wrong)
        except chat.TemplateError:
            continue
        raise AssertionError(wrong)


def test_packing(spark):
    lengths, counts = [1, 2, 5, 9, 10], [5, 1, 7, 2, 3]
    cost = lambda bounds: sum(c * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts))
    best = min(cost((*x, 10)) for x in itertools.combinations(lengths[:-1], 2))
    assert cost(packing.optimal_bounds(lengths, counts, 3)) == best
    texts = [*TEXTS, " a\tb  c\n" * 50]
    got = packing.pack(docs(spark, texts), max_tokens=20, buckets=3, batch_tokens=40).collect()
    for i, t in enumerate(texts):
        pieces = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert (pieces[0]["text"] if t is None else "".join(p["text"] for p in pieces)) == t
        assert sum(p["n_tokens"] for p in pieces) == len((t or "").split()) and all(p["n_tokens"] <= p["bucket_tokens"] for p in pieces)
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(got)


def test_quality_learns(spark):
    rng = np.random.default_rng(5)
    text = lambda junk: " ".join("".join(rng.choice(list("abcde"), 4)) + ("%%" if junk else "") for _ in range(60))
    net = quality.train([(text(i % 2), 1 - i % 2) for i in range(120)])
    fresh = [text(i % 2) for i in range(40)]
    assert np.mean((quality.score(net, fresh) >= 0.5) == np.array([1 - i % 2 for i in range(40)])) > 0.95
    got = quality.classify(docs(spark, TEXTS), net).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)


def test_language_model(spark):
    texts = ["the cat sat on the mat " * 8, "The mat sat on the cat", *TEXTS[:6]]
    rows = spark.createDataFrame([(i, t, i == 1) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r for r in lm.score_texts(rows).collect()}
    tokens = [(t or "").lower().split() + [None] for t in texts]
    c = Counter(x for i, w in enumerate(tokens) if i != 1 for x in w)
    for i, w in enumerate(tokens):
        want = sum(math.log10((c[x] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1))) for x in w)
        assert abs(got[i]["base_score"] - want) < 1e-9 and got[i]["n_tokens"] == len(w) and got[i]["n_known"] == sum(c[x] > 0 for x in w)
        assert got[i]["score"] < 0
    # the probabilities of all 257 symbols after a byte add up to one, whatever the counts say
    rng = np.random.default_rng(2)
    pairs = np.zeros(256 * lm.SYMBOLS, np.int64)
    pairs[[97 * lm.SYMBOLS + 98, 97, lm.END]] = 5
    code, first = lm.fit(pairs)
    for p in (0, 97):
        keys = p * lm.SYMBOLS + np.arange(lm.SYMBOLS)
        length = code.length[keys].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(length)])
        step = code.packed[np.repeat(code.at[keys] - ends[:-1], length) + np.arange(ends[-1])]
        kinds = np.unique(step & 0xFFFF).astype(np.int64)
        model = lm.Model(code, first, [kinds] * 2, [rng.normal(0, 3, len(kinds)).astype(np.float32) for _ in range(2)])
        records = lm._inputs(model, lm.Layout(np.arange(lm.SYMBOLS), ends, step, [(step & 0xFFFF).astype(np.int64)] * 2))
        order = np.argsort(-length, kind="stable")
        cost = lm._mix(records, np.arange(ends[-1], dtype=np.int32), ends[:-1][order], length[order])
        assert abs(np.exp(-cost).sum() - 1) < 1e-3
    alone, beside = (lm.log10_probability(model, t) for t in ([""], ["ab", ""]))
    assert alone[0] < 0 and abs(beside[1] - alone[0]) < 1e-6


def test_language_model_learns_while_it_codes(spark):
    rng = np.random.default_rng(6)
    letters = lambda n: "".join(chr(c) for c in rng.integers(97, 123, n))
    model = lm.Model(*lm.fit(np.zeros(256 * lm.SYMBOLS, np.int64)))
    again, apart = (lm.log10_probability(model, [t])[0] for t in (letters(40) * 20, letters(800)))
    assert again > 0.7 * apart > apart  # what has been said before costs less


def test_language_model_tells_all_contexts_apart(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijkl"), 6)) for _ in range(40)]
    texts = ["." + " ".join(rng.choice(words, 200)) for _ in range(6)]
    other = ["." + "".join(map(chr, rng.integers(65, 91, 40_000))) for _ in range(40)]
    score = lambda rows: {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame([(i, t, False) for i, t in enumerate(rows)], "doc_id long, text string, held_out boolean")).collect()}
    alone, among = score(texts), score(texts + other)
    # the others share no context with the texts but those of the first symbols
    assert all(abs(among[i] - alone[i]) < 0.01 * abs(alone[i]) + 4 for i in range(len(texts))), [(among[i], alone[i]) for i in range(len(texts))]


def test_allow_list_covers_only_its_part(spark):
    key = "q7Zr2Kx9Lm4Tv8Bn1Wc6Yd3Hf5Jg0Ps-"
    texts = [f"https://h.io/example/{key}", key + "A" * 8 + key[::-1], "example" + key[:6]]
    got = [r["secrets"] for r in secrets.scan_secrets(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got[0] and got[1] and not got[2]
    for text, spans in zip(texts, got):
        assert not any(re.search(r"example|A{8}", text[s["start"] : s["end"]]) for s in spans)
    assert {s["start"] < len(key) for s in got[1]} == {True, False}


def test_base_spans_of_the_queries_against_brute_force(spark, tmp_path):
    key = "9f3b2c7d1e8a4f60b5c9d2e7f1a3b4c8"
    texts = [
        *TEXTS, f"Password = hunter2hunter2 {key} AKIAABCDEFGHIJKLMN", "api-key: x api_key: 12345678 TOKEN:abcdefgh", "a.b@c.de, x@y.zz.uk @no.de a@b",
        "10.0.0.1 256.1.1.1 1.2.3.4.5 001.02.3.4 1..2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+49 (30) 123-456.78 +1 2 +123456789012345678", "é 😀 a@b.cd 1.1.1.1",
        "1" * 5000 + ".2.3.4", "+1" + " " * 3000, "ssn 123-45-6789, card 5500000000000004",
    ]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    kinds = {
        "op1_secret_scans": [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32)],
        "op8_pii": [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x[-9:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
        ],
    }
    for name, patterns in kinds.items():
        for r in queries.QUERIES[name](spark, str(tmp_path)).collect():
            t = texts[r["doc_id"]] or ""
            want = sorted(((k, m.start(), m.end()) for k, p, ok in patterns for m in re.finditer(p, t, re.A) if ok(m)), key=lambda x: (x[1], [k for k, _, _ in patterns].index(x[0])))
            assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest(), (name, t[:80])
            assert all(r[f"n_{k}"] == sum(x[0] == k for x in want) for k, _, _ in patterns)
            assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r["spans"].split(","))


def test_long_runs_of_digits_are_read_once():
    began = time.time()
    assert pii.find("7" * 1_000_000) == [] and pii.find("1." * 200_000)[0][0] == "ip"
    assert time.time() - began < 20


def test_batches_keep_their_budget(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(["w"] * int(n)) for n in rng.integers(0, 60, 400)]
    rows = [(None if i % 3 == 0 else i % 7, t, None, None, None, 1.0) for i, t in enumerate(texts)]  # ids missing and repeated
    got = packing.pack(spark.createDataFrame(rows, docs(spark, []).schema), max_tokens=40, buckets=4, batch_tokens=200).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got if r["piece"] == 0 and r["n_tokens"] < 40) == Counter((r[0], r[1]) for r in rows if len(r[1].split()) < 40)
    by = {}
    for r in got:
        by.setdefault(r["bucket"], {}).setdefault(r["batch"], []).append(r)
    for batches in by.values():
        room = 200 // next(iter(batches.values()))[0]["bucket_tokens"] if next(iter(batches.values()))[0]["bucket_tokens"] else 200
        assert sorted(batches) == list(range(len(batches)))
        for k, pieces in batches.items():
            assert sorted(p["slot"] for p in pieces) == list(range(len(pieces)))
            assert len(pieces) == room or (k == len(batches) - 1 and 0 < len(pieces) <= room)
    lengths = Counter(r["n_tokens"] for r in got)
    padding = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in lengths.items())
    bounds = sorted({r["bucket_tokens"] for r in got})
    sizes = sorted(lengths)
    assert padding(bounds) == min(padding((*x, sizes[-1])) for x in itertools.combinations(sizes[:-1], 3))


def test_cross_parse_is_of_the_whole_text():
    rng = np.random.default_rng(1)
    make = lambda letters, n: "".join(rng.choice(list(letters), n))
    samples = {"a": make("abcde ", 3000), "b": make("abxyz ", 3000)}
    model = langid.train(samples)
    autos = [langid.suffix_automaton(np.array([model.symbols[p] for p in langid._fold(x).tolist()])) for x in samples.values()]

    def brute(text, root):
        state, phrases = None, 0
        for p in langid._fold(text).tolist():
            c = model.symbols.get(p, 0)
            to = autos[root][state].get(c) if state is not None else None
            if to is None:
                phrases += 1
                to = autos[root][0].get(c)
            state = to
        return phrases

    texts = [make("abcdexyzq ", n) for n in (0, 1, 5, 255, 256, 257, 700, 3000, 9000)] + ["a" * 2800, "q" * 600, make("abc ", 20000)]
    counts, _ = langid.parse_costs(model, texts)
    assert [list(row) for row in counts] == [[brute(t, r) if t else 0 for r in range(2)] for t in texts]


def test_grid_order_join_over_many_intervals(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 8))
    x = np.concatenate([centres[rng.integers(0, 60, 3000)] + rng.normal(0, 0.25, (3000, 8)), rng.normal(size=(2000, 8))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.93
    group = np.arange(len(x))
    while True:
        new = np.array([group[row].min() for row in links])
        if (new == group).all():
            break
        group = new
    rows = spark.createDataFrame([(i, [float(v) for v in r], 1) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in egojoin.near_duplicates(rows).collect()}
    assert all(got[i]["n_links"] == links[i].sum() - 1 and got[i]["component_id"] == group[i] for i in range(len(x)))


def test_large_missing_and_repeated_ids(spark, tmp_path):
    big = 1 << 53
    ids = [None, big + 1, big + 3, 5, 5, None]
    texts = ["one text about nothing", "another text here", "third text of them", "password: hunter2hunter2", "mail a@b.cd please", ""]
    spark.createDataFrame(list(zip(ids, texts, ["aa"] * 6)), "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(big + 1, 1), (5, 0), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, "another text here"), (3, "third text of them")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    turns = [(i, t, "user" if t % 2 == 0 else "assistant", f"{i} says {t}") for i in (None, big, big + 1) for t in range(2)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name in ("op1_secret_scans", "op2_quality_classifier", "op5_benchmark_decontamination", "op7_language_id", "op8_pii", "op9_lm_scoring", "op10_simhash_near_dedup"):
        got = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(ids), name
        if name.startswith("op5"):
            hit = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in got if r["n_hit"]}
            assert hit == {big + 1: (3, 0), big + 3: (4, 1)}  # an item without an id hits, and is in no list
    assert Counter(r["doc_id"] for r in queries.QUERIES["op4_packing"](spark, str(tmp_path)).collect()) == Counter(ids)
    got = {r["conv_id"]: r["n_turns"] for r in queries.QUERIES["op3_chat_formatting"](spark, str(tmp_path)).collect()}
    assert got == {None: 2, big: 2, big + 1: 2, -7: 2}


def test_templates_read_messages_once(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    loop = "{% for m in messages %}{{ m.text }}{% endfor %}"
    assert chat.format_conversations(turns, "a" + loop).first()["formatted"] == "ahi"
    for wrong in (loop + loop, "{% for x in messages %}" + loop + "{% endfor %}"):
        try:
            chat.format_conversations(turns, wrong)
        except chat.TemplateError:
            continue
        raise AssertionError(wrong)


def test_quality_sample_is_of_whole_texts_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [("".join(rng.choice(list("abcdef "), 5000)) + ("!!" * 40 if i % 2 else ""), 1 - i % 2) for i in range(30)]
    one, two = (quality.fit(spark.createDataFrame(r, "text string, label int").repartition(n)) for r, n in ((rows, 1), (rows[::-1], 5)))
    assert all(np.array_equal(getattr(one, k), getattr(two, k)) for k in ("taps", "weight", "out"))
