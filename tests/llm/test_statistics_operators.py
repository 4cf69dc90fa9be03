"""SimHash links, phrases and whitening against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.data import documents, empty, rows_of
from twintext.llm import phrases, simhash_dedup, whitening
from twintext.llm.common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# SimHash


def fingerprint(text, k=3):
    words = WORD.findall(text.translate(LOWER))
    grams = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(rows, most):
    """The least id reached from each id over fingerprints and shared ids."""
    prints = defaultdict(set)
    for i, f in rows:
        prints[i].add(f)
    ids, parent = list(prints), {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            if any((a ^ b).bit_count() <= most for a in prints[i] for b in prints[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def checked(df, rule=simhash_dedup.Rule()):
    found = simhash_dedup.near_duplicates(df, rule)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [(r[0], fingerprint(r[1] or "", rule.words)) for r in df.select("doc_id", "text").collect()]
    least = components_of([p for p in prints if p[0] is not None], rule.most)
    expected = Counter((i, f"{f:016x}", least.get(i)) for i, f in prints)
    assert Counter(rows_of(found, *found.columns)) == expected


def test_simhash_components(spark):
    docs = documents(spark)
    checked(docs)
    checked(docs, simhash_dedup.Rule(words=2, most=5))
    assert simhash_dedup.near_duplicates(empty(docs)).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["Ab", "c", "déf", "\t", "x" * 40]) for _ in range(500))
    texts = [text, "", "a b", text[:300], "one", "y" * 100 + " a b"]
    whole = [fingerprint(t) for t in texts]
    for size in (1 << 20, 64, 3):
        monkeypatch.setattr(simhash_dedup, "_PIECE", size)
        monkeypatch.setattr(simhash_dedup, "_HASHED", size)
        assert simhash_dedup.fingerprints_of([t.encode() for t in texts], 3).tolist() == whole


def near_prints(seed, n):
    """Random fingerprints, and clouds of some that differ in few bits."""
    rnd = random.Random(seed)
    values = {rnd.getrandbits(64) for _ in range(n)}
    for _ in range(3):
        center = rnd.getrandbits(64)
        for _ in range(n):
            value = center
            for bit in rnd.sample(range(64), rnd.randrange(0, 6)):
                value ^= 1 << bit
            values.add(value)
    return sorted(values | {0, 1, (1 << 64) - 1})


@pytest.mark.parametrize("crowd", [4_096, 32, 8])
@pytest.mark.parametrize("most", [0, 3])
def test_links_lose_nothing(spark, monkeypatch, crowd, most):
    """Also where every bucket is a crowd that is dealt out again, twice."""
    monkeypatch.setattr(simhash_dedup, "_CROWD", crowd)
    values = np.array(near_prints(most, 40), "u8")
    signed = values.view("i8").tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = simhash_dedup.links(Scratch(spark, "test"), df, simhash_dedup.Rule(most=most))
    expected = {
        (min(a, b), max(a, b))
        for k, (a, x) in enumerate(zip(signed, values.tolist()))
        for b, y in zip(signed[:k], values[:k].tolist())
        if (x ^ y).bit_count() <= most
    }
    rows = rows_of(found, "a", "b")
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_pivots_discard_without_loss():
    """The largest difference of coordinates is a lower bound, and a sharp one."""
    values = np.random.default_rng(3).integers(0, 1 << 63, 2_000, "u8")
    table = simhash_dedup.pivot_table(values).astype("i4")
    a, b = np.triu_indices(300, 1)
    bound = np.abs(table[a] - table[b]).max(axis=1)
    distance = np.bitwise_count(values[a] ^ values[b])
    assert (bound <= distance).all()
    assert (bound > 3).mean() > 0.999


def test_equal_fingerprints_in_a_third_of_all_rows(spark):
    rows = [(k, "the same words in many rows") for k in range(300)] + [(k, f"text of number {k} {k * k}") for k in range(300, 600)]
    checked(spark.createDataFrame(rows, "doc_id long, text string"))


# Phrases


def mined(rows, rule):
    """Rows as the operator returns them, by counting every phrase on its own."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, rule.longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= rule.least}
        kept = []
        for p, a in candidates.items():
            longer = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= rule.inside * a for b in longer):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[: rule.first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return Counter(out)


def talk(spark):
    rnd = random.Random(9)
    stock = ["New", "York", "new", "the", "of", "été", "日本", "city", "(a)", "'"]
    rows = [(None, None, "en"), (1, "", "en"), (1, " \t ", None), (2, "...\n!?", "xx"), (3, "alone", "yy")]
    for k in range(120):
        words = "".join(rnd.choice(stock) + rnd.choice([" ", " ", " ", "\t", ", ", ".", "\r\n", " "]) for _ in range(rnd.randrange(60)))
        rows += [(k, words, rnd.choice(["en", "fr", None, "und"]))] * rnd.choice([1, 1, 3])
    rows += [(7, "of the city of New York " * 3000, "en")]
    return spark.createDataFrame([(i, t, v, 5, "x") for i, t, v in rows], "doc_id long, text string, lang string, w1 int, F string")


@pytest.mark.parametrize(
    "rule", [phrases.Rule(), phrases.Rule(longest=2, least=3), phrases.Rule(longest=4, least=2, inside=80, first=7)]
)
def test_phrases(spark, rule):
    docs = talk(spark)
    found = phrases.collocations(docs, rule)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = mined(rows_of(docs, "lang", "text"), rule)
    assert Counter(rows_of(found, *found.columns)) == expected and expected
    assert phrases.collocations(empty(docs), rule).count() == 0


@pytest.mark.parametrize("held, piece", [(1 << 18, 1 << 20), (7, 3)])
@pytest.mark.parametrize("codes", [1 << 20, 6, 0])
def test_chunks_and_words_without_code(spark, monkeypatch, held, piece, codes):
    monkeypatch.setattr(phrases, "CODES", codes)
    rule = phrases.Rule(longest=3, least=2)
    docs = talk(spark)
    words = phrases.word_counts(docs).cache()
    made = phrases.codes_of(words, rule)
    assert made.complete == (codes > 6) and len(made.words) <= codes
    monkeypatch.setattr(phrases, "_HELD", held)
    monkeypatch.setattr(phrases, "_PIECE", piece)
    for lang, texts in [("en", [b"a b c. d e", b"f g"]), ("fr", [b"h"])]:
        batch = phrases.pa.record_batch([phrases.pa.array([lang] * len(texts)), phrases.pa.array(texts)], ["lang", "text"])
        rebuilt = [w for _, tokens, n in phrases._by_language(batch, 2) for w in tokens[:n]]
        assert b" ".join(rebuilt) == b" . ".join(t.replace(b".", b" .") for t in texts) + b" ."
    found = phrases.collocations(docs, rule)
    assert Counter(rows_of(found, *found.columns)) == mined(rows_of(docs, "lang", "text"), rule)


def test_products_beyond_64_bits(spark):
    x, y, both = 10**13 + 9 * 10**12, 10**13, 9 * 10**12
    rows = [("en", 1, "x", x), ("en", 1, "y", y), ("en", 2, "x y", both)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, f long").cache()
    candidates = counts.where("size = 2").withColumnRenamed("f", "a")
    row = phrases._scored(candidates, counts, phrases.Rule()).first()
    assert (row["l"], row["r"], row["score"]) == (x, y, 10**6 * both * both // (x * y))


def test_only_longest_windows_are_counted(spark):
    docs = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    codes = phrases.Codes((b"a", b"b"), False)
    found = rows_of(phrases.longest_windows(docs, codes), "window", "f")
    assert sorted(found) == [('! " ~c', 1), ('" ~c', 1), ("~c", 1)]
    whole = rows_of(phrases.longest_windows(docs, phrases.Codes((b"a", b"b"), True)), "window", "f")
    assert sorted(whole) == [('! "', 1), ('"', 1)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_windows_are_made_once_and_summed_once_per_length(spark):
    docs = spark.createDataFrame([("a b c d", "en")], "text string, lang string")
    for longest in (2, 3, 5):
        rule = phrases.Rule(longest=longest, least=1)
        windows = phrases.longest_windows(docs, phrases.Codes((b"a", b"b"), False), rule)
        plan = plan_of(phrases.phrase_counts(windows, rule))
        assert plan.count("MapInArrow") == 1 and plan.count("Aggregate [") == longest - 1 and "Union" not in plan
    assert "Expand" not in plan_of(phrases.word_counts(docs))


@pytest.mark.parametrize("codes", [1 << 20, 6, 0])
def test_windows_of_more_than_one_number(spark, monkeypatch, codes):
    monkeypatch.setattr(phrases, "CODES", codes)
    monkeypatch.setattr(phrases, "_WINDOWS", 50)
    monkeypatch.setattr(phrases, "_ROWS", 3)
    rnd = random.Random(5)
    stock = ["a", "b", "c\x01", "c", "~", "~d", "\x02", "é"]
    rows = [("".join(rnd.choice(stock) + rnd.choice([" ", " ", " ", "; "]) for _ in range(30)), rnd.choice(["en", None])) for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    rule = phrases.Rule(longest=5, least=2)
    found = phrases.collocations(docs, rule)
    assert Counter(rows_of(found, *found.columns)) == mined(rows_of(docs, "lang", "text"), rule)


def test_numbers_of_windows_are_the_codes_of_their_words(spark):
    words = tuple(f"w{k}".encode() for k in range(93**3 + 200))
    codes = phrases.Codes(words, False)
    some = [0, 1, 92, 93, 94, 93**2 - 1, 93**2, 93**2 + 93, 93**3 - 1, 93**3, 93**3 + 199]
    docs = spark.createDataFrame([(f"w{k} new w{some[-1 - i]}", "en") for i, k in enumerate(some)], "text string, lang string")
    decode = codes.decoder()
    found = [" ".join(decode(c).decode() for c in w.encode().split(b" ")) for (w,) in rows_of(phrases.longest_windows(docs, codes), "window")]
    expected = {t for i, k in enumerate(some) for t in (f"w{k} new w{some[-1 - i]}", f"new w{k}", f"w{k}")}
    assert Counter(found) == Counter(expected)


def test_words_are_counted_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_HELD", 3)
    docs = spark.createDataFrame([("a B. b", "en"), ("a", None), ("...", "xx"), (None, "yy")], "text string, lang string")
    found = {(lang, word): f for lang, word, f in rows_of(phrases.word_counts(docs), "lang", "word", "f")}
    assert found == {("en", None): 3, ("en", "a"): 1, ("en", "b"): 2, ("und", None): 1, ("und", "a"): 1}


# Whitening


def vectors(spark, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6))
    rows = [(k, v.astype("f4").astype(float).tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, rows[k % 3][1]) for k in range(50)] + [rows[5], rows[5], (None, rows[6][1])]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6)]
    rows += [(204, []), (205, [1.0, 2.0]), (206, [1e300] * 6), (207, [0.0] * 6)]
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, Weight int")


def fitted(rows, weights):
    good = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(c is not None and abs(c) < 2.0**40 for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], object)
    fit = x if weights == "count" else np.array([list(t) for t in {tuple(r) for r in x}], object)
    n, sums = len(fit), fit.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((fit * n - sums) / n).astype("f8")
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    z = ((n * x - sums) / n).astype("f8") @ basis[:, ::-1] / np.sqrt(values[::-1])
    return [i for i, _ in good], n, deviation, values[::-1] / values.sum(), z


@pytest.mark.parametrize("weights, components", [("count", 32), ("count", 3), ("one", 32)])
def test_whitening(spark, weights, components):
    df = vectors(spark)
    found = whitening.whitened(df, components, weights)
    assert found.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    ids, n, deviation, explained, z = fitted(rows_of(df, "vec_id", "embedding"), weights)
    m = min(components, 6)
    by_component = defaultdict(list)
    for r in found.collect():
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        by_component[r["component"]].append((r["vec_id"], r["deviation"], r["whitened"]))
    assert sorted(by_component) == list(range(1, m + 1))
    key = lambda t: (t[0] is None, t[0] or 0, round(t[2], 6))
    for c, got in by_component.items():
        sign = max((1, -1), key=lambda s: -sum(abs(a[2] - s * b) for a, b in zip(sorted(got, key=key), sorted(z[:, c - 1]))))
        ways = [sorted(zip(ids, deviation.tolist(), (s * z[:, c - 1]).tolist()), key=key) for s in (sign, -sign)]
        got = sorted(got, key=key)
        assert any(
            all(a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-8) for a, b in zip(got, way)) for way in ways
        ) and len(got) == len(ids)


def test_nothing_to_whiten(spark):
    df = vectors(spark)
    assert whitening.whitened(empty(df)).count() == 0
    assert whitening.whitened(df.where("vec_id IN (200, 202)")).count() == 0
    assert whitening.whitened(df.where("vec_id = 5")).count() == 0  # equal vectors have no variance


def test_components_without_variance_are_left_out(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [*v, v[0], 3.0]) for k, v in enumerate(rng.normal(size=(40, 3)).tolist())]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert found.count() == 40 * 3 and found.agg(F.max("identity_error")).first()[0] < 1e-9


def test_large_numbers_stay_exact(spark):
    rows = [(k, [2.0**39 * (k % 3), float(k)]) for k in range(30)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1)
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    exact = {k: sum((30 * c - s) ** 2 for c, s in zip(v, sums)) for k, v in enumerate(x)}
    assert {r[0]: r[1] for r in rows_of(found, "vec_id", "deviation")} == {
        k: v if v < 1 << 63 else None for k, v in exact.items()
    }
