"""Operators on documents against brute force, with every awkward case at once."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty, rows_of
from twintext.llm import bpe_automaton, line_dedup, near_dedup, packing, quality_rules, token_counts
from twintext.llm.queries import vocabulary_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def texts(docs):
    return [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]


# Quality rules


def measured(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_measurements(docs):
    judged = quality_rules.judged(docs)
    assert judged.columns[:8] == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    ]
    found = Counter(rows_of(judged, *judged.columns[:7]))
    expected = Counter()
    for i, t in texts(docs):
        m = measured(t)
        expected[(i, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert found == expected
    assert quality_rules.judged(empty(docs)).count() == 0


def test_policies_and_ablations(docs):
    ledger = quality_rules.ledger(docs).cache()
    failed = [r["failed"] for r in ledger.collect()]
    for policy in (quality_rules.BASE, quality_rules.STANDARD):
        kept = quality_rules.keep_passing(docs, policy)
        assert kept.columns == docs.columns
        assert kept.count() == sum(not f & policy.mask for f in failed)
        for row in quality_rules.ablations(ledger, policy).collect():
            bit = 1 << quality_rules.RULES.index(row["rule"])
            assert row["failing"] == sum(bool(f & bit) for f in failed)
            assert row["rejected_only_by"] == sum(f & policy.mask == bit for f in failed)
            assert row["kept_without"] == sum(not f & policy.mask & ~bit for f in failed)
    report = quality_rules.ablations(empty(ledger)).collect()
    assert len(report) == len(quality_rules.RULES) and all(r["kept_without"] == 0 for r in report)


def test_the_ledger_of_a_filtered_table_plans_quickly(spark, docs):
    assert len(quality_rules.keep_passing(docs)._jdf.queryExecution().optimizedPlan().toString()) < 200_000


# Line dedup


def kept_lines(rows, keep):
    holders = defaultdict(set)
    keyed = []
    for i, t in rows:
        lines = [(x, x.strip(" \t\n\v\f\r").translate(LOWER)) for x in t.split("\n")]
        keyed.append((i, lines))
        for _, key in lines:
            if len(key) >= 40:
                holders[key].add(i)
    last = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    return [
        (i, "\n".join(x for x, key in lines if key not in last or last[key] == i), len(lines)) for i, lines in keyed
    ]


def test_line_dedup(docs):
    expected = Counter()
    for (i, kept, n), (_, t) in zip(kept_lines(texts(docs), None), texts(docs)):
        dropped = n - (kept.count("\n") + 1 if kept or t == "" else 0)
        expected[i, n, dropped if kept != t else 0, hashlib.sha256(kept.encode()).hexdigest()] += 1
    found = Counter(rows_of(line_dedup.digests(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256"))
    assert found == expected
    changed = line_dedup.without_repeated(docs)
    assert changed.columns == docs.columns and changed.count() == docs.count()
    assert line_dedup.digests(empty(docs)).count() == 0


def test_first_occurrences_stay(spark):
    line = "a line of more than forty characters, repeated"
    rows = [(k, "\n".join([line, "short", line])) for k in (3, 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = line_dedup.without_repeated(df, min_docs=2, keep=line_dedup.FIRST)
    assert sorted(rows_of(kept, "doc_id", "text")) == [(1, line + "\nshort"), (2, "short"), (3, "short")]


def test_bitmaps_of_many_lines(spark):
    line = "a line of more than forty characters, number "
    text = "\n".join(f"{line}{k}" if k % 3 else "own" for k in range(300))
    df = spark.createDataFrame([(k, text if k else "x\n" + text) for k in range(6)], "doc_id long, text string")
    kept = dict(rows_of(line_dedup.without_repeated(df), "doc_id", "text"))
    assert kept[5] == text and kept[3] == "\n".join(["own"] * 100) and kept[0] == "\n".join(["x"] + ["own"] * 100)


# Near duplicates


def shingles(text, k):
    words = WORD.findall(text.translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def linked(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, words, percent):
    rule = near_dedup.Rule(words, percent)
    found = near_dedup.near_duplicates(docs, rule)
    parents = linked(texts(docs), words, percent)
    expected = Counter(
        (i, len(shingles(t, words)), parents.get(i), i is None or parents[i] == i) for i, t in texts(docs)
    )
    assert Counter(rows_of(found, "doc_id", "n_shingles", "component_id", "kept")) == expected
    one = near_dedup.one_of_each(docs, rule)
    assert one.columns == docs.columns
    ids = [r[0] for r in rows_of(one, "doc_id")]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in parents if parents[i] == i)
    assert ids.count(None) == 1
    assert near_dedup.near_duplicates(empty(docs), rule).count() == 0


def test_texts_that_share_an_id_are_not_lost(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (5, b + " more"), (5, a), (5, None), (7, c), (8, c), (8, c + " end"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(near_dedup.one_of_each(docs), "doc_id", "text")
    others = [r for r in found if not (r[1] or "").startswith("b")]
    assert Counter(others) == Counter([(5, a), (5, None), (7, c), (None, a)])
    near = set(found) - set(others)
    assert len(near) == len(found) - len(others) == 1 and near <= {(5, b), (5, b + " more")}
    again = near_dedup.one_of_each(docs.repartition(3, "text"))
    assert Counter(rows_of(again, "doc_id", "text")) == Counter(found)


def test_blocks_find_links_between_components():
    import numpy as np
    import pyarrow as pa

    def side(rows):
        nodes, components, sets = zip(*rows)
        return pa.table({
            "node": pa.array(nodes, pa.int64()), "component": pa.array(components, pa.int64()),
            "signature": pa.array([[0] * 8 for _ in sets], pa.list_(pa.int64())),
            "shingles": pa.array([np.array(s, "u8").tobytes() for s in sets], pa.binary()),
        })

    base = list(range(20))
    apart = side([(5, 5, base), (6, 6, list(range(50, 70)))])
    others = side([(1, 1, base + [99]), (2, 1, base), (5, 5, base), (6, 6, list(range(50, 70)))])
    rule = near_dedup.Rule(3, 85)
    links = near_dedup._links_in_block(apart, others, rule).to_pylist()
    assert [x["a"] for x in links] == [5] and links[0]["b"] in (1, 2)
    far = others.set_column(2, "signature", pa.array([[0x1111111111111111] * 8] * 4, pa.list_(pa.int64())))
    assert not near_dedup._links_in_block(apart, far, rule).num_rows  # all low bits differ


def test_signatures_count_differing_minima():
    import numpy as np

    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 16, (2, 5, near_dedup.HASHES), "u8")
    packed = [sum(x[:, k::16] << np.uint64(4 * k) for k in range(16)) for x in (a, b)]
    assert (near_dedup._different(*packed) == (a[:, None] != b[None]).sum(axis=2)).all()


def test_many_short_texts_with_common_words(spark, monkeypatch):
    """Unlinked texts that fill buckets, dealt out to several blocks, and links among them."""
    monkeypatch.setattr(near_dedup, "_NODES", (50, 300))
    rows = [(k, f"the same words w{k}") for k in range(2000)]
    long = " ".join(f"v{k}" for k in range(60))
    rows += [(3000 + k, f"{long} {' '.join(f'x{j}' for j in range(k))}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(near_dedup.near_duplicates(docs, near_dedup.Rule(3, 85)), "doc_id", "component_id")
    assert Counter(found) == Counter([(k, k) for k in range(2000)] + [(3000 + k, 3000) for k in range(12)])


# Tokens


def test_automaton_equals_the_library(docs):
    from tokenizers import Tokenizer

    path = vocabulary_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in texts(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected[i, len(ids), digest, hashlib.sha256(text.encode()).hexdigest()] += 1
    found = bpe_automaton.digests(docs, path)
    assert Counter(rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == expected
    assert bpe_automaton.digests(empty(docs), path).count() == 0


@pytest.mark.parametrize("word", [b"", b"a", b"aa", b"aaa", b"aaaa", b"abab", b"abcab", b"bcabc", b"cabcabca"])
def test_gadgets_on_a_small_vocabulary(word):
    labels = {i: bytes([i]) for i in range(256)}
    pairs = [(97, 97), (97, 98), (257, 99), (98, 99), (258, 258)]
    merges = []
    for k, (a, b) in enumerate(pairs):
        labels[256 + k] = labels[a] + labels[b]
        merges.append((a, b, 256 + k))
    tokens = list(word)
    for a, b, made in merges:
        out = []
        for t in tokens:
            if out and out[-1] == a and t == b:
                out[-1] = made
            else:
                out.append(t)
        tokens = out
    automaton = bpe_automaton.Automaton(labels, merges)
    assert automaton.encode(word) == tokens and automaton.decode(tokens) == word


def test_unigram_counts(docs):
    import base64

    path = vocabulary_file("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(p): int(r) for p, r in map(bytes.split, file)}
    scores = token_counts.zipf_scores(ranks)

    def best(word):
        table = [(0, 0)]
        for end in range(1, len(word) + 1):
            table.append(max(
                (table[k][0] + scores[word[k:end]], table[k][1] - 1) for k in range(end) if word[k:end] in scores
            ))
        return -table[-1][1]

    from twintext.llm.pretokens import splitter

    split, known = splitter(), {}
    for row in token_counts.token_counts(docs, path).collect():
        text = dict(texts(docs))[row["doc_id"]]
        found = [w for part in split(text) for w in part]
        for w in found:
            known.setdefault(w, best(w.encode()))
        assert (row["n_words"], row["n_tokens"]) == (len(found), sum(known[w] for w in found))
    assert token_counts.token_counts(empty(docs), path).count() == 0


def test_a_full_trie_starts_anew(monkeypatch):
    scores = {bytes([b]): -10 for b in range(256)} | {b"ab": -5, b"abc": -4}
    whole = token_counts.PrefixTrie(scores)
    monkeypatch.setattr(token_counts, "_NODES", 3)
    monkeypatch.setattr(token_counts, "_DEEPEST", 2)
    small = token_counts.PrefixTrie(scores)
    words = [b"abcab", b"ab", b"cab", b"abcabcabd", b""]
    assert [small.count(w) for w in words] == [whole.count(w) for w in words] == [2, 1, 2, 4, 0]


# Packing


def test_packing(docs):
    from tokenizers import Tokenizer

    path, capacity = vocabulary_file("word_bpe_49k.json"), 64
    library = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in texts(docs):
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            data = b"".join(x.to_bytes(4, "little") for x in part)
            expected[i, k // capacity, k, len(part), zlib.crc32(data)] += 1
    packed = packing.packed_pieces(docs, path, capacity).cache()
    assert Counter(rows_of(packed, "doc_id", "piece", "start", "length", "ids_crc32")) == expected
    places = defaultdict(list)
    for s, o, n in rows_of(packed, "sequence_id", "offset", "length"):
        places[s].append((o, n))
    for parts in places.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert len(places) == best_fit_decreasing([k[3] for k, n in expected.items() for _ in range(n)], capacity)
    assert packing.packed_pieces(empty(docs), path).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_sweeps_equal_best_fit_decreasing():
    import random

    rnd = random.Random(4)
    for _ in range(200):
        capacity = rnd.choice([1, 7, 50, 100])
        lengths = [rnd.randrange(1, rnd.choice([capacity, max(1, capacity // 6)]) + 1) for _ in range(rnd.randrange(150))]
        assert packing.plan(dict(Counter(lengths)), capacity).sequences == best_fit_decreasing(lengths, capacity)


def test_sequences_hold_their_tokens(spark):
    df = spark.createDataFrame([(b"abcd", 1), (b"efgh" * 3, 3), (b"ijkl", 1)], "ids binary, length long")
    joined = packing.sequences(packing.best_fit(df, "length", 4))
    assert sorted(len(r["ids"]) for r in joined.collect()) == [4, 16]


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        packing.plan({5: 1}, 4)


# Pipeline


def test_pipeline_against_brute_force(spark, tmp_path):
    """With null and repeated ids, repeated rows and further columns of clashing names."""
    import corpus_pipeline

    rows = documents(spark)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    judged = quality_rules.judged(rows).select("doc_id", "failed_bits", F.monotonically_increasing_id())
    bits = [r[1] for r in judged.orderBy(judged.columns[2]).collect()]
    passing = [x for x, b in zip(texts(rows), bits) if not b]
    kept = [(i, t) for i, t, _ in kept_lines(passing, None)]
    parents = linked(kept, 5, 80)
    expected = Counter({(i, t) for i, t in kept if i is None or parents[i] == i})
    docs = rows
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == rows.columns
    assert Counter(rows_of(docs, "doc_id", "text")) == expected
    packed = corpus_pipeline.run(spark, str(tmp_path))
    pieces = [r.asDict() for r in packed.collect()]
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(i for i, _ in expected)
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = [0, *[o + n for o, n in sorted(places)]]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
    lengths = Counter()
    for i, t in expected:
        lengths[i] += len(library().encode(t, add_special_tokens=False).ids) + 1
    found = Counter()
    for r in pieces:
        found[r["doc_id"]] += r["length"]
    assert found == lengths


def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_pipeline_over_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    empty(documents(spark)).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_counts_characters_anew(spark):
    import corpus_pipeline

    line = "a line that is found in every one of these documents"
    docs = spark.createDataFrame([(k, f"{line}\nown {k}", 60) for k in range(5)], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.without_repeated_lines(spark, docs, "")
    assert sorted(rows_of(kept, "doc_id", "n_chars")) == [*((k, 5) for k in range(4)), (4, len(line) + 6)]


def test_encoding_and_decoding_as_columns(spark):
    from twintext.llm.common import ship_package

    path = vocabulary_file("byte_bpe_50k.json")
    ship_package(spark)
    df = spark.createDataFrame([("Hello été",), (None,), ("",)], "text string")
    ids = df.select(bpe_automaton.encode(F.col("text"), path).alias("ids"))
    assert [r[0] for r in ids.select(bpe_automaton.decode(F.col("ids"), path)).collect()] == ["Hello été", "", ""]
    odd = spark.createDataFrame([([39, None, 68],), (None,), ([180],)], "ids array<int>")
    assert [r[0] for r in odd.select(bpe_automaton.decode(F.col("ids"), path)).collect()] == ["He", "", "\ufffd"]
