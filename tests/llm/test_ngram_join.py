import random
import re

import numpy as np
import pytest

from revspark.llm import ngram_join
from revspark.llm.components import components
from revspark.llm.ngram_join import near_duplicates
from revspark.llm.packed import pack, unpack
from tests.llm.helpers import documents, odd_texts


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute_force(ids, texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        root = find(i)
        if d is not None:
            least[root] = min(least.get(root, d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d)
                   for i, d in enumerate(ids)), key=repr)


def near_copies(seed=1, groups=6, each=25):
    """Groups of edited copies, chains of ever more edits, and a passage that all share."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    passage = [word() for _ in range(30)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rnd.randint(3, 120))]
        if g % 2:
            base += passage
        now = base
        for k in range(each):
            if g % 3 == 0:
                now = list(base)  # copies of one text; else a chain
            now = list(now)
            for _ in range(rnd.randint(0, 3)):
                now[rnd.randrange(len(now))] = word()
            texts.append(" ".join(now).title() if k % 5 == 0 else " ".join(now))
    texts += [" ".join(passage + [word() for _ in range(n)]) for n in (0, 1, 2, 5, 9, 40)]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("run_shingles", [300, 3_000_000])
def test_equals_brute_force(spark, run_shingles):
    texts = near_copies() + odd_texts(n=20)
    ids = random.Random(4).sample(range(-500, 5000), len(texts))
    got = near_duplicates(documents(spark, texts, ids), run_shingles=run_shingles)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(ids, texts)


def test_threshold_is_exact(spark):
    """Unions of 100 shingles with 75 and with 74 in common."""
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words[:104]), " ".join(words[25:104]), " ".join(words[26:104])]
    for b, together in ((1, True), (2, False)):
        got = near_duplicates(documents(spark, [texts[0], texts[b]])).collect()
        assert ({r["component_id"] for r in got} == {0}) is together


def test_repeated_and_null_ids(spark):
    texts = ["a b c d e f", "a b c d e f", "A b c d e f", None, "", "q", "q", "x y", "z " * 9]
    ids = [5, 5, None, 3, 2, None, None, None, 9]
    got = near_duplicates(documents(spark, texts, ids)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(ids, texts)


def test_empty_tables(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    got = near_duplicates(documents(spark, [None, " "])).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (1, 0, 1)]


def boilerplate(seed=5, n=240):
    """A third of the documents share most of their words without being alike; among them are pairs
    that are, in the words around."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    same = [word() for _ in range(60)]
    ends = [[word() for _ in range(24)] for _ in range(n // 6)]
    texts = []
    for i in range(n):
        if i % 3:
            texts.append(" ".join(word() for _ in range(rnd.randint(20, 90))))
        else:
            end = list(ends[(i // 3) % len(ends)])
            if i % 2:
                end[rnd.randrange(24)] = word()
            if i % 5 == 0:
                end = end[:12] + [word() for _ in range(12)]
            texts.append(" ".join(same + end))
    return texts


@pytest.mark.parametrize("star_keys,list_rows", [(3, 20_000), (1, 7), (1, 1)])
def test_shared_boilerplate_and_lists_in_parts(spark, monkeypatch, star_keys, list_rows):
    monkeypatch.setattr(ngram_join, "STAR_KEYS", star_keys)
    monkeypatch.setattr(ngram_join, "LIST_ROWS", list_rows)
    texts = boilerplate()
    ids = random.Random(1).sample(range(9000), len(texts))
    got = near_duplicates(documents(spark, texts, ids)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(ids, texts)


def test_merged_counts_are_those_of_the_short_lists(spark, monkeypatch):
    texts = [t for t in boilerplate(seed=9, n=120) if t]
    docs = documents(spark, texts)
    seen = []
    whole = ngram_join.merged_lists
    monkeypatch.setattr(ngram_join, "merged_lists",
                        lambda nodes, labels, *rest: seen.append(
                            (nodes, whole(nodes, spark.createDataFrame([], "node long, component long"),
                                          *rest))) or seen[-1][1])
    near_duplicates(docs).collect()
    nodes, merged = seen[0]
    short = {r["node"]: set(r["prefix"]) for r in nodes.collect()}
    sets = {r["node"]: r for r in nodes.collect()}
    rows = merged.collect()
    assert any(r["merged"] > 1 for r in rows)
    for r in rows:
        assert 1 <= r["merged"] <= len(short[r["node_a"]] & short[r["node_b"]])
        total = sets[r["node_a"]]["n_shingles"] + sets[r["node_b"]]["n_shingles"]
        assert r["enough"] == (175 * r["merged"] >= 75 * total)
    # No pair that links is out: the brute-force links of different sets are all there.
    found = [shingles(t) for t in texts]
    links = {frozenset((frozenset(a), frozenset(b))) for a in found for b in found
             if a != b and 100 * len(a & b) >= 75 * len(a | b)}
    assert len(rows) >= len(links) > 0


def test_probes_count_what_is_in_common():
    rnd = np.random.default_rng(2)
    draw = lambda n: np.unique(rnd.integers(0, 60, n).astype(np.uint64))
    pairs = [(draw(rnd.integers(0, 30)), draw(rnd.integers(0, 90))) for _ in range(200)]
    got = ngram_join.in_common([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [len(np.intersect1d(a, b)) for a, b in pairs]
    assert ngram_join.in_common([], []).tolist() == []


def test_rest_pairs_find_links_that_stars_miss(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "STAR_KEYS", 1)
    texts = near_copies(seed=7, groups=9, each=12)
    ids = list(range(len(texts)))
    got = near_duplicates(documents(spark, texts, ids)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_force(ids, texts)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packed_arrays_round_trip():
    rnd = np.random.default_rng(1)
    arrays = [np.sort(rnd.integers(0, 2**63, 1000).astype(np.uint64)),
              rnd.integers(-5, 5, 7), np.zeros(0, np.uint32), np.array([True, False])]
    for a, b in zip(arrays, unpack(pack(*arrays, ascending=1))):
        assert a.dtype == b.dtype and (a == b).all()
