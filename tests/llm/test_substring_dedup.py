import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from revspark.llm import anchors, substring_dedup as module
from revspark.llm.packed import pack, unpack
from revspark.llm.substring_dedup import substring_dedup, window_minima
from revspark.llm.suffix_array import common_prefix_at_least, permuted_prefixes, suffix_array
from tests.llm.helpers import documents, odd_texts


def brute_force(ids, texts):
    seen, out = {}, []
    for i, t in zip(ids, texts):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                seen[b[k:k + 50]] = min(seen.get(b[k:k + 50], i), i)
    for i, t in zip(ids, texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and seen[b[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed=1):
    """Texts around common passages, cut at any byte, with copies and low-entropy stretches."""
    rnd = random.Random(seed)
    say = lambda n, abc="abcdé ": "".join(rnd.choice(abc) for _ in range(n))
    common = [say(rnd.randint(45, 160)) for _ in range(6)]
    texts = []
    for _ in range(60):
        t = say(rnd.randint(0, 120))
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(common)
            a = rnd.randint(0, 20)
            t += p[a:len(p) - rnd.randint(0, 20)] + say(rnd.randint(0, 30))
        texts.append(t)
    texts += ["a" * n for n in (49, 50, 51, 400, 200)] + ["ab" * 90, "ba" * 60, texts[3], texts[7]]
    return texts


def run(spark, ids, texts):
    got = substring_dedup(documents(spark, texts, ids)).drop("text_key")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("shard_bytes", [200, 8 << 20])
def test_equals_brute_force(spark, monkeypatch, shard_bytes):
    texts = passages() + odd_texts(n=20)
    ids = random.Random(3).sample(range(-300, 3000), len(texts))
    monkeypatch.setattr(module, "SHARD_BYTES", shard_bytes)
    assert run(spark, ids, texts) == brute_force(ids, texts)


def test_repeated_and_null_ids(spark):
    texts = passages(5)
    ids = [random.Random(i).choice([None, 1, 2, 2, 3, i]) for i in range(len(texts))]
    texts, ids = texts + texts[:5], ids + ids[:5]
    assert run(spark, ids, texts) == brute_force(ids, texts)


def test_kept_bytes(spark):
    text = "".join(random.Random(9).choice("abcdefg ") for _ in range(120))
    got = {r["doc_id"]: r["kept"] for r in substring_dedup(
        documents(spark, [text, "x" + text + "yé"]), with_text=True).collect()}
    assert got == {0: text, 1: "xyé"}


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert run(spark, [1, 2], [None, "short"]) == brute_force([1, 2], [None, "short"])


@pytest.mark.parametrize("alphabet,size", [(1, 200), (2, 300), (4, 500), (200, 300)])
def test_suffix_arrays(alphabet, size):
    rng = np.random.default_rng(alphabet)
    for n in (1, 2, 3, size):
        for text in (rng.integers(0, alphabet, n), np.tile(rng.integers(0, alphabet, 7), n)[:n]):
            text = text.astype(np.uint8)
            raw = text.tobytes()
            assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: raw[i:])
    assert len(suffix_array(np.zeros(0, np.uint8))) == 0


def test_common_prefixes():
    text = np.frombuffer(b"abcdefghijklmnopqrst" * 10, np.uint8)
    at = np.array([0, 20, 21, 41, 60])
    assert common_prefix_at_least(text, at, 50).tolist() == [True, False, True, False]


def test_window_minima():
    a, b = b"x" * 10 + bytes(range(50)), bytes(range(50)) + b"y" * 5
    got = window_minima(np.frombuffer(a + b, np.uint8), np.array([0, 60]), np.array([11, 6]),
                        np.array([9, 4]))
    assert got.tolist() == [9] * 10 + [4] + [4] * 6


@pytest.mark.parametrize("block", [100, 1 << 18])
def test_anchors_depend_on_the_window_alone(block):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99 if i % 2 else 122, rng.integers(0, 400)).astype(np.uint8))
             for i in range(40)] + [b"a" * 300, b"", b"x" * 49, b"y" * 50]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.append(0, np.cumsum([len(t) for t in texts]))
    by_window = {}
    covered = 0
    for r, first, n, at, _, _ in zip(*anchors.segments(data, offs, block)):
        for k in range(n):
            assert offs[r] <= first + k and first + k + 50 <= offs[r + 1] and 0 <= at - k < 20
            window = data[first + k:first + k + 50].tobytes()
            assert by_window.setdefault(window, at - k) == at - k
            covered += 1
    assert covered == sum(max(0, len(t) - 49) for t in texts)


def removed_in_process(ids, texts, groups=3, ranges=8):
    """The operator's steps over hand-made groups, without Spark; also the largest range's bytes."""
    def by(name, tables):
        whole = pa.concat_tables(tables)
        return [whole.filter(pa.array(whole.column(name).to_numpy() == k))
                for k in sorted(set(whole.column(name).to_pylist()))]

    rows = [[i for i in range(len(ids)) if i % groups == g] for g in range(groups)]
    dealt = []
    for g, own in enumerate(rows):
        raw = [texts[i].encode() for i in own]
        blob = pack(np.array([ids[i] for i in own]), np.zeros(len(own), bool), np.array(own),
                    np.array([len(r) for r in raw]), np.frombuffer(b"".join(raw), np.uint8))
        dealt.append(pa.table({"grp": pa.array([g], pa.int32()), "blob": pa.array([blob])}))
    posted = [module.post_anchors(ranges)(t) for t in dealt]
    shared = pa.concat_tables([module.shared_anchors(t) for t in by("range", posted)])
    of = lambda table, g: table.filter(pa.array(table.column("grp").to_numpy() == g))
    asked = by("range", [module.post_segments(ranges)(t, of(shared, g))
                         for g, t in enumerate(dealt)])
    answers = pa.concat_tables([module.answer_segments(t) for t in asked])
    out = pa.concat_tables([module.remove(False)(t, of(shared, g), of(answers, g))
                            for g, t in enumerate(dealt)])
    largest = max(sum(x.nbytes for b in t.column("blob") for x in unpack(b.as_buffer()))
                  for t in asked)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    result = sorted(zip(*(out.column(n).to_pylist() for n in names)), key=repr)
    return result, largest, sum(x.nbytes for t in asked for b in t.column("blob")
                                for x in unpack(b.as_buffer()))


def test_hot_anchor_is_split_over_ranges_and_shards(monkeypatch):
    rnd = random.Random(12)
    say = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    menu = "Home | News | About us | Terms of licence | Help "  # 49 bytes
    texts = [say(25) + menu + say(25) for _ in range(40_000)]
    for i in range(0, 3000, 3):  # windows with the hot anchor that do repeat
        texts[i] = texts[i][:-25] + texts[i + 1][-25:]
    ids = rnd.sample(range(10**6), len(texts))
    sizes = []
    whole = module.suffix_array
    monkeypatch.setattr(module, "suffix_array",
                        lambda text, depth: sizes.append(len(text)) or whole(text, depth))
    got, largest, posted = removed_in_process(ids, texts)
    assert got == brute_force(ids, texts)
    assert sizes and max(sizes) <= 2 * module.SHARD_BYTES
    assert largest <= 1.5 * posted / 8


@pytest.mark.parametrize("shard_bytes", [60, 500, 5000])
def test_split_anchors_equal_brute_force(monkeypatch, shard_bytes):
    monkeypatch.setattr(module, "SHARD_BYTES", shard_bytes)
    texts = passages(7) + [t or "" for t in odd_texts(n=20)]
    ids = [random.Random(i).choice([1, 2, 2, 3, i, 2 * i]) for i in range(len(texts))]
    assert removed_in_process(ids, texts)[0] == brute_force(ids, texts)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 26])
def test_permuted_prefixes_equal_direct_comparison(alphabet):
    rng = np.random.default_rng(alphabet)
    passage = rng.integers(0, alphabet, 120)
    text = np.concatenate([np.concatenate([rng.integers(0, alphabet, 9), passage[a:]])
                           for a in (0, 3, 40, 60, 0)] + [rng.integers(0, alphabet, 80)])
    text = text.astype(np.uint8)
    raw, length = text.tobytes(), 50
    for depth in (length, None):
        suffixes = suffix_array(text, depth)
        suffixes = suffixes[(suffixes <= len(text) - length) & (suffixes % 17 != 5)]
        want = {b: raw[a:a + length] == raw[b:b + length]
                for a, b in zip(suffixes[:-1].tolist(), suffixes[1:].tolist())}
        places, same = permuted_prefixes(text, suffixes, length)
        assert places.tolist() == sorted(want)
        assert dict(zip(places.tolist(), same.tolist())) == want
        assert any(want.values())
    for n in (0, 1):
        assert len(common_prefix_at_least(text, suffixes[:n], length)) == 0


def test_windows_of_split_anchors_are_told_apart_by_their_bytes(monkeypatch):
    """With every window's hash alike, only the suffix arrays can tell them apart."""
    monkeypatch.setattr(module, "SHARD_BYTES", 2000)
    seen = []
    minima = module.window_minima
    monkeypatch.setattr(module, "window_minima",
                        lambda text, *rest: seen.append(len(text)) or minima(text, *rest))
    rnd = random.Random(14)
    say = lambda n: "".join(rnd.choice("abcdef ") for _ in range(n))
    menu = "Home | News | About us | Terms of licence | "
    texts = [say(30) + menu + say(30) for _ in range(300)]
    for i in range(0, 200, 2):
        texts[i] = texts[i][:-30] + texts[i + 1][-30:]
    ids = list(range(len(texts)))
    assert removed_in_process(ids, texts)[0] == brute_force(ids, texts)
    assert len(seen) > 5
