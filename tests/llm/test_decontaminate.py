import hashlib
import random
import re

from pyspark.sql import functions as F

from revspark.llm import decontaminate
from revspark.llm.decontaminate import contamination
from tests.llm.helpers import documents, odd_texts

ITEMS = "item_id long, text string, key string, word string, size int, start int, doc_id long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def items(spark, rows):
    return spark.createDataFrame([(i, t, "k", "w", 1, 2, 3) for i, t in rows], ITEMS)


def brute_force(ids, texts, bench, window=10):
    windows = {}
    for i, t in bench:
        w = words(t)
        size = min(window, len(w))
        if i is not None and w:
            for s in range(len(w) - size + 1):
                windows.setdefault(tuple(w[s:s + size]), set()).add(str(i))
    out = []
    for i, t in zip(ids, texts):
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), names, bool(hit)))
    return sorted(out, key=repr)


def run(spark, ids, texts, bench, **kw):
    got = contamination(documents(spark, texts, ids), items(spark, bench), **kw)
    return sorted((tuple(r) for r in got.drop("text_key").collect()), key=repr)


def planted(seed=1):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Wind", "stone", "ÉTÉ", "été", "x1", "42", "漢字", "K", "and"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    bench = [(i, say(rnd.randint(10, 25))) for i in range(12)]
    bench += [(100, "short item"), (101, "one"), (102, ""), (103, None), (None, say(12)),
              (104, bench[0][1]), (104, bench[1][1]), (5, bench[5][1]), (20, "K k K"),
              (105, "  The  the THE the the the the the the the the ")]
    texts = [say(rnd.randint(0, 60)) for _ in range(30)]
    for i, t in bench[:12]:
        cut = words(t)
        a = rnd.randint(0, 3)
        texts.append(say(9) + "\n" + ", ".join(cut[a:a + rnd.randint(8, 20)]).upper() + " " + say(4))
    texts += ["A short item, one.", "été " * 30, "ÉTÉ the of", "the " * 300, "K k k", "K k K"]
    return bench, texts + odd_texts(n=5)


def test_equals_brute_force(spark):
    bench, texts = planted()
    ids = list(range(len(texts)))
    assert run(spark, ids, texts, bench) == brute_force(ids, texts, bench)


def test_in_parts_beyond_the_broadcast_bound(spark):
    bench, texts = planted(2)
    ids = list(range(len(texts)))
    got = run(spark, ids, texts, bench, broadcast_bytes=4000)
    assert got == brute_force(ids, texts, bench)


def test_repeated_and_null_ids(spark):
    bench = [(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k")]
    texts = ["x a b c d e f g h i j y", "x a b c d e f g h i j y", "nothing", "a b c d e f g h i j"]
    ids = [7, 7, 7, None]
    assert run(spark, ids, texts, bench) == brute_force(ids, texts, bench)


def test_empty_tables(spark):
    texts = ["a b", None]
    assert run(spark, [], [], [(1, "a b")]) == []
    assert run(spark, [0, 1], texts, []) == brute_force([0, 1], texts, [])


def test_plan_has_no_python(spark):
    bench, texts = planted()
    df = contamination(documents(spark, texts), items(spark, bench))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_prompt_of_thousands_of_items_is_verified_once(spark, monkeypatch):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(9))
    prompt = [word() for _ in range(10)]
    bench = [(i, " ".join(prompt + [word() for _ in range(3)])) for i in range(3000)]
    texts = [" ".join([word(), *prompt, word()]) for _ in range(20)] + ["nothing " * 12]
    seen = []
    whole = decontaminate.occurrences
    monkeypatch.setattr(decontaminate, "occurrences",
                        lambda *args: seen.append((args[1], whole(*args))) or seen[-1][1])
    ids = list(range(len(texts)))
    assert run(spark, ids, texts, bench) == brute_force(ids, texts, bench)
    (prefixes, found), = seen
    assert found.count() == 20  # one for each place the prompt is at
    assert prefixes.where(F.col("window") == " ".join(prompt)).count() == 1
    assert prefixes.count() == 1 + 3 * 3000
