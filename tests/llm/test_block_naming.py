import hashlib
import random

import pytest
from pyspark.sql import functions as F

from revspark.llm.block_naming import exact_duplicates, normalised
from tests.llm.helpers import documents, odd_texts, rows

SPACE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(texts, ids):
    """The contract, stated plainly over a list."""
    whole = [(t or "").translate(SPACE) for t in texts]
    groups = {}
    for at, text in enumerate(whole):
        groups.setdefault(text, []).append(at)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda at: (-len(texts[at] or ""), ids[at] is None, ids[at] or 0, at))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(ids[at], ids[best], len(members), at == best, sha) for at in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1, 7, 64, 4096])
def test_equals_brute_force(spark, block_bytes):
    texts = odd_texts(n=30)
    if block_bytes == 1:
        texts = [t[:300] if t else t for t in texts]
    ids = random.Random(3).sample(range(1000), len(texts))
    got = rows(exact_duplicates(documents(spark, texts, ids), block_bytes=block_bytes))
    assert got == brute(texts, ids)


def test_blocks_that_share_a_hash_keep_their_own_names(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    ids = list(range(200))
    for block_hash in (lambda b: F.lit(7).cast("long"), lambda b: F.length(b).cast("long")):
        got = exact_duplicates(documents(spark, texts, ids), block_bytes=3, block_hash=block_hash)
        assert rows(got) == brute(texts, ids)


def test_texts_whose_blocks_differ_only_in_order_or_number(spark):
    texts = ["abab", "baba", "ab", "abababab", "aabb", "ab ab", "", "ba", "ababab", "abababa"]
    got = rows(exact_duplicates(documents(spark, texts), block_bytes=2))
    assert got == brute(texts, list(range(len(texts))))
    assert sum(r[3] for r in got) == len(texts) - 1


def test_the_row_with_most_code_points_stays_then_the_smallest_id(spark):
    texts = ["a b", "ab", "a  b", "a\tb ", "é\n", "é", None, "", "\x0b\x0c", " ", "  "]
    ids = [9, 1, 8, 7, 5, 6, 4, 3, None, 2, 0]
    got = {r["doc_id"]: r for r in exact_duplicates(documents(spark, texts, ids)).collect()}
    assert {got[i]["keep_id"] for i in (9, 1, 8, 7)} == {7}
    assert got[5]["kept"] and not got[6]["kept"]
    assert got[None]["kept"] and got[4]["keep_id"] is None and got[4]["group_size"] == 3
    assert got[2]["keep_id"] == 0 and got[0]["group_size"] == 2  # no-break space is no white space


def test_repeated_rows_and_null_ids(spark):
    texts, ids = ["x y"] * 4 + [None, None, "z"], [3, 3, None, None, None, None, None]
    got = exact_duplicates(documents(spark, texts, ids)).collect()
    assert sorted((r["group_size"], r["keep_id"] or -1) for r in got) == [
        (1, -1), (2, -1), (2, -1), (4, 3), (4, 3), (4, 3), (4, 3)]
    assert sum(r["kept"] for r in got) == 3


def test_a_very_long_text_and_its_copy(spark):
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefg é漢\n") for _ in range(300_000))
    texts = [long, long.replace("\n", " \n "), long[:-1] + "!", "x"]
    got = rows(exact_duplicates(documents(spark, texts), block_bytes=1024))
    assert got == brute(texts, [0, 1, 2, 3])


def test_empty_table_and_schema(spark):
    got = exact_duplicates(documents(spark, []))
    assert got.count() == 0
    assert got.dtypes == [("doc_id", "bigint"), ("keep_id", "bigint"), ("group_size", "bigint"),
                          ("kept", "boolean"), ("text_sha256", "string")]


def test_normalisation_deletes_six_characters_only(spark):
    text = "".join(chr(c) for c in range(1, 0x250))
    got = spark.createDataFrame([(text,)], "t string").select(normalised(F.col("t"))).first()[0]
    assert got == text.translate(SPACE)


def test_no_python_in_the_plan(spark):
    got = exact_duplicates(documents(spark, ["a", "b", "a"]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
