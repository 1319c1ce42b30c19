import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revspark.llm.toxicity import toxicity as op2
from tests.llm import test_decontaminate, test_ngram_join, test_substring_dedup
from tests.llm.helpers import documents, odd_texts
from tests.llm.test_tokens import check_packing

TOXIC = ["snarkle", "grubble", "vexoria"]


def corpus(seed=8):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 7)))
    say = lambda n: [word() for _ in range(n)]
    bench = [(i, " ".join(say(15))) for i in range(4)]
    passage = " ".join(say(60))
    texts, toxic = [], []
    for i in range(120):
        words = say(rnd.randint(20, 60))
        if i % 4 == 0:
            words.insert(5, rnd.choice(TOXIC))
            words.insert(15, rnd.choice(TOXIC))
            toxic.append(i)
        elif i % 4 == 1 and i > 8:
            words = texts[i - 4].split()  # a near copy, in a chain of them
            words[rnd.randrange(len(words))] = word()
        elif i % 8 == 2:
            words += passage.split()
        elif i % 16 == 3:
            words += bench[i % 4][1].split()
        texts.append(" ".join(words))
    return texts + odd_texts(n=12), toxic, bench


@pytest.fixture
def tables(spark, tmp_dir):
    texts, toxic, bench = corpus()
    ids = [*range(len(texts) - 1), None]
    documents(spark, texts, ids).write.parquet(f"{tmp_dir}/documents.parquet")
    marks = [(i, 1, int(i in toxic)) for i in range(120)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_dir}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(
        f"{tmp_dir}/benchmark.parquet")
    return tmp_dir, list(zip(ids, texts)), toxic, bench


def test_stages_against_brute_force(spark, tables):
    folder, rows, toxic, bench = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "packing"]

    def stage(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, folder)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{folder}/{k}")
        back = spark.read.parquet(f"{folder}/{k}")
        texts = back.select("doc_id", "text").collect() if k < 4 else []
        return back, sorted(map(tuple, texts), key=repr)

    docs, kept = stage(0, docs)
    scored = op2(spark.read.parquet(f"{folder}/documents.parquet"),
                 spark.read.parquet(f"{folder}/labels.parquet"))
    rejected = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    assert kept == sorted((r for r in rows if r[0] not in rejected), key=repr)
    assert len(rejected ^ set(toxic)) <= 6  # a classifier that learned from few rows

    ids, texts = zip(*kept)
    groups = {}
    for (i, n, c) in test_ngram_join.brute_force(ids, texts):
        groups.setdefault(("empty", i) if n == 0 else c, []).append(i)
    docs, kept = stage(1, docs)
    assert sorted((i for i, _ in kept), key=repr) == sorted(
        (min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)

    found = {r[0]: r[2] for r in test_substring_dedup.brute_force(*zip(*kept))}
    before = dict(kept)
    docs, kept = stage(2, docs)
    assert any(found.values()) and len(kept) == len(found)
    for i, t in kept:
        if not found[i]:
            assert t == before[i]
        else:  # cuts may part characters
            assert 0 <= len(before[i].encode()) - found[i] - len(t.encode()) < 4 * 20
    changed = {r["doc_id"]: r["n_chars"] for r in docs.collect()}
    assert all(changed[i] == len(t) for i, t in kept if found[i])

    hit = {r[0] for r in test_decontaminate.brute_force(*zip(*kept), bench) if r[5]}
    want = sorted((r for r in kept if r[0] not in hit), key=repr)
    docs, kept = stage(3, docs)
    assert hit and kept == want

    packed, _ = stage(4, docs)
    result = packed.collect()
    check_packing(result, *zip(*kept))

    run = corpus_pipeline.run(spark, folder)
    names = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*names).collect()), key=repr) == sorted(
        (tuple(r[n] for n in names) for r in result), key=repr)


def test_repeated_rows(spark, tables):
    folder = tables[0]
    df = documents(spark, ["a b c d e f", "a b c d e f", "", None, None], [1, 1, 2, 2, 2])
    df = df.withColumn("source", F.monotonically_increasing_id().cast("string"))
    got = corpus_pipeline.near_copies(spark, df, folder).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == [
        (1, "a b c d e f"), (2, ""), (2, ""), (2, "")]
    for stage in (corpus_pipeline.repeated_passages, corpus_pipeline.decontaminate):
        assert stage(spark, df, folder).count() == 5


def test_empty_documents(spark, tables):
    folder = tables[0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), folder).count() == 0


CLASHING = ("kept", "__rows", "__id", "__key", "found_n", "found__kept", "n", "component", "text_key",
            "score", "a.b", "Doc Id")


def test_stages_keep_columns_of_any_name(spark, tables):
    folder, rows, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = docs
    clash = docs.select("*", *[F.col("n_chars").cast("string").alias(c) for c in CLASHING
                               if c not in docs.columns])
    for k in range(4):
        stage = corpus_pipeline.STAGES[k][1]
        small, wide = stage(spark, plain, folder), stage(spark, clash, folder)
        assert wide.columns == clash.columns
        pick = lambda df: sorted(
            ((r["doc_id"], r["text"], r["n_chars"]) for r in df.collect()), key=repr)
        assert pick(small) == pick(wide)
