import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revspark.llm import spans
from revspark.llm.alignment import _unpacked, aligned, token_groups
from tests.llm.helpers import documents, odd_texts, rows

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["a  b", "  lead", "trail ", "trail   ", " ", "   ", "\n", "a\n b", "tab\t x", "mark ▁ here",
       "▁", "﷽ ligature ﬁ", "😀😀 é", "<s> </s> <unk> <0x41>", "<|endoftext|>x", "漢字の文", "\x00 a",
       "é combining", "１２３ ②", "don't we'll 'tis", "A" * 500, "漢" * 300, " nbsp", "x\r\ny"]


def plain_tokens():
    """Id and bytes of the tokens of a whole text, asked of the libraries at once."""
    a = Tokenizer.from_file(public_tokenizers.path(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))
    alphabet = spans.byte_level_alphabet()

    def piece(i):
        text = b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b.is_byte(i) else text.replace("▁", " ").encode()

    def both(text):
        found = a.encode(" " + text, add_special_tokens=False)
        return ([(i, bytes(alphabet[c] for c in t)) for i, t in zip(found.ids, found.tokens)],
                [(i, piece(i)) for i in b.encode(text)])

    return both


def brute(texts, ids):
    """The contract over a list, byte by byte."""
    both, found, totals = plain_tokens(), [], Counter()
    for text in texts:
        groups, links, n_a, n_b = "", [], 0, 0
        if text:
            a, b = both(text)
            want = (" " + text).encode()
            if b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want:
                n_a, n_b = len(a), len(b)
                owner_a = [k for k, (_, x) in enumerate(a) for _ in x]
                owner_b = [k for k, (_, x) in enumerate(b) for _ in x]
                pairs = sorted(set(zip(owner_a, owner_b)))
                links = [(a[i][0], b[j][0]) for i, j in pairs]
                ends = set(np.cumsum([len(x) for _, x in a]).tolist())
                ends &= set(np.cumsum([len(x) for _, x in b]).tolist())
                cut = [0, *sorted(ends)]
                parts = [(sorted(set(owner_a[x:y])), sorted(set(owner_b[x:y])))
                         for x, y in zip(cut, cut[1:])]
                groups = ";".join(",".join(str(a[i][0]) for i in p) + "|"
                                  + ",".join(str(b[j][0]) for j in q) for p, q in parts)
        found.append((n_a, n_b, groups, links))
        totals.update(links)
    highest = {}
    for (_, b), n in totals.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for i, (n_a, n_b, groups, links) in zip(ids, found):
        out.append((i, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links),
                    sum(totals[x] == highest[x[1]] for x in links), sum(totals[x] for x in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run_bytes", [1, 2000, 8 << 20])
def test_equals_brute_force(spark, run_bytes):
    texts = odd_texts(n=30) + ODD
    ids = random.Random(3).sample(range(1000), len(texts))
    df = documents(spark, texts, ids)
    want = brute(texts, ids)
    assert rows(aligned(df, A, B, run_bytes=run_bytes)) == sorted((w[:-1] for w in want), key=repr)
    assert dict(rows(token_groups(df, A, B))) == {w[0]: w[-1] for w in want}


def test_tokens_of_units_are_those_of_whole_texts():
    rnd = random.Random(8)
    signs = ["a", "b", " ", " ", "  ", "é", "漢", "😀", "\n", "'s", "1", "!", "▁", "the", "́", "ﬁ"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    texts = [t for t in texts + ODD if t]
    both = plain_tokens()
    pair = spans.tokenizer_pair(A, B)
    for _ in range(2):  # first met, then remembered
        for found, which in ((pair[0]([" " + t for t in texts]), 0),
                             (pair[1]([" " + t for t in texts]), 1)):
            at = 0
            for text, n, whole in zip(texts, found.counts.tolist(), found.whole.tolist()):
                want = both(text)[which]
                assert found.ids[at:at + n].tolist() == [i for i, _ in want], text
                assert whole == (b"".join(x for _, x in want) == (" " + text).encode())
                if whole:
                    assert found.sizes[at:at + n].tolist() == [len(x) for _, x in want], text
                at += n


def test_units_that_are_not_remembered(spark, monkeypatch):
    monkeypatch.setattr(spans, "MAX_UNITS", 16)
    monkeypatch.setattr(spans, "MAX_UNIT_BYTES", 4)
    texts = [t for t in odd_texts(n=10) if t][:12]
    pair = spans.ByteLevel(public_tokenizers.path(A)), spans.SentencePiece(public_tokenizers.path(B))
    both = plain_tokens()
    for text in texts:
        for which, found in enumerate((pair[0]([" " + text]), pair[1]([" " + text]))):
            assert found.ids.tolist() == [i for i, _ in both(text)[which]]


def test_repeated_rows_null_ids_and_nothing(spark):
    texts, ids = ["a b", "a b", None, "", "a b"], [1, 1, 2, None, None]
    got = rows(aligned(documents(spark, texts, ids), A, B))
    assert got == sorted((w[:-1] for w in brute(texts, ids)), key=repr)
    assert [r[1:] for r in got if r[0] == 2] == [(0, 0, 0, 0, 0, 0, "")]


def test_empty_table_and_schema(spark):
    got = aligned(documents(spark, []), A, B)
    assert got.count() == 0
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]


def test_a_very_long_text_and_one_hot_pair(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["wind", "stone", "é", "naïve", "42."]) for _ in range(30_000))]
    texts += ["the the the"] * 300
    ids = list(range(len(texts)))
    got = rows(aligned(documents(spark, texts, ids), A, B, run_bytes=500))
    assert got == sorted((w[:-1] for w in brute(texts, ids)), key=repr)


def test_packed_pairs_of_documents_without_any():
    places, times = _unpacked(__import__("zlib").compress(b"", 1), np.zeros(3, np.int64))
    assert len(places) == len(times) == 0
