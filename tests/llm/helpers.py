"""Shared by the operators' tests: documents with odd rows, and rows as sorted tuples."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "rank int, bucket int, length long, n long, score double, label int, word string")


def documents(spark, texts, ids=None):
    """Documents with the given texts and columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src", len(t or ""), 1, 2, 3, 4, 0.5, 1, "w") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts(seed=1, n=60):
    """Null, empty, very long, repeated and near-equal texts in mixed scripts and signs."""
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Wind", "river's", "it'll", "été", "naïve", "漢字", "x1", "42",
                  "end.", "stone", "paper", "light", "!!", "a", "\n", "\t", "  ", "ÀB", "I've"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 80)))
             for _ in range(n)]
    texts += [None, "", " ", "a", "\n\n", texts[0], texts[0], texts[1] + " tail",
              " ".join(rnd.choice(vocabulary) for _ in range(9000)), "\u0000   　x",
              "<|endoftext|> a <|endoftext|>", "'"]
    return texts


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
