from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent)]

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that operators use inside.
    "key string, n string, set_id string, state string, first string, rank string, part string, "
    "start string, length string, score string, text_hash string, id string, root string, "
    "toxic string, norm string, ranges string, place string, tie string, items string"
)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 8)))
        for _ in range(vocabulary)
    ]
    return " ".join(rng.choice(words) for _ in range(n))


def edge_texts():
    """(doc_id, text): nulls, empty and very long texts, ties, copies and near copies."""
    long = prose(1, 30_000, 5_000)
    base = prose(2, 120)
    passage = prose(3, 80)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, long),
        (2, long[: len(long) // 2]),
        (3, base),
        (4, " ".join(near)),
        (5, base.replace(" ", "\n\t ")),
        (6, base.upper()),
        (7, None),
        (8, ""),
        (9, " \t\n\x0b\x0c\r"),
        (10, "one"),
        (11, "One"),
        (12, "one two three four"),
        (13, "one two three four five"),
        (None, base),
        (None, None),
        (14, prose(4, 50) + " " + passage + " " + prose(5, 40)),
        (15, prose(6, 30) + "\n" + passage + "\n" + prose(7, 300)),
        (16, (prose(8, 12) + "\n") * 40),
        (17, "a" * 3000),
        (18, "中文 テキスト 😀 " * 30),
        (19, "\x00\x01 ﬁ   \xa0 x"),
        (20, base),
        (20, base),
        (20, prose(9, 60)),
        (-5, prose(10, 200)),
        (2**62, prose(10, 200) + " end"),
    ]
    # A group of near copies with other words in each, and small sets around the boundary.
    for i in range(30):
        words = base.split()
        words[i * 4] = f"w{i}"
        rows.append((100 + i, " ".join(words)))
    for i in range(40):
        words = prose(11, 14).split()
        words[i % 14] = f"v{i % 3}"
        rows.append((200 + i, " ".join(words)))
    for i in range(30):
        rows.append((300 + i, prose(50 + i, 20 + 3 * i, 60)))
    return rows


@pytest.fixture(scope="session")
def edge_rows():
    return edge_texts()


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    extra = [None] * (len(SCHEMA.split(",")) - 2)
    rows = [(d, t, *extra) for d, t in edge_rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest given tables."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
