from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def tokenizer_path() -> str:
    from tenantflow.llm.inputs import default_tokenizer

    return default_tokenizer()


@pytest.fixture(scope="session")
def tokenizer(tokenizer_path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def awkward_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, white space only, very long, other scripts, repeats."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(400)]
    long_text = " ".join(rng.choices(words, k=30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\f\r "),
        (4, "one two"),
        (5, "One  TWO"),
        (6, long_text),
        (7, long_text + " more"),
        (8, "x" * 50_000),
        (9, "Ünïcode naïve 東京タワー Σίσυφος İstanbul é  em\x1cfs\x85nel   nb"),
        (10, "it's <|endoftext|> we'll 12 ³ ½ %%% !!! don't<|startoftext|>x"),
        (11, "a b c d e f g h i j"),
        (12, "a b c d e f g h i j"),
        (13, "A B C D E F G H I J\n"),
        (13, "A B C D E F G H I J\n"),
        (None, "a row without an id and some words"),
        (None, None),
    ]


@pytest.fixture
def awkward(spark):
    """The awkward texts, with columns whose names the operators use themselves."""
    schema = (
        "doc_id long, text string, KEPT string, digest string, start string, node string, "
        "text_key string, winner string, n_chars long, class string"
    )
    rows = [(i, t, "k", "d", "s", "n", "t", "w", None if t is None else len(t), "c") for i, t in awkward_texts()]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
