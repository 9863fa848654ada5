import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm.tokens import NO_RANK, Encoder, PairTree, count_tokens, default_path, encode_corpus, merge_piece, parse_ranks

with open(default_path(), "rb") as file:
    RANKS = parse_ranks(file.read())
ENCODER = Encoder(RANKS)
BYTES = {rank: token for token, rank in RANKS.items()}


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_round_trip(text):
    assert b"".join(BYTES[i] for i in ENCODER.encode(text)).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\tx1.'é漢🙂<|endoftext|> ​\x1c\x85", max_size=120))
def test_equals_the_public_library(reference, text):
    assert ENCODER.encode(text) == reference.encode_ordinary(text)


def test_long_words(reference):
    rng = random.Random(2)
    for text in ("x" * 50_000, "ab" * 20_000, "".join(rng.choice("abcdefgh") for _ in range(30_000))):
        assert ENCODER.encode(text) == reference.encode_ordinary(text)


def test_every_token_of_the_vocabulary_is_reached_by_merges():
    for token, rank in list(RANKS.items())[::37]:
        assert merge_piece(token, RANKS) == (rank,)


@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.lists(st.tuples(st.integers(0, 39), st.integers(0, 6)), max_size=20))
def test_tree_yields_the_leftmost_lowest(ranks, changes):
    tree = PairTree(list(ranks))
    for place, rank in changes:
        if place < len(ranks):
            ranks[place] = rank if rank < 6 else NO_RANK
            tree.put(place, ranks[place])
    assert tree.lowest() == (-1 if min(ranks) == NO_RANK else ranks.index(min(ranks)))


def test_whole_table(spark, reference):
    rows = [(1, "The harbour was quiet.\r\n"), (2, ""), (3, None), (4, "  "), (4, "again"), (None, "x"), (5, "<|endoftext|>"), (6, "word " * 3000)]
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, TEXT string")
    got = sorted(((r["key"], r["ids"]) for r in encode_corpus(df, key="doc_id", text="text").collect()), key=str)
    assert got == sorted(((k, reference.encode_ordinary(t or "")) for k, t in rows), key=str)
    counts = count_tokens(df, text="text", keep=("doc_id",)).collect()
    assert sorted((str(r["doc_id"]), r["tokens"]) for r in counts) == sorted((str(k), len(reference.encode_ordinary(t or ""))) for k, t in rows)
    assert encode_corpus(df.limit(0), key="doc_id", text="text").count() == 0
