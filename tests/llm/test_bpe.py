import random

import pytest

from tidemark.llm.bpe import NONE, Encoder, PairTree, count_tokens, encode_corpus, load_ranks, merge_piece
from tidemark.llm.queries import vocabulary_files

PATH, PATTERN = vocabulary_files()


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


def slow_merge(piece, ranks):
    """Every pair is looked at before each merge."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks.get(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        if not found or min(found)[0] == NONE:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_tree_keeps_the_leftmost_minimum():
    r = random.Random(5)
    for n in (1, 2, 3, 17):
        values = [r.randrange(5) for _ in range(n)]
        t = PairTree(values)
        for _ in range(50):
            assert (t.least(), t.leftmost()) == (min(values), values.index(min(values)))
            i = r.randrange(n)
            values[i] = r.choice([NONE, r.randrange(5)])
            t.set(i, values[i])


def test_pieces_against_slow_merge(ranks):
    r = random.Random(6)
    for _ in range(300):
        piece = "".join(r.choice("aabcehinorst éß日\n") for _ in range(r.randrange(1, 40))).encode()
        assert merge_piece(piece, ranks) == slow_merge(piece, ranks)


TEXTS = ["", " ", None, "Hello, world!", "<|endoftext|> is text", "I'm 3.14\n\n\tx  y ", "a" * 5000, "é日本語 😀 ‍ ार", "naïve\x00\x01", "ab" * 3000 + " end"]


def test_corpus_against_the_public_library(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    public = Tokenizer.from_file(path("byte_bpe_50k.json"))
    public.encode_special_tokens = True
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, "", "clash", 1)], "doc_id long, text string, ids string, n_tokens long")
    got = encode_corpus(df, key="doc_id", text="text", path=PATH, pattern=PATTERN).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        want = public.encode(TEXTS[r.doc_id], add_special_tokens=False).ids if TEXTS[r.doc_id] else []
        assert r.ids == want
    counted = {r.doc_id: r.n_tokens for r in count_tokens(df, keys=["doc_id"], text="text", path=PATH, pattern=PATTERN).collect()}
    assert counted == {r.doc_id: len(r.ids) for r in got}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode_corpus(df, key="doc_id", text="text", path=PATH, pattern=PATTERN).collect() == []


def test_long_piece_takes_n_log_n(ranks):
    import time

    e = Encoder(ranks, PATTERN)
    took = []
    for n in (20_000, 80_000):
        text = "".join(random.Random(n).choices("abcdefgh", k=n))
        began = time.process_time()
        e.encode(text)
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]  # 16 times if it were quadratic
