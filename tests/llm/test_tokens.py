import os
import random

import pytest

from lexigraft.llm import tokens

RANKS = os.path.join(tokens.TOKENIZERS, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary files")


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.load_ranks(RANKS))


@pytest.fixture(scope="module")
def other():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(tokens.TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_same_ids_as_the_library(encoder, other):
    r = random.Random(7)
    texts = ["", " ", "<|endoftext|>", "don't\n\n  x", "名词解释", "é" * 50, "a" * 3000, "😀🎉 ok"]
    texts += ["".join(r.choice("abehinorst  \n=-_.0129é中文œ😀'") for _ in range(r.randint(1, 80))) for _ in range(2000)]
    for t in texts:
        assert encoder.encode(t) == other(t)


def test_prefixes_appends_and_edits(encoder):
    v, r = encoder.vocab, random.Random(1)
    whole = lambda b: tokens.PrefixEncoding(v, b).tokens()
    for _ in range(200):
        b = bytes(r.choice(b"aaabcdeeinrstt ") for _ in range(r.randint(1, 40)))
        p = tokens.PrefixEncoding(v)
        for i in range(0, len(b), 3):
            p.append(b[i : i + 3])
        assert p.tokens() == whole(b) and all(p.tokens(k) == whole(b[:k]) for k in range(len(b)))
        i = r.randint(0, len(b))
        j = r.randint(i, len(b))
        p.replace(i, j, b"the")
        assert p.tokens() == whole(b[:i] + b"the" + b[j:])


def test_column(spark, encoder):
    df = spark.createDataFrame([(1, "hello world", 0), (2, None, 0), (3, "", 0), (4, "x" * 200_000, 0), (1, "hello world", 0)], "id int, t string, ids int").drop("ids")
    got = [r.ids for r in tokens.encode_column(df, "t", RANKS).orderBy("id").collect()]
    assert got[0] == got[1] == [31373, 995] and got[2] == [] and got[3] == [] and len(got[4]) > 1000
    assert tokens.encode_column(df.limit(0), "t", RANKS).count() == 0
