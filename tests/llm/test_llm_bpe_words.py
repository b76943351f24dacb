"""Words of the pre-tokenizer are encoded once and kept, whatever stands around them."""

import random

import numpy as np
import public_tokenizers

from tessera.llm.bpe import Codec, encode
from tessera.llm.packing import pack, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_around_line_ends_are_encoded_once():
    codec = Codec(PATH)
    made = []
    word_ids = codec.word_ids
    codec.word_ids = lambda w: made.append(w) or word_ids(w)
    for i in range(50):
        words = [f"{a}\n{b}" for a in ("alpha", "beta", "été") for b in ("gamma,", "“delta”")]
        random.Random(i).shuffle(words)
        text = " ".join(words)
        assert codec.encode(text) == codec.library(text).tobytes()
    assert len(made) == len(set(made)) <= 16 and not codec.words


def test_words_of_known_characters_equal_the_library():
    codec, rng = Codec(PATH), random.Random(3)
    some = " \n\t\r\x0b\x0c\x1c\x00\x7f'sdrevmlAbz09.,!_\xa0　éñßя中ा́²½٣“”€​ \x85᠎😀ꟊ"
    for _ in range(4000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(1, 14)))
        assert codec.encode(text) == codec.library(text).tobytes(), ascii(text)


def test_many_texts_at_once_equal_the_library(monkeypatch):
    monkeypatch.setattr("tessera.llm.bpe.CACHE", 40)
    monkeypatch.setattr("tessera.llm.bpe.GROUP", 300)
    codec, rng = Codec(PATH), random.Random(4)
    some, odd = " \n\t''''sdrevmlAb0.,\xa0　é中", "\x1c\x00\u2003\x85᠎😀ꟊ"
    for _ in range(60):
        texts = ["".join(rng.choice(some if rng.random() < 0.99 else odd) for _ in range(rng.randint(0, 14))) for _ in range(60)]
        texts += ["<|endoftext|>'s a", "", "x'll", "'ll", "a'r", "'v", "de'm", "a" * 5000 + "  ", "\0", "it's 'd"]
        rng.shuffle(texts)
        assert codec.encode_all(texts) == [codec.library(t).tobytes() for t in texts]
    assert codec.past and codec.encode_all([]) == []


def test_packing_takes_ids_as_bytes(spark):
    rows = [(i, "it's  one text\n" * (i % 40)) for i in range(60)] + [(70, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lists, raw = (encode(docs, PATH, ["doc_id"], want=(w,)) for w in ("ids", "ids_binary"))
    got = [sorted(map(tuple, pack(t, ids_col=c, row=64, shards=3).collect())) for t, c in ((lists, "ids"), (raw, "ids_binary"))]
    assert got[0] == got[1] and got[0]
    assert pack(raw, ids_col="ids_binary", row=64).count() == pack(lists, row=64).count()


def test_ids_in_bytes_are_cut_without_python(spark):
    rows = [(i, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate((0, 1, 63, 64, 65, 200))] + [(None, b"\1\0\0\0"), (9, None)]
    cut = pieces(spark.createDataFrame(rows, "doc_id long, ids binary"), "doc_id", "ids", 64, 3)
    assert "InArrow" not in cut._jdf.queryExecution().executedPlan().toString()  # each such node holds a worker beside the encoder's
    want = [(i, a, x[4 * a:4 * a + 256]) for i, x in rows if x for a in range(0, len(x) // 4, 64)]
    got = [(r["doc"], r["start"], bytes(r["part"])) for r in cut.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    lists = spark.createDataFrame([(i, None if x is None else np.frombuffer(x, "<u4").tolist()) for i, x in rows], "doc_id long, ids array<int>")
    assert sorted(map(str, pieces(lists, "doc_id", "ids", 64, 3).collect())) == sorted(map(str, cut.collect()))
