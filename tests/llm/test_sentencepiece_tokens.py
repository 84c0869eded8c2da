import os
import struct

import pytest
from fixture import documents, texts
from pyspark.sql import functions as F

from leadlens.llm import sentencepiece_tokens as sp

pytestmark = pytest.mark.skipif(not os.path.exists(sp.MODEL), reason="no tokenizer files here")
ODD = ["", " ", "  a  b\nc ", "▁x ▁", "<s> <unk> </s> <0x0A>", "\x00\t\r", "é漢\U0001F600\u0301", "a" * 5000, "\n" * 300]


@pytest.fixture(scope="module")
def reference():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)


def test_parity_and_round_trip(spark, reference):
    rows = [*texts(), *((100 + k, t) for k, t in enumerate(ODD))]
    got = sp.tokens(documents(spark, rows))
    want = sorted(((d, reference.encode(t or "")) for d, t in rows), key=repr)
    assert sorted(((r["id"], list(r["ids"])) for r in got.collect()), key=repr) == want
    assert all(r["parity"] and (r["roundtrip"] or "▁" in dict(rows)[r["id"]]) and r["n_tokens"] == len(r["ids"])
               for r in got.collect())


def test_every_row_is_verified_by_default(spark):
    docs = documents(spark, [*texts(), *((100 + k, t) for k, t in enumerate(ODD))])
    assert docs.count() == sp.tokens(docs).where("parity").count()
    assert docs.count() == docs.select(sp.encoded(F.col("text")).alias("e")).where("e.parity").count()


def test_decoding_a_column(spark):
    rows = [(k, t) for k, t in enumerate(ODD) if "▁" not in t]
    done = documents(spark, rows).select("text", sp.decoded(sp.encoded(F.col("text"))["ids"]).alias("again"))
    assert all(r["text"] == r["again"] for r in done.collect())
    assert sp.tokens(documents(spark, [])).count() == 0


def _field(number, value):
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        return bytes([number << 3 & 127 | (128 if number > 15 else 0), *([number >> 4] if number > 15 else []), value])
    return bytes([number << 3 | 2, len(value)]) + value


def test_unigram_models_follow_their_scores():
    pieces = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), ("▁", -3.0, 1), ("a", -4.0, 1),
              ("b", -4.0, 1), ("ab", -5.0, 1), ("▁ab", -6.0, 1), ("aba", -9.5, 1)]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    data += _field(2, _field(3, 1) + _field(35, 1)) + _field(3, _field(3, 1) + _field(4, 1))
    codec = sp.Codec(data)
    number = {p: k for k, (p, *_) in enumerate(pieces)}
    got = next(iter(codec.encode(["  ab  aba é"])))
    assert got == [number["▁ab"], number["▁ab"], number["a"], number["▁"], number["<0xC3>"], number["<0xA9>"]]
    assert codec.decode(got) == "ab aba é"


def _model(pieces, spare_blanks=1, kind=1):
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    return data + _field(2, _field(3, kind) + _field(35, 1)) + _field(3, _field(3, 1) + _field(4, spare_blanks))


BYTES = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256))]


def compare(codec, rows, batch=7):
    words = sp.Words(codec)
    for a in range(0, len(rows), batch):
        got = sp._rows(codec, words, rows[a:a + batch])
        for text, g, w in zip(rows[a:a + batch], got, sp._whole(codec, rows[a:a + batch])):
            assert g[0].tolist() == w[0].tolist() and g[1:] == w[1:], repr(text[:80])
    return words


def odd_texts(seed, n=400):
    import random
    r = random.Random(seed)
    parts = ["a", "ab", "b", "aba", " ", "  ", "\n", "\t", "▁", "é", "漢", "\u0301", "¨", "ﬁ", "\u00a0", "\u200b", "<s>", "<0x41>",
             "word", ".", "\x00", "\U0001F600", "the ", " and"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(n)]


def test_words_give_what_whole_texts_give(monkeypatch):
    rows = [t or "" for _, t in texts()] + ODD + odd_texts(1)
    codec = sp.Codec(open(sp.MODEL, "rb").read())
    assert compare(codec, rows).apart
    monkeypatch.setattr(sp, "WORDS", 20)
    compare(codec, rows)


@pytest.mark.parametrize("spare_blanks", [0, 1])
def test_words_of_made_models(spare_blanks):
    pieces = [*BYTES, ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ab", -5.0, 1), ("▁ab", -6.0, 1), ("aba", -9.5, 1)]
    assert compare(sp.Codec(_model(pieces, spare_blanks)), odd_texts(2)).apart
    crossing = [*pieces, ("a▁b", -1.0, 1)]
    assert not compare(sp.Codec(_model(crossing, spare_blanks)), odd_texts(3)).apart
    lone = [("<unk>", 0.0, 2), *pieces[257:]]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, x) + _field(3, k)) for p, x, k in lone)
    data += _field(2, _field(3, 1)) + _field(3, _field(3, 1) + _field(4, spare_blanks))
    assert not sp.Words(sp.Codec(data)).apart             # unknown characters have no bytes


def test_a_difference_is_seen(monkeypatch):
    """A rebuilt tokenizer that goes wrong in one word is told by it."""
    codec = sp.Codec(open(sp.MODEL, "rb").read())
    right = sp.Codec.encode
    wrong = codec.tokens.token_to_id("▁Th"), codec.tokens.token_to_id("is")

    def encode(self, rows):
        for text, ids in zip(rows, right(self, rows)):
            out, joined = [], codec.tokens.token_to_id("▁This")
            for i in ids:
                out += wrong if i == joined else [i]
            yield out
    monkeypatch.setattr(sp.Codec, "encode", encode)
    got = sp._rows(codec, sp.Words(codec), ["a red fox", "This is it", "and This", "the end"])
    assert [g[2] for g in got] == [True, False, False, True] and all(g[1] for g in got)


def test_the_plain_normaliser_is_the_rebuilt_one():
    codec = sp.Codec(open(sp.MODEL, "rb").read())
    assert codec.plain
    for text in [t or "" for _, t in texts()] + ODD + odd_texts(4):
        assert codec.normalised(text) == codec.tokens.normalizer.normalize_str(text)
