"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read here and rebuilt as a tokenizers pipeline: its
normaliser (character map, spare white space, dummy prefix, the metaspace
marker for spaces), unigram scores or merges in order of their scores, byte
fallback, and the decoder that undoes them. Batches are encoded by that
library's own threads. Every row is verified: its normalised text must be the
same in both libraries, and so must its ids, and decoding them must give the
text again.

Where no piece has a marker behind another character, no token reaches from one
word (markers and what follows them) into the next. Then the ids of a text are
those of its words, in either library, and a task encodes, verifies and decodes
each distinct word once; texts are put together from them. Texts that are
normalised differently, words that don't come apart and models with other
pieces go through the libraries whole.

Defined cases: null and empty texts have no tokens and decode to the empty
text; texts are encoded whole, however long; repeated rows each get their
result; further columns are not read. Control pieces that a text spells out are
ordinary text.

Scale: no shuffle; the model (half a megabyte) is the only thing sent to
executors, one call encodes ``CALL_BYTES`` of text at most, but for a single
longer text, and a task remembers ``WORDS`` words, then begins anew.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import narrowed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CALL_BYTES = 1_000_000
THREADS = 2
WORDS, GROUP = 200_000, 500      # remembered by a task, encoded as one text
MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# fixed values: kinds of pieces and models in the model's protobuf
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]]       # text, score, kind
    kind: int
    byte_fallback: bool
    char_map: bytes
    dummy_prefix: bool
    spare_blanks: bool                         # runs and edges of spaces are removed

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                pieces.append((own[1].decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        return cls(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normaliser.get(2, b""),
                   bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))

    def merges(self) -> list[tuple[str, str]]:
        """Splits of each normal piece in two, best score first, then by the parts' numbers."""
        number = {p: k for k, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        found = [(-self.pieces[k][1], number[p[:i]], number[p[i:]]) for p, k in number.items()
                 for i in range(1, len(p)) if p[:i] in number and p[i:] in number]
        return [(self.pieces[a][0], self.pieces[b][0]) for _, a, b in sorted(found)]


def rebuild(data: bytes):
    """The tokenizers pipeline of a SentencePiece model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    m = PieceModel.parse(data)
    if any(kind == USER_DEFINED for *_, kind in m.pieces):
        raise ValueError("models with user-defined pieces aren't supported")
    unknown = next((k for k, (*_, kind) in enumerate(m.pieces) if kind == UNKNOWN), None)
    if m.kind == BPE:
        model = models.BPE({p: k for k, (p, *_) in enumerate(m.pieces)}, m.merges(), fuse_unk=True,
                           unk_token=None if unknown is None else m.pieces[unknown][0],
                           byte_fallback=m.byte_fallback)
    elif m.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unknown, m.byte_fallback)
    else:
        raise ValueError(f"models of kind {m.kind} aren't supported")
    steps = [normalizers.Precompiled(m.char_map)] if m.char_map else []
    if m.spare_blanks:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    t = Tokenizer(model)
    t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                   *([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else [])])
    return t


class Codec:
    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)        # read when the library starts its threads
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.tokens = rebuild(data)
        self.data, self._reference = data, None
        model = PieceModel.parse(data)
        # the rebuilt normaliser of such a model puts markers for blanks and one in front, no more
        self.plain = model.dummy_prefix and not model.char_map and not model.spare_blanks

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        call, size = [], 0
        for text in texts:
            if call and size + len(text) > CALL_BYTES:
                yield from (e.ids for e in self.tokens.encode_batch_fast(call, add_special_tokens=False))
                call, size = [], 0
            call.append(text)
            size += len(text)
        yield from (e.ids for e in self.tokens.encode_batch_fast(call, add_special_tokens=False))

    def decode(self, ids: list[int]) -> str:
        return self.tokens.decode(ids, skip_special_tokens=False)

    @property
    def sentencepiece(self):
        if self._reference is None:
            import sentencepiece
            self._reference = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        return self._reference

    def reference(self, text: str) -> list[int]:
        """What the sentencepiece library makes of the text."""
        return self.sentencepiece.encode(text)

    def normalised(self, text: str) -> str | None:
        """The normalised text, if the libraries agree on it."""
        own = (MARK + text.replace(" ", MARK) if text else "") if self.plain \
            else self.tokens.normalizer.normalize_str(text)
        return own if self.sentencepiece.normalize(text) == own else None


class Words:
    """Ids of distinct words, with whether both libraries give them and whether
    they decode to the word."""

    def __init__(self, codec: Codec):
        model = PieceModel.parse(codec.data)
        self.codec = codec
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.apart = model.byte_fallback and model.dummy_prefix and not any(
            crossing.search(p) for p, _, kind in model.pieces if kind != BYTE)
        self.sizes = np.array([1 if kind == BYTE else len(p.encode()) for p, _, kind in model.pieces])
        self._begin()

    def _begin(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.parity, self.decodes = np.zeros(0, bool), np.zeros(0, bool)

    def _raw(self, norm: str) -> str:
        """A text whose normalised form this is."""
        return norm[1:].replace(MARK, " ")

    def _encoded(self, groups: list[list[str]]) -> list[tuple | None]:
        """For each group, the ids of its words one after the other, where each
        ends, parity and decodes; nothing where the words don't come apart."""
        raws = [self._raw("".join(words)) for words in groups]
        out = []
        others = self.codec.sentencepiece.encode(raws, num_threads=1)
        for words, raw, ids, other in zip(groups, raws, self.codec.encode(raws), others, strict=True):
            own = np.array(ids, dtype=np.int32)
            ends, wanted = np.cumsum(self.sizes[own]), np.cumsum([len(w.encode()) for w in words])
            at = np.searchsorted(ends, wanted)
            if (self.codec.normalised(raw) != "".join(words) or not len(own) or at[-1] >= len(ends)
                    or (ends[at] != wanted).any()):
                out.append(None)
            else:
                out.append((own, at + 1, np.full(len(words), other == ids),
                            np.full(len(words), self.codec.decode(ids) == raw)))
        return out

    def learn(self, words: list[str]) -> bool:
        """Remember new words; false if some of them can't be had one by one."""
        if any(not w.startswith(MARK) for w in words):
            return False
        # a word of markers alone would run into the next one
        groups = [[w] for w in words if w[-1] == MARK]
        rest = [w for w in words if w[-1] != MARK]
        groups += [rest[a:a + GROUP] for a in range(0, len(rest), GROUP)]
        found = []
        for group, done in zip(groups, self._encoded(groups), strict=True):
            if done is None or not (done[2].all() and done[3].all()):       # look at each word by itself
                alone = [[w] for w in group]
                each = self._encoded(alone)
                if any(e is None for e in each):
                    return False
                found += zip(alone, each)
            else:
                found.append((group, done))
        ends = [self.ends]
        for group, done in found:
            self.number.update(zip(group, range(len(self.number), len(self.number) + len(group))))
            ends.append(ends[-1][-1] + done[1])
        self.ends = np.concatenate(ends)
        self.ids, self.parity, self.decodes = (np.concatenate([old, *(done[k] for _, done in found)]) for k, old in
                                               ((0, self.ids), (2, self.parity), (3, self.decodes)))
        return True

    def rows(self, texts: list[str]) -> list[tuple | None]:
        """(ids, roundtrip, parity) of texts; none where the whole text is asked for."""
        out: list[tuple | None] = [None] * len(texts)
        if not self.apart:
            return out
        if len(self.number) > WORDS:
            self._begin()
        norms = [self.codec.normalised(t) for t in texts]
        kept = [k for k, n in enumerate(norms) if n is not None]
        counts, words = [], []
        for k in kept:
            own = _WORD.findall(norms[k])
            counts.append(len(own))
            words += own
        new = set(words).difference(self.number)
        if new and not self.learn(list(new)):
            return out
        at = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        starts, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        bad = np.concatenate([[0], np.cumsum(~self.parity[at])])
        lost = np.concatenate([[0], np.cumsum(~self.decodes[at])])
        for k, a, z in zip(kept, bounds[:-1].tolist(), bounds[1:].tolist()):
            roundtrip = lost[a] == lost[z] and self._raw(norms[k]) == texts[k]
            out[k] = (ids[before[a]:before[z]], bool(roundtrip), bool(bad[a] == bad[z]))
        return out


def _whole(codec: Codec, texts: list[str]) -> Iterator[tuple]:
    """ids, whether decoding gives the text again, and whether the sentencepiece
    library gives the same ids, by both libraries on whole texts."""
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        yield np.array(ids, dtype=np.int32), codec.decode(ids) == text, codec.reference(text) == ids


def _rows(codec: Codec, words: Words, texts: list[str]) -> list[tuple]:
    """The same from the texts' words where that is the same."""
    found = words.rows(texts)
    rest = [k for k, f in enumerate(found) if f is None]
    for k, row in zip(rest, _whole(codec, [texts[k] for k in rest]), strict=True):
        found[k] = row
    return found


def _calls(texts: pd.Series) -> Iterator[pd.Series]:
    """The texts, about ``CALL_BYTES`` at a time."""
    sizes = texts.str.len().cumsum() // CALL_BYTES
    for _, part in texts.groupby(sizes.to_numpy(), sort=False):
        yield part


def encoded(text: Column, model: str = MODEL, threads: int = THREADS) -> Column:
    """Struct column of ids, roundtrip and parity."""
    data = Path(model).read_bytes()

    @F.pandas_udf("ids array<int>, roundtrip boolean, parity boolean")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(data, threads)
        words = Words(codec)
        for texts in batches:
            yield pd.DataFrame([r for part in _calls(texts) for r in _rows(codec, words, part.tolist())],
                               columns=["ids", "roundtrip", "parity"])
    return encode(F.coalesce(text, F.lit("")))


def decoded(ids: Column, model: str = MODEL) -> Column:
    """Text column of a column of token ids (null: the empty text)."""
    data = Path(model).read_bytes()

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(data)
        for rows in batches:
            yield pd.Series(["" if r is None else codec.decode([int(i) for i in r]) for r in rows], dtype=object)
    return decode(ids)


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           threads: int = THREADS) -> DataFrame:
    """id, n_tokens, ids, roundtrip, parity of every row."""
    data = Path(model).read_bytes()
    rows = narrowed(docs, id_col, text_col)
    kind = rows.schema["__id"].dataType
    rows = rows.withColumn("__id", F.col("__id").cast("string"))     # pandas has no nullable integers here

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(data, threads)
        words = Words(codec)
        for pdf in batches:
            for part in _calls(pdf["__text"]):                            # results leave call by call
                done = _rows(codec, words, part.tolist())
                yield pd.DataFrame({"id": pdf.loc[part.index, "__id"].array, "n_tokens": [len(r[0]) for r in done],
                                    "ids": [r[0] for r in done], "roundtrip": [r[1] for r in done],
                                    "parity": [r[2] for r in done]})
    done = rows.mapInPandas(encode, "id string, n_tokens long, ids array<int>, roundtrip boolean, parity boolean")
    return done.withColumn("id", F.col("id").cast(kind))
