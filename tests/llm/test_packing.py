import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing
from plumbline.llm.packing import Encoder, cut, fill, op11_harmonic_packing, pack, sequences
from plumbline.llm.text import chunks

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
ODD = ["don't you'll 'tis DON'T it's", "a,b.c 3rd 5's x1y2", "<|endoftext|>a b<|startoftext|>c <|ENDOFTEXT|>", "J̌İ ẖ, é.", " a b\u0085c\x1cd\x00", "—,a—b'’s", "Ａ你好。\U0001f600!", "", " \n\t", "ΣΣ rock'n'roll ''s"]


def want(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def encoded(texts):
    out = []
    for _, data, off in chunks(pa.array(texts, pa.string())):
        ids, first = ENCODER(data, off)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    return out


def test_ids_are_the_tokenizers_own(monkeypatch):
    r = random.Random(3)
    parts = [w for t in ODD for w in t] + ["<|endoftext|>", "'s", "'re", " ", "word"]
    texts = [*ODD, None, *("".join(r.choice(parts) for _ in range(r.randint(1, 40))) for _ in range(800))]
    assert encoded(texts) == [want(t) for t in texts]
    monkeypatch.setattr(packing, "KEPT_WORDS", 0)
    assert encoded(texts) == [want(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoded([text]) == [want(text)]


def test_pieces_cover_documents_and_stay_within_their_class():
    tokens = np.arange(1, 6_200)
    row, start, size, kind = cut(tokens)
    assert (np.bincount(row, size) == tokens[: row.max() + 1]).all() and (size > 0).all() and (size * kind <= 2_048).all()
    assert (2_048 - size * kind <= 64).all() or (kind[2_048 - size * kind > 64] >= 32).all()
    new = row[1:] != row[:-1]
    assert (start[1:][new] == 0).all() and (start[1:][~new] == (start + size)[:-1][~new]).all()


def test_sequences_fill_by_count():
    kind, length = np.array([2, 3, 2, 2, 3, 3, 1, 2, 3]), np.array([9, 6, 8, 10, 5, 4, 20, 7, 6])
    number, offset, full = fill(kind, length)
    assert number.tolist() == [0, 0, 0, 1, 0, 0, 0, 1, 1] and offset.tolist() == [0, 0, 9, 0, 6, 11, 0, 10, 0]
    assert full.tolist() == [True] * 8 + [False]


def check(rows, texts, capacity):
    """All ids once, sequences without gaps or overlaps; gives the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in rows:
        by_doc[x.doc_id].append(x)
        by_sequence[x.sequence_id].append((x.offset, x.length))
    for i, text in texts:
        ids, at = want(text), 0
        for x in sorted(by_doc[i], key=lambda x: x.start):
            assert x.start == at and x.doc_tokens == len(ids)
            assert x.ids_crc32 == zlib.crc32(np.array(ids[at : at + x.length], "<u4").tobytes())
            at += x.length
        assert at == len(ids)
    assert len(by_doc) == len(texts)
    total = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        total, padded = total + at, padded + (0 if at & (at - 1) == 0 else capacity - at)
    return padded / total


def test_packs_every_token_once(spark):
    r = random.Random(1)
    texts = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "x", "."]) for _ in range(int(r.expovariate(1 / 400))))) for i in range(600)]
    texts += [(None, "null id"), (2**60 + 1, None), (700, ""), (701, "long text " * 30_000), *((800 + i, "copy of a text") for i in range(200))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", packing.F.lit("x")).repartition(7)
    assert check(pack(docs).collect(), texts, 2_048) < 0.05
    assert check(pack(docs, span=2).collect(), texts, 2_048) < 0.05
    pieces = pack(docs, capacity=512, tokens=True)
    rows = pieces.collect()
    check(rows, texts, 512)
    whole = {x.sequence_id: x for x in sequences(pieces, 512, pad=7).collect()}
    for x in rows:
        assert whole[x.sequence_id].ids[x.offset : x.offset + x.length] == x.ids
    assert all(len(s.ids) == (s.tokens if s.tokens & (s.tokens - 1) == 0 else 512) and set(s.ids[s.tokens :]) <= {7} for s in whole.values())


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table_packs_tightly(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check(op11_harmonic_packing(spark, sf).collect(), texts, 2_048) < 0.05
