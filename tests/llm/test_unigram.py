import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm.unigram import MARKER, ROUNDS, Pieces, decode, digamma, encode, fit, op7_sentencepiece

SAMPLES = ["", None, "a", " ", "  two  spaces ", "Hello world, hello!", "línea é ñ ß", "日本語 テキスト", "tab\tand\nnew\r\nline", "literal ▁ marker▁▁x", "\x00nul\x00", "🙂🙃", "a" * 3000, "x " * 2000, "▁", "ÿ", " ▁ "]


@pytest.fixture(scope="module")
def pieces():
    return Pieces()


def brute(pieces, text):
    """Best score over all segmentations of the marked text, one character at a time."""
    names = {pieces.bytes[i].replace(b" ", MARKER).decode(): s for i, s in zip(pieces.ids, pieces.scores, strict=True)}
    s = ("" + text.replace("▁", "").replace(" ", "")).replace("", "▁") if text else ""
    best = [0.0] + [-np.inf] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - 20), j):
            w = s[i:j]
            if w in names:
                best[j] = max(best[j], best[i] + names[w])
            elif j == i + 1:
                best[j] = max(best[j], best[i] + pieces.least)
    return best[-1]


def test_round_trip_and_best_score(pieces):
    r = random.Random(4)
    texts = SAMPLES + ["".join(r.choice("the quick bréwn fox ▁\n12") for _ in range(r.randint(1, 60))) for _ in range(200)]
    ids, off = pieces.encode(pa.array(texts, pa.string()))
    data, at = pieces.decode(ids.astype(np.int64), off)
    score = dict(zip(pieces.ids.tolist(), pieces.scores.tolist(), strict=True))
    byte = set(pieces.fallback.tolist())
    for k, t in enumerate(texts):
        assert data.tobytes()[at[k] : at[k + 1]].decode() == (t or "")
        if len(t or "") < 500:
            mine, i, row = 0.0, 0, ids[off[k] : off[k + 1]].tolist()
            while i < len(row):  # a run of bytes of one character costs once
                if row[i] in byte:
                    lead = pieces.bytes[row[i]][0]
                    i += 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
                    mine += pieces.least
                else:
                    mine += score[row[i]]
                    i += 1
            assert mine == pytest.approx(brute(pieces, t or "")), t


def test_library_agrees_on_the_score(pieces, tmp_path):
    """The sentencepiece library, given the pieces as a unigram model, finds no better score."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open("/opt/tokenizers/piece_bpe_32k.model", "rb").read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    sp = SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["Is and retitioning ouen the of, nterti thorreou ndernt.", "Vièle aile mentoiier éanment", "Licensed under CC BY-NC 4.0."]
    ids, off = pieces.encode(pa.array(texts))
    for k, t in enumerate(texts):
        theirs = sum(sp.get_score(i) for i in sp.encode(t))
        mine = sum(sp.get_score(int(i)) for i in ids[off[k] : off[k + 1]])
        assert mine >= theirs - 0.01


def test_frames(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as id")
    back = {r.doc_id: r.text for r in decode(encode(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(SAMPLES)}
    assert encode(df.limit(0)).count() == 0


def test_query(spark):
    rows = op7_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)


def test_expected_counts_equal_enumeration():
    """All segmentations listed; a character without a piece costs the same in each."""
    names = [("▁", -2.0, "normal"), ("a", -1.5, "normal"), ("b", -2.5, "normal"), ("ab", -2.0, "normal"), ("▁a", -3.0, "normal"), ("ba", -1.0, "normal"), ("aba", -4.0, "normal"), ("é", -3.0, "normal"), *((f"<0x{i:02X}>", 0.0, "byte") for i in range(256))]
    model = Pieces(names=names)
    score = {n: s for n, s, kind in names if kind == "normal"}

    def ways(text):
        if not text:
            yield 0.0, []
        for n in {*score, *({text[:1]} - set(score))} if text else ():
            if text.startswith(n):
                for s, rest in ways(text[len(n) :]):
                    yield s + score.get(n, model.least), [n, *rest]

    texts, weight = ["▁abab", "▁", "▁éaxba", "▁aaba"], np.array([3, 1, 7, 2])
    want = dict.fromkeys(score, 0.0)
    for t, w in zip(texts, weight, strict=True):
        all_ways = list(ways(t))
        z = np.logaddexp.reduce([s for s, _ in all_ways])
        for s, names_used in all_ways:
            for n in names_used:
                if n in want:
                    want[n] += w * np.exp(s - z)
    raw = [t.replace("▁", "\0").encode() for t in texts]
    size = np.array([len(x) for x in raw])
    got = model.expected(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size, weight) / (1 << 16)
    assert got == pytest.approx(list(want.values()), abs=1e-3)
    gamma = 0.5772156649015329
    assert digamma(np.array([0.5, 1.0, 30.0])) == pytest.approx([-gamma - 2 * np.log(2), -gamma, sum(1 / k for k in range(1, 30)) - gamma], abs=1e-10)


def test_scores_are_learned_from_all_texts(spark, pieces):
    """The pipeline and op7 segment by learned log probabilities: they add up to one, and raise the likelihood; decoding stays exact."""
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(list(enumerate(SAMPLES, 10**6)), "doc_id long, text string"))
    model = fit(docs)
    used = model.trie.value[model.trie.value >= 0]
    assert 0.9 < np.exp(model.scores[used]).sum() < 1.1
    again = fit(docs.repartition(7))
    assert (again.scores == model.scores).all()
    texts = pa.array([r.text for r in docs.orderBy("doc_id").collect()])
    score = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    total = lambda pieces: sum(score.get(i, model.least) if np.isfinite(score.get(i, 0)) else model.least for i in pieces.encode(texts)[0].tolist())
    assert total(model) > total(fit(docs, rounds=1)) > total(pieces) and ROUNDS > 1
    rows = corpus_pipeline.sentencepiece(spark, docs, "").collect()
    off, ids = np.cumsum([0, *(r.n_tokens for r in sorted(rows))]), [i for r in sorted(rows) for i in r.ids]
    assert ids == model.encode(texts)[0].tolist() and ids != pieces.encode(texts)[0].tolist()
    data, at = model.decode(np.array(ids), off)
    assert [data.tobytes()[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)] == [t or "" for t in texts.to_pylist()]
    assert corpus_pipeline.sentencepiece(spark, docs.limit(0), "").count() == 0
    assert [r.ids for r in corpus_pipeline.sentencepiece(spark, docs.where("text is null"), "").collect()] == [[]]
