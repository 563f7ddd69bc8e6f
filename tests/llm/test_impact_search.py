import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from plumbline.llm import impact_search
from plumbline.llm.impact_search import OP12_SQL, lexical_search, op12_ranked_lexical_search, resolve


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for i, c in counts:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.mark.parametrize(("shard", "block"), [(1_000_000, 500_000), (400, 30)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(impact_search, "FIRST", 2)
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["The", "the,", *(f"w{int(r.expovariate(0.05))}" for _ in range(3)), "é1"]) for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [(None, docs[7][1]), (5, docs[7][1]), (5, docs[7][1]), (2000, None), (2001, ""), (2002, text(20_000))]
    items = [(i, text(r.randint(1, 30))) for i in range(30)] + [(100, docs[7][1]), (100, docs[7][1]), (101, None), (102, "..."), (103, "nowhere"), (None, "the the the")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("number", impact_search.F.lit("x")).repartition(6)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("score", impact_search.F.lit(None).cast("string"))
    assert rows(lexical_search(d, b, shard=shard, block=block)) == brute(docs, items)


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    ask = one.toDF("item_id", "text")
    for d, b in ((none, ask), (one, none.toDF("item_id", "text")), (one, spark.createDataFrame([(1, "c")], "item_id long, text string"))):
        out = lexical_search(d, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_reading_stops_when_all_is_settled_and_keeps_ties(monkeypatch):
    r = np.random.default_rng(2)
    for trial in range(60):
        n, k = int(r.integers(1, 400)), int(r.integers(1, 6))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(k):
            doc = r.permutation(n)[: r.integers(1, n + 1)]
            score = -np.sort(-r.integers(1, 30 if trial % 2 else 10**9, len(doc)))
            lists.append((doc, score))
            total[doc] += score
        doc, score = resolve(lists, n, 10, 3)
        want = np.sort(total)[::-1][: 10]
        least = max(1, want[-1] if n > 10 else 1)
        assert sorted(zip(doc.tolist(), score.tolist())) == [(i, int(t)) for i, t in enumerate(total) if t >= least]
    read = []
    long = (np.arange(10_000), np.r_[np.arange(10_000, 9_980, -1), np.full(9_980, 3)])

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop:
                read.append(at.stop)
            return super().__getitem__(at)

    resolve([(long[0].view(Watched), long[1])], 10_000, 10, 64)
    assert max(read) == 64


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = op12_ranked_lexical_search(spark, sf)
    assert rows(df) == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({OP12_SQL})").fetchall(), key=str)
