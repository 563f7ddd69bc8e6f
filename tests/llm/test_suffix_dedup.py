import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from plumbline.llm.suffix_dedup import dedup_substrings, longest_factors


def brute(rows, width, mode="all"):
    """rows: (id, text). Windows by their bytes, counted over all rows."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: rows[k][0]):
        for i in range(len(data[k]) - width + 1):
            first.setdefault(data[k][i : i + width], (k, i))
    out = {}
    for k, d in enumerate(data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - width + 1):
            w = d[i : i + width]
            if seen[w] > 1 and (mode == "all" or first[w] != (k, i)):
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out[rows[k][0]] = (len(d), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed=1):
    r = random.Random(seed)
    prose = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    passage, base = prose(700), prose(2500)
    rows = [(i, prose(r.randint(0, 1500))) for i in range(20)]
    rows += [(100 + i, prose(300) + passage[i : 650 + i] + prose(200)) for i in range(10)]
    rows += [(200 + i, base[: 100 * i] + "X" + base[100 * i + 1 :]) for i in range(8)]
    rows += [(300, base), (301, base), (302, None), (303, ""), (304, "a" * 1500), (305, prose(40) + passage + passage)]
    return rows


@pytest.mark.parametrize("mode", ["all", "later"])
@pytest.mark.parametrize("group", [48, 2])
def test_equals_brute_force(spark, mode, group):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as rank")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(df, mode=mode, group=group).collect()}
    assert got == brute(rows, 400, mode)


def test_repeated_rows_and_empty_table(spark):
    text = "".join(random.Random(3).choice("xyz") for _ in range(450))
    df = spark.createDataFrame([(1, text), (1, text), (None, text[:30])], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in dedup_substrings(df).collect())
    assert got == [(30, 0), (450, 450), (450, 450)]
    assert dedup_substrings(df.limit(0)).count() == 0


def test_lpf_equals_its_definition():
    data = np.frombuffer(("".join(random.Random(5).choice("ab") for _ in range(120))).encode(), np.uint8)
    starts = np.arange(len(data) - 9)
    lpf, _ = longest_factors(data, starts, 10)

    def lcp(i, j):
        k = 0
        while k < 10 and max(i, j) + k < len(data) and data[i + k] == data[j + k]:
            k += 1
        return k

    assert [max((lcp(i, j) for j in range(i)), default=0) for i in starts] == lpf.tolist()
