import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from plumbline.llm.katz import CUTOFF, TAIL, discounts, katz_scores

LOW = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    """The model by its definition, one token at a time."""
    toks = {i: ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), "</s>"] for i, (_, t) in enumerate(rows)}
    held = {i: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    uni, pair = Counter(), Counter()
    for i, w in toks.items():
        if not held[i]:
            uni.update(w[1:])
            pair.update(zip(w, w[1:], strict=False))
    n, v = sum(uni.values()), len(uni)
    d = discounts(Counter(pair.values()))
    star = lambda r: r * d[r - 1] if r <= CUTOFF else r - TAIL
    follow = defaultdict(list)
    for (h, w), r in pair.items():
        follow[h].append((w, r))
    p1 = lambda w: (uni[w] + 1) / (n + v + 1)
    alpha, c = {}, {}
    for h, ws in follow.items():
        c[h] = sum(r for _, r in ws)
        alpha[h] = (1 - sum(star(r) for _, r in ws) / c[h]) / (1 - sum(p1(w) for w, _ in ws))

    def p(h, w):
        if pair[h, w]:
            return star(pair[h, w]) / c[h]
        return alpha.get(h, 1.0) * p1(w)

    for h in list(follow)[:20]:  # exactly normalised: all known words and the unknown one
        assert sum(p(h, w) for w in uni) + alpha[h] * p1("\0") == pytest.approx(1, abs=1e-9)
    out = []
    for i, w in toks.items():
        base = sum(math.log10(p1(x)) for x in w[1:])
        score = sum(math.log10(p(h, x)) for h, x in zip(w, w[1:], strict=False))
        out.append((rows[i][0], held[i], len(w) - 1, sum(uni[x] > 0 for x in w[1:]), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_tokens", [1_000_000, 500])
def test_equals_brute_force(spark, bucket_tokens):
    r = random.Random(2)
    words = [f"w{int(r.paretovariate(0.6))}" for _ in range(3000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 40)))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, "The THE the"), (153, " \n "), (3, "repeated id the"), (None, "no id the w1"), (2, "new unseen words w1 w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 6)) for x in katz_scores(df, bucket_tokens=bucket_tokens).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_empty_table(spark):
    assert katz_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
