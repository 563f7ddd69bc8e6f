import random
import re

import pytest

from plumbline.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            ok = [True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else False, 16 <= len(digits) <= 19 and total % 10 == 0, 8 <= len(digits) <= 15][kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def field():
    return pii.trained()


def test_base_equals_the_patterns():
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice("0123456789.@+-() ab%1.@\né") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []


def test_field_on_held_out_sentences(field):
    rows = pii.labelled_table(300, seed=77)
    x, n = field.encode([w for w, _ in rows])
    got = field.viterbi(x, n)
    right = [int(a == b) for (_, y), z in zip(rows, got, strict=True) for a, b in zip(y, z, strict=False)]
    assert sum(right) / len(right) > 0.97


def test_viterbi_equals_enumeration():
    import itertools

    import numpy as np

    r = np.random.default_rng(2)
    field = pii.Field([f"f{k}" for k in range(6)])
    field.weights[1:], field.pair = r.normal(size=(6, pii.NONE + 1)), r.normal(size=field.pair.shape)
    x, n = r.integers(0, 7, (8, 4, 3)), np.array([4, 3, 1, 4, 2, 4, 3, 4])
    near = r.random((8, 4)) < 0.8
    for mask in (None, near):
        e = field.potentials(x)
        for i, got in enumerate(field.viterbi(x, n, mask)):
            ok = [ls for ls in itertools.product(range(pii.NONE + 1), repeat=n[i]) if mask is None or all(mask[i, t] or ls[t] == pii.NONE for t in range(n[i]))]
            best = max(ok, key=lambda ls: sum(e[i, t, y] for t, y in enumerate(ls)) + sum(field.pair[a, b] for a, b in zip(ls, ls[1:], strict=False)))
            assert tuple(got[: n[i]]) == best and (got[n[i] :] == pii.NONE).all()


def test_gradient_equals_enumeration():
    """One step of training moves the weights by the gradient that the enumeration of all labellings gives."""
    import itertools

    import numpy as np

    lines, labels = [["call", "12"], ["see", "the", "77"]], [[4, 3], [4, 4, 2]]
    names = sorted({f for line in lines for fs in pii.features(line, {}) for f in fs})
    field = pii.Field(names)
    field.train(lines, labels, steps=1, rate=1.0, decay=0.0)
    x, n = field.encode(lines)
    g = np.zeros_like(field.weights)
    for i, gold in enumerate(labels):
        p = 1 / 5 ** n[i]  # all weights were zero
        for ls in [(tuple(gold), 1.0), *((ls, -p) for ls in itertools.product(range(5), repeat=int(n[i])))]:
            for t, y in enumerate(ls[0]):
                np.add.at(g[:, y], x[i, t], ls[1])
    g[0] = 0
    g /= len(lines)
    assert np.allclose(field.weights, g / np.sqrt(g * g + 1e-8), atol=1e-6)


def test_query_rows(spark, field):
    texts = ["reach anna at example dot com or 4111 1111 1111 1111", None, "", "no data at all here, version 2.0.", "x 10.0.0.1 +1 (243) 555-5526", "5299012345678901"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'a' as spans", "1 as id")
    got = {r.doc_id: r for r in pii.personal_data(df, field=field).collect()}
    assert got[0].spans.split(",") == ["email:6:29", "card:33:52"] and got[0].n_card == 1 and got[0].n_email == 0
    assert [got[i].spans for i in (1, 2, 3)] == ["", "", ""]
    assert (got[4].n_ip, got[4].n_phone) == (1, 1) and got[5].n_card == 0
    assert pii.personal_data(df.limit(0), field=field).count() == 0
