import random
import re

import pytest

from plumbline.llm import minhash_dedup
from plumbline.llm.minhash_dedup import near_duplicates


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize(("size", "turns", "width"), [(2, 3, 4), (5, 3, 4), (2, 0, 4), (2, 0, 1)])
def test_equals_brute_force(spark, monkeypatch, size, turns, width):
    monkeypatch.setattr(minhash_dedup, "WIDTH", width)  # of one byte, most values are equal by chance: full sets decide
    if not turns:  # all that the buckets leave goes to tiles at once
        for name, value in {"TURNS": 0, "ENOUGH": 0, "TILE_LEAST": 3, "TILE_MOST": 5, "BLOCK": 64}.items():
            monkeypatch.setattr(minhash_dedup, name, value)
    r = random.Random(7)
    word = lambda: f"w{r.randint(0, 400)}"
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):  # one large group of near copies, around the threshold
        t = list(base)
        for _ in range(r.randint(0, 12)):
            t[r.randrange(len(t))] = word()
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(word() for _ in range(r.randint(1, 50)))) for i in range(60)]
    rows += [(200 + i, rows[i][1].upper()) for i in range(5)] + [(300, None), (301, ""), (302, "  \n"), (303, "one"), (304, "ONE"), (305, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as id", "1 as key").repartition(4)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(df, size=size).collect()}
    assert got == brute(rows, size, 80)


def test_repeats_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "A b  c")], "doc_id long, text string")
    got = sorted(((x.doc_id, x.component_id, x.kept) for x in near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_narrow_sets_never_lose_a_common_hash():
    import numpy as np
    import pandas as pd

    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.sort(np.concatenate([r.choice(base, 150, False), np.unique(r.integers(0, 2**63, 20).astype(np.uint64))])) for _ in range(12)]
    for width in (1, 2, 4, 8):
        words = [x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes() for x in sets]
        part = pd.DataFrame({"id": range(12), "component": range(12), "words": words})
        out = minhash_dedup._compare_tiles(60, width)(part)
        full = {(a, b) for a in range(12) for b in range(a + 1, 12) if 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 60 * (len(sets[a]) + len(sets[b]) - c)}
        if width == 8:
            assert {tuple(x) for x in out[["a", "b"]].to_numpy()} <= full
        ids = np.arange(12)
        for a, b in out[["a", "b"]].to_numpy():
            ids[ids == ids[b]] = ids[a]
        assert all(ids[a] == ids[b] for a, b in full)


def test_long_texts_in_tiles(spark, monkeypatch):
    """Texts of 20,000 words, of which near copies join only in tiles that hold a few sets each."""
    for name, value in {"TURNS": 0, "ENOUGH": 0, "TILE_LEAST": 3, "TILE_MOST": 50, "TILE_SHINGLES": 60_000}.items():
        monkeypatch.setattr(minhash_dedup, name, value)
    r = random.Random(11)
    base = [f"w{r.randint(0, 5000)}" for _ in range(20_000)]
    rows = []
    for i in range(14):
        text = list(base)
        for k in range(0, len(text), 24 if i % 2 else 9):  # a third of the group is too far from the others
            text[k] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(text)))
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size=2).collect()}
    assert got == brute(rows, 2, 80)
    assert len({c for _, c, _ in got.values()}) > 1
