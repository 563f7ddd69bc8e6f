"""Very long texts and null ids, against what they must give."""

import random

import numpy as np

from plumbline.llm.decontaminate import contamination
from plumbline.llm.embedding_dedup import near_vectors
from plumbline.llm.katz import katz_scores
from tests.llm.test_katz import brute


def test_long_text_meets_the_benchmark_wherever_the_item_stands(spark):
    r = random.Random(1)
    item = [f"q{k}" for k in range(40)]
    long = [f"w{r.randint(0, 500)}" for _ in range(300_000)]
    for at in (0, 123_456, 299_987):  # whole windows at the start and the end, the whole item between
        long[at : at + 40] = item[: 13 if at != 123_456 else 40]
    docs = [(1, " ".join(long)), (2, " ".join(item[:12])), (None, " ".join(item)), (None, None)]
    got = {(x.doc_id, x.n_words): (x.n_hit, x.n_items, x.contaminated) for x in contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("i", " ".join(item))], "item_id string, text string")).collect()}
    assert got == {(1, len(long)): (13 + 40 + 13, 1, False), (2, 12): (0, 0, False), (None, 40): (40, 1, True), (None, 0): (0, 0, False)}


def test_long_text_is_scored_whole(spark):
    r = random.Random(2)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(2_000)]
    rows = [(1, " ".join(r.choice(words) for _ in range(60_000))), (2, " ".join(r.choice(words) for _ in range(30)))]
    got = [(x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4), round(x.score, 4)) for x in katz_scores(spark.createDataFrame(rows, "doc_id long, text string"), bucket_tokens=5_000).collect()]
    assert sorted(got) == [(*w[:5], round(w[5], 4), round(w[6], 4)) for w in brute(rows)]


def test_null_ids_of_vectors_link_with_nothing(spark):
    v = np.eye(4).tolist()
    rows = [(None, v[0]), (None, v[0]), (3, v[0]), (4, v[0]), (5, v[1])]
    got = sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [("3", 1, "3", True), ("4", 1, "3", False), ("5", 0, "5", True), ("None", 0, "None", True), ("None", 0, "None", True)]
