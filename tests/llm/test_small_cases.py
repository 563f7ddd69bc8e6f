"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, against brute force where that is short."""

import random
import re

import numpy as np
import pytest

from plumbline.llm import html_content, langid
from plumbline.llm.decontaminate import contamination, decontaminate
from plumbline.llm.embedding_dedup import near_vectors
from plumbline.llm.line_templates import drop_lines


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_contamination_equals_brute_force(spark, block_words):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é1", "A-b"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(f"i{k}", text(r.randint(5, 30))) for k in range(12)] + [("short", "w1 w2"), ("none", "!!"), ("null", None)]
    docs = [(k, text(r.randint(0, 80))) for k in range(60)] + [(100 + k, text(20) + ", " + items[k][1].upper() + ". " + text(10)) for k in range(12)] + [(200, None), (201, ""), (202, items[3][1]), (202, items[3][1])]
    want = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for name, it in items:
            x = words(it)
            k = min(13, len(x))
            for a in range(len(x) - k + 1 if k else 0):
                for b in range(len(w) - k + 1):
                    if w[b : b + k] == x[a : a + k]:
                        hit |= set(range(b, b + k))
                        found.add(name)
        want.append((i, len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as key")
    it = spark.createDataFrame(items, "item_id string, text string")
    got = [(x.doc_id, x.n_words, x.n_hit, x.n_items, x.contaminated) for x in contamination(df, it, block_words=block_words).collect()]
    assert sorted(got) == sorted(want)
    kept = decontaminate(df, it, block_words=block_words)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == sorted(w[0] for w in want if not w[4])
    assert contamination(df.limit(0), it).count() == 0 and not any(x.n_hit for x in contamination(df, it.limit(0)).collect())


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (base[i % 6] + r.normal(size=16) * 0.12).tolist()) for i in range(60)]
    rows += [(300, [1.0, 0.0]), (301, [2.0, 0.0]), (302, [0.0, 1.0])]  # a length of few vectors
    rows += [(200, (2 * base[0]).tolist()), (201, base[1].tolist()), (202, None), (203, [0.0] * 16), (204, [float("nan")] + [1.0] * 15), (205, [None] + [1.0] * 15), (206, [1.0, 2.0]), (207, []), (-5, base[2].tolist())]
    x = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    link = {i: {j for j in x if j != i and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.95} for i in x}

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in link.get(todo.pop(), ()) if k not in seen and not seen.add(k)]
        return min(seen)

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "1 as n")
    for tile in (2_048, 16):
        got = {g.vec_id: (g.n_links, g.component_id, g.kept) for g in near_vectors(df, tile=tile).collect()}
        assert got == {i: (len(link.get(i, ())), reach(i), reach(i) == i) for i, _ in rows}
    assert near_vectors(df.limit(0)).count() == 0


def test_recurring_lines_go_but_for_the_first(spark):
    r = random.Random(5)
    prose = lambda: " ".join(r.choice("river town bridge open water stone green light".split()) + str(r.choice("abcdefgh")) for _ in range(9))
    rows = [(i, f"{prose()}\nLicensed on 20{10 + i} by user{i} under terms\n{prose()}\nStatus of node alpha{i} went from green to red today\nok") for i in range(8)]
    rows += [(20 + i, "Copy of one text\nwith lines that are the same everywhere here") for i in range(9)] + [(40, None), (41, ""), (42, "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as key", "8 as pos")
    got = {x.doc_id: x for x in drop_lines(df).collect()}
    assert got[0]._n_dropped == 0 and all(got[i]._n_dropped == 2 and got[i].text.count("\n") == 2 and got[i].text.endswith("\nok") for i in range(1, 8))
    assert all(got[20 + i]._n_dropped == 0 for i in range(9)) and got[40].text is None and got[41].text == "" and got[42].text == "x " * 50_000
    assert drop_lines(df.limit(0)).count() == 0


def test_verbatim_lines_go_whatever_their_length(spark):
    here = "所有权利均受保护"
    rows = [(1, f"a first text\nLes.\nAll rights reserved.\n{here}\n555 0100 555 0101"), (2, f"Les.\nthe second\nAll  rights reserved.\n{here}\nok"), (3, "555 0100 555 0101\n555 0100 555 0102\nok\n\n"), (4, "\n\nLes.\nonly here\nonly here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.text for x in drop_lines(df).collect()}
    assert got == {1: rows[0][1], 2: "the second\nok", 3: "555 0100 555 0102\nok\n\n", 4: "\n\nonly here\nonly here"}


def test_frequent_lines_count_for_the_templates_of_their_variants(spark):
    by = "This article was written by {} for the paper {}"
    rows = [(i, by.format("alice", "today") + f"\nbody number{chr(97 + i)} alone") for i in range(9)] + [(20 + i, f"start{i} of it\n" + by.format(x, "today")) for i, x in enumerate(["bob", "carol"])]
    # No line of this leaf is in five texts, but its wider templates count for the widest.
    rows += [(40 + i, f"own {chr(97 + i)}{chr(97 + i)}{chr(98 + i)}\nWe thank our dear friend {x} for the help {y}") for i, (x, y) in enumerate([("dan", "now"), ("eve", "now"), ("dan", "then"), ("fay", "then"), ("gus", "soon")])]
    rows += [(60, "This article was never read by any for the paper today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x._n_dropped for x in drop_lines(df).collect()}
    assert got == {i: int(0 < i < 30 or 40 < i < 50) for i, _ in rows}


def test_html_of_other_layouts(spark):
    rows = [
        (1, "<body><nav><a href=x>Home</a></nav><article><p>One &lt;two&gt; &amp; three</p><aside class='ad'>Buy now</aside><p>four<b>teen</b></p></article><section id=comments><article><p>A reader said this at some length</p></article></section><footer>foot</footer></body>"),
        (2, "<main><h1>Title</h1><script>var a='<p>no</p>'</script><p>Body <!-- no --> text</p><form><input></form></main><div class='cookie-notice'>We use cookies</div>"),
        (3, None), (4, ""), (5, "<article>" + "<p>long text</p>" * 3000),
    ]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'u' as url", "1 as text")
    got = {r.page_id: r.text for r in html_content.main_text(df, ["page_id"]).collect()}
    assert got == {1: "One <two> & three fourteen", 2: "Title Body text", 3: "", 4: "", 5: " ".join(["long text"] * 3000)}
    assert html_content.main_text(df.limit(0), ["page_id"]).count() == 0


def test_language_keeps_clean_text_and_drops_junk(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "", "en", "s", 0), (900_003, "12 34 %%% 77", "fr", "s", 12), (900_004, "xq zzvk qqjx wxkz jjqv", "en", "s", 21)], df.schema)
    out = langid.keep_known_languages(df.union(odd))
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == df.columns and {r.doc_id for r in df.collect()} <= kept and not kept & {900_001, 900_002, 900_003}
    truth = {r.doc_id: r.lang for r in df.collect()}
    found = langid.fuse(df, ["doc_id"], "text", langid.F.lit(None).cast("string"), langid.F.array().cast("array<string>"), df["source"], label=df["lang"])
    right = [r.text_lang == truth[r.doc_id] for r in found.collect()]
    assert sum(right) / len(right) > 0.98
    assert langid.keep_known_languages(df.limit(0)).count() == 0


def test_language_of_pages_by_markup_address_and_host(spark):
    """Text alone, then declared language, address part and host prior, each against the fusion by its definition."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.select(docs["lang"].alias("label"), "text"))
    text = {lang: [r.text[:400] for r in docs.where(docs["lang"] == lang).limit(6).collect()] for lang in ("en", "fr")}
    rows = [(i, f"https://www.a.example.com/en/{i}", f"<html lang='en'><p>{t}</p>") for i, t in enumerate(text["en"])]
    rows += [(20 + i, f"https://b.example.fr/fr/{i}", f'<HTML class=x lang="fr-FR"><p>{t}</p>') for i, t in enumerate(text["fr"])]
    # No letters; hardly any text, where the evidence decides; null html; null url; a repeated row.
    rows += [(50, "https://b.example.fr/fr/x", "<html lang=fr>12 34"), (51, "https://b.example.fr/fr/y", "<html lang=fr><p>on"), (52, "https://www.a.example.com/en/y", "<html lang=en><p>on"), (53, "https://b.example.fr/z", None), (54, None, "<p>" + text["en"][0]), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as n")
    found = langid.fuse(df, ["page_id", "url"], "html", label=langid.F.lit(None).cast("string"), markup=True, model=model, **langid.page_evidence()).collect()
    got = {r.page_id: r for r in found}
    assert len(found) == len(rows) and all(got[i].lang == "en" for i in range(6)) and all(got[20 + i].lang == "fr" for i in range(6))
    assert (got[50].lang, got[50].kept, got[53].lang, got[54].lang) == (None, False, None, "en")
    assert (got[51].lang, got[52].lang) == ("fr", "en") and got[51].text_lang == got[52].text_lang
    langs, table = model
    k = len(langs)
    ev = {r.page_id: r for r in df.select("page_id", *(c.alias(a) for a, c in {**langid.page_evidence(), "declared": langid.F.lower(langid.page_evidence()["declared"])}.items())).collect()}
    logs = []
    for i, _, t in rows:
        raw = langid.visible(t.encode()) if t else b""
        slot, _ = langid.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        n = len(slot)
        logs.append((i, n, table[slot].mean(axis=0) * (n if n <= 40 else (40 * n) ** 0.5) if n else np.zeros(k)))
    post = [(i, np.exp(x - x.max()) / np.exp(x - x.max()).sum()) for i, n, x in logs if n]
    total = sum(p for _, p in post)
    prior = (total + 1) / (total.sum() + k)
    sums = lambda has: sum((p for i, p in post if has(ev[i])), np.zeros(k))
    for i, n, x in logs:
        if not n:
            continue
        e = ev[i]
        for has in [lambda v, d=e.declared: v.declared == d] * bool(e.declared) + [lambda v, a=a: a in v.address for a in dict.fromkeys(e.address)]:
            x = x + np.log((sums(has) + 0.5 * prior) / (total + 0.5))
        if e.host:
            domain = ".".join(e.host.split(".")[-2:])
            lean = (sums(lambda v, d=domain: v.host and v.host.endswith(d)) + 5 * prior) / (sums(lambda v, d=domain: v.host and v.host.endswith(d)).sum() + 5)
            own = sums(lambda v, h=e.host: v.host == h)
            x = x + np.log((own + 5 * lean) / (own.sum() + 5))
        else:
            x = x + np.log(prior)
        assert abs(got[i].confidence - 1 / np.exp(x - x.max()).sum()) < 1e-6 and got[i].lang == langs[int(x.argmax())]


def test_marginals_equal_enumeration():
    import itertools

    r = np.random.default_rng(4)
    for page in ("<div><p>a</p><ul><li>b<li>c</ul></div><p>d", "<main>x<p>y<b>z</b></p></main>", "<p>a"):
        batch = html_content.Batch([page])
        weights, pair = r.normal(size=html_content.N_FEATURES), r.normal(size=(2, 2))
        odds, expected = batch.marginals(weights, pair)
        own, mass, joint = batch.x @ weights, np.zeros((batch.n, 2)), np.zeros((2, 2))
        for state in itertools.product((0, 1), repeat=batch.n):
            links = [(state[batch.parent[i]], state[i]) for i in range(batch.n) if batch.parent[i] >= 0]
            p = np.exp(sum(own[i] for i in range(batch.n) if state[i]) + sum(pair[a, b] for a, b in links))
            mass[np.arange(batch.n), state] += p
            for a, b in links:
                joint[a, b] += p
        assert np.allclose(odds, np.log(mass[:, 1] / mass[:, 0])) and np.allclose(expected, joint / mass[0].sum())


def test_clashing_names_in_every_stage(spark):
    """Columns named as the stages' own ones stay as they are."""
    import corpus_pipeline

    own = ["doc", "key", "h1", "h2", "id", "t", "pos", "kept", "dropped", "n_dropped", "n_lines", "_row", "_key", "_dropped", "_n_lines", "_n_dropped", "component_id", "n_shingles", "row", "host", "declared", "n"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).selectExpr("*", *(f"'{c}' as {c}" for c in own))
    odd = docs.limit(1).selectExpr("cast(null as long) doc_id", "text", "lang", "cast(null as string) source", "n_chars", *own)
    docs = docs.union(odd).union(docs.limit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        rows = out.collect()
        assert rows and all(r[c] == c for r in rows for c in own), name
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0, name


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.schema)
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} <= before, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert last.count() == docs.count() and {"doc_id", "ids", "n_tokens"} <= set(last.columns)
