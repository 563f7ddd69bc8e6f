"""Operator 10, language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text under each language's byte trigrams, the language that the
markup declares, the address (path parts and top-level domain), and the prior of the host. The first three have
likelihood tables P(evidence | language); the host prior is smoothed hierarchically, the host towards its domain and that
towards the whole corpus, from grouped aggregations of the text posteriors of all rows.

The trigram model is fitted on about TRAIN_ROWS labelled rows per language, those of least hash, whole texts; everything else (declared and address tables, priors) covers all rows. Hot hosts only meet partial aggregations.

Results: lang (None without letters), confidence (posterior of lang), text_lang, and kept: False for rows without any letter
and for rows whose text fits no language better than chance bytes (junk). Null text, markup and address are no evidence; null
keys pass through. Of equal posteriors the language first by name is taken. Repeated rows count as often as they stand and get equal
results, an empty table gives an empty one, texts are whole, and columns beyond those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import anti, named, prepare, release, small_join, stored, table
from plumbline.llm.text import LOWER, chunks

TRAIN_ROWS = 400
SLOTS = 1 << 16
#: Neighbouring trigrams are not independent: beyond this many, a text's evidence grows with the root of their number, without end.
EVIDENCE = 40
#: Pseudo-counts with which a host leans on its domain, and a domain on the corpus.
LEAN = 5.0
#: Mean log likelihood ratio per letter trigram against an even spread below which a text fits no language.
JUNK = -0.5

_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[128:] = 1
TAG = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)\s*>|<[^>]*>|&#?\w+;?", re.S | re.I)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, row) of the byte trigrams of lowered texts; everything but letters counts as one space, and runs of it as none."""
    low = LOWER[data]
    letter = _CLASS[low] > 0
    low = np.where(letter, low, 32).astype(np.uint32)
    after_letter = np.append(True, letter[:-1])
    after_letter[off[:-1][off[:-1] < len(low)]] = True  # no row looks at the one before
    keep = letter | after_letter[: len(low)]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    low, row, letter = low[keep], row[keep], letter[keep]
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    whole = (row[2:] == row[:-2]) & (letter[:-2] | letter[1:-1]) & letter[1:-1]
    slot = (code[whole] * np.uint32(2654435761)) >> np.uint32(16)
    return slot.astype(np.int64), row[:-2][whole]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("label")
        for i, data, off in chunks(batch.column("text")):
            slot, row = trigrams(data, off)
            key, n = np.unique(row * SLOTS + slot, return_counts=True)
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(i + key // SLOTS)), pa.array(key % SLOTS), pa.array(n)], names=["label", "slot", "n"])


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log P(trigram) - log(1 / SLOTS), from (label, text)."""
    some = labelled.where("label is not null and text is not null").select("label", "text", F.xxhash64("text").alias("r"))
    # A threshold on the hash from the label's row count keeps the sample near TRAIN_ROWS without sorting anything.
    share = F.least(F.lit(1.0), F.lit(float(TRAIN_ROWS)) / F.count("*"))
    # Labels are few, so their shares are broadcast and no text is shuffled.
    shares = stored(some.groupBy("label").agg(share.alias("share")))
    sample = small_join(some, shares, "label").where((F.col("r") / F.lit(2.0**64) + 0.5) <= F.col("share")).select("label", "text")
    counts = sample.mapInArrow(_train, "label string, slot long, n long").groupBy("label", "slot").agg(F.sum("n").alias("n")).collect()
    release(shares)
    langs = sorted({c["label"] for c in counts})
    table_ = np.zeros((len(langs), SLOTS))
    for c in counts:
        table_[langs.index(c["label"]), c["slot"]] = c["n"]
    total = table_.sum(axis=1, keepdims=True)
    return langs, np.log((table_ + 0.1) / (total + 0.1 * SLOTS) * SLOTS).T.copy() if langs else np.zeros((SLOTS, 0))


def visible(html: bytes) -> bytes:
    return TAG.sub(b" ", html)


def _likelihood(model: np.ndarray, markup: bool):
    """Per row: the mean log likelihood ratio of each language and the number of trigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            if markup:
                texts = pa.array([visible(t.encode()).decode("utf-8", "replace") if t else None for t in texts.to_pylist()], pa.large_string())
            means, ns = [], []
            for _, data, off in chunks(texts):
                slot, row = trigrams(data, off)
                n = np.bincount(row, minlength=len(off) - 1)
                sums = np.column_stack([np.bincount(row, weights=model[slot, k], minlength=len(off) - 1) for k in range(model.shape[1])]) if model.shape[1] else np.zeros((len(n), 0))
                means.append(sums / np.maximum(n, 1)[:, None])
                ns.append(n)
            rest = [c for c in batch.schema.names if c != "text"]
            mean = np.concatenate(means) if means else np.zeros((0, model.shape[1]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(list(mean), pa.list_(pa.float64())), pa.array(np.concatenate(ns) if ns else np.zeros(0, np.int64))], names=[*rest, "mean", "n"])

    return run


def fuse(rows: DataFrame, keys: list[str], text: str, declared: Column, address: Column, host: Column, label: Column | None = None, markup: bool = False, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """keys, lang, confidence, text_lang, letters and kept of each row."""
    spark = rows.sparkSession
    prepare(spark)
    declared = F.lower(F.substring(F.trim(declared), 1, 2))
    base = rows.select(*keys, declared.alias("declared"), F.array_distinct(address).alias("address"), host.alias("host"), F.col(text).alias("text"))
    langs, table_ = model or fit(rows.select((F.lower(label) if label is not None else declared).alias("label"), F.col(text).alias("text")))
    if not langs:
        none = F.lit(None).cast("string")
        return base.select(*keys, none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), F.lit(0).cast("long").alias("letters"), F.lit(False).alias("kept"))
    k = len(langs)
    kinds = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in base.schema if c.name != "text")
    scored = base.mapInArrow(_likelihood(table_, markup), f"{kinds}, mean array<double>, n long")
    weight = F.when(F.col("n") > EVIDENCE, F.sqrt(F.col("n") * float(EVIDENCE))).otherwise(F.col("n").cast("double"))
    scored = stored(scored.withColumn("text_log", F.transform("mean", lambda m: m * weight)))
    best = F.array_position("mean", F.array_max("mean")).cast("int")
    # Text posteriors: soft counts for all the other tables.
    top = F.array_max("text_log")
    soft = F.transform("text_log", lambda x: F.exp(x - top))
    norm = F.aggregate(soft, F.lit(0.0), lambda a, x: a + x)
    post = scored.where("n > 0").select("declared", "address", "host", F.transform(soft, lambda x: x / norm).alias("p"))
    sums = [F.sum(F.col("p")[i]).alias(f"p{i}") for i in range(k)]
    whole = post.agg(*sums).first()
    total = [whole[f"p{i}"] or 0.0 for i in range(k)]
    everything = sum(total) or 1.0
    prior = [(t + 1) / (everything + k) for t in total]
    # P(declared | language) and P(address part | language): values are few codes, counted over all rows.
    said = {r["declared"]: [r[f"p{i}"] for i in range(k)] for r in post.where("declared is not null and declared rlike '^[a-z]{2}$'").groupBy("declared").agg(*sums).collect()}
    parts = {r["a"]: [r[f"p{i}"] for i in range(k)] for r in post.withColumn("a", F.explode("address")).where("a rlike '^[a-z]{2,3}$'").groupBy("a").agg(*sums).collect()}

    def evidence(counts: dict, column: Column) -> Column:
        """Log likelihoods of a value, smoothed towards no effect."""
        if not counts:
            return F.array_repeat(F.lit(0.0), k)
        table = F.create_map(*(x for v, c in counts.items() for x in (F.lit(v), F.array(*(F.lit(float(np.log((c[i] + 0.5 * prior[i]) / (total[i] + 0.5)))) for i in range(k))))))
        return F.coalesce(table[column], F.array_repeat(F.lit(0.0), k))

    # Host prior: counts lean on those of the domain, which lean on the corpus.
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$|^([^.]+)$", 0)
    hosts = post.where("host is not null").groupBy("host").agg(*sums).withColumn("domain", domain)
    domains = hosts.groupBy("domain").agg(*(F.sum(f"p{i}").alias(f"d{i}") for i in range(k)))
    n_host, n_domain = sum(F.col(f"p{i}") for i in range(k)), sum(F.col(f"d{i}") for i in range(k))
    leaned = [(F.col(f"p{i}") + LEAN * (F.col(f"d{i}") + LEAN * prior[i]) / (n_domain + LEAN)) / (n_host + LEAN) for i in range(k)]
    hosts = stored(hosts.join(domains, "domain").select("host", F.array(*(F.log(x) for x in leaned)).alias("host_log")))
    joined = small_join(scored, hosts, "host", "left")
    flat = F.array(*(F.lit(float(np.log(p))) for p in prior))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    from_address = F.aggregate(F.coalesce("address", F.array().cast("array<string>")), F.array_repeat(F.lit(0.0), k), lambda s, a: F.zip_with(s, evidence(parts, a), lambda x, y: x + y))
    fused = add(add(add("text_log", F.coalesce("host_log", flat)), evidence(said, F.col("declared"))), from_address)
    out = joined.withColumn("all", fused).withColumn("most", F.array_max("all"))
    weights = F.transform("all", lambda x: F.exp(x - F.col("most")))
    name = F.array(*(F.lit(x) for x in langs))
    lang = F.when(F.col("n") > 0, F.element_at(name, F.array_position("all", F.col("most")).cast("int")))
    fits = F.coalesce(F.array_max("mean") >= JUNK, F.lit(False))
    return out.select(
        *keys, lang.alias("lang"), F.when(F.col("n") > 0, 1.0 / F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0).alias("confidence"),
        F.when(F.col("n") > 0, F.element_at(name, best)).alias("text_lang"), F.col("n").alias("letters"), ((F.col("n") > 0) & fits).alias("kept"),
    )


def page_evidence() -> dict[str, Column]:
    url = F.lower("url")
    host = F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)
    path = F.split(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1), "/")
    # Top-level domain and the whole parts of the path.
    address = F.concat(F.array(F.element_at(F.split(host, r"\."), -1)), path)
    return {
        "declared": F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2})", 1),
        "address": F.coalesce(F.filter(address, lambda a: a.rlike("^[a-z]{2,3}$")), F.array().cast("array<string>")),
        "host": F.nullif(host, F.lit("")),
    }


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages; the trigram model learns from the documents' language column."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select(F.lower("lang").alias("label"), "text"))
    pages = table(spark, sf_dir, "pages")
    return fuse(pages, ["page_id", "url"], "html", label=F.lit(None).cast("string"), markup=True, model=model, **page_evidence())


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """Documents whose text fits a language; columns as they were. Declared language and source are evidence too."""
    prepare(docs.sparkSession)
    keyed = named(docs, "doc_id", "text", "lang", "source")
    rows = keyed.select("h1", "h2", *(F.col("doc")[c].alias(c) for c in ("text", "lang", "source")))
    found = fuse(rows, ["h1", "h2"], "text", F.col("lang"), F.array().cast("array<string>"), F.col("source"))
    bad = stored(found.where("not kept").select("h1", "h2").distinct())
    return anti(keyed, bad, ["h1", "h2"]).select(*(F.col("doc")[c].alias(c) for c in docs.columns))
