"""Operator 3, line dedup with a log-template tree.

Method: a tree of fixed depth. A line's leaf is its number of tokens and its first DEPTH tokens, where a token with a digit
is a variable field. Within a leaf, tokens that hold at their place in at least `min_docs` texts are constants and all others
variable fields; what remains is the line's template, if constants are at least SIMILAR of its tokens. A template counts for all lines
that hold its constants, those with more constants (a name that is frequent by itself) as well. If they are in at least `min_docs`
different texts it recurs: its lines are dropped everywhere but at the first occurrence (least id, then position), so content that merely
repeats is kept once.

A line whose tokens, digits included, are the same in at least VERBATIM_DOCS different texts recurs too, whatever its tokens: the
thresholds MIN_TOKENS, MIN_DOCS and SIMILAR hold for templates only. Just lines of under MIN_CHARS characters (white space aside) stay.

Copies of one text count once, so whole documents that repeat are left to document dedup. Lines and tokens are 64-bit hashes, made in numpy as the texts are scanned; leaves, lines and templates are counted by
DataFrame aggregations that combine before the shuffle, so no hot line or leaf meets in one task. Null text has no lines and stays null; an empty text is one empty line. Repeated rows share
their fate. Null ids come last. Long texts are whole, an empty table gives an empty one, and further columns stay as they are, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import anti, prepare, release, semi, small_join, stored, table
from plumbline.llm.text import MIX2, NOT_SPACE, POWERS, chunks, mix, prefix_hash, span_hash, words

DEPTH = 3
MIN_DOCS = 5
MIN_TOKENS = 4
VERBATIM_DOCS = 2
MIN_CHARS = 3
SIMILAR = 0.6
#: Bits of the map of open lines that the second scan gets: 8 MB.
BITS = 2**26
FIELD = "<*>"
FIELD_HASH = np.uint64(0xF1E1D)


def line_arrays(data: np.ndarray, off: np.ndarray):
    """Of the lines with tokens: (row, place in the row, tokens, fields, leaf, hash, hash with digits, characters), and of all tokens (line, hash, is a field)."""
    start, end, rows = words(data, off, NOT_SPACE)
    if not len(start):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 3 + (np.zeros(0, np.int64),), (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    token = span_hash(prefix_hash(data), start, end)
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data < 58))])
    field = digits[end] > digits[start]
    true = token.copy()
    token[field] = FIELD_HASH
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    breaks = np.flatnonzero(data == 10)
    row = np.repeat(np.arange(len(off) - 1), np.diff(rows))
    line = np.searchsorted(breaks, start) + row
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    n = np.diff(np.append(first, len(line)))
    k = np.arange(len(line)) - np.repeat(first, n)
    up, _ = POWERS.get(int(n.max()) + 1)
    spread = mix(token) * up[k]
    whole = mix(np.add.reduceat(spread, first))
    exact = mix(np.add.reduceat(mix(true) * up[k], first))
    lead = mix(np.add.reduceat(np.where(k < DEPTH, spread, np.uint64(0)), first) + n.astype(np.uint64) * np.uint64(MIX2))
    at = line[first] - (np.searchsorted(breaks, off[:-1]) + np.arange(len(off) - 1))[row[first]]
    return (row[first], at, n, np.add.reduceat(field.astype(np.int64), first), lead, whole, exact, np.add.reduceat(begun[end] - begun[start], first)), (np.repeat(np.arange(len(first)), n), token, field)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, ids, t = (batch.column(c) for c in ("key", "id", "t"))
        for i, data, off in chunks(batch.column("text")):
            (row, at, n, fields, leaf, h, exact, chars), _ = line_arrays(data, off)
            some = (n >= MIN_TOKENS) | (chars >= MIN_CHARS)
            rows = pa.array(i + row[some])
            n, fields, leaf, h, exact = n[some], fields[some], leaf[some], h[some], exact[some]
            firm = pa.array(n - fields >= SIMILAR * n)
            # Templates take lines of MIN_TOKENS; the hash with digits is null where it equals the other.
            short = n < MIN_TOKENS
            yield pa.RecordBatch.from_arrays([key.take(rows), ids.take(rows), t.take(rows), pa.array(at[some]), firm, pa.array(leaf.view(np.int64), mask=short), pa.array(h.view(np.int64), mask=short), pa.array(exact.view(np.int64), mask=~short & (fields == 0))], names=["key", "id", "t", "pos", "firm", "leaf", "h", "exact"])


def _tokens(bitmap: np.ndarray):
    """A row of token hashes for each line whose hash is in the bitmap (and some that only share a bit, which a join takes out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, off in chunks(batch.column("text")):
                (row, _, n, _, leaf, h, _, _), (line, token, field) = line_arrays(data, off)
                bit = h & np.uint64(BITS - 1)
                keep = (n >= MIN_TOKENS) & ((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                some = keep[line] if len(line) else np.zeros(0, bool)
                ends = pa.array(np.concatenate([[0], np.cumsum(n[keep])]).astype(np.int32))
                token, field = pa.array(token[some].view(np.int64)), pa.array(field[some])
                yield pa.RecordBatch.from_arrays([pa.array(leaf[keep].view(np.int64)), pa.array(h[keep].view(np.int64)), batch.column("t").take(pa.array(i + row[keep])), pa.ListArray.from_arrays(ends, token), pa.ListArray.from_arrays(ends, field)], names=["leaf", "h", "t", "tokens", "fields"])

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """BITS bits, set where the low bits of a hash (column h) point to: a fixed size, whatever the number of hashes."""
    place = (F.col("h").bitwiseAND(F.lit(BITS - 1)) + 1).alias("place")
    parts = hashes.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for x in parts:
        raw = np.frombuffer(bytes(x["bits"]), np.uint8)
        out[(x["part"] - 1) * 4_096 : (x["part"] - 1) * 4_096 + len(raw)] = raw
    return out


def recurring_lines(docs: DataFrame, id_col: str, text_col: str, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, id, t, dropped): for each text with recurring lines, the places of those to drop. key and t: xxhash64 of id and text, and of the text."""
    texts = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    small = stored(texts.mapInArrow(_lines, "key long, id long, t long, pos long, firm boolean, leaf long, h long, exact long"))
    per_line = small.where("h is not null").groupBy("leaf", "h", "t").agg(F.first("firm").alias("firm"), F.first(F.expr("exact is null")).alias("plain"))
    lines = stored(per_line.groupBy("leaf", "h").agg(F.count("*").alias("texts"), F.min("t").alias("one"), F.first("firm").alias("firm"), F.first("plain").alias("plain")))
    recurs = (F.col("texts") >= min_docs) & F.col("firm")
    # Lines that recur as they are.
    same = lines.where(recurs | (F.col("plain") & (F.col("texts") >= VERBATIM_DOCS))).select("h", F.col("h").alias("template"))
    again = small.where("exact is not null").select("exact", "t").distinct().groupBy("exact").count().where(f"count >= {VERBATIM_DOCS}").select("exact")
    # Leaves that could hold a template with fields: enough texts, and a line that does not recur as it is.
    hot = F.col("texts") >= min_docs
    leaves = lines.groupBy("leaf").agg(F.sum("texts").alias("texts"), F.count("*").alias("kinds"), F.max(~recurs).alias("open")).where(f"texts >= {min_docs} and kinds > 1 and open").select("leaf")
    # A line in min_docs texts makes all its tokens constants and its template shared, so one of its texts tells all.
    left = stored(lines.join(leaves, "leaf").groupBy("h").agg(F.max(F.when(hot, F.col("one")).otherwise(0)).alias("one")))
    # Their tokens: one more scan, which knows the lines that are left by a bitmap; the join then takes just those.
    scanned = texts.select("t", "text").mapInArrow(_tokens(_bitmap(left)), "leaf long, h long, t long, tokens array<long>, fields array<boolean>")
    held = small_join(scanned, left, "h").where("one = 0 or one = t").groupBy("leaf", "h", "t").agg(F.first("tokens").alias("tokens"), F.first("fields").alias("fields"), F.max(F.col("one") != 0).alias("hot"))
    held = stored(held)
    tokens = held.select("leaf", "h", "t", "hot", F.size("tokens").cast("long").alias("n"), F.posexplode(F.arrays_zip("tokens", "fields")).alias("at", "x")).select("leaf", "h", "t", "n", F.col("at").cast("long").alias("at"), F.col("x.tokens").alias("token"), F.col("x.fields").alias("field"), "hot")
    constant = stored(tokens.where("not field").select("leaf", "at", "token", "t", "hot").distinct().groupBy("leaf", "at", "token").agg(F.count("*").alias("count"), F.max("hot").alias("hot")).where(f"hot or count >= {min_docs}").select("leaf", "at", "token"))
    kinds = stored(tokens.select("leaf", "h", "n", "at", "token", "hot").distinct().join(constant, ["leaf", "at", "token"]))
    release(left, constant)
    # A template is its leaf and its constants with their places: hashes add up whatever the order.
    template = stored(kinds.groupBy("leaf", "h", "n", "hot").agg(F.sum(F.xxhash64("at", "token") % F.lit(2**40)).alias("sum"), F.count("*").alias("firm")).where(f"firm >= {SIMILAR} * n").select("h", "leaf", "hot", "firm", F.xxhash64("leaf", "sum").alias("template")))
    in_texts = stored(held.select("leaf", "h", "t").join(template, ["leaf", "h"]).groupBy("template", "t").agg(F.max("hot").alias("hot")))
    own = in_texts.groupBy("template").agg((F.max("hot") | (F.count("*") >= min_docs)).alias("shared"))
    known = stored(template.groupBy("leaf", "template", "firm").agg(F.min("h").alias("h")).join(own, "template"))
    wider = stored(_wider(known, kinds))
    # Shared alone, with a template that is and has all its constants, or by the texts of all that have them.
    by_one = known.where("shared").select("template", F.col("template").alias("whole"))
    match = known.select("template", F.col("template").alias("whole")).union(wider)
    certain = match.join(by_one.select("template"), "template").select("whole").distinct()
    few = in_texts.select("template", "t").join(known.where("not shared").select("template"), "template")
    summed = match.join(certain, "whole", "left_anti").join(few, "template").select("whole", "t").distinct().groupBy("whole").count().where(f"count >= {min_docs}").select("whole")
    found = template.select("h", "template").join(match, "template").join(certain.union(summed), "whole").select("h", F.col("whole").alias("template"))
    found = stored(same.union(found))
    release(lines, held, kinds, in_texts, known, wider, template)
    order = F.struct(F.coalesce("id", F.lit(2**62)).alias("id"), F.col("key"), F.col("pos"))
    hits = stored(small.select("h", "key", "id", "t", "pos").join(found.select("h").distinct(), "h"))
    # A line's first occurrence stays if it is the first of each of its templates.
    least = stored(hits.groupBy("h").agg(F.min(order).alias("m")))
    first = found.join(least, "h").groupBy("template").agg(F.min("m").alias("first"))
    stays = found.join(first, "template").join(least, "h").groupBy("h").agg(F.first("m").alias("m"), F.min(F.col("m") == F.col("first")).alias("stays"))
    repeats = stored(small.select("exact", "key", "id", "t", "pos").join(again, "exact"))
    start = repeats.groupBy("exact").agg(F.min(order).alias("m"))
    drop = hits.join(stays, "h").where("not stays or key <> m.key or pos <> m.pos").select("key", "id", "t", "pos")
    drop = drop.union(repeats.join(start, "exact").where("key <> m.key or pos <> m.pos").select("key", "id", "t", "pos"))
    out = stored(drop.groupBy("key", "id", "t").agg(F.collect_set("pos").alias("dropped")))
    release(small, found, hits, least, repeats)
    return out


def _wider(known: DataFrame, kinds: DataFrame) -> DataFrame:
    """(template, whole): pairs of a leaf's templates where the first holds all constants of the second and more.

    They meet on the constant of the second that fewest templates of the leaf hold, if the bits of the second's constants are all
    among those of the first; the constants themselves are then compared.
    """
    several = known.groupBy("leaf").agg(F.count("*").alias("k"), F.min("firm").alias("lo"), F.max("firm").alias("hi")).where("k > 1 and lo < hi").select("leaf")
    some = known.join(several, "leaf")
    held = kinds.select("leaf", "h", F.xxhash64("at", "token").alias("c")).join(some.select("leaf", "h", "template", "firm"), ["leaf", "h"])
    bit = lambda shift: F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(shiftright(c, {shift}), 64) as int))"))
    sets = stored(held.groupBy("leaf", "template", "firm").agg(F.collect_set("c").alias("cs"), bit(0).alias("b0"), bit(20).alias("b1")))
    holds = stored(sets.select("leaf", "template", "firm", "b0", "b1", F.explode("cs").alias("c")))
    often = holds.groupBy("leaf", "c").agg(F.count("*").alias("k"))
    rare = holds.join(often, ["leaf", "c"]).groupBy("template").agg(F.min(F.struct("k", "c")).alias("r"), F.first("leaf").alias("leaf"), F.first("firm").alias("size"), F.first("b0").alias("w0"), F.first("b1").alias("w1")).select("leaf", F.col("r.c").alias("c"), F.col("template").alias("whole"), "size", "w0", "w1")
    wide = holds.withColumnsRenamed({"leaf": "l", "c": "d"})
    pairs = rare.join(wide, F.expr("leaf = l and c = d and firm > size and (w0 & ~b0) = 0 and (w1 & ~b1) = 0")).select("template", "whole")
    mine = sets.select("template", F.col("cs").alias("mine"))
    theirs = sets.select(F.col("template").alias("whole"), F.col("cs").alias("theirs"))
    return pairs.join(mine, "template").join(theirs, "whole").where("size(array_except(theirs, mine)) = 0").select("template", "whole")


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, kept, n_lines, n_dropped) of each row: the row as a struct, so that no name clashes, and its text without recurring lines."""
    prepare(docs.sparkSession)
    found = recurring_lines(docs, id_col, text_col, min_docs)
    text = F.col("doc")[text_col]
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).withColumn("key", F.xxhash64(F.col("doc")[id_col], text))
    ids = found.select("key").distinct()
    # Only texts that lose lines meet their places, always in a shuffle: lists of places have no bound.
    places = found.select(F.col("key").alias("k"), "id", "t", "dropped")
    same = (F.col("key") == F.col("k")) & F.col("doc")[id_col].cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("t"))
    losing = semi(keyed, ids, "key").join(places.hint("merge"), same, "left").select("doc", "dropped")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), "dropped")
    cut = losing.select("doc", F.when(F.col("dropped").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i.cast("int"))), "\n")).alias("kept"), F.greatest(F.coalesce(F.size("dropped"), F.lit(0)), F.lit(0)).cast("long").alias("n_dropped"))
    rest = anti(keyed, ids, "key").select("doc", text.alias("kept"), F.lit(0).cast("long").alias("n_dropped"))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return cut.union(rest).select("doc", "kept", F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"), "n_dropped")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with recurring lines taken out of the text, and two columns: _n_lines and _n_dropped (in place of any of these names)."""
    named = [F.col("kept").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    return cut_lines(docs, id_col, text_col, min_docs).select(*named, F.col("n_lines").alias("_n_lines"), F.col("n_dropped").alias("_n_dropped"))


def op3_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP3_SQL = rf"""
WITH l AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT r, doc_id, text, unnest(range(0, len(ls))) AS pos, unnest(ls) AS raw FROM l),
m AS (SELECT r, doc_id, text, pos, trim(regexp_replace(raw, '[\t\x0b\f\r ]+', ' ', 'g')) AS exact FROM x),
f AS (SELECT *, regexp_replace(exact, '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line, len(string_split(exact, ' ')) AS n FROM m WHERE exact <> ''),
g AS (SELECT *, string_split(line, ' ') AS ts FROM f WHERE n >= {MIN_TOKENS}),
k AS (SELECT n || ':' || array_to_string(ts[1:{DEPTH}], ' ') AS leaf, line, n, ts, text FROM g GROUP BY ALL),
kind AS (SELECT leaf, line, n, len(list_filter(any_value(ts), lambda t: t <> '{FIELD}')) AS firm, count(*) AS texts FROM k GROUP BY leaf, line, n),
again AS (SELECT exact FROM f WHERE n >= {MIN_TOKENS} OR length(replace(exact, ' ', '')) >= {MIN_CHARS} GROUP BY exact HAVING count(DISTINCT text) >= {VERBATIM_DOCS}),
open_ AS (SELECT leaf FROM kind GROUP BY leaf HAVING sum(texts) >= {MIN_DOCS} AND count(*) > 1 AND bool_or(texts < {MIN_DOCS} OR firm < {SIMILAR} * n)),
tok AS (SELECT leaf, line, n, text, unnest(range(1, n + 1)) AS place, unnest(ts) AS token FROM k SEMI JOIN open_ USING (leaf)),
con AS (SELECT leaf, place, token FROM tok WHERE token <> '{FIELD}' GROUP BY ALL HAVING count(DISTINCT text) >= {MIN_DOCS}),
t AS (SELECT leaf, line, list(place || ' ' || token ORDER BY place) AS cs FROM (SELECT DISTINCT leaf, line, n, place, token FROM tok) JOIN con USING (leaf, place, token) GROUP BY leaf, line, n HAVING count(*) >= {SIMILAR} * n),
u AS (SELECT leaf, cs, min(line) AS one FROM t GROUP BY leaf, cs),
held AS (SELECT w.leaf, w.cs AS whole, v.cs FROM u w JOIN u v ON w.leaf = v.leaf AND (v.cs = w.cs OR (len(v.cs) > len(w.cs) AND list_has_all(v.cs, w.cs)))),
wide AS (SELECT h.leaf, h.whole FROM held h JOIN t ON t.leaf = h.leaf AND t.cs = h.cs JOIN k ON k.leaf = t.leaf AND k.line = t.line GROUP BY ALL HAVING count(DISTINCT k.text) >= {MIN_DOCS}),
found AS (SELECT line, line AS template FROM kind WHERE texts >= {MIN_DOCS} AND firm >= {SIMILAR} * n
  UNION SELECT t.line, t.leaf || '|' || array_to_string(h.whole, ' ') FROM t JOIN held h ON h.leaf = t.leaf AND h.cs = t.cs JOIN wide w ON w.leaf = h.leaf AND w.whole = h.whole),
least_ AS (SELECT line, min({{'d': doc_id, 'p': pos}}) AS m FROM g GROUP BY line),
first_ AS (SELECT template, min(m) AS one FROM found JOIN least_ USING (line) GROUP BY template),
stays AS (SELECT line, any_value(m) AS m, bool_and(m = one) AS stays FROM found JOIN first_ USING (template) JOIN least_ USING (line) GROUP BY line),
begins AS (SELECT exact, min({{'d': doc_id, 'p': pos}}) AS m FROM f SEMI JOIN again USING (exact) GROUP BY exact),
gone AS (SELECT r, list(DISTINCT pos) AS ps FROM (SELECT r, pos FROM g JOIN stays s USING (line) WHERE NOT s.stays OR {{'d': doc_id, 'p': pos}} <> s.m
  UNION ALL SELECT r, pos FROM f JOIN begins b USING (exact) WHERE {{'d': doc_id, 'p': pos}} <> b.m) GROUP BY r)
SELECT l.doc_id, coalesce(len(l.ls), 0) AS n_lines, coalesce(len(g.ps), 0) AS n_dropped,
       sha256(coalesce(array_to_string(list_filter(l.ls, lambda v, i: g.ps IS NULL OR NOT list_contains(g.ps, i - 1)), chr(10)), '')) AS kept_sha256
FROM l LEFT JOIN gone g USING (r)
"""
