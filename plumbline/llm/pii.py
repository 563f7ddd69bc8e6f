"""Operator 6, personal data by a linear-chain conditional random field over word shapes.

Fixed patterns give the base spans (e-mail, ip, card, phone). The field finds what they miss: forms spelled out, groups and
separators of other kinds. Its labels are the four kinds and none; its features are shapes of a word and of its neighbours
(digits as 9, letters as a or A), digit counts and a few words. It is trained by gradient ascent on the conditional
likelihood of a small labelled table, which is built here from sentences with slots, and decoded by Viterbi over padded
batches in numpy. Spans of the field that meet a base span are dropped; base spans always stay.

The field's entities stay within REACH words of a sign, a word with a digit, an @ or a spelled-out dot or at; other words have
the label none by definition, so lines without a sign need no decoding. Lines are decoded whole, and all base patterns run in
time linear in the text.

Results per row: counts of base spans, base_sha256, spans (all, as kind:start:end in code points) and n_added. Null text is
empty. Rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import prepare, table

KINDS = ("email", "ip", "card", "phone")
NONE = 4
WORD = re.compile(r"\S+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]|(?<![^\W_])dot(?![^\W_])|[\[({]at[\])}]", re.I)
REACH = 5
LEXICON = frozenset("at dot (at) [at] {at} (dot) [dot] {dot} com net org mail email e-mail write contact phone tel tel. tel: call fax mobile card visa mastercard credit number ip address host server ssn version token id no. invoice order".split())
EDGE = ".,;:!?\"'()[]{}<>|"


# --- base patterns ---------------------------------------------------------------------------------------------


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @: the characters before it that an address may have, not before the last match, and a domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start."""
    out = [(0, s, e) for s, e in emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p[-10:]) <= 255 and not p[:-10].strip("0") for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# --- the field ---------------------------------------------------------------------------------------------------

_SHAPE = {**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "9" for c in "0123456789"}}
_RUN = re.compile(r"a+|A+|9{6,}")


def shape(word: str) -> str:
    raw = "".join(_SHAPE.get(c, c if c < "\x80" else "a") for c in word)
    return _RUN.sub(lambda m: m[0][0] if m[0][0] != "9" else "9+", raw)


def signs(word: str) -> list[str]:
    """What a word tells by itself."""
    core = word.strip(EDGE)
    digits = sum(c in "0123456789" for c in word)
    low = word.lower()
    found = ["s=" + shape(core)]
    if digits:
        found += [f"n={min(digits, 20)}", "d" if digits == len(core) else "d." if set(core) <= set("0123456789.-/()+") else "dx", f"p={core.count('.')}", f"h={core.count('-')}"]
    if "@" in word:
        found.append("@")
    for w in (low, core.lower()):
        if w in LEXICON:
            found.append("w=" + w)
    if word[:1] in "(+[":
        found.append("o=" + word[0])
    return found


def features(words: list[str], memo: dict[str, list[str]]) -> list[list[str]]:
    own = []
    for w in words:
        if w not in memo:
            if len(memo) > 20_000:
                memo.clear()
            memo[w] = signs(w)
        own.append(memo[w])
    out = []
    for i, f in enumerate(own):
        row = list(f)
        row += ["-" + x for x in own[i - 1]] if i else ["-^"]
        row += ["+" + x for x in own[i + 1]] if i + 1 < len(own) else ["+$"]
        out.append(row)
    return out


class Field:
    """Weights of features by label, and of label pairs."""

    def __init__(self, names: list[str]) -> None:
        self.at = {n: i + 1 for i, n in enumerate(names)}  # 0: no feature
        self.weights, self.pair, self.memo = np.zeros((len(names) + 1, NONE + 1)), np.zeros((NONE + 1, NONE + 1)), {}

    def encode(self, lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(lines, words, features) of feature numbers, padded, and the lines' lengths."""
        rows = [[[self.at[f] for f in fs if f in self.at] for fs in features(line, self.memo)] for line in lines]
        x = np.zeros((len(rows), max(map(len, rows), default=0), max((len(f) for r in rows for f in r), default=0)), np.int32)
        for i, r in enumerate(rows):
            for j, f in enumerate(r):
                x[i, j, : len(f)] = f
        return x, np.array([len(r) for r in rows])

    def potentials(self, x: np.ndarray) -> np.ndarray:
        return self.weights[x].sum(axis=2) if x.shape[2] else np.zeros((*x.shape[:2], NONE + 1))

    def viterbi(self, x: np.ndarray, n: np.ndarray, near: np.ndarray | None = None) -> np.ndarray:
        """The best labels of each line (padding gets the label none); without `near`, a word can only have the label none."""
        e = self.potentials(x)
        if near is not None:
            e[~near, :NONE] = -1e9
        score, back = e[:, 0], np.zeros(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            via = score[:, :, None] + self.pair
            back[:, t] = via.argmax(axis=1)
            new = via.max(axis=1) + e[:, t]
            score = np.where((t < n)[:, None], new, score)
        out = np.full(e.shape[:2], NONE, np.int8)
        now = score.argmax(axis=1)
        for t in range(e.shape[1] - 1, -1, -1):
            live = t < n
            out[live, t] = now[live]
            step = back[np.arange(len(now)), t, now]
            now = np.where(live & (t > 0), step, now)
        return out

    def train(self, lines: list[list[str]], labels: list[list[int]], steps: int = 150, rate: float = 0.3, decay: float = 1e-3) -> None:
        """Gradient ascent on the conditional log likelihood: forward and backward sums over all lines at once."""
        x, n = self.encode(lines)
        b, t_max = x.shape[:2]
        y = np.full((b, t_max), NONE)
        for i, row in enumerate(labels):
            y[i, : len(row)] = row
        live = np.arange(t_max) < n[:, None]
        gold = np.eye(NONE + 1)[y] * live[:, :, None]
        pairs = np.zeros_like(self.pair)
        both = live[:, 1:]
        np.add.at(pairs, (y[:, :-1][both], y[:, 1:][both]), 1)
        flat = x[live]
        speed_w, speed_p = np.zeros_like(self.weights), np.zeros_like(self.pair)
        sum_exp = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
        for _ in range(steps):
            e = self.potentials(x)
            fore, aft = np.zeros_like(e), np.zeros_like(e)
            fore[:, 0] = e[:, 0]
            for t in range(1, t_max):
                fore[:, t] = e[:, t] + sum_exp(fore[:, t - 1][:, :, None] + self.pair, 1)
            for t in range(t_max - 2, -1, -1):
                on = sum_exp(self.pair + (e[:, t + 1] + aft[:, t + 1])[:, None, :], 2)
                aft[:, t] = np.where((t + 1 < n)[:, None], on, 0.0)
            total = sum_exp(fore[np.arange(b), n - 1], 1)
            p = np.exp(fore + aft - total[:, None, None]) * live[:, :, None]
            joint = np.exp(fore[:, :-1, :, None] + self.pair + (e[:, 1:] + aft[:, 1:])[:, :, None, :] - total[:, None, None, None]) * both[:, :, None, None]
            g = np.zeros_like(self.weights)
            diff = (gold - p)[live]
            for k in range(flat.shape[1]):
                np.add.at(g, flat[:, k], diff)
            g[0] = 0
            g = g / b - decay * self.weights
            h = (pairs - joint.sum(axis=(0, 1))) / b - decay * self.pair
            speed_w, speed_p = speed_w + g * g, speed_p + h * h
            self.weights += rate * g / np.sqrt(speed_w + 1e-8)
            self.pair += rate * h / np.sqrt(speed_p + 1e-8)


def labelled_table(n: int = 500, seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """Sentences with slots filled in: (words, labels)."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    name = lambda: "".join(r.choice(["an", "ber", "cor", "dal", "el", "fin", "gor", "hel", "is"]) for _ in range(r.randint(1, 3)))
    site = lambda: name() + r.choice([" dot ", " (dot) ", " [dot] "]) + r.choice(["com", "net", "org", "de"])
    slots = {
        "email": [lambda: f"{name()}.{d(2)}@{name()}.example.com", lambda: f"{name()}@{name()}.org", lambda: f"{name()} at {site()}", lambda: f"{name()} (at) {site()}", lambda: f"{name()} [at] {name()}.com", lambda: f"{name()}.{name()} [at] {site()}", lambda: f"{name()}@localhost"],
        "ip": [lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)) + f":{d(4)}", lambda: "-".join(str(r.randint(100, 255)) for _ in range(4))],
        "card": [lambda: d(16), lambda: " ".join(d(4) for _ in range(4)), lambda: "-".join(d(4) for _ in range(4)), lambda: f"{d(4)} {d(6)} {d(5)}", lambda: ".".join(d(4) for _ in range(4))],
        "phone": [lambda: f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"+{d(2)} {d(3)} {d(7)}", lambda: f"0{d(3)} {d(7)}", lambda: f"00{d(2)} {d(3)} {d(6)}", lambda: f"{d(3)}.{d(3)}.{d(4)}"],
    }
    none = [lambda: f"20{d(2)}-0{r.randint(1, 9)}-1{d(1)}", lambda: f"{d(2)}:{d(2)}", lambda: f"{r.randint(1, 9)}.{d(1)}", lambda: f"{d(1)}.{d(1)}.{d(1)}", lambda: d(r.randint(1, 3)), lambda: f"20{d(2)}", lambda: f"{d(2)}%", lambda: f"${d(3)}.{d(2)}", lambda: f"{d(1)},{d(3)}", lambda: f'"{"".join(r.choice("0123456789abcdef") for _ in range(r.choice([8, 32, 40])))}"', lambda: f"#{d(4)}", lambda: f"v{d(1)}.{d(1)}", lambda: f"{d(3)}/{d(3)}", lambda: f"x{d(2)}", lambda: d(r.randint(5, 7)), lambda: f"{d(2)}/{d(2)}/20{d(2)}", lambda: "@" + name(), lambda: "dot", lambda: "token = " + f'"{"".join(r.choice("0123456789abcdef") for _ in range(40))}"', lambda: f"Version {d(1)}.{d(1)}.", lambda: f"BY-NC {d(1)}.{d(1)}.", lambda: f"chapter {d(2)}", lambda: f"{d(3)} people", lambda: f"at {d(2)}:{d(2)}"]
    lead = ["write to", "call", "my number is", "phone:", "tel.", "card number", "visa", "paid with", "from host", "the ip address", "contact", "mail", "and", "of the", "that", "|", "with", "est de", "und die", "y los", "License,"]
    plain = "The of and river Town opened to a bridge, after works. many came was seen; on sunday le de la und der que los é schön niño |".split()
    out = []
    for _ in range(n):
        words: list[str] = []
        labels: list[int] = []

        def add(text: str, label: int, words=words, labels=labels) -> None:
            for w in text.split():
                words.append(w)
                labels.append(label)

        for _ in range(r.randint(1, 3)):
            add(" ".join(r.choice(plain) for _ in range(r.randint(0, 5))), NONE)
            if r.random() < 0.55:
                kind = r.randrange(4)
                if r.random() < 0.6:
                    add(r.choice(lead), NONE)
                add(r.choice(slots[KINDS[kind]])() + r.choice(["", "", "", ".", ","]), kind)
            elif r.random() < 0.8:
                add(r.choice(lead) if r.random() < 0.3 else "", NONE)
                add(r.choice(none)() + r.choice(["", "", "."]), NONE)
            add(" ".join(r.choice(plain) for _ in range(r.randint(1, 5))), NONE)
        out.append((words, labels))
    return out


def trained() -> Field:
    rows = labelled_table()
    memo: dict = {}
    names = sorted({f for words, _ in rows for fs in features(words, memo) for f in fs})
    field = Field(names)
    field.train([w for w, _ in rows], [y for _, y in rows])
    field.memo = {}
    return field


def field_spans(field: Field, lines: list[tuple[int, str]], cells: int = 400_000) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the field finds in each (offset, line)."""
    words = [[(m.start() + o, m.end() + o) for m in WORD.finditer(line)] for o, line in lines]
    out: list[list[tuple[int, int, int]]] = [[] for _ in lines]
    order = sorted((i for i in range(len(lines)) if words[i]), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(words[order[end]]) * 25 <= cells:
            end += 1
        part = order[at:end]
        cut = [[lines[i][1][s - lines[i][0] : e - lines[i][0]] for s, e in words[i]] for i in part]
        x, n = field.encode(cut)
        near = np.zeros(x.shape[:2], bool)
        for row, line in enumerate(cut):
            for k in [k for k, w in enumerate(line) if SIGN.search(w)]:
                near[row, max(0, k - REACH) : k + REACH + 1] = True
        for i, labels in zip(part, field.viterbi(x, n, near), strict=True):
            offset, line = lines[i]
            k = 0
            while k < len(words[i]):
                kind, j = int(labels[k]), k
                while j + 1 < len(words[i]) and labels[j + 1] == kind:
                    j += 1
                if kind != NONE:
                    s, e = words[i][k][0], words[i][j][1]
                    while s < e and line[s - offset] in EDGE and line[s - offset] != "(":
                        s += 1
                    while e > s and line[e - 1 - offset] in EDGE:
                        e -= 1
                    if SIGN.search(line[s - offset : e - offset]):
                        out[i].append((kind, s, e))
                k = j + 1
        at = end
    return out


def _find(field: Field):
    def joined(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, lines, owner = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                hit = SIGN.search(text) if text else None
                if not hit:
                    base.append([])
                    continue
                base.append(base_spans(text))
                at = 0
                for line in text.split("\n"):
                    if SIGN.search(line):
                        lines.append((at, line))
                        owner.append(row)
                    at += len(line) + 1
            every = [list(b) for b in base]
            for row, spans in zip(owner, field_spans(field, lines), strict=True):
                every[row] += [x for x in spans if all(x[2] <= s or x[1] >= e for _, s, e in base[row])]
            counts = [[sum(k == kind for k, _, _ in b) for b in base] for kind in range(4)]
            cols = [*(pa.array(c, pa.int64()) for c in counts), pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()), pa.array([joined(e) for e in every], pa.string()), pa.array([len(e) - len(b) for e, b in zip(every, base, strict=True)], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols], names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of each row."""
    prepare(docs.sparkSession)
    field = field or trained()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_find(field), f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long").withColumnRenamed("id", id_col)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
