r"""Operator 4: personal data by base rules and a linear-chain CRF.

Base rules find spans of four kinds, leftmost and non-overlapping within a kind:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ip    ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, each part at most 255
* card  ``[0-9]([\x20-]?[0-9])+``, 12 to 19 digits that pass Luhn
* phone ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits

A match that fails its check is dropped, without another try. A linear-chain
conditional random field over word-shape features, trained from a small labelled
table, adds spans of the same kinds that the rules miss (a phone number without
a plus, an address with "(at)", a card with dots between its digits; shapes tell it
whether digits pass Luhn); a span of it that touches a base span is
dropped, so base spans stay as they are. Sequences are sentences: words up to one
that ends in . ! or ? or at a line's end. Decoding is Viterbi over all sentences of a batch
at once. Offsets are code points, end exclusive.

Defined cases: null and empty texts have no span; an id that is null or repeated
is passed through, one result row for each row; extra columns are ignored; an
empty table gives an empty result. The labelled table is collected for training:
``LABELLED_ROWS`` rows at most.

Plan: one pass over the documents without a shuffle; the model is a few kilobytes
in the task's closure. The rules cost time linear in the text: they look around
each ``@``, and over runs of digits, never from each position anew.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import Words, parts, read, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELLED_ROWS = 20_000
PART = 1 << 21            # bytes of texts whose words are decoded together

# --- base rules --------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        end = None
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield begin, end
        free = end or at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


_RULES = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base rules, in order."""
    return sorted((a, k, b) for k, rule in enumerate(_RULES) for a, b in rule(text))


# --- word shapes ---------------------------------------------------------------

LOWER, UPPER, DIGIT, AT, DOT, DASH, PLUS, PAREN, MARK, WIDE = (1 << i for i in range(10))
_CLASS = np.zeros(256, dtype=np.uint16)
_CLASS[33:127] = MARK
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = LOWER, UPPER, DIGIT
for _c, _bit in (("@", AT), (".", DOT), ("-", DASH), ("+", PLUS), ("(", PAREN), (")", PAREN)):
    _CLASS[ord(_c)] = _bit
_CLASS[128:] = WIDE
_RANK = np.zeros(1 << 10, dtype=np.int64)      # class bit -> 0..9
_RANK[[1 << i for i in range(10)]] = np.arange(10)
_SIZE = np.array([0, 0, 1, 2, 3, 4, 4, 5, 5, 5, 6, 6, 6, 6, 6, 7])   # length 0..15+
_NUM = np.array([0, 1, 2, 3, 4, 5, 5, 5, 6, 6, 6, 6, 7, 7, 7, 7, 8])  # digits 0..16+
# templates: set of classes; digits x length; dots x digits; ends; letters of the "at"
# kind; Luhn of the word; Luhn of four words of four digits, this one among them
_WIDTHS = (1 << 10, 9 * 8, 4 * 9, 100, 4, 3, 3)
_STARTS = np.cumsum((0, *_WIDTHS))[:-1]
N_FEATURES = sum(_WIDTHS)
_END_MARKS = np.zeros(256, dtype=bool)
_END_MARKS[[ord(c) for c in ".!?"]] = True


def _shapes(words: Words) -> np.ndarray:
    """One row a word: its feature of each template."""
    data, starts, ends = words.data, words.starts, words.ends
    kind = _CLASS[data]
    mask = np.bitwise_or.reduceat(kind, starts).astype(np.int64)
    digits = np.add.reduceat((kind == DIGIT).astype(np.int32), starts)
    dots = np.minimum(np.add.reduceat((kind == DOT).astype(np.int32), starts), 3)
    length = np.minimum(ends - starts, 15)
    number = _NUM[np.minimum(digits, 16)]
    # "(at)" or "[at]" inside a word
    inner = np.zeros(len(data), dtype=bool)
    if len(data) > 3:
        inner[1:-2] = ((data[1:-2] == 97) & (data[2:-1] == 116)
                       & ((data[:-3] == 40) | (data[:-3] == 91))
                       & ((data[3:] == 41) | (data[3:] == 93)))
    at_word = np.add.reduceat(inner.astype(np.int32), starts) > 0
    word_luhn, group_luhn = _luhn_shapes(words, kind == DIGIT, digits)
    return np.stack([
        _STARTS[0] + mask,
        _STARTS[1] + number * 8 + _SIZE[length],
        _STARTS[2] + dots * 9 + number,
        _STARTS[3] + _RANK[kind[starts]] * 10 + _RANK[kind[ends - 1]],
        _STARTS[4] + at_word * 2 + ((mask & AT) > 0),
        _STARTS[5] + word_luhn, _STARTS[6] + group_luhn], axis=1)


def _luhn_shapes(words: Words, is_digit: np.ndarray,
                 digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0: not the digits of a card, 1: they pass Luhn, 2: they fail; for each word
    alone, and in groups of four words of four digits."""
    at = np.flatnonzero(is_digit)
    word = np.searchsorted(words.starts, at, side="right") - 1
    from_right = np.cumsum(digits)[word] - 1 - np.arange(len(at))
    value = (words.data[at] - 48).astype(np.int64) << (from_right & 1)
    total = np.bincount(word, value - 9 * (value > 9), minlength=len(digits)).astype(np.int64)
    alone = np.where((digits >= 12) & (digits <= 19), 1 + (total % 10 != 0), 0)
    group = np.zeros(len(digits), dtype=np.int64)
    four = digits == 4                     # an even count, so sums of words add up
    k = np.arange(max(0, len(digits) - 3))
    k = k[four[k] & four[k + 1] & four[k + 2] & four[k + 3]
          & (words.doc[k] == words.doc[k + 3])] if len(k) else k
    passes = (total[k] + total[k + 1] + total[k + 2] + total[k + 3]) % 10 == 0
    for start, mark in ((k[~passes], 2), (k[passes], 1)):   # one that passes tells more
        for i in range(4):
            group[start + i] = mark
    return alone, group


def _sentences(words: Words) -> np.ndarray:
    """Index of each sentence's first word."""
    data, starts, ends, doc = words.data, words.starts, words.ends, words.doc
    first = np.ones(len(starts), dtype=bool)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    first[1:] = ((doc[1:] != doc[:-1]) | _END_MARKS[data[ends[:-1] - 1]]
                 | (breaks[starts[1:]] != breaks[ends[:-1]]))
    return np.flatnonzero(first)


# --- the field -------------------------------------------------------------------

LABELS = ("O", "email", "ip", "B-card", "I-card", "B-phone", "I-phone")
_N = len(LABELS)


class Field(NamedTuple):
    weights: np.ndarray      # feature x label
    moves: np.ndarray        # label x next label
    begin: np.ndarray        # label of a sentence's first word


def viterbi(field: Field, shapes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The best label of each word; sentences of a batch advance together."""
    n = len(shapes)
    scores = field.weights[shapes[:, 0]]
    for c in range(1, shapes.shape[1]):    # one template at a time
        scores += field.weights[shapes[:, c]]
    lengths = np.diff(np.append(heads, n))
    order = np.argsort(-lengths, kind="stable")
    heads, lengths = heads[order], lengths[order]
    back = np.zeros((n, _N), dtype=np.int8)
    best = scores[heads] + field.begin
    left = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    for t in range(1, lengths[0]):
        m = left[t]                       # sentences that have a word t
        at = heads[:m] + t
        paths = best[:m, :, None] + field.moves
        back[at] = paths.argmax(axis=1)
        best[:m] = paths.max(axis=1) + scores[at]
    labels = np.zeros(n, dtype=np.int8)
    state = best.argmax(axis=1)
    for t in range(lengths[0] - 1, -1, -1):
        m = left[t]                       # sentences longer than t
        at = heads[:m] + t
        labels[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return labels


def train(labelled: DataFrame, steps: int = 150, rate: float = 0.2,
          ridge: float = 1e-3) -> Field:
    """A field from a table of ``text`` and ``spans`` ("kind:start:end,...")."""
    rows = labelled.select("text", "spans").limit(LABELLED_ROWS).collect()
    texts = [r["text"] or "" for r in rows]
    words = Words(pa.array(texts, pa.string()), hashed=False)
    if not len(words.starts):
        return Field(np.zeros((N_FEATURES, _N)), np.zeros((_N, _N)),
                     np.array([0.0] + [-1e3] * (_N - 1)))
    gold = np.zeros(len(words.starts), dtype=np.int64)
    for i, (text, row) in enumerate(zip(texts, rows)):
        for span in filter(None, (row["spans"] or "").split(",")):
            kind, a, b = span.split(":")
            a, b = (words.offsets[i] + len(text[:int(x)].encode()) for x in (a, b))
            inside = np.flatnonzero((words.starts < b) & (words.ends > a))
            single = kind in ("email", "ip")
            gold[inside] = LABELS.index(kind if single else f"I-{kind}")
            if not single:
                gold[inside[:1]] = LABELS.index(f"B-{kind}")
    heads = _sentences(words)
    shapes = _shapes(words)
    size = np.diff(np.append(heads, len(gold)))
    t_max = size.max()
    at = np.minimum(heads[:, None] + np.arange(t_max), len(gold) - 1)
    live = np.arange(t_max) < size[:, None]
    params = [np.zeros((N_FEATURES, _N)), np.zeros((_N, _N)), np.zeros(_N)]
    means = [np.zeros_like(p) for p in params]
    squares = [np.zeros_like(p) for p in params]
    onehot = np.eye(_N)[gold]
    pairs = np.zeros((_N, _N))
    for t in range(1, t_max):
        np.add.at(pairs, (gold[at[live[:, t], t - 1]], gold[at[live[:, t], t]]), 1)
    for step in range(1, steps + 1):
        marginal, moves, begin = _expected(params, shapes, at, live)
        grad_w = np.zeros_like(params[0])
        for c in range(shapes.shape[1]):
            np.add.at(grad_w, shapes[:, c], marginal - onehot)
        grads = [grad_w, moves - pairs, begin - onehot[heads].sum(axis=0)]
        for p, g, m, s in zip(params, grads, means, squares):
            g = g / len(heads) + ridge * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return Field(*params)


def _expected(params, shapes, at, live):
    """Posterior label counts: of each word, of moves, of first words."""
    weights, moves, begin = params
    scores = weights[shapes].sum(axis=1)[at]
    n, t_max = at.shape
    log = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) \
        + x.max(axis=axis)
    fore = np.zeros((n, t_max, _N))
    aft = np.zeros((n, t_max, _N))
    fore[:, 0] = scores[:, 0] + begin
    for t in range(1, t_max):
        step = log(fore[:, t - 1, :, None] + moves, 1) + scores[:, t]
        fore[:, t] = np.where(live[:, t, None], step, fore[:, t - 1])
    z = log(fore[:, -1], 1)
    for t in range(t_max - 2, -1, -1):
        step = log(moves + (scores[:, t + 1] + aft[:, t + 1])[:, None, :], 2)
        aft[:, t] = np.where(live[:, t + 1, None], step, 0)
    marginal = np.zeros((len(shapes), _N))
    each = np.exp(fore + aft - z[:, None, None])
    marginal[at[live]] = each[live]
    total = np.zeros((_N, _N))
    for t in range(1, t_max):
        on = live[:, t]
        total += np.exp(fore[on, t - 1, :, None] + moves
                        + (scores[on, t] + aft[on, t])[:, None, :] - z[on, None, None]).sum(axis=0)
    return marginal, total, each[:, 0].sum(axis=0)


# --- the small labelled table -------------------------------------------------------

# Sentence frames of the labelled table; {x} marks a filled-in item.
_FRAMES = (
    "please write to {email} soon", "mail {email} or call {phone}.", "contact: {email}",
    "my number is {phone} at home", "call me on {phone} tonight.", "{phone} is my cell",
    "fon {phone} und fax {phone}", "she paid with {card} yesterday", "card {card} was declined.",
    "numero {card} fue usado ayer", "login came from {ip} twice", "server {ip} is down.",
    "ping {ip} failed again", "l'adresse {ip} est connue", "in {number} there were {number} cases",
    "the year {number} was cold.", "version {version} came out on {date}",
    "token={secret} was leaked", "key {secret} expired", "it costs {price} each.",
    "a walk in the park, with friends", "and then the long story ended.",
    "section {version} has {number} lines", "room {number} is free", "von {number} bis {number}",
    "see page {number}, line {number}", "{date} was a monday", "l'été dernier à la mer",
    "order {secret} ships {date}.", "ratio {version} of {number}", "er ist größer als zuvor",
    'hash = "{secret}" in the file', "'{secret}' was rejected", 'api_key: "{secret}"',
    "{phone} {card} were both read aloud", "{ip} {card} {phone}", "password={secret} once",
    "the {number} items (of {number}) are here", "A. B. wrote this, too",
    "serial {serial} is on the box", "parcel {serial} left today.", "she read {serial} yesterday",
    "id {serial}, page {number}", "card {serial} was mistyped.",
)


def labelled_examples(seed: int = 7, rounds: int = 12) -> list[tuple[str, str]]:
    """``(text, spans)`` rows: the frames above, filled in ``rounds`` times each."""
    r = random.Random(seed)

    def digits(n):
        return "".join(r.choice("0123456789") for _ in range(n))

    def name():
        return "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(3, 9)))

    def email():
        host = f"{name()}{r.choice(['', r.choice('0123456789')])}.{r.choice(['com', 'org', 'de', 'co.uk'])}"
        user = name() + r.choice(["", f".{name()}", digits(2), f".{digits(2)}", f"_{digits(1)}"])
        return user + r.choice(["@", "@", "(at)", "[at]"]) + r.choice(["", "mail."]) + host

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {a} {c}{b}",
                         f"({a}){b}-{c}", f"+{digits(2)} {a} {b} {c}"])

    def card(passes=True):
        while True:
            number = digits(16)
            if _luhn(number) == passes:
                return r.choice(["", " ", "-", "."]).join(re.findall("....", number))

    makers = {
        "email": email, "phone": phone, "card": card, "serial": lambda: card(False),
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4))
        + r.choice(["", "", ":8080", "/24"]),
        "number": lambda: digits(r.choice([1, 2, 3, 4, 4, 5, 6])),
        "version": lambda: ".".join(str(r.randint(0, 20)) for _ in range(r.choice([2, 3]))),
        "date": lambda: r.choice(["{2}.{1}.20{0}", "20{0}-{1}-{2}", "{1}/{2}/20{0}"]).format(
            digits(2), f"0{r.randint(1, 9)}", f"1{r.randint(0, 9)}"),
        "secret": lambda: r.choice(["AKIA", "", "pw="]) + "".join(
            r.choice("abcdef0123456789ABCDEF") for _ in range(r.choice([12, 18, 24, 40]))),
        "price": lambda: r.choice(["$", "€"]) + digits(2) + "." + digits(2),
    }
    rows = []
    for _ in range(rounds):
        for frame in _FRAMES:
            text, spans = "", []
            for i, part in enumerate(re.split(r"\{(\w+)\}", frame)):
                if i % 2:
                    item = makers[part]()
                    if part in KINDS:
                        spans.append(f"{part}:{len(text)}:{len(text) + len(item)}")
                    part = item
                text += part
            rows.append((text, ",".join(spans)))
    return rows


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_examples(), "text string, spans string")


# --- over documents -------------------------------------------------------------------

_EDGES = ".,;:!?\"'<>[]{}"


def _field_spans(words: Words, labels: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Byte spans ``(start, kind number, end)`` of each document that has one."""
    found: dict[int, list] = {}
    hits = np.flatnonzero(labels)
    for w in hits:
        name = LABELS[labels[w]]
        kind = KINDS.index(name.removeprefix("B-").removeprefix("I-"))
        spans = found.setdefault(int(words.doc[w]), [])
        if name.startswith("I-") and spans and spans[-1][3] == w - 1 and spans[-1][1] == kind:
            spans[-1] = (spans[-1][0], kind, int(words.ends[w]), w)
        else:
            spans.append((int(words.starts[w]), kind, int(words.ends[w]), w))
    return found


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGES:
        a += 1
    while a < b and text[b - 1] in _EDGES:
        b -= 1
    return a, b


def find_spans(field: Field, column: pa.Array) -> Iterator[tuple[list, list]]:
    """For each text its base spans and all its spans, in order."""
    for a, b in parts(column, PART):
        yield from _spans_of(field, column.slice(a, b - a))


def _spans_of(field: Field, column: pa.Array) -> Iterator[tuple[list, list]]:
    words = Words(column, hashed=False)
    added: dict[int, list] = {}
    risky: set[int] = set()
    if len(words.starts):
        shapes = _shapes(words)
        added = _field_spans(words, viterbi(field, shapes, _sentences(words)))
        mask = shapes[:, 0] - _STARTS[0]
        risky = set(words.doc[(mask & (DIGIT | AT)) > 0].tolist())
    for i in range(len(column)):
        if i not in risky and i not in added:
            yield [], []
            continue
        text = column[i].as_py() or ""
        base = base_spans(text)
        spans = list(base)
        raw, offset = None, words.offsets[i]
        for a, kind, b, _ in added.get(i, ()):
            raw = raw or text.encode()
            lo = len(raw[:a - offset].decode())
            lo, hi = _trimmed(text, lo, lo + len(raw[a - offset:b - offset].decode()))
            if lo < hi and all(hi <= x or lo >= y for x, _, y in base):
                spans.append((lo, kind, hi))
        yield base, sorted(spans)


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def pii_spans(docs: DataFrame, field: Field, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id``, the base spans and all spans as text ("kind:start:end,...")."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(find_spans(field, batch.column(1)))
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in rows], pa.int64())
                      for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([_joined(b) for b, _ in rows], pa.string()),
                 pa.array([_joined(s) for _, s in rows], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                           + ", base string, spans string")


def run(spark, sf_dir) -> DataFrame:
    found = pii_spans(read(spark, sf_dir, "documents"), train(labelled_table(spark)))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS),
                        F.sha2("base", 256).alias("base_sha256"), "spans")


SQL = None
