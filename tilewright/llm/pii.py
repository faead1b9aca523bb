"""Personal data in texts: fixed patterns, and a linear-chain conditional random
field that finds what they miss.

The field tags tokens with the beginning or the inside of a kind, or with nothing.
Its features are the shapes of a token and its neighbours, learnt from a small
labelled table. Tokens that are further than ``REACH`` from any hot one (a digit,
"@", "+", a "dot" or its like) can only be tagged with nothing. A token with one
tag to choose from cuts the chain, so decoding the stretches between such tokens
gives the best tagging of the whole text, and plain prose costs one regular
expression. Stretches are decoded side by side in numpy, by Viterbi.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pii_examples import EXAMPLES
from .shared import slices, written_slim

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
#: Rows of the labelled table that are learnt from, by a hash of their text.
MOST_EXAMPLES = 5000
#: How far from a hot token a span may reach, in tokens.
REACH = 6
TAGS = 1 + 2 * len(KINDS)
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"

# --- fixed patterns

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(text: str) -> bool:
    """Whether the digits of a text pass the check of card numbers."""
    digits = [ord(c) - 48 for c in reversed(text) if "0" <= c <= "9"]
    return not (sum(digits[::2]) + sum(2 * d - 9 * (d > 4) for d in digits[1::2])) % 10


def n_digits(text: str) -> int:
    return sum("0" <= c <= "9" for c in text)


def _emails(text: str) -> Iterator[Span]:
    """An email runs from the first letter that its name can have before an "@". Each
    "@" is looked at once, so the time is linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        name = text[done:at]
        start = done + len(name.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, 0, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    """In a chain of numbers with dots between them, every four are one candidate."""
    for chain in _CHAIN.finditer(text):
        if chain.group().count(".") < 3:
            continue
        numbers = list(_DIGITS.finditer(text, *chain.span()))
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            if all(_small(n.group()) for n in four):
                yield four[0].start(), 1, four[3].end()


def _small(number: str) -> bool:
    return len(number.lstrip("0")) <= 3 and int(number[-4:]) <= 255


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find: of each kind the leftmost matches that do not
    overlap, without those that fail the kind's check."""
    found = [*_emails(text)] if "@" in text else []
    found += _ips(text)
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= n_digits(m.group()) <= 19 and luhn(m.group())]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= n_digits(m.group()) <= 15]
    return sorted(found)


# --- stretches of tokens that the field looks at

_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|[^\w\s]|_")
_HOT = re.compile(r"[0-9@+]|(?i:\bdot\b|[\[({<]\s?(?:at|dot|punkt|punto|point)\s?[\])}>])")


def _before(text: str, lo: int, at: int, n: int) -> int:
    """Where the nth token before a place begins, not before ``lo``."""
    room = 64
    while True:
        start = max(lo, at - room)
        begins = [m.start() for m in _TOKEN.finditer(text, start, at)]
        # the first token of the window may be the rest of one that begins before it
        whole = begins if start == lo else begins[1:]
        if start == lo or len(whole) >= n:
            return whole[-n] if len(whole) >= n else whole[0] if whole else at
        room *= 4


def stretches(text: str) -> Iterator[tuple[list[str], list[int], list[bool]]]:
    """(tokens, their places, whether a tag is open to each) around the hot tokens of
    a text. Between two stretches lie only tokens that no span can reach."""
    hot = _HOT.search(text)
    end = 0
    while hot:
        tokens, places, heat = [], [], []
        last = -1
        for m in _TOKEN.finditer(text, _before(text, end, hot.start(), REACH + 2)):
            while hot and hot.end() <= m.start():
                hot = _HOT.search(text, m.start())
            tokens.append(m.group())
            places.append(m.start())
            heat.append(bool(hot) and m.start() < hot.end() and hot.start() < m.end())
            last = len(tokens) - 1 if heat[-1] else last
            if len(tokens) - 1 - last > 2 * REACH + 2 and last >= 0:
                break
        # the next hot token may be within reach of what comes after the last open one
        keep = last + REACH + 3
        tokens, places, heat = tokens[:keep], places[:keep], heat[:keep]
        far = min(last + REACH, len(tokens) - 1)
        end = places[far] + len(tokens[far])
        near = np.convolve(heat, np.ones(2 * REACH + 1))[REACH : REACH + len(heat)] > 0
        yield tokens, places, near.tolist()
        hot = _HOT.search(text, end)


@lru_cache(maxsize=50_000)
def _shape(token: str) -> str:
    if "0" <= token[0] <= "9":
        return f"d{len(token) if len(token) < 5 else 5 if len(token) < 9 else 9 if len(token) < 12 else 12}"
    if token[0].isalpha():
        return ("u" if token.isupper() else "t" if token[0].isupper() else "l") + str(min(len(token), 4))
    return token


_GAP = {" ", "-", ".", "/", "_", "(", ")"}


def _numbers(text: str, tokens: list[str], places: list[int]) -> list[str]:
    """For every token, what the run of numbers that it stands in looks like: how many
    digits, and whether they pass the check of card numbers."""
    out = [""] * len(tokens)
    k = 0
    while k < len(tokens):
        if not "0" <= tokens[k][0] <= "9":
            k += 1
            continue
        j = k
        while j + 1 < len(tokens) and (tokens[j + 1] in _GAP or "0" <= tokens[j + 1][0] <= "9") and places[j + 1] - places[j] - len(tokens[j]) <= 1:
            j += 1
        while not "0" <= tokens[j][0] <= "9":
            j -= 1
        run = "".join(t for t in tokens[k : j + 1] if "0" <= t[0] <= "9")
        n = len(run)
        kind = f"n{n if n < 12 else 12 if n < 20 else 20}"
        if 12 <= n < 20:
            kind += "+" if luhn(run) else "-"
        elif any(t == "0" or t.startswith("00") for t in tokens[k : k + 1]):
            kind += "o"
        out[k : j + 1] = [kind] * (j + 1 - k)
        k = j + 1
    return out


def features(text: str, tokens: list[str], places: list[int], words: frozenset[str]) -> list[list[str]]:
    """The features of each token: shapes up to two places away, pairs of them, gaps,
    short words that the labelled table has, and runs of numbers."""
    n = len(tokens)
    glued = [k > 0 and places[k] == places[k - 1] + len(tokens[k - 1]) for k in range(n)]
    low = [t.lower() for t in tokens]
    base = [w if w in words else _shape(t) for t, w in zip(tokens, low, strict=True)]
    at = ["^", "^", *[b + ("~" if g else "") for b, g in zip(base, glued, strict=True)], "$", "$"]
    runs = _numbers(text, tokens, places)
    out = []
    for k in range(n):
        a, b, c, d, e = at[k : k + 5]
        out.append([f"0{c}", f"1{b}", f"2{d}", f"3{a}", f"4{e}", f"5{b} {c}", f"6{c} {d}", f"7{a} {b} {c}", f"8{c} {d} {e}", f"9{runs[k]}", f"r{runs[k]} {c}"])
    return out


# --- the field


def decode(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The best tags of sequences side by side, by Viterbi. emissions: (sequences,
    steps, tags), padded; transitions: (tags, tags). Ties go to the lesser tag."""
    n, steps, tags = emissions.shape
    score = emissions[:, 0].copy()
    back = np.zeros((steps, n, tags), np.int8)
    for t in range(1, steps):
        ways = score[:, :, None] + transitions[None]
        back[t] = ways.argmax(1)
        moved = ways.max(1) + emissions[:, t]
        going = lengths > t
        score[going] = moved[going]
    out = np.zeros((n, steps), np.int64)
    rows = np.arange(n)
    tag = score.argmax(1)
    for t in range(steps - 1, -1, -1):
        inside = lengths > t
        out[inside, t] = tag[inside]
        before = back[t, rows, tag]
        tag = np.where(inside & (t > 0), before, tag)
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large negative number: an inside tag
    follows only its own kind. Tag 0 is nothing, 2k + 1 begins kind k, 2k + 2 goes on."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 * k + 2] = -1e4
        out[2 * k + 1, 2 * k + 2] = out[2 * k + 2, 2 * k + 2] = 0
    return out


#: No sequence begins with an inside tag.
_START = np.array([0.0] + [0.0, -1e4] * len(KINDS))


class Field:
    """A linear-chain conditional random field over string features."""

    def __init__(self, words: frozenset[str], index: dict[str, int], weights: np.ndarray, transitions: np.ndarray):
        self.words, self.index, self.weights, self.transitions = words, index, weights, transitions

    @classmethod
    def fit(cls, lines: Iterable[str], passes: int = 150, rate: float = 0.25, decay: float = 0.02) -> Field:
        """Learns from lines with spans between tags, such as "<ip>10.0.0.1</ip>", by
        gradient ascent on the likelihood with decaying weights. Deterministic."""
        texts = [untagged(line) for line in lines]
        cut = [(text, spans, tokens, places) for text, spans in texts for tokens, places, _ in stretches(text)]
        seen = Counter(t.lower() for text, _, tokens, _ in cut for t in tokens if t.isalpha() and len(t) <= 5)
        words = frozenset(w for w, n in seen.items() if n >= 3)
        made = [features(text, tokens, places, words) for text, _, tokens, places in cut]
        index: dict[str, int] = {}
        for f in (f for line in made for token in line for f in token):
            index.setdefault(f, len(index))
        gold = [_tags(spans, tokens, places) for _, spans, tokens, places in cut]
        field = cls(words, index, np.zeros((len(index), TAGS)), np.zeros((TAGS, TAGS)))
        if gold:
            field._climb([np.array([[index[f] for f in token] for token in line]) for line in made], gold, passes, rate, decay)
        return field

    def _climb(self, made: list[np.ndarray], gold: list[np.ndarray], passes: int, rate: float, decay: float) -> None:
        n, steps, wide = len(made), max(map(len, made)), made[0].shape[1]
        lengths = np.array([len(g) for g in gold])
        ids, y = np.zeros((n, steps, wide), np.int64), np.zeros((n, steps), np.int64)
        for k, (f, g) in enumerate(zip(made, gold, strict=True)):
            ids[k, : len(g)], y[k, : len(g)] = f, g
        real = np.arange(steps)[None, :] < lengths[:, None]
        flat = ids[real]
        # what the labelled table has of each feature and step
        has, steps_has = np.zeros_like(self.weights), np.zeros_like(self.transitions)
        np.add.at(has, (flat.ravel(), np.repeat(y[real], wide)), 1)
        both = real[:, 1:]
        np.add.at(steps_has, (y[:, :-1][both], y[:, 1:][both]), 1)
        forbidden = allowed()
        squares = [np.full_like(self.weights, 1e-8), np.full_like(self.transitions, 1e-8)]
        for _ in range(passes):
            e = self.weights[ids].sum(2)
            e[:, 0] += _START
            m = self.transitions + forbidden
            ahead, behind = np.zeros((2, n, steps, TAGS))
            ahead[:, 0] = e[:, 0]
            for t in range(1, steps):
                step = _lse(ahead[:, t - 1, :, None] + m[None], 1) + e[:, t]
                ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
            for t in range(steps - 2, -1, -1):
                step = _lse(m[None] + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where(real[:, t + 1, None], step, 0)
            total = _lse(ahead[:, -1], 1)
            tag = np.exp(ahead + behind - total[:, None, None])[real]
            expects = np.zeros_like(self.weights)
            np.add.at(expects, flat.ravel(), np.repeat(tag, wide, axis=0))
            pair = np.exp(ahead[:, :-1, :, None] + m[None, None] + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None])
            steps_expects = pair[both].sum(0)
            for w, g, s in ((self.weights, has - expects - decay * self.weights, squares[0]), (self.transitions, steps_has - steps_expects - decay * self.transitions, squares[1])):
                s += g * g
                w += rate * g / np.sqrt(s)

    def emissions(self, text: str, tokens: list[str], places: list[int], free: list[bool]) -> np.ndarray:
        made = features(text, tokens, places, self.words)
        out = np.zeros((len(tokens), TAGS))
        for k, token in enumerate(made):
            if free[k]:
                ids = [i for f in token if (i := self.index.get(f)) is not None]
                out[k] = self.weights[ids].sum(0)
            else:
                out[k, 1:] = -1e6
        out[0] += _START
        return out

    def tag(self, texts: list[str], most: int = 1 << 16) -> list[list[Span]]:
        """Spans of each text. At most about ``most`` padded tokens are decoded at a
        time, in order of their length."""
        found: list[list[Span]] = [[] for _ in texts]
        held: list[tuple] = []
        size = 0
        for k, text in enumerate(texts):
            for tokens, places, free in stretches(text):
                held.append((k, tokens, places, self.emissions(text, tokens, places, free)))
                size += len(tokens)
                if size >= most:
                    self._settle(held, found, most)
                    held, size = [], 0
        self._settle(held, found, most)
        return found

    def _settle(self, held: list[tuple], found: list[list[Span]], most: int) -> None:
        held.sort(key=lambda h: len(h[1]))
        matrix = self.transitions + allowed()
        at = 0
        while at < len(held):
            to = at + 1
            while to < len(held) and len(held[to][1]) * (to + 1 - at) <= most:
                to += 1
            group = held[at:to]
            lengths = np.array([len(h[1]) for h in group])
            e = np.zeros((len(group), lengths[-1], TAGS))
            for row, h in zip(e, group, strict=True):
                row[: len(h[1])] = h[3]
            for (k, tokens, places, _), tags in zip(group, decode(e, lengths, matrix), strict=True):
                found[k] += _spans(tags, tokens, places)
            at = to


def _tags(spans: list[Span], tokens: list[str], places: list[int]) -> np.ndarray:
    out = np.zeros(len(tokens), np.int64)
    for start, kind, end in spans:
        at = [k for k, p in enumerate(places) if start <= p < end]
        out[at] = 2 * kind + 2
        out[at[:1]] = 2 * kind + 1
    return out


def _spans(tags: np.ndarray, tokens: list[str], places: list[int]) -> Iterator[Span]:
    """The spans of a tagging: each begins at a beginning and goes on as long as its
    kind does."""
    k = 0
    while k < len(tokens):
        if tags[k] % 2:
            j = k
            while j + 1 < len(tokens) and tags[j + 1] == tags[k] + 1:
                j += 1
            yield places[k], int(tags[k]) // 2, places[j] + len(tokens[j])
            k = j
        k += 1


_MARK = re.compile(r"<(/?)(" + "|".join(KINDS) + ")>")


def untagged(line: str) -> tuple[str, list[Span]]:
    """A line of the labelled table as its text and its spans."""
    text, spans, at, start = "", [], 0, 0
    for m in _MARK.finditer(line):
        text += line[at : m.start()]
        at = m.end()
        if m.group(1):
            spans.append((start, KINDS.index(m.group(2)), len(text)))
        else:
            start = len(text)
    return text + line[at:], spans


_DOTS = re.compile(r"(?i)\.|\b(?:dot|punkt|punto|point)\b")


def sound(text: str, span: Span) -> bool:
    """Whether a span can be of its kind: the checks of the fixed patterns, and for
    an email a dot, in letters or not, and a name on either side."""
    start, kind, end = span
    part = text[start:end]
    if kind == 0:
        return bool(_DOTS.search(part)) and len(re.findall(r"\w+", part)) >= 3
    numbers = _DIGITS.findall(part)
    if kind == 1:
        return len(numbers) == 4 and all(map(_small, numbers))
    n = sum(map(len, numbers))
    return 12 <= n <= 19 and luhn(part) if kind == 2 else 9 <= n <= 15


def all_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, whether a fixed pattern found it) of each text, in order of
    start, then kind. The field adds spans that touch none of the fixed ones."""
    out = []
    for text, tagged in zip(texts, field.tag(texts), strict=True):
        base = base_spans(text)
        taken = sorted((s, e) for s, _, e in base)
        more, k, reach = [], 0, 0
        for span in sorted(tagged):
            while k < len(taken) and taken[k][0] < span[2]:
                reach = max(reach, taken[k][1])
                k += 1
            if reach <= span[0] and sound(text, span):
                more.append(span)
        out.append(sorted([(*s, True) for s in base] + [(*s, False) for s in more]))
    return out


def _bounded(labelled: DataFrame) -> list[str]:
    """At most MOST_EXAMPLES different lines of a labelled table (line), in order."""
    fine = labelled.select(F.col("line").cast("string").alias("line")).where("line is not null").distinct()
    return sorted(r.line for r in fine.orderBy(F.xxhash64("line"), "line").limit(MOST_EXAMPLES).collect())


def find_personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, and spans, an array of
    kind (email, ip, card, phone), start, end (code points, end exclusive) and base
    (a fixed pattern found it), in order of start, then kind.

    labelled (line): lines with spans between tags, such as "<ip>10.0.0.1</ip>"; the
    field learns from at most MOST_EXAMPLES different ones. None: the examples of
    this package. Without any line the field adds nothing. Fixed patterns always
    hold; the field adds spans that overlap none of theirs and pass the checks of
    their kind. Null and empty texts have no spans; rows that repeat, or have a null
    doc_id, each have their own. Other columns are ignored. Texts are read where
    they are, in small batches, and nothing is shuffled.
    """
    field = Field.fit(EXAMPLES if labelled is None else _bounded(labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in slices(batches):
            found = all_spans([t or "" for t in batch.column(1).to_pylist()], field)
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return written_slim(slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, spans {SPANS}"), "personal-data")
