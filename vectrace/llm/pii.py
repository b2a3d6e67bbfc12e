"""Personal data: candidate spans scored by gradient-boosted trees.

Fixed patterns give the base spans.  Beside them, generous generators propose overlapping candidates
(spelt-out e-mail addresses, ungrouped or oddly grouped numbers); features of their format and
context go through boosted trees, and those above their kind's calibrated threshold that overlap no
base span are added.  An added card passes the Luhn test, an added address has octets, an added phone
number has 9 to 15 digits.

The trees are fitted on rows labelled by the corpus itself, of all its different texts.  True rows are
base matches with their format disturbed, where they stand; false rows are candidates of the same texts
that touch no base match, look-alikes that break a kind's test put in a match's place, and look-alikes
put where no match stands.  A quarter of the texts, by their hash, calibrates the thresholds.

Features, margins and gradients are whole numbers, so sums of them do not depend on their order.  Equal
rows are counted by Spark; trees and thresholds need nothing but sums over the distinct ones, taken on
the driver for up to ``LOCAL_PATTERNS`` of them and by Spark beyond, with the same model.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectrace.llm.common import checkpoint, slices, texts

KINDS = ("email", "ip", "card", "phone")
#: Distinct labelled rows up to which the driver sums them.
LOCAL_PATTERNS = 1 << 18
#: A feature is a whole number below LEVELS; margins are in parts of UNIT, gradients of ONE.
LEVELS, UNIT, ONE = 512, 1 << 10, 1 << 20
#: Different texts that a measurement on the driver takes at most, and their length.
MEASURED_TEXTS, MEASURED_CHARS = 2000, 20_000
#: Share of true spans that a threshold must reach among the calibration rows it selects.
PRECISION = 0.99
#: True and false rows of a kind below which nothing of it is added.
LEAST_ROWS = 20

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, so the look-behind changes no result.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _octets(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in s.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at signs: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans in code points, by kind and start; matches that fail their test are dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


_GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[{] ?at ?[)\]}] ?| at )[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-]{2,24}){1,4}", re.I)),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[?\.\]? ?[0-9]{1,3}){3}(?![0-9.])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,3}[0-9]{3,6}){2,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:00 ?[0-9]{1,3}[ .-]?|\(?[0-9]{3}\)?[ .-]?)[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9])")),
    ("phone", re.compile(r"\((?:[0-9]{3})\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])0[0-9](?:[ .-]?[0-9]{2}){4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])00 ?[0-9]{2,3}(?:[ ./-]?[0-9]{2,5}){2,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])\(?0?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])")),
)
_AT_WORD = re.compile(r"at[ )\]}]", re.I)

#: Fixed words that name a kind of personal data before it.
_CUES = {
    "email": re.compile(r"\b(e-?mail|mail|write|contact|reach|courriel|correo|contacto|kontakt)\b[^.\n]{0,24}$", re.I),
    "ip": re.compile(r"\b(ip|host|server|address|client|ping|serveur|adresse|servidor)\b[^.\n]{0,24}$", re.I),
    "card": re.compile(r"\b(card|visa|mastercard|amex|credit|payment|cc|carte|karte|tarjeta)\b[^.\n]{0,24}$", re.I),
    "phone": re.compile(r"\b(call|tel|phone|mobile|cell|fax|dial|sms|telefon|handy|appel\w*|t[eé]l[eé]phone|tel[eé]fono|llam\w*)\b[^.\n]{0,24}$", re.I),
}
_OTHER = re.compile(r"\b(version|order|invoice|isbn|id|no|serial|part|ref|ticket|page|section|total)\b[^.\n]{0,16}$", re.I)
FEATURES = (
    "is_email is_ip is_card is_phone length digits separators separator_kinds luhn octets groups bracket "
    "first_group last_group cue other_cue letter_before letter_after sign_before repeats top_domain spelt colon_before"
).split()


def _valid(kind: str, s: str) -> bool:
    """What an added span must be, whatever the trees say."""
    if kind == "card":
        return 13 <= len(d := _digits(s)) <= 19 and luhn(d)
    if kind == "ip":
        return all(int(g) <= 255 for g in re.findall(r"[0-9]+", s))
    return kind != "phone" or 9 <= len(_digits(s)) <= 15


def candidates(text: str) -> list[Span]:
    """Every generator's proposals; they may overlap one another and the base spans."""
    found: list[Span] = []
    has_digit = _DIGIT.search(text) is not None
    for kind, pattern in _GENERATORS:
        if has_digit if kind != "email" else _AT_WORD.search(text):
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def features(text: str, span: Span) -> list[int]:
    """Whole numbers below LEVELS: no generator proposes more than some 270 characters."""
    kind, a, b = span
    s = text[a:b]
    digits = _digits(s)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", s) if g]
    seps = re.sub(r"[0-9A-Za-z]", "", s)
    before, after = text[max(0, a - 40) : a], text[b : b + 2]
    prior = before.rstrip()[-1:]
    most = max((digits.count(c) for c in set(digits)), default=0)
    return [
        *(int(kind == k) for k in KINDS), b - a, len(digits), len(seps), len(set(seps)),
        int(bool(digits) and luhn(digits)), int(kind == "ip" and all(int(g) <= 255 for g in groups if g.isdecimal())),
        len(groups), int("(" in s), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        int(bool(_CUES[kind].search(before))), int(bool(_OTHER.search(before))),
        int(before[-1:].isalpha()), int(after[:1].isalpha()), int(prior in "#$%=/:" and prior != ""),
        (LEVELS - 1) * most // max(1, len(digits)),
        int(kind == "email" and groups[-1].lower() in ("com", "org", "net", "edu", "de", "fr", "es", "io") if groups else False),
        int(kind == "email" and not re.search(r"[^A-Za-z0-9 ]", s)), int(prior == ":"),
    ]


@dataclass(frozen=True)
class Model:
    """Boosted regression trees of depth 3 as arrays, and each kind's threshold on the margin (in parts of UNIT)."""

    feature: np.ndarray  # trees x 7 inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x 8
    bias: int
    threshold: dict[str, float]

    def margin(self, x: np.ndarray, first: int = 0) -> np.ndarray:
        """The sum of the trees from ``first`` on, and of the bias where that is 0."""
        out = np.full(len(x), 0 if first else self.bias, dtype=np.int64)
        for f, c, leaf in zip(self.feature[first:], self.cut[first:], self.leaf[first:], strict=True):
            out += leaf[_below(x, f, c, 3) - 7]
        return out


def _below(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row reaches at a depth of a tree; a node's children are 2n + 1 and 2n + 2."""
    rows, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node


_WIDTH = len(FEATURES)
#: Of distinct labelled rows (features, then whether held out), their true and false numbers and their margins: two sums for each cell.
Sums = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Patterns:
    """Distinct labelled rows with their numbers of true and false ones, as arrays or as a table (pattern, true, false)."""

    def __init__(self, rows: DataFrame | tuple[np.ndarray, np.ndarray]):
        self.rows, self.done = rows, 0
        if not isinstance(rows, DataFrame):
            self.margin = np.zeros(len(rows[0]), dtype=np.int64)

    def _margins(self, model: Model) -> np.ndarray:
        """Of rows on the driver, what the trees that are new since the last call add to."""
        if not self.done:
            self.margin[:] = model.bias
        self.margin += replace(model, bias=0).margin(self.rows[0], self.done)
        self.done = len(model.feature)
        return self.margin

    def summed(self, sums: Sums, model: Model, cells: int) -> np.ndarray:
        """``sums`` over all patterns, cells x 2; the model may only grow from call to call."""
        if not isinstance(self.rows, DataFrame):
            return sums(*self.rows, self._margins(model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((cells, 2))
            for batch in batches:
                x, n = _arrays(batch)
                total += sums(x, n, model.margin(x))
            at = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, k].astype(np.int64)) for k in (0, 1))], ["cell", "a", "b"])

        found = self.rows.mapInArrow(run, "cell long, a long, b long").groupBy("cell").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        out = np.zeros((cells, 2))
        for r in found.collect():  # cells at most
            out[r["cell"]] = r["a"], r["b"]
        return out

    def precise(self, model: Model) -> dict[int, tuple[float, float]]:
        """By a kind's place, the least margin at and above which PRECISION of the rows held out are true, and the next one below.

        Only margins that occur are summed: their range has no bound, as a leaf's value grows with its rows.
        """
        if not isinstance(self.rows, DataFrame):
            kinds, margins, true, false = _held_out(*self.rows, self._margins(model))
            return {i: found for i in range(len(KINDS)) if (found := _least_precise(*(c[kinds == i] for c in (margins, true, false))))}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, n = _arrays(batch)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _held_out(x, n, model.margin(x))], ["kind", "margin", "true", "false"])

        counted = self.rows.mapInArrow(run, "kind long, margin long, true long, false long").groupBy("kind", "margin").agg(F.sum("true").alias("true"), F.sum("false").alias("false"))
        down = Window.partitionBy("kind").orderBy(F.desc("margin"))
        sums = counted.select("kind", "margin", F.sum("true").over(down).alias("t"), F.sum("false").over(down).alias("f"), F.lead("margin").over(down).alias("below"))
        good = sums.filter((F.col("t") >= F.lit(PRECISION) * (F.col("t") + F.col("f"))) & (F.col("margin") >= 0))
        least = good.groupBy("kind").agg(F.min("margin").alias("margin"), F.min_by("below", "margin").alias("below"))
        return {r["kind"]: (r["margin"], -np.inf if r["below"] is None else r["below"]) for r in least.collect()}  # a row a kind


def _arrays(table: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Features with whether held out, and true and false numbers, of rows (pattern, true, false)."""
    x = np.frombuffer(b"".join(table.column(0).to_pylist()), dtype=np.uint16).reshape(-1, _WIDTH + 1)
    return x, np.stack([table.column(k).to_numpy() for k in (1, 2)], axis=1)


def _totals(x: np.ndarray, n: np.ndarray, _: np.ndarray) -> np.ndarray:
    """True and false rows by held out and kind."""
    cell = x[:, _WIDTH].astype(np.int64) * len(KINDS) + x[:, : len(KINDS)].argmax(axis=1)
    return np.stack([np.bincount(cell, n[:, k], 2 * len(KINDS)) for k in (0, 1)], axis=1)


def _histograms(feature: np.ndarray, cut: np.ndarray, depth: int) -> Sums:
    """Gradients and second derivatives of the rows fitted, by node of a depth, feature and value."""

    def sums(x: np.ndarray, n: np.ndarray, margin: np.ndarray) -> np.ndarray:
        mine = x[:, _WIDTH] == 0
        x, n, margin = x[mine], n[mine], margin[mine]
        p, w = 1 / (1 + np.exp(-np.clip(margin / UNIT, -500, 500))), n.sum(axis=1)
        both = np.rint((n[:, 0] - w * p) * ONE), np.rint(w * p * (1 - p) * ONE)
        node = (_below(x, feature, cut, depth) - (2**depth - 1)) * LEVELS
        out = np.empty((2**depth, _WIDTH, LEVELS, 2))
        for j in range(_WIDTH):
            at = node + x[:, j]
            for k in (0, 1):
                out[:, j, :, k] = np.bincount(at, both[k], 2**depth * LEVELS).reshape(-1, LEVELS)
        return out.reshape(-1, 2)

    return sums


def _grow(patterns: Patterns, model: Model, shrink: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree of depth 3 by the second-order gain, over every distinct cut."""
    feature, cut, leaf = np.zeros(7, dtype=np.int64), np.full(7, np.inf), np.zeros(8, dtype=np.int64)
    for depth in range(3):
        cells = (2**depth, _WIDTH, LEVELS, 2)
        sums = patterns.summed(_histograms(feature, cut, depth), model, int(np.prod(cells[:3]))).reshape(cells) / ONE
        for i, of in enumerate(sums):
            node, (g, h) = 2**depth - 1 + i, of[0].sum(axis=0)
            best, left = 1e-6, (g, h)
            for j in range(_WIDTH):
                v = np.flatnonzero(of[j, :, 1])
                gl, hl = np.cumsum(of[j, v], axis=0)[:-1].T
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if len(gain) and gain[k := int(np.argmax(gain))] > best:
                    best, feature[node], cut[node], left = gain[k], j, (v[k] + v[k + 1]) / 2, (gl[k], hl[k])
            if depth == 2:
                for side, (a, b) in enumerate((left, (g - left[0], h - left[1]))):
                    leaf[2 * i + side] = round(shrink * UNIT * a / (b + 1))
    return feature, cut, leaf


def _held_out(x: np.ndarray, n: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows held out, the kinds and margins that occur, ascending, with their true and false numbers."""
    mine = x[:, _WIDTH] > 0
    key, at = np.unique(np.stack([x[mine, : len(KINDS)].argmax(axis=1), margin[mine]]), axis=1, return_inverse=True)
    true, false = (np.bincount(at.reshape(-1), n[mine, k], key.shape[1]).astype(np.int64) for k in (0, 1))
    return key[0], key[1], true, false


def _least_precise(margins: np.ndarray, true: np.ndarray, false: np.ndarray) -> tuple[float, float] | None:
    """Of a kind's margins, ascending: the least one, not below even odds, from which on PRECISION of the rows are true, and the one before."""
    true, false = (np.cumsum(c[::-1])[::-1] for c in (true, false))
    good = np.flatnonzero((true >= PRECISION * (true + false)) & (margins >= 0))
    return (float(margins[good[0]]), float(margins[good[0] - 1]) if good[0] else -np.inf) if len(good) else None


def _thresholds(patterns: Patterns, model: Model, enough: list[bool]) -> dict[str, float]:
    """By kind, what PRECISION asks of the margin: midway between two margins that occur, and never below even odds."""
    found = patterns.precise(model)
    return {kind: max(0.0, sum(found[i]) / 2) if some and i in found else float("inf") for i, (kind, some) in enumerate(zip(KINDS, enough, strict=True))}


def _disturbed(kind: str, s: str, rng: random.Random) -> str:
    """A base match as people write it to escape a pattern, or as another country's."""
    digits = _digits(s)
    if kind == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), (" [at] ", ".")])
        user, _, domain = s.partition("@")
        return user + at + domain.replace(".", dot)
    if kind == "ip":
        return s.replace(".", rng.choice(["[.]", " . "]))
    if kind == "card":
        return rng.choice([".", "/", "_", " - ", "  "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    a, b, c = own[:3], own[3:6], own[6:]
    pairs = [own[i : i + 2] for i in range(0, len(own), 2)]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{digits[:2]} {digits[2:5]} {digits[5:]}", " ".join(["0" + pairs[0][:1], *pairs[1:]])])


_WORD = re.compile(r"[A-Za-z]{2,12}")


def _look_alike(kind: str, text: str, rng: random.Random) -> str:
    """What a generator proposes and is none of its kind; words are those after random places of the text."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    if kind == "email":
        found = [_WORD.search(text, rng.randrange(len(text))) or _WORD.search(text) for _ in range(3)]
        a, b, c = (m[0] if m else "word" for m in found)
        return rng.choice([f"{a} at {b}.{c}", f"{a} at {b} dot {c}", f"{a} at {b} dot com"])
    if kind == "ip":
        return rng.choice([".", " . ", "[.]"]).join([str(rng.randint(256, 999)), *(str(rng.randint(0, 999)) for _ in range(3))])
    if kind == "card":
        d = n(15)
        d += next(c for c in "0123456789" if not luhn(d + c))
        return rng.choice([".", "/", "_", " - ", "", " ", "-"]).join(d[i : i + 4] for i in range(0, 16, 4))
    return rng.choice([n(10), n(9), f"{n(4)}-{n(3)}-{n(4)}", f"{n(3)} {n(7)}", f"{n(2)}.{n(3)}.{n(3)}", f"{n(3)}-{n(3)}-{n(4)}"])


Labelled = tuple[str, Span, bool]


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def labelled(text: str, seed: int = 7) -> Iterator[Labelled]:
    """Labelled candidates (text, span, true) of a text, in windows of their own context; the same for equal texts."""
    if not text:
        return
    rng = random.Random(int.from_bytes(_digest(text)) ^ seed)
    base = base_spans(text)
    apart = _disjoint(base)
    ends = [d for _, d in apart]

    def near(a: int, b: int) -> bool:
        i = bisect_left(ends, a - 1)
        return i < len(apart) and apart[i][0] < b + 2

    places = [("in", k, a, b) for k, a, b in base]
    for _ in range(4):
        at = rng.randrange(len(text) + 1)
        at = text.find(" ", at) + 1 or len(text)
        if not near(at, at):
            places.append(("out", rng.choice(KINDS), at, at))
    for where, kind, a, b in places:
        tries = [(_look_alike(kind, text, rng), False)]
        if where == "in":
            tries.append((_disturbed(kind, text[a:b], rng), True))
            if kind in ("email", "phone"):
                tries.pop(0)  # where a true one stands, such a look-alike may well be one
        before, after = text[max(0, a - 60) : a], text[b : b + 20]
        for s, true in tries:
            window = before + s + (after if where == "in" else " " + after)
            low, high = len(before), len(before) + len(s)
            for c in candidates(window):
                if c[0] == kind and c[1] < high and c[2] > low:
                    yield window, c, true and c[1] <= low and c[2] >= high and c[2] - c[1] - len(s) <= 1
    for c in candidates(text):
        if not near(c[1], c[2]):
            window = text[max(0, c[1] - 60) : c[2] + 20]
            shift = max(0, c[1] - 60)
            yield window, (c[0], c[1] - shift, c[2] - shift), False


def _rows(text: str, seed: int = 7) -> np.ndarray:
    """Features of a text's labelled candidates, whether it is held out, and the label."""
    held = _digest(text)[0] % 4 == 0
    rows = [(*features(t, span), held, true) for t, span, true in labelled(text, seed) if not true or _valid(span[0], t[span[1] : span[2]])]
    return np.array(rows, dtype=np.uint16).reshape(-1, _WIDTH + 2)


def _counted(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows without their label, and the numbers of true and of false ones."""
    every = np.concatenate([np.zeros((0, _WIDTH + 2), dtype=np.uint16), *rows])
    x, at = np.unique(every[:, :-1], axis=0, return_inverse=True)
    return x, np.stack([np.bincount(at.reshape(-1), every[:, -1] == label, len(x)) for label in (1, 0)], axis=1).astype(np.int64)


def patterns_of(df: DataFrame, text_col: str = "text", seed: int = 7) -> Patterns:
    """The labelled rows of every different text of ``df``, equal ones counted; nulls have none."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            made = [(_digest(t), rows.tobytes()) for t in texts(part.column(0)) if len(rows := _rows(t, seed))]
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.binary()) for k in (0, 1)], ["id", "rows"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            x, n = _counted([np.frombuffer(r, dtype=np.uint16).reshape(-1, _WIDTH + 2) for r in part.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), *(pa.array(n[:, k]) for k in (0, 1))], ["pattern", "true", "false"])

    # Equal texts have equal rows, so any copy's will do.
    different = df.select(text_col).mapInArrow(label, "id binary, rows binary").dropDuplicates(["id"]).select("rows")
    counted = different.mapInArrow(count, "pattern binary, true long, false long")
    found = checkpoint(counted.groupBy("pattern").agg(F.sum("true").alias("true"), F.sum("false").alias("false")))
    return Patterns(found if found.count() > LOCAL_PATTERNS else _arrays(found.toArrow()))


def training_sample(df: DataFrame, text_col: str = "text") -> list[str]:
    """Texts to measure a model with on the driver: of those with a digit or an at sign, the ones with the least hashes."""
    mine = F.col(text_col).rlike("[0-9@]") & (F.length(text_col) <= MEASURED_CHARS)
    hashed = df.filter(mine).select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    least = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(MEASURED_TEXTS).collect()]
    if not least:
        return []
    found = hashed.filter(F.col("hash") <= least[-1]).groupBy("hash").agg(F.min("text").alias("text")).collect()  # MEASURED_TEXTS at most
    return [r["text"] for r in sorted(found, key=lambda r: r["hash"])]


def fit(corpus: DataFrame | list[str], trees: int = 40, seed: int = 7, text_col: str = "text") -> Model:
    """Trees by Newton boosting of the logistic loss, on all texts; thresholds from the texts held out.

    With fewer than ``LEAST_ROWS`` true or false rows of a kind, fitted or held out, none of it is added.
    """
    if isinstance(corpus, DataFrame):
        patterns = patterns_of(corpus, text_col, seed)
    else:
        patterns = Patterns(_counted([_rows(t, seed) for t in dict.fromkeys(corpus)]))
    model = Model(np.zeros((0, 7), dtype=np.int64), np.zeros((0, 7)), np.zeros((0, 8), dtype=np.int64), 0, {kind: float("inf") for kind in KINDS})
    totals = patterns.summed(_totals, model, 2 * len(KINDS)).reshape(2, len(KINDS), 2)
    enough = (totals >= LEAST_ROWS).all(axis=(0, 2)).tolist()
    if not any(enough):
        return model
    true, false = totals[0].sum(axis=0)
    model = replace(model, bias=round(UNIT * float(np.log(true / false))))
    for _ in range(trees):
        feature, cut, leaf = _grow(patterns, model, 0.3)
        model = replace(model, feature=np.vstack([model.feature, feature]), cut=np.vstack([model.cut, cut]), leaf=np.vstack([model.leaf, leaf]))
    return replace(model, threshold=_thresholds(patterns, model, enough))


def measured(model: Model, sample: list[str], seed: int = 19) -> dict[str, tuple[float, float, int]]:
    """By kind, the precision and recall of the model on labelled candidates of texts, and the number of true ones."""
    rows = np.concatenate([np.zeros((0, _WIDTH + 2), dtype=np.uint16), *(_rows(t, seed) for t in sample)])
    x, y = rows[:, :_WIDTH], rows[:, -1]
    margin, out = model.margin(x), {}
    for i, kind in enumerate(KINDS):
        mine = x[:, i] > 0
        taken = margin[mine] >= model.threshold[kind]
        hit = float((taken & (y[mine] > 0)).sum())
        out[kind] = (hit / max(1, taken.sum()), hit / max(1.0, y[mine].sum()), int(y[mine].sum()))
    return out


def _disjoint(found: list[Span]) -> list[tuple[int, int]]:
    """The places of the spans, ascending, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for _, a, b in sorted(found, key=lambda s: s[1]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind and start; an added span overlaps no other span."""
    base = base_spans(text)
    proposed = [c for c in candidates(text) if model.threshold[c[0]] < float("inf") and _valid(c[0], text[c[1] : c[2]])]
    if not proposed:
        return base, base
    margin = model.margin(np.array([features(text, s) for s in proposed]))
    taken, added = _disjoint(base), []
    for m, (kind, a, b) in sorted(zip((-margin).tolist(), proposed, strict=True)):
        if -m < model.threshold[kind]:
            continue
        at = bisect_left(taken, (b, b))
        if not at or taken[at - 1][1] <= a:
            insort(taken, (a, b))
            added.append((kind, a, b))
    return base, sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _written(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redacted(text: str, found: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def detect(df: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row; rows are never merged.

    The counts and base_sha256 are of the base spans, ``spans`` lists all.  Null and empty texts have none.
    Without a model, one is fitted on all of ``df``'s own texts.
    """
    model = model or fit(df, text_col=text_col)
    kind = dict(df.dtypes)[id_col]
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            found = [spans(t, model) for t in texts(part.column(1))]
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(_written(b).encode()).hexdigest() for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *counts, pa.array(digest, pa.string()), pa.array([_written(a) for _, a in found], pa.string())], names
            )

    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def redact(df: DataFrame, model: Model | None = None, text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced; all columns kept, a null text stays null, no row is dropped.

    Without a model, one is fitted on all of ``df``'s own texts.
    """
    model = model or fit(df, text_col=text_col)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            clean = [None if t is None else redacted(t, spans(t, model)[1]) for t in part.column(at).to_pylist()]
            cols = list(part.columns)
            cols[at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(cols, part.schema.names)

    return df.select([F.col(f"`{c}`") for c in df.columns]).mapInArrow(run, df.schema)
