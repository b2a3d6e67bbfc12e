"""Language-model scoring with a hierarchical Pitman-Yor model of words.

Tokens are words (A-Z lower-cased) and one end per text.  Every preceding word, and the text's start,
has a restaurant that seats the words following it; each of its tables is a customer of the root,
whose own base is uniform over the known words and one unknown.  All contexts, pairs and words count,
at every size.

The corpus is cut into *units* of some 2 million tokens.  A unit sends its distinct pairs to buckets
dealt by context and its distinct words to buckets dealt by word, as packed arrays: one row for each
unit and bucket, never one for a token.

1. *Counts.*  A context bucket merges the pairs of all units and keeps, for each unit, where its pairs
   went; a word bucket does the same for words.
2. *Seating.*  Root probabilities follow from how many tables a word has sent up; context buckets sweep
   over their restaurants by Gibbs sampling and send tables up again (``ROUNDS`` times).  Tables of a
   dish with few customers are drawn from their exact conditional by generalised Stirling numbers; of
   one with many, a whole seating is proposed and accepted by Metropolis-Hastings.
3. *Scores.*  Buckets answer the units: of each pair its own share, averaged over the kept samples, of
   each word its count, its root probability and its restaurant's back-off.  A unit's texts are read
   again and summed.

Within a round the root stands still, and a quarter of a restaurant's dishes is drawn at a time, so
this is a blocked Gibbs sampler that approaches the sequential one.  A context with a large share of all
tokens has its restaurant dealt in shards by word; a shard takes its tables times the number of shards
for the whole restaurant's.  Words are told apart by 62 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrace.llm import scan
from vectrace.llm.blobs import ROWS, Held, Row, Store, batch_of, by_key, by_unit, cut, distinct, pack, press, same_cuts, unpack, unpress
from vectrace.llm.scan import mix

CONCENTRATION = 1.0
#: Sweeps of a round that only sends tables up, sweeps before the first kept sample, and kept samples.
SENDING, BURN_IN, SAMPLES = 4, 4, 4
#: Seatings of the root; all restaurants are swept after each.
ROUNDS = 2
#: Tokens of a unit (one text more at most) and, about, of a bucket.
UNIT_TOKENS, BUCKET_TOKENS = 3 << 19, 1 << 21
#: Contexts of at least this share of all tokens may be split.
HOT_SHARE = 1 << 16
#: Dishes of up to so many customers are drawn from their exact conditional.
EXACT_CUSTOMERS = 24
#: Parts of a restaurant's dishes that are drawn one after the other.
PARTS = 4
#: Words that stand for all words of one class of customer counts in the root.
REPLICAS = 64
#: Counts up to here keep a class of their own in the root; above, a class is at most 1/1024 of the count.
EXACT_COUNTS = 4096
#: Codes of the end token and of the context of a text's first token; words have none of these.
END, START = 1, 0
_LOW = np.uint64(0xFFFFFFFF)

#: Kinds of rows.
_SENT, _PAIRS, _CODES, _WORDS, _COUNTS, _PLACES, _ASKED, _TABLES, _CLASS, _ROOTS, _SHARES, _ROOMS, _VALUES, _UNIT = range(14)


def held_out(doc_id: Column) -> Column:
    """Texts the model does not learn from: crc32 of the id as text leaves 1 by 5; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def count_class(count: np.ndarray) -> np.ndarray:
    """The upper end of a count's class."""
    step = 1 << np.maximum(np.frexp(np.maximum(count, 1).astype(np.float64))[1] - 11, 0)
    return np.where(count <= EXACT_COUNTS, count, -(-count // step) * step)


# --- seating -------------------------------------------------------------------------------------


def stirling(size: int, discount: float) -> np.ndarray:
    """Generalised Stirling numbers: weight of all seatings of n customers at t tables, at [n, t]."""
    out = np.zeros((size + 1, size + 1))
    out[0, 0] = 1.0
    for n in range(size):
        t = np.arange(1, n + 2)
        out[n + 1, 1 : n + 2] = out[n, : n + 1] + np.maximum(n - discount * t, 0.0) * out[n, 1 : n + 2]
    return out


class Seats:
    """Tables of dishes, each of at least two customers of one restaurant; sweeps given what else stands there."""

    def __init__(self, room: np.ndarray, customers: np.ndarray, rooms: int, discount: float, rng: np.random.Generator):
        self.room, self.customers, self.rooms, self.discount, self.rng = room, customers, rooms, discount, rng
        self.tables = np.ones(len(room))
        order = np.argsort(room, kind="stable")
        first = np.zeros(rooms + 1, dtype=np.int64)
        np.cumsum(np.bincount(room, minlength=rooms), out=first[1:])
        part = np.empty(len(room), dtype=np.int64)
        part[order] = (np.arange(len(room)) - first[room[order]]) % PARTS
        self.log_stirling = np.log(np.maximum(stirling(EXACT_CUSTOMERS, discount), 1e-300))
        size = np.minimum(customers, EXACT_CUSTOMERS + 1)
        order = np.lexsort((size, part))
        edges = np.flatnonzero(np.diff(part[order] * 1000 + size[order], prepend=-1))
        parts: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(PARTS)]
        for a, b in zip(edges.tolist(), np.append(edges, len(order))[1:].tolist(), strict=True):
            parts[part[order[a]]].append((int(size[order[a]]), order[a:b]))
        self.parts = parts
        self.paths: dict[int, np.ndarray] = {}

    def sweep(self, root: np.ndarray, fixed: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Draw all tables anew, given root probabilities and further tables by room; the rooms' tables after it.

        ``scale`` is what the tables here are multiplied with to give those of the whole restaurant.
        """
        total = fixed + np.bincount(self.room, self.tables, self.rooms)
        for number, groups in enumerate(self.parts):
            for size, at in groups:
                others = total[self.room[at]] * scale[self.room[at]] - self.tables[at]
                if size <= EXACT_CUSTOMERS:
                    self.tables[at] = self._few(size, root[at], others)
                else:
                    self.tables[at] = self._many(number, at, root[at], others)
            total = fixed + np.bincount(self.room, self.tables, self.rooms)
        return total

    def _few(self, n: int, root: np.ndarray, others: np.ndarray) -> np.ndarray:
        d, theta = self.discount, CONCENTRATION
        if n == 2:
            odds = (theta + d * (others + 1)) * root / (1 - d)
            return 1.0 + (self.rng.random(len(root)) * (1 + odds) < odds)
        more = np.log((theta + d * (others[:, None] + np.arange(1, n))) * root[:, None])
        weight = np.concatenate((np.zeros((len(root), 1)), np.cumsum(more, axis=1)), axis=1) + self.log_stirling[n, 1 : n + 1]
        weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        return 1.0 + (self.rng.random((len(root), 1)) * weight[:, -1:] >= weight).sum(axis=1)

    def _many(self, part: int, at: np.ndarray, root: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Customers sit down in turn, in blocks of an eighth once there are 16.

        Such a seating is drawn with its weight over the weights passed over; the test holds those of the
        new path against those of the old one, both under what stands there now.
        """
        order = np.argsort(-self.customers[at], kind="stable")
        n, root, others = self.customers[at][order], root[order], others[order]
        d, theta = self.discount, CONCENTRATION
        old = self.paths.get(part)
        t, log, before, path, i = np.ones(len(n)), np.zeros(len(n)), np.zeros(len(n)), [], 1
        while i < n[0]:
            active = int(np.searchsorted(-n, -i, side="left"))
            size = np.minimum(max(1, i // 8) if i >= 16 else 1, n[:active] - i)
            new = (theta + d * (others[:active] + t[:active])) * root[:active]
            weight = np.maximum(i - d * t[:active], 0.0) + new
            log[:active] += size * np.log(weight)
            path.append(t.astype(np.int32))
            if old is not None:
                then = old[len(path) - 1][:active]
                before[:active] += size * np.log(np.maximum(i - d * then, 0.0) + (theta + d * (others[:active] + then)) * root[:active])
            t[:active] += self.rng.binomial(size, np.minimum(1.0, new / weight))
            i += max(1, i // 8) if i >= 16 else 1
        path.append(t.astype(np.int32))
        if old is not None:
            stay = np.log(self.rng.random(len(n)) + 1e-300) >= log - before
            path = [np.where(stay, b, a) for a, b in zip(path, old, strict=True)]
        self.paths[part] = np.stack(path)
        out = np.empty(len(n))
        out[order] = path[-1]
        return out


def restaurants(
    room: np.ndarray, customers: np.ndarray, root: np.ndarray, fixed: np.ndarray, scale: np.ndarray, discount: float,
    rng: np.random.Generator, burn_in: int, samples: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sweeps given the root: mean tables of each dish, mean tables of each room with ``fixed``, last tables of each dish."""
    seats = Seats(room, customers, len(fixed), discount, rng)
    mean, total = np.zeros(len(room)), np.zeros(len(fixed))
    for turn in range(burn_in + samples):
        now = seats.sweep(root, fixed, scale)
        if turn >= burn_in:
            mean += seats.tables / samples
            total += now / samples
    return mean, total, seats.tables


@dataclass
class Root:
    """Root probability by class of customer counts; the first class, 0, is the unknown word."""

    classes: np.ndarray
    chance: np.ndarray

    def of(self, customers: np.ndarray) -> np.ndarray:
        return self.chance[np.searchsorted(self.classes, count_class(customers))]


def seat_root(classes: list[tuple[int, int]], types: int, discount: float, seed: int) -> Root:
    """The root's restaurant from (class of customer counts, number of words): all words of a class by replicas."""
    rng = np.random.default_rng([17, seed])
    count = np.array([c for c, _ in classes if c > 0], dtype=np.int64)
    words = np.array([k for c, k in classes if c > 0], dtype=np.float64)
    copies = np.minimum(words, REPLICAS).astype(np.int64)
    customers, share = np.repeat(count, copies), np.repeat(words / copies, copies)
    base, total = 1.0 / (types + 1), CONCENTRATION + float((count * words).sum())
    tables, kept, opened = np.ones(len(customers)), np.zeros(len(customers)), 0.0
    seats = Seats(np.zeros(int((customers > 1).sum()), dtype=np.int64), customers[customers > 1], 1, discount, rng)
    many = customers > 1
    for turn in range(BURN_IN + SAMPLES):
        if many.any():
            # One replica is moved at a time, as it were: the others' tables are those of all words.
            others = float((tables * share).sum())
            seats.sweep(np.full(int(many.sum()), base), np.array([others - tables[many].sum()]), np.ones(1))
            tables[many] = seats.tables
        if turn >= BURN_IN:
            kept += tables / SAMPLES
            opened += float((tables * share).sum()) / SAMPLES
    floor = (CONCENTRATION + discount * opened) / total * base
    mean = np.bincount(np.repeat(np.arange(len(count)), copies), kept, len(count)) / np.maximum(copies, 1)
    return Root(np.concatenate(([0], count)), np.concatenate(([floor], (count - discount * mean) / total + floor)))


# --- units ---------------------------------------------------------------------------------------


def _coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all tokens of the texts, and how many each text has."""
    found = scan.words(column)
    sizes = found.count + 1
    ends = np.cumsum(sizes) - 1
    flat = np.full(int(sizes.sum()), END, dtype=np.uint64)
    inner = np.ones(len(flat), dtype=bool)
    inner[ends] = False
    flat[inner] = (found.hash >> np.uint64(1)) | np.uint64(2)
    return flat, sizes


@dataclass
class Unit:
    """Texts of a unit; its words, pairs and rooms ascending by code, pairs by room and word."""

    origin: int
    ids: list[pa.Array]
    held: np.ndarray
    sizes: np.ndarray
    word: np.ndarray  # codes, START first
    word_n: np.ndarray  # training counts
    token: np.ndarray  # pair of each token
    pair_word: np.ndarray  # place in word
    pair_n: np.ndarray  # training counts
    room: np.ndarray  # codes
    room_pairs: np.ndarray  # pairs of each
    room_context: np.ndarray  # place in word
    room_scale: np.ndarray  # shards that the context is dealt to

    def cut_pairs(self, buckets: int) -> Iterator[tuple[int, slice, slice]]:
        """(bucket, its rooms, its pairs)."""
        ends = np.concatenate(([0], np.cumsum(self.room_pairs)))
        for bucket, a, b in cut(self.room, buckets):
            yield bucket, slice(a, b), slice(int(ends[a]), int(ends[b]))


def _unit(origin: int, ids: list[pa.Array], held: np.ndarray, flat: np.ndarray, sizes: np.ndarray, hot: dict[int, int]) -> Unit:
    word, at = distinct(flat)
    word, at = np.concatenate((np.array([START], dtype=np.uint64), word)), at + 1
    train = np.repeat(~held, sizes)
    before = np.concatenate(([0], at[:-1]))
    before[np.cumsum(sizes) - sizes] = 0
    rooms, context, scale, room_of = word, np.arange(len(word)), np.ones(len(word), dtype=np.int64), before
    big = [(i, hot[c]) for i, c in enumerate(word.tolist()) if c in hot] if hot else []
    for i, shards in big:
        mine = np.flatnonzero(before == i)
        if room_of is before:
            room_of = before.copy()
        room_of[mine] = len(rooms) + (mix(word[at[mine]]) % np.uint64(shards)).astype(np.int64)
        codes = mix(mix(word[i : i + 1]) + np.arange(1, shards + 1, dtype=np.uint64))
        rooms = np.concatenate((rooms, (codes >> np.uint64(1)) | np.uint64(2)))
        context, scale = np.concatenate((context, np.full(shards, i))), np.concatenate((scale, np.full(shards, shards)))
    order = np.argsort(rooms, kind="stable")
    rank = np.empty(len(rooms), dtype=np.uint64)
    rank[order] = np.arange(len(rooms), dtype=np.uint64)
    pair, token = distinct(rank[room_of] << np.uint64(32) | at.astype(np.uint64))
    pair_room = (pair >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(pair_room, prepend=-1))
    present = order[pair_room[first]]
    return Unit(
        origin, ids, held, sizes, word, np.bincount(at[train], minlength=len(word)), token, (pair & _LOW).astype(np.int64),
        np.bincount(token[train], minlength=len(pair)), rooms[present], np.diff(first, append=len(pair)), context[present], scale[present],
    )


def _units(batches: Iterator[pa.RecordBatch], hot: dict[int, int], tokens: int) -> Iterator[Unit]:
    """Units of (id, held_out, text) in the order of the partition."""
    origin = TaskContext.get().partitionId() << 32
    ids, held, flats, sizes, size = [], [], [], [], 0
    for part in scan.byte_slices(batches, 2):
        flat, n = _coded(part.column(2))
        ids.append(part.column(0))
        held.append(part.column(1).to_numpy(zero_copy_only=False).astype(bool))
        flats.append(flat)
        sizes.append(n)
        size += len(flat)
        if size >= tokens:
            yield _unit(origin, ids, *map(np.concatenate, (held, flats, sizes)), hot)
            origin, ids, held, flats, sizes, size = origin + 1, [], [], [], [], 0
    if size:
        yield _unit(origin, ids, *map(np.concatenate, (held, flats, sizes)), hot)


# --- jobs ----------------------------------------------------------------------------------------


def _heavy(source: DataFrame, bucket_tokens: int) -> tuple[int, dict[int, int]]:
    """All tokens, and the shards of contexts to split.

    A task names the words that make 1 / HOT_SHARE of its own tokens.  A word of twice that share of all
    tokens has at least that share left after all tasks where it is rarer, so none is missed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size, room = [], 0, UNIT_TOKENS

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, at = distinct(np.concatenate([c for c, _ in seen]))
            return codes, np.bincount(at, np.concatenate([n for _, n in seen]), len(codes)).astype(np.int64)

        for part in scan.byte_slices(batches, 2):
            flat, sizes = _coded(part.column(2))
            seen.append(np.unique(flat, return_counts=True))
            seen.append((np.array([START], dtype=np.uint64), np.array([len(sizes)])))
            size += len(flat)
            if sum(len(c) for c, _ in seen) > room:
                seen = [merged()]
                room = UNIT_TOKENS + 2 * len(seen[0][0])
        if size:
            codes, n = merged()
            much = n >= max(2, size // HOT_SHARE)
            yield pa.RecordBatch.from_pydict({"code": np.concatenate((codes[much].astype(np.int64), [-1])), "n": np.concatenate((n[much], [size]))})

    found = source.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    rows = {r["code"]: r["n"] for r in found.filter((F.col("code") == -1) | (F.col("n") > 2 * bucket_tokens)).collect()}  # HOT_SHARE at most
    return rows.get(-1, 0), {c: -(-n // bucket_tokens) for c, n in rows.items() if c >= 0}


def _send(source: DataFrame, hot: dict[int, int], buckets: int, unit_tokens: int) -> DataFrame:
    """Each unit's pairs to the context buckets (keys from 0 up) and words to the word buckets (from -1 down)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, hot, unit_tokens):
            rows = []
            for bucket, rooms, pairs in u.cut_pairs(buckets):
                split = np.flatnonzero(u.room_scale[rooms] > 1)
                body = pack(
                    u.room[rooms], press(u.room_pairs[rooms]), u.word[u.pair_word[pairs]], press(u.pair_n[pairs]),
                    split, u.word[u.room_context[rooms][split]], u.room_scale[rooms][split],
                )
                rows.append((_SENT, bucket, u.origin, body, 0, 0))
            for bucket, a, b in cut(u.word, buckets):
                rows.append((_SENT, -1 - bucket, u.origin, pack(u.word[a:b], press(u.word_n[a:b])), 0, 0))
            yield batch_of(rows)

    return source.mapInArrow(run, ROWS)


def _merge(buckets: int) -> Callable[[int, Held], Iterator[Row]]:
    """Merged pairs of a context bucket, merged words of a word bucket, and each unit's places in them."""

    def words(key: int, sent: list[tuple[int, bytes]]) -> Iterator[Row]:
        parts = [unpack(body) for _, body in sent]
        word, at = distinct(np.concatenate([p[0] for p in parts]))
        count = np.bincount(at, np.concatenate([unpress(p[1]) for p in parts]), len(word)).astype(np.int64)
        yield _COUNTS, key, 0, pack(word, count), int(count.sum()), int((count > 0).sum())
        end = 0
        for (origin, _), p in zip(sent, parts, strict=True):
            start, end = end, end + len(p[0])
            yield _PLACES, key, origin, pack(at[start:end].astype(np.uint32)), 0, 0

    def pairs(key: int, sent: list[tuple[int, bytes]]) -> Iterator[Row]:
        parts = [unpack(body) for _, body in sent]
        room, in_room = distinct(np.concatenate([p[0] for p in parts]))
        word, in_word = distinct(np.concatenate([p[2] for p in parts]))
        in_room = np.repeat(in_room, np.concatenate([unpress(p[1]) for p in parts]))
        pair, at = distinct(in_room.astype(np.uint64) << np.uint64(32) | in_word.astype(np.uint64))
        count = np.bincount(at, np.concatenate([unpress(p[3]) for p in parts]), len(pair)).astype(np.int64)
        context, scale = room.copy(), np.ones(len(room), dtype=np.int64)
        for p in parts:
            place = np.searchsorted(room, p[0][p[4]])
            context[place], scale[place] = p[5], p[6]
        pair_room, pair_word = (pair >> np.uint64(32)).astype(np.int64), (pair & _LOW).astype(np.int64)
        once, many = count == 1, count > 1
        code = once.astype(np.uint32)
        code[many] = np.arange(2, 2 + int(many.sum()))
        end = 0
        for (origin, _), p in zip(sent, parts, strict=True):
            start, end = end, end + len(p[2])
            check = np.bitwise_xor.reduce(p[2], keepdims=True) if len(p[2]) else np.zeros(1, dtype=np.uint64)
            yield _CODES, key, origin, pack(press(code[at[start:end]]), check), 0, 0
        customers = np.bincount(pair_room, count, len(room)).astype(np.int64)
        keep = customers > 0
        if not keep.any():
            return
        singles = np.bincount(pair_room[once], minlength=len(room))
        wanted, want = distinct(pair_word[many])
        number = np.cumsum(keep) - 1
        body = pack(context[keep], scale[keep], customers[keep], singles[keep], number[pair_room[many]].astype(np.uint32), want.astype(np.uint32), count[many])
        yield _PAIRS, key, 0, body, int(once.sum()), int((count == 2).sum())
        known = np.bincount(pair_word[count > 0], minlength=len(word))
        alone = np.bincount(pair_word[once], minlength=len(word))
        mine = known > 0
        for bucket, a, b in cut(word[mine], buckets):
            yield _WORDS, -1 - bucket, key, pack(word[mine][a:b], alone[mine][a:b].astype(np.uint32), known[mine][a:b].astype(np.uint32)), 0, 0

    def make(key: int, held: Held) -> Iterator[Row]:
        return pairs(key, held[_SENT]) if key >= 0 else words(key, held[_SENT])

    return make


def _customers(key: int, held: Held) -> Iterator[Row]:
    """Customers of each word in the root, told to the buckets that sweep over it; their classes and counts."""
    asked = held.get(_WORDS, [])
    if not asked:
        return
    sent = {origin: unpack(body)[0] for origin, body in held.get(_TABLES, [])}
    parts = [unpack(body) for _, body in asked]
    word, at = distinct(np.concatenate([p[0] for p in parts]))
    tables = []
    for (origin, _), (_, alone, known) in zip(asked, parts, strict=True):
        mine = known.astype(np.int64)
        if origin in sent:
            mine = alone.astype(np.int64)
            mine[known > alone] += sent[origin]
        tables.append(mine)
    customers = np.bincount(at, np.concatenate(tables), len(word)).astype(np.int64)
    end = 0
    for (origin, _), (codes, alone, known) in zip(asked, parts, strict=True):
        start, end = end, end + len(codes)
        if (want := known > alone).any():
            yield _ASKED, origin, -1 - key, pack(customers[at[start:end]][want]), 0, 0
    for c, k in zip(*(x.tolist() for x in np.unique(count_class(customers), return_counts=True)), strict=True):
        yield _CLASS, 0, 0, None, c, k
    yield _ROOTS, key, 0, pack(word, customers), 0, 0


def _sweep(root: Root, discount: float, seed: int, buckets: int, last: bool) -> Callable[[int, Held], Iterator[Row]]:
    """Sweeps over the restaurants of a bucket: tables sent up; at ``last`` shares for the units and sums by context."""

    def make(key: int, held: Held) -> Iterator[Row]:
        share = np.zeros(0)
        if _PAIRS in held:
            context, scale, customers, singles, room, want, count = unpack(held[_PAIRS][0][1])
            answers = [unpack(body)[0] for _, body in held.get(_ASKED, [])]
            chance = root.of(np.concatenate(answers)) if answers else np.zeros(0)
            rng = np.random.default_rng([seed, key])
            mean, total, tables = restaurants(
                room.astype(np.int64), count, chance[want], singles.astype(np.float64), scale.astype(np.float64), discount, rng,
                BURN_IN if last else SENDING - 1, SAMPLES if last else 1,
            )
            share = count - discount * mean
            if last:
                order = np.argsort(context, kind="stable")
                for bucket, a, b in cut(context[order], buckets):
                    yield _ROOMS, -1 - bucket, key, pack(context[order[a:b]], customers[order[a:b]], total[order[a:b]]), 0, 0
            else:
                sums, end = np.bincount(want, tables, len(chance)).astype(np.uint32), 0
                for (bucket, _), answer in zip(held.get(_ASKED, []), answers, strict=True):
                    start, end = end, end + len(answer)
                    yield _TABLES, -1 - bucket, key, pack(sums[start:end]), 0, 0
        value = np.concatenate(([0.0, 1.0 - discount], share)).astype(np.float32)
        for origin, body in held.get(_CODES, []):
            code, check = unpack(body)
            yield _SHARES, origin, key, pack(press(value[unpress(code)].view(np.uint32)), check), 0, 0

    return make


def _values(root: Root, discount: float) -> Callable[[int, Held], Iterator[Row]]:
    """Answers to the units: of each word its count, root probability, back-off and customers as a context."""

    def make(key: int, held: Held) -> Iterator[Row]:
        if _COUNTS not in held:
            return
        word, count = unpack(held[_COUNTS][0][1])
        chance = np.full(len(word), root.chance[0])
        for _, body in held.get(_ROOTS, []):
            known, customers = unpack(body)
            chance[np.searchsorted(word, known)] = root.of(customers)
        seated, tables = np.zeros(len(word)), np.zeros(len(word))
        for _, body in held.get(_ROOMS, []):
            context, customers, total = unpack(body)
            at = np.searchsorted(word, context)
            np.add.at(seated, at, customers)
            np.add.at(tables, at, total)
        seated += CONCENTRATION
        back_off = (CONCENTRATION + discount * tables) / seated
        for origin, body in held.get(_PLACES, []):
            at = unpack(body)[0]
            yield _VALUES, origin, -1 - key, pack(count[at], chance[at], back_off[at].astype(np.float32), seated[at].astype(np.float32)), 0, 0

    return make


def _again(source: DataFrame, hot: dict[int, int], buckets: int, unit_tokens: int) -> DataFrame:
    """Each unit as it is summed at the end: its texts' ids and sizes, and the pair of each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, hot, unit_tokens):
            ids = pa.chunked_array(u.ids).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([ids], ["id"]))
            check, size = [], []
            for _, _, pairs in u.cut_pairs(buckets):
                check.append(np.bitwise_xor.reduce(u.word[u.pair_word[pairs]]))
                size.append(pairs.stop - pairs.start)
            # Frequent pairs get small numbers, so that most of their bytes are zero.
            order = np.argsort(-np.bincount(u.token, minlength=len(u.pair_word)), kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            body = pack(
                np.frombuffer(sink.getvalue(), dtype=np.uint8), u.held.view(np.uint8), u.sizes, press(rank[u.token]), press(order), press(u.pair_word),
                press(u.room_context), press(u.room_pairs), np.array(check, dtype=np.uint64), np.array(size),
            )
            yield batch_of([(_UNIT, u.origin, 0, body, 0, 0)])

    return source.mapInArrow(run, ROWS)


def _summed(rows: DataFrame, id_type: str, tokens: int, types: int, buckets: int) -> DataFrame:
    """The texts' sums from units, shares of their pairs and values of their words."""

    def unit(rows: Held) -> Iterator[pa.RecordBatch]:
        raw, held, sizes, *pressed, check, size = unpack(rows[_UNIT][0][1])
        token, order, pair_word, room_context, room_pairs = map(unpress, pressed)
        token = order[token]
        parts = [(unpress(share).view(np.float32), mark) for share, mark in (unpack(b) for _, b in rows[_SHARES])]
        if [len(p[0]) for p in parts] != size.tolist() or [int(p[1][0]) for p in parts] != check.tolist():
            raise RuntimeError("the texts read differently the second time")
        count, chance, back_off, seated = (np.concatenate(x) for x in zip(*(unpack(b) for _, b in rows[_VALUES]), strict=True))
        context = np.repeat(room_context, room_pairs)
        score = np.log10(np.concatenate([p[0] for p in parts]) / seated[context].astype(np.float64) + back_off[context] * chance[pair_word])
        base = np.log10((count + 0.5) / (tokens + 0.5 * (types + 1)))
        word, starts = pair_word[token], np.cumsum(sizes) - sizes
        total = [np.add.reduceat(x, starts) for x in ((count > 0)[word].astype(np.int64), base[word], score[token])]
        ids = pa.ipc.open_stream(pa.py_buffer(raw)).read_all().column(0).combine_chunks()
        cols = [held.astype(bool), sizes, total[0], np.full(len(sizes), tokens), total[1], total[2]]
        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cols)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_unit(rows, unit, schema, buckets)


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_tokens: int = UNIT_TOKENS, bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """One row per input row: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    ``base_score`` is the log10 probability of the text under add-half unigrams, ``score`` under the
    model.  Null texts are empty: their end alone is scored.  Rows that repeat are scored each.  No
    training rows at all leave every token unknown; an empty table gives no rows.  The texts are read
    three times and cut the same way each time; if they read differently the job fails.
    """
    with same_cuts(df.sparkSession):
        return _score(df, id_col, text_col, unit_tokens, bucket_tokens)


def _score(df: DataFrame, id_col: str, text_col: str, unit_tokens: int, bucket_tokens: int) -> DataFrame:
    store, kind = Store(df.sparkSession, "hpyp", ROWS), dict(df.dtypes)[id_col]
    source = df.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"), F.col(text_col).alias("text"))
    size, hot = _heavy(source, bucket_tokens)
    buckets = max(1, -(-size // bucket_tokens))
    store.write(by_key(_send(source, hot, buckets, unit_tokens), _merge(buckets), 2 * buckets), "merged")
    total = store.read("merged", _COUNTS).agg(F.sum("a").alias("n"), F.sum("b").alias("v")).first()
    tokens, types = int(total["n"] or 0), int(total["v"] or 0)
    seen = store.read("merged", _PAIRS).agg(F.sum("a").alias("once"), F.sum("b").alias("twice")).first()
    ones, twos = int(seen["once"] or 0), int(seen["twice"] or 0)
    discount = float(np.clip(ones / max(1, ones + 2 * twos), 0.2, 0.9))
    words, pairs = store.read("merged", _WORDS), store.read("merged", _PAIRS)
    for turn in range(ROUNDS):
        sent = words.unionByName(store.read(f"swept{turn - 1}", _TABLES)) if turn else words
        store.write(by_key(sent, _customers, 2 * buckets), f"asked{turn}")
        found = store.read(f"asked{turn}", _CLASS).groupBy("a").agg(F.sum("b").alias("n")).collect()  # bounded by count_class
        root = seat_root(sorted((int(r["a"]), int(r["n"])) for r in found), types, discount, turn)
        last = turn == ROUNDS - 1
        told = pairs.unionByName(store.read(f"asked{turn}", _ASKED))
        told = told.unionByName(store.read("merged", _CODES)) if last else told
        store.write(by_key(told, _sweep(root, discount, turn, buckets, last), 2 * buckets), f"swept{turn}")
    known = store.read("merged", _COUNTS, _PLACES).unionByName(store.read(f"asked{turn}", _ROOTS)).unionByName(store.read(f"swept{turn}", _ROOMS))
    store.write(by_key(known, _values(root, discount), 2 * buckets), "values")
    store.drop("merged", *(f"asked{i}" for i in range(ROUNDS)), *(f"swept{i}" for i in range(ROUNDS - 1)))
    rows = _again(source, hot, buckets, unit_tokens).unionByName(store.read(f"swept{turn}", _SHARES)).unionByName(store.read("values", _VALUES))
    done = _summed(rows, kind, tokens, types, 2 * buckets)
    store.write(done, "scores", by_kind=False)
    store.drop(f"swept{turn}", "values")
    return store.whole("scores", done.schema)


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, n_tokens, base_perplexity, perplexity) over the rows of ``score``."""
    power = lambda c: F.pow(F.lit(10.0), F.try_divide(-F.sum(c), F.sum("n_tokens")))
    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("n_tokens"), power("base_score").alias("base_perplexity"), power("score").alias("perplexity")
    )
