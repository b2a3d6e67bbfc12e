"""Byte-level BPE: corpus-level merge replay and decoding.

A rank file maps byte strings to ranks, which are also the ids.

1. *Pieces.*  Texts are cut into pieces by the tokenizer's pattern.  The one pattern that the public
   files share is cut by array operations over classes of characters; any other by its expression.
   A unit of the corpus (see ``blobs``) sends its distinct pieces to buckets dealt by a hash of their
   bytes, so each distinct piece of the corpus reaches one bucket.
2. *Replay.*  A bucket lays its pieces out as one run of symbols.  An inverted index lists the positions
   of every adjacent pair by the rank of its merge; merges are replayed in rank order, all positions
   of a merge at once, and only the neighbours of what was merged are looked up again.  Pieces that are
   themselves in the file are single ids, as in the original library.
3. *Texts.*  Buckets answer each unit with the ids of its pieces; the unit puts its texts together.

Where a merge makes a pair of a lower rank than its own, rank order has passed that pair; such pieces are
encoded by the definition with a heap.  Pieces are told apart by 64-bit hashes inside a unit and a bucket; a
bucket compares their bytes, and fails rather than mix two.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrace.llm import scan
from vectrace.llm.blobs import ROWS, Held, Row, Store, batch_of, by_key, by_unit, cut, loosen, pack, press, same_cuts, squeeze, unpack, unpress
from vectrace.llm.common import slices

#: Bytes of text of a unit (one text more at most) and, about, of all texts of a bucket's pieces.
UNIT_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20
#: The pattern that is cut without an expression.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SENT, _IDS, _UNIT = range(3)
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read once on the driver (under 1 MB) and shipped with the job."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, as the pattern's properties have it."""
    import regex

    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = (x if x < 0xD800 else x + 0x800 for x in m.span())
            out[a:b] = kind
    return out


def _pattern_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of PATTERN begin in the UTF-8 bytes of rows run together.

    Runs of one class are pieces, but for three rules: of white space before other characters the last
    one stands apart from the rest; if that is a space it joins what follows; and an apostrophe alone,
    with no space to join it, takes one of the fixed endings from the letters behind it.
    """
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    first = data[at]
    kind = _classes()[:128][np.minimum(first, 127)]
    for size, low, high, mask in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0x100, 0x07)):
        mine = np.flatnonzero((first >= low) & (first < high))
        if len(mine):
            code = (first[mine] & mask).astype(np.int64)
            for k in range(1, size):
                code = code << 6 | (data[at[mine] + k] & 0x3F)
            kind[mine] = _classes()[code]
    n = len(at)
    rows = np.searchsorted(at, bounds[:-1][bounds[:-1] < bounds[1:]])  # first character of each row
    edge = np.zeros(n + 1, dtype=bool)
    edge[rows] = edge[n] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    ends = np.append(run[1:], True)  # the last character of its run
    space, blank = kind == _SPACE, first == 0x20
    before_text = space & ends & ~edge[1:]  # the last white space before other characters of its row
    start = run | before_text
    joined = np.zeros(n, dtype=bool)
    joined[1:] = (before_text & blank)[:-1]
    start &= ~joined
    alone = np.flatnonzero((first == 0x27) & run & ends & ~joined & ~edge[1:])
    alone = alone[kind[alone + 1] == _LETTER]
    if len(alone):
        padded = np.concatenate((first, np.zeros(2, dtype=np.uint8)))
        inside = np.concatenate((run, [True, True]))
        a, b = padded[alone + 1], padded[alone + 2]
        one = np.isin(a, np.frombuffer(b"stmd", dtype=np.uint8))
        two = ~inside[alone + 2] & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        start[alone[one | two] + 1] = False
        for taken, size in ((one, 2), (two, 3)):
            rest = alone[taken] + size
            rest = rest[rest < n]
            start[rest[~run[rest]]] = True
    return at[start]


def _heap_merge(ids: list[int], rank_of: Callable[[int, int], int]) -> list[int]:
    """One piece by its definition: merge the leftmost pair of least rank until none is left."""
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [(r, i) for i in range(len(ids) - 1) if (r := rank_of(ids[i], ids[i + 1])) >= 0]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= len(ids) or rank_of(ids[i], ids[j]) != rank:
            continue
        ids[i], ids[j], after[i] = rank, -1, after[j]
        if after[i] < len(ids):
            before[after[i]] = i
            if (r := rank_of(rank, ids[after[i]])) >= 0:
                heappush(heap, (r, i))
        if before[i] >= 0 and (r := rank_of(ids[before[i]], rank)) >= 0:
            heappush(heap, (r, before[i]))
    return [x for x in ids if x >= 0]


class Coder:
    """Encoder and decoder for one rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.vocab = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.vocab}
        self.pattern = pattern
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)])
        merges = {
            self.ranks[token[:k]] << 32 | self.ranks[token[k:]]: rank
            for token, rank in self.ranks.items() for k in range(1, len(token)) if token[:k] in self.ranks and token[k:] in self.ranks
        }
        self.pair = np.array(sorted(merges), dtype=np.int64)
        self.merged = np.array([merges[p] for p in self.pair.tolist()], dtype=np.int64)

    def starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin in the rows' bytes."""
        if self.pattern == PATTERN:
            return _pattern_starts(data, bounds)
        import regex

        out, find = [], regex.compile(self.pattern).finditer
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            text, done, size = data[a:b].tobytes().decode("utf-8"), 0, a
            for m in find(text):
                if m.start() != done:
                    raise ValueError("the pattern leaves characters out")
                if m.end() > done:
                    out.append(size)
                    size += len(m[0].encode("utf-8"))
                    done = m.end()
            if done != len(text):
                raise ValueError("the pattern leaves characters out")
        return np.array(out, dtype=np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; -1 where the file has none."""
        if not len(self.pair):
            return np.full(len(left), -1, dtype=np.int64)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], -1)

    def rank_of(self, left: int, right: int) -> int:
        return self.ranks.get(self.vocab[left] + self.vocab[right], -1)

    def alone(self, piece: bytes) -> list[int]:
        return _heap_merge(self.single[list(piece)].tolist(), self.rank_of)

    def replay(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces run together and how many each has, merges replayed over the pieces' bytes together."""
        n = len(data)
        ids = self.single[data].astype(np.int32)
        ends = np.cumsum(size)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        full = size > 0
        after[ends[full] - 1], before[(ends - size)[full]] = -1, -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(position: np.ndarray, rank: np.ndarray) -> None:
            mine = rank >= 0
            position, rank = position[mine], rank[mine]
            if not len(position):
                return
            order = np.argsort(rank, kind="stable")
            position, rank = position[order], rank[order]
            edges = np.flatnonzero(np.diff(rank, prepend=-1))
            for r, a, b in zip(rank[edges].tolist(), edges.tolist(), np.append(edges, len(rank))[1:].tolist(), strict=True):
                if r in index:
                    index[r].append(position[a:b])
                else:
                    index[r] = [position[a:b]]
                    heappush(heap, r)

        left = np.flatnonzero(after >= 0).astype(np.int32)
        file(left, self.lookup(ids[left], ids[left + 1]))
        odd = []
        while heap:
            rank = heappop(heap)
            p = np.concatenate(index.pop(rank))
            p = p[(ids[p] >= 0) & (after[p] >= 0)]
            p = np.unique(p[self.lookup(ids[p], ids[after[p]]) == rank])
            if not len(p):
                continue
            # Of pairs that overlap in a row, every other one from the left merges.
            linked = np.zeros(len(p), dtype=bool)
            linked[1:] = after[p[:-1]] == p[1:]
            if linked.any():
                place = np.arange(len(p))
                p = p[(place - np.maximum.accumulate(np.where(linked, 0, place))) % 2 == 0]
            gone = after[p]
            far = after[gone]
            ids[p], ids[gone], after[p] = rank, -1, far
            has = far >= 0
            before[far[has]] = p[has]
            q = before[p]
            place = np.concatenate((p[has], q[q >= 0]))
            new = self.lookup(ids[place], ids[after[place]])
            if (back := (new >= 0) & (new < rank)).any():
                odd.append(place[back])
            file(place, new)
        kept = ids >= 0
        piece = np.repeat(np.arange(len(size)), size)
        count = np.bincount(piece[kept], minlength=len(size))
        if not odd:
            return ids[kept], count
        # Rank order has passed some pairs here.
        out = np.split(ids[kept], np.cumsum(count)[:-1])
        for w in np.unique(piece[np.concatenate(odd)]).tolist():
            out[w] = np.array(self.alone(data[ends[w] - size[w] : ends[w]].tobytes()), dtype=np.int64)
        return np.concatenate(out), np.array([len(x) for x in out])

    def ids_of(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces run together and how many each has; pieces of the file are single ids."""
        raw, ends = data.tobytes(), np.cumsum(size)
        get = self.ranks.get
        whole = np.array([get(raw[a:b], -1) for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)], dtype=np.int64)
        rest = whole < 0
        replayed, n = self.replay(data[np.repeat(rest, size)], size[rest])
        count = np.ones(len(size), dtype=np.int64)
        count[rest] = n
        out = np.empty(int(count.sum()), dtype=np.int64)
        mine = np.repeat(rest, count)
        out[mine], out[~mine] = replayed, whole[~rest]
        return out, count

    def encode(self, batch: list[str]) -> list[list[int]]:
        """Ids of each text."""
        unit = _unit(0, self, [pa.nulls(len(batch))], [scan.column_bytes(pa.array(batch, pa.string()))])
        ids, count = self.ids_of(unit.data, unit.size)
        return [x.tolist() for x in _texts(unit.token, unit.tokens, ids, count)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


@lru_cache(maxsize=2)
def _coder(rank_file: bytes, pattern: str) -> Coder:
    return Coder(rank_file, pattern)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    shift = start - (np.cumsum(size) - size)
    return np.arange(int(size.sum())) + np.repeat(shift, size)


def _texts(token: np.ndarray, tokens: np.ndarray, ids: np.ndarray, count: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of each text from its pieces; ``tokens`` is how many pieces a text has."""
    first = np.cumsum(count) - count
    upto = np.cumsum(tokens)
    for a, b in zip((upto - tokens).tolist(), upto.tolist(), strict=True):
        mine = token[a:b]
        yield ids[_ranges(first[mine], count[mine])]


class _Unit:
    """Texts of a unit: the distinct pieces by hash, the piece at each place, pieces of each text."""

    def __init__(self, origin: int, ids: list[pa.Array], data: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray, tokens: np.ndarray):
        self.origin, self.ids, self.tokens = origin, ids, tokens
        self.hash, first, token = np.unique(hashes, return_index=True, return_inverse=True)
        self.token = token.reshape(-1).astype(np.uint32)
        self.size = size[first].astype(np.int64)
        self.data = data[_ranges(start[first], self.size)]


def _unit(origin: int, coder: Coder, ids: list[pa.Array], columns: list[tuple[np.ndarray, np.ndarray]]) -> _Unit:
    starts, sizes, hashes, tokens, base = [], [], [], [], 0
    for data, bounds in columns:
        start = coder.starts(data, bounds)
        end = np.append(start, len(data))[1:]
        starts.append(start + base)
        sizes.append((end - start).astype(np.uint32))
        hashes.append(scan.chunk_hashes(data, start, end))
        tokens.append(np.diff(np.searchsorted(start, bounds)))
        base += len(data)
    return _Unit(origin, ids, np.concatenate([d for d, _ in columns]), *map(np.concatenate, (starts, sizes, hashes, tokens)))


def _units(batches: Iterator[pa.RecordBatch], coder: Coder, unit_bytes: int) -> Iterator[_Unit]:
    """Units of (id, text) in the order of the partition."""
    origin = TaskContext.get().partitionId() << 32
    ids, columns, size = [], [], 0
    for part in scan.byte_slices(batches, 1):
        ids.append(part.column(0))
        columns.append(scan.column_bytes(part.column(1)))
        size += len(columns[-1][0])
        if size >= unit_bytes:
            yield _unit(origin, coder, ids, columns)
            origin, ids, columns, size = origin + 1, [], [], 0
    if ids:
        yield _unit(origin, coder, ids, columns)


def _send(source: DataFrame, rank_file: bytes, pattern: str, buckets: int, unit_bytes: int) -> DataFrame:
    """Each unit's distinct pieces to the buckets of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, _coder(rank_file, pattern), unit_bytes):
            ends, rows = np.concatenate(([0], np.cumsum(u.size))), []
            for bucket, a, b in cut(u.hash >> np.uint64(1), buckets):
                rows.append((_SENT, bucket, u.origin, pack(squeeze(u.data[ends[a] : ends[b]]), press(u.size[a:b])), 0, 0))
            yield batch_of(rows)

    return source.mapInArrow(run, ROWS)


def _replayed(rank_file: bytes, pattern: str) -> Callable[[int, Held], Iterator[Row]]:
    """Each distinct piece of a bucket is encoded once; every unit gets the ids of its pieces."""

    def make(key: int, held: Held) -> Iterator[Row]:
        parts = [(loosen(data), unpress(sizes)) for data, sizes in (unpack(body) for _, body in held[_SENT])]
        data, size = (np.concatenate([p[i] for p in parts]) for i in range(2))
        size = size.astype(np.int64)
        start = np.cumsum(size) - size
        _, first, at = np.unique(scan.chunk_hashes(data, start, start + size), return_index=True, return_inverse=True)
        at = at.reshape(-1)
        if (size[first][at] != size).any() or (data[_ranges(start[first][at], size)] != data).any():
            raise RuntimeError("two pieces have one hash")
        ids, count = _coder(rank_file, pattern).ids_of(data[_ranges(start[first], size[first])], size[first])
        begin, end = np.cumsum(count) - count, 0
        for (origin, _), (bytes_, sizes) in zip(held[_SENT], parts, strict=True):
            low, end = end, end + len(sizes)
            mine = at[low:end]
            check = np.array([int(scan.mix(sizes.astype(np.uint64)).sum()) ^ len(bytes_)], dtype=np.uint64)
            yield _IDS, origin, key, pack(press(ids[_ranges(begin[mine], count[mine])]), press(count[mine]), check), 0, 0

    return make


def _again(source: DataFrame, rank_file: bytes, pattern: str, buckets: int, unit_bytes: int) -> DataFrame:
    """Each unit as it is put together at the end: its texts' ids and, compressed, the piece at each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _units(batches, _coder(rank_file, pattern), unit_bytes):
            column = pa.chunked_array(u.ids).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("id", column.type)])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([column], ["id"]))
            # Frequent pieces get small numbers, so that most of their bytes are zero.
            order = np.argsort(-np.bincount(u.token, minlength=len(u.hash)), kind="stable")
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            sizes = u.size.astype(np.uint32)
            check = [int(scan.mix(sizes[a:b].astype(np.uint64)).sum()) ^ int(sizes[a:b].sum()) for _, a, b in cut(u.hash >> np.uint64(1), buckets)]
            body = pack(
                np.frombuffer(sink.getvalue(), dtype=np.uint8), u.tokens, press(rank[u.token]),
                order.astype(np.uint32), np.array(check, dtype=np.uint64),
            )
            yield batch_of([(_UNIT, u.origin, 0, body, 0, 0)])

    return source.mapInArrow(run, ROWS)


Make = Callable[[Coder, pa.Array, Iterator[np.ndarray]], Iterator[pa.RecordBatch]]


def _encoded(df: DataFrame, rank_file: bytes, pattern: str, id_col: str, text_col: str, schema: str, make: Make, unit_bytes: int, bucket_bytes: int) -> DataFrame:
    """What ``make`` gives for each unit from its rows' ids and the token ids of each row."""
    store = Store(df.sparkSession, "bpe", ROWS)
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def unit(held: Held) -> Iterator[pa.RecordBatch]:
        raw, tokens, places, order, check = unpack(held[_UNIT][0][1])
        parts = [unpack(body) for _, body in held.get(_IDS, [])]
        if [int(p[2][0]) for p in parts] != check.tolist():
            raise RuntimeError("the texts read differently the second time")
        none = np.empty(0, dtype=np.uint32)
        ids, count = (np.concatenate([none, *(unpress(p[i]) for p in parts)]) for i in range(2))
        token = order[unpress(places)] if len(order) else none
        column = pa.ipc.open_stream(pa.py_buffer(raw)).read_all().column(0).combine_chunks()
        yield from make(_coder(rank_file, pattern), column, _texts(token, tokens, ids, count.astype(np.int64)))

    with same_cuts(df.sparkSession):
        size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(1, -(-size // bucket_bytes))
        store.write(by_key(_send(source, rank_file, pattern, buckets, unit_bytes), _replayed(rank_file, pattern), buckets), "ids")
        rows = _again(source, rank_file, pattern, buckets, unit_bytes).unionByName(store.read("ids", _IDS))
        done = by_unit(rows, unit, schema, max(2 * buckets, -(-2 * size // unit_bytes)))
        store.write(done, "done", by_kind=False)
    store.drop("ids")
    return store.whole("done", done.schema)


def encode(
    df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    unit_bytes: int = UNIT_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(doc_id, ids array<int>) for every row; a null text has no ids.  Rows are never merged.

    The texts are read twice and must read the same; if they do not the job fails.
    """

    def make(coder: Coder, column: pa.Array, found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = list(found)
        offsets = np.cumsum([0, *map(len, rows)])
        flat = np.concatenate([np.empty(0, dtype=np.int32), *rows]).astype(np.int32)
        # Lists count their items with 32 bits, so a unit is handed on in runs of texts.
        at = 0
        while at < len(rows):
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 22))) - 1)
            lists = pa.ListArray.from_arrays(pa.array(offsets[at : upto + 1] - offsets[at], pa.int32()), pa.array(flat[offsets[at] : offsets[upto]]))
            yield pa.RecordBatch.from_arrays([column.slice(at, upto - at), lists], ["doc_id", "ids"])
            at = upto

    schema = f"doc_id {dict(df.dtypes)[id_col]}, ids array<int>"
    return _encoded(df, rank_file, pattern, id_col, text_col, schema, make, unit_bytes, bucket_bytes)


def decode(df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes) from an array of ids; null gives no bytes, an id outside the file raises KeyError."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(rank_file, pattern)
        for part in slices(batches):
            raw = [coder.decode(x or []) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return df.select(id_col, ids_col).mapInArrow(run, f"doc_id {dict(df.dtypes)[id_col]}, bytes binary")


def digests(
    df: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    unit_bytes: int = UNIT_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, keeping digests only."""

    def make(coder: Coder, column: pa.Array, found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        count, hashed, decoded = [], [], []
        for x in found:
            ids = x.tolist()
            count.append(len(ids))
            hashed.append(hashlib.sha256(",".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        cols = [column, pa.array(count, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {dict(df.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(df, rank_file, pattern, id_col, text_col, schema, make, unit_bytes, bucket_bytes)
