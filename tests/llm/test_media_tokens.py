import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vectrace.llm import bpe, gif, scan, unigram

public_tokenizers = pytest.importorskip("public_tokenizers")


def wild(rng, n=400):
    return ["".join(rng.choice("ab \n\t'sé日🙂0129.,! \x00́▁") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_stored_payload_reads_back():
    rng = random.Random(1)
    for size in (64, 4096, 64 * 1024, 64 * 2100):
        for make in (lambda n: bytes(rng.randrange(256) for _ in range(n)), lambda n: b"a" * n, lambda n: bytes(rng.choice(b"ab") for _ in range(n))):
            data = make(size)
            assert gif.read_back(gif.encode(data))[0] == data
    with pytest.raises(ValueError):
        gif.encode(b"abc")


def codes_to_stream(codes, size):
    """A code stream by the textbook's rule, widths following the decoder's table."""
    out, bits, n, free, width, first = bytearray(), 0, 0, (1 << size) + 2, size + 1, True
    for c in codes:
        bits |= c << n
        n += width
        while n >= 8:
            out.append(bits & 255)
            bits >>= 8
            n -= 8
        if c == 1 << size:
            free, width, first = (1 << size) + 2, size + 1, True
        elif first:
            first = False
        elif free < 4096:
            free += 1
            if free == 1 << width and width < 12:
                width += 1
    if n:
        out.append(bits & 255)
    return bytes(out)


def test_expand_small_code_sizes_early_clears_and_deferred_clear():
    assert gif.expand(codes_to_stream([4, 1, 6, 6, 2, 5], 2), 2, 100) == bytes([1, 1, 1, 1, 1, 2])
    assert gif.expand(codes_to_stream([4, 1, 4, 2, 2, 4, 4, 3, 5], 2), 2, 100) == bytes([1, 2, 2, 3])
    rng = random.Random(2)
    plain = [rng.randrange(256) for _ in range(9000)]  # no clear after the table is full
    assert gif.expand(codes_to_stream([256, *plain, 257], 8), 8, 9000) == bytes(plain)
    with pytest.raises(gif.GifError):
        gif.expand(codes_to_stream([4, 1, 3, 7, 5], 2) [:1] + b"\xff\xff", 2, 100)


def image(left, top, w, h, samples, flags=0, palette=b"", control=None):
    out = b""
    if control is not None:
        disposal, clear, delay = control
        out += struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, clear or 0, 0)
    stream = codes_to_stream([4, *[x for s in samples for x in (s, 4)], 5], 2)
    return out + struct.pack("<BHHHHB", 0x2C, left, top, w, h, flags) + palette + bytes([2, len(stream)]) + stream + b"\0"


def test_disposal_transparency_local_palette_and_interlace():
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    head = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + palette
    data = head + image(0, 0, 2, 2, [1, 1, 1, 1], control=(1, None, 5))
    data += image(0, 0, 1, 1, [2], control=(3, None, 7)) + image(1, 1, 1, 1, [3], control=(2, None, 1))
    data += image(0, 0, 2, 2, [0, 2, 0, 0], control=(0, 0, 2)) + image(0, 0, 1, 1, [0], flags=0x80, palette=bytes([9, 8, 7, 1, 1, 1])) + b";"
    frames = [f for f in map(lambda f: (f.start_ms, f.delay_ms, f.canvas[..., :3].copy(), f.canvas[..., 3].copy()), gif.decode(data))]
    red, green, blue, none = [255, 0, 0], [0, 255, 0], [0, 0, 255], [0, 0, 0]
    assert [f[:2] for f in frames] == [(0, 50), (50, 70), (120, 10), (130, 20), (150, 0)]
    assert frames[0][2].tolist() == [[red, red], [red, red]]
    assert frames[1][2].tolist() == [[green, red], [red, red]]  # then restored
    assert frames[2][2].tolist() == [[red, red], [red, blue]]  # then cleared there
    assert frames[3][2].tolist() == [[red, green], [red, none]] and frames[3][3].tolist() == [[255, 255], [255, 0]]
    assert frames[4][2].tolist()[0][0] == [9, 8, 7]
    laced = head + image(0, 0, 1, 2, [1, 2], flags=0x40) + b";"
    assert next(gif.decode(laced)).canvas[:, 0, :3].tolist() == [red, green]
    for broken in (b"", b"GIF89a", data[:-1], data[:40], head + b"\x99"):
        with pytest.raises(gif.GifError):
            list(gif.decode(broken))


def test_every_cut_and_a_huge_canvas_are_error_rows(spark):
    data = gif.encode(bytes(range(64)) * 3)
    rows = [(i, data[:i]) for i in range(len(data))] + [(-1, b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b";")]
    df = spark.createDataFrame(rows, "doc_id long, media binary").repartition(2)
    got = gif.frames(df).collect()
    assert {r.doc_id for r in got if r.error} == {i for i, _ in rows}
    assert next(r for r in got if r.doc_id == -1).error == "the canvas is too large"
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    head = b"GIF89a" + struct.pack("<HHBBB", 2, 1, 0x80, 0, 0) + palette[:6]  # two colours
    clear = next(gif.decode(head + image(0, 0, 2, 1, [1, 3], control=(0, 3, 1)) + b";"))  # the transparent index lies beyond them
    assert clear.canvas[0].tolist() == [[255, 0, 0, 255], [0, 0, 0, 0]] and sum(gif.histograms(clear)[0]) == 1
    with pytest.raises(gif.GifError):
        next(gif.decode(head + image(0, 0, 2, 1, [1, 3]) + b";"))


def test_histograms_of_covering_frames_equal_those_of_the_canvas():
    rng = random.Random(5)
    for f in gif.decode(gif.encode(bytes(rng.randrange(256) for _ in range(64 * 1500)))):
        whole = gif.histograms(f)
        f.alone = None
        assert gif.histograms(f) == whole


def test_media_operators(spark):
    texts = [None, "", "a", "a", "é日🙂", "long text " * 20_000]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, media int")
    trip = {r.doc_id: r for r in gif.round_trip(df).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = trip[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
    assert trip[2][1:] == trip[3][1:]
    stored = gif.store(df)
    frames = gif.frames(stored).collect()
    assert len([f for f in frames if f.doc_id == 5]) == 4 and all(f.error is None for f in frames)
    one = next(f for f in frames if f.doc_id == 2)
    assert sum(one.red) == 64 and one.width == 64 and np.frombuffer(one.rgba, dtype=np.uint8)[0] == ord("a")
    bad = spark.createDataFrame([(1, None), (2, b"junk")], "doc_id long, media binary")
    assert sorted((r.doc_id, r.frame, r.error) for r in gif.frames(bad).collect()) == [(1, None, "no GIF header"), (2, None, "no GIF header")]
    assert gif.round_trip(df.limit(0)).collect() == [] and gif.frames(stored.limit(0)).collect() == []


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_ids_equal_the_library(ranks):
    import tiktoken

    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    texts = [*wild(random.Random(0)), "a" * 800, "aaaa bbbb" * 60, "", " unbelievable thnterblement Über", "<|endoftext|>"]
    ids = coder.encode(texts)
    assert ids == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(i) for i in ids] == [t.encode() for t in texts]


def test_replay_equals_the_definition_where_rank_order_goes_back():
    # "abc" ranks below "bc", so merging in rank order passes it before (a, bc) can form.
    import base64

    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"bc", b"xbc", b"xabc", b"aa", b"aaa"]
    file = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens))
    coder = bpe.Coder(file, r"\S+|\s+")

    def definition(piece):
        ids = list(piece)
        while pairs := [(r, i) for i in range(len(ids) - 1) if (r := coder.rank_of(ids[i], ids[i + 1])) >= 0]:
            rank, i = min(pairs)
            ids[i : i + 2] = [rank]
        return ids

    rng = random.Random(3)
    words = [b"abcabc", b"xabc", b"aabcc", b"xbcabc", b"", b"aaaaaaa", *(bytes(rng.choice(b"abcx") for _ in range(rng.randint(1, 12))) for _ in range(300))]
    ids, count = coder.replay(np.frombuffer(b"".join(words), dtype=np.uint8), np.array([len(w) for w in words]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [definition(w) for w in words]
    assert [coder.alone(w) for w in words if w] == [definition(w) for w in words if w]


def test_pieces_equal_the_pattern(ranks):
    import regex

    rng = random.Random(6)
    some = "aZé日ﬁ1²٣ \t\n\r\x0b\x1c\x85\xa0\u2003\u3000'!.🙂\u0301stmdrevl"
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["don't we'll 'tis ''s 's's !'s x'RE they've'd", "'", "'s", " 's", "\n's", "a'", "a'l", "a'r", "'v", "  ", " \n a", "a \n", "''", "'ll'"]
    texts += ["".join(rng.choice("stmdrevl'' a") for _ in range(12)) for _ in range(3000)]
    data, bounds = scan.column_bytes(pa.array(texts))
    start = bpe.Coder(ranks, public_tokenizers.PATTERN).starts(data, bounds)
    end, at = [*start[1:].tolist(), len(data)], 0
    for k, text in enumerate(texts):
        expect = regex.findall(public_tokenizers.PATTERN, text)
        got = [data[a:b].tobytes().decode() for a, b in zip(start[at : at + len(expect)].tolist(), end[at : at + len(expect)], strict=True)]
        assert got == expect, text
        at += len(expect)
    assert at == len(start)


def test_long_pieces_equal_the_library(ranks):
    import tiktoken

    coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["".join(rng.choice("etaoinshr") for _ in range(200_000)), "ab" * 50_000, "é" * 9999]
    assert coder.encode(texts) == [library.encode_ordinary(t) for t in texts]
    one = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))  # one piece of 1 MB
    assert coder.decode(coder.encode([one])[0]) == one.encode()
    assert coder.encode([one])[0] == coder.alone(one.encode())


def test_bpe_operators(spark, ranks):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "héllo wörld", "x"), (3, "héllo wörld", "x"), (None, "z " * 30_000, "x")], "doc_id long, text string, ids string")
    encoded = bpe.encode(df, ranks, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.bytes)) for r in back.collect()) == sorted([(1, b""), (2, b""), *[(3, "héllo wörld".encode())] * 2, (0, b"z " * 30_000)])
    digest = {r.doc_id: r for r in bpe.digests(df, ranks, public_tokenizers.PATTERN).collect()}
    ids = next(r.ids for r in encoded.collect() if r.doc_id == 3)
    assert digest[3].n_tokens == len(ids) and digest[3].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digest[1].n_tokens == 0 and digest[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(df.limit(0), ranks, public_tokenizers.PATTERN).collect() == []
    rows = [(i, t) for i, t in enumerate(wild(random.Random(9), 300))]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    small = bpe.encode(many, ranks, public_tokenizers.PATTERN, unit_bytes=500, bucket_bytes=1000)  # many units and buckets
    assert {r.doc_id: r.ids for r in small.collect()} == dict(enumerate(bpe.Coder(ranks, public_tokenizers.PATTERN).encode([t for _, t in rows])))
    other = bpe.encode(many, ranks, r"\S+|\s+")
    assert {r.doc_id: r.ids for r in other.collect()} == dict(enumerate(bpe.Coder(ranks, r"\S+|\s+").encode([t for _, t in rows])))


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = unigram.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [*wild(random.Random(4)), "", "  two  spaces ", "日本語テキスト🙂🙂", "word " * 5000, "x" * 3000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(-1, None, 1)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in unigram.token_counts(df, pieces).collect()}
    assert [got[i] for i in range(len(texts))] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got[-1] == 0
    assert unigram.token_counts(df.limit(0), pieces).collect() == []


def test_ties_go_to_the_earliest_start():
    # "ab"+"c" and "a"+"bc" score alike; the piece that ends later and starts earlier is met first.
    pieces = (("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("c", -2.0), ("▁a", -3.0), ("b", -2.0), ("ab", -4.0), ("bc", -4.0), ("abc", -6.0))
    assert unigram.Counter(pieces).text("abc") == 2
    assert unigram.Counter(pieces).word("▁abc") == 2
