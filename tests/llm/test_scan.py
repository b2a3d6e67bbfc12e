import random

import numpy as np
import pyarrow as pa

from vectrace.llm import blobs, scan


def wild(rng, n):
    return [None if rng.random() < 0.1 else "".join(rng.choice("aB zé日🙂\t\n\x0b\x0c\r\x1c\xa0.") for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_words_equal_a_plain_split():
    rng = random.Random(1)
    for kind in (pa.string(), pa.large_string()):
        texts = [*wild(rng, 500), "", None, "W" * 70 + " " + "w" * 70, " ", "x"]
        column = pa.array(["cut off", *texts], kind).slice(1)
        found = scan.words(column)
        split = [(t or "").encode().lower().split() for t in texts]
        assert found.count.tolist() == [len(w) for w in split]
        name = {}
        for word, value in zip((w for ws in split for w in ws), found.hash.tolist(), strict=True):
            assert name.setdefault(word, value) == value
        assert len(set(name.values())) == len(name)
    assert scan.words(pa.array([], pa.string())).count.tolist() == [] == scan.words(pa.array([], pa.string())).hash.tolist()


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(scan, "SLICE_BYTES", 40)
    rng = random.Random(2)
    texts = [*wild(rng, 80), "long " * 50, None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    parts = list(scan.byte_slices(iter([batch, batch.slice(5, 20)]), 1))
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(len(texts)), *range(5, 25)]
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 40 for p in parts)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        numbers = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert blobs.unpress(blobs.press(numbers)).tolist() == numbers.tolist()
        data = rng.integers(0, 256, n, dtype=np.uint8)
        assert blobs.loosen(blobs.squeeze(data)).tolist() == data.tolist()
    code = np.sort(rng.integers(0, 1 << 62, 500, dtype=np.uint64))
    runs = list(blobs.cut(code, 7))
    assert [a for _, a, _ in runs] == [0, *(b for _, _, b in runs[:-1])] and runs[-1][2] == 500
    assert [k for k, _, _ in runs] == sorted({k for k, _, _ in runs}) and all(0 <= k < 7 for k, _, _ in runs)
