"""Vector searches against brute force, and archives written and read back."""

from __future__ import annotations

import hashlib
import math
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from commentloom.llm import ann, vafile, warc
from commentloom.llm.hilbert import hilbert_keys

VECTORS = "vec_id bigint, embedding array<double>, label int, v string, _id string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in vectors], VECTORS).repartition(4)


def usable(vectors, zero: bool):
    """One vector for each id, as the docstrings say."""
    out = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or (zero and not any(v)):
            continue
        out[i] = min(out.get(i, v), v)
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(11)
    out = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    out += [(300 + i, out[5][1]) for i in range(40)]  # equal vectors
    out += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None] + [0.0] * 6), (404, [math.nan] * 8)]
    out += [(405, [math.inf] + [1.0] * 7), (None, [1.0] * 8), out[10], (10, [9.0] * 8), (450, [1e6] * 8), (500, [1.0, 2.0])]
    return out


def test_hilbert_keys_are_a_path():
    grid = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    order = np.argsort(hilbert_keys(grid, 3))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_exact_search(spark, vectors):
    got = vafile.top_inner(frame(spark, vectors), 5, F.col("_id") % 50 == 0, block_rows=64, query_rows=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    data = {i: [math.floor(256 * x) for x in v] for i, v in usable(vectors, False).items()}
    want = []
    for q in (i for i in data if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v, data[q], strict=True)), i) for i, v in data.items() if i != q and len(v) == len(data[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_exact_search_of_few_and_none(spark):
    few = frame(spark, [(0, [1.0, -2.0]), (1, [0.5, 0.25]), (50, [3.0, 1.0])])
    assert vafile.top_inner(few, 5, F.col("_id") % 50 == 0).count() == 4
    assert vafile.top_inner(few.limit(0), 5, F.col("_id") % 50 == 0).count() == 0


def test_neighbours(spark, vectors):
    got = ann.nearest(frame(spark, vectors), 10, F.col("_id") % 20 == 0, block_rows=16, query_rows=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    data = {i: np.array(v) for i, v in usable(vectors, True).items() if len(v) == 8}
    hits = total = 0
    rows: dict[int, list] = {}
    for r in sorted(map(tuple, got.collect())):
        rows.setdefault(r[0], []).append(r)
    assert set(rows) == {i for i in data if i % 20 == 0}
    for q, mine in rows.items():
        want = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        assert [r[1] for r in mine] == list(range(1, len(mine) + 1))
        assert all(r[3] == float(np.sqrt(((data[r[2]] - data[q]) ** 2).sum())) for r in mine)
        assert [(r[3], r[2]) for r in mine] == sorted((r[3], r[2]) for r in mine)
        hits += len({r[2] for r in mine} & {i for _, i in want})
        total += len(want)
    assert hits / total >= 0.9
    assert [r[2] for r in rows[300]] == [5, *range(301, 310)]  # equal vectors: the smallest ids


def test_neighbours_of_table_and_none(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = ann.nearest(df, 10, F.col("_id") % 100 == 0).collect()
    data = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    hits = 0
    for q in {r.query_id for r in got}:
        want = sorted((float(((v - data[q]) ** 2).sum()), i) for i, v in data.items() if i != q)[:10]
        hits += len({r.vec_id for r in got if r.query_id == q} & {i for _, i in want})
    assert hits / len(got) >= 0.9
    assert ann.nearest(df.limit(0), 10, F.col("_id") % 100 == 0).count() == 0


def recall(spark, vectors, queries, k=10):
    """Mean share of each query's true neighbours that are found; every query is answered."""
    got = {}
    for r in ann.nearest(frame(spark, vectors), k, F.col("_id").isin(queries)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    data, shares = {i: np.array(v) for i, v in vectors}, []
    for q in queries:
        far = sorted((float(((v - data[q]) ** 2).sum()), i) for i, v in data.items() if i != q and len(v) == len(data[q]))[:k]
        shares.append(len(got.get(q, set()) & {i for _, i in far}) / max(1, len(far)))
    return np.mean(shares)


def test_neighbours_of_every_width(spark):
    """Two fifths have another width; both widths' queries are answered, from their own width."""
    rng = np.random.default_rng(7)
    vectors = [(i, rng.normal(size=24 if i % 5 < 2 else 16).tolist()) for i in range(1000)] + [(5000, [1.0, 2.0, 3.0])]
    for width in (16, 24):
        assert recall(spark, vectors, [i for i, v in vectors if len(v) == width][:60]) >= 0.9
    assert ann.nearest(frame(spark, vectors), 10, F.col("_id") == 5000).count() == 0


@pytest.mark.parametrize("offset", [1e4, -3e6])
def test_neighbours_far_from_the_origin(spark, offset):
    """Squares of the offset have no digits left for the distances."""
    rng = np.random.default_rng(3)
    x = offset + 1e-4 * rng.normal(size=(2000, 32))
    assert recall(spark, list(enumerate(x.tolist())), list(range(0, 2000, 40))) >= 0.9


def test_candidates_of_a_hot_vector_do_not_grow_with_its_copies(spark):
    """A third of the vectors are equal: only k + 1 of them are indexed."""
    rng = np.random.default_rng(2)
    counts = []
    for n in (600, 1200):
        x = rng.normal(size=(n, 8))
        x[::3] = x[0]
        vectors = vafile.one_per_id(frame(spark, list(enumerate(x.tolist()))), "vec_id", "embedding")
        indexed = vafile.few_twins(vectors, 6)
        assert indexed.count() == n - len(x[::3]) + 6
        codes = vafile._codes(indexed, -2000.0, 16.0)
        asked = vectors.where("_id % 50 = 0")
        counts.append(vafile.bounded_candidates(codes, asked, 5, -2000.0, 16.0, 2, 1).where("vec_id % 3 = 0").count() / (n / 50))
    assert counts[1] < 1.3 * counts[0]


@pytest.mark.parametrize("radius", [1e-5, 1e-3])
def test_neighbours_in_a_tight_cluster(spark, radius):
    """A third of the vectors lie in one place of every curve, which spans more ranges than three."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x[::3] = x[0] + radius * rng.normal(size=(1000, 64))
    got = ann.nearest(frame(spark, list(enumerate(x.tolist()))), 10, F.col("_id") % 50 == 0).collect()
    hits = {True: [], False: []}
    for q in range(0, 3000, 50):
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        want = set(np.argsort(far)[:10].tolist())
        hits[q % 3 == 0].append(len(want & {r.vec_id for r in got if r.query_id == q}) / 10)
    assert np.mean(hits[True]) >= 0.9 and np.mean(hits[False]) >= 0.9, {k: np.mean(v) for k, v in hits.items()}


# ---- archives

PAGES = "page_id bigint, url string, html string, payload string"


def test_archives(spark):
    big = "<p>" + "ü" * 80 + "</p>"
    data = [(5, "http://a/x y\r\nz", big), (3, None, big), (9, "u", big), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", "")]
    data += [(None, "u", big), (7, "u", "<b>" + "long " * 4000), (3, None, big), (None, None, None)]
    pages = spark.createDataFrame([(*d, "clash") for d in data], PAGES).repartition(3)
    got = warc.round_trip(pages, archive_bytes=200)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = []
    for i, _, html in data:
        raw = (html or "").encode()
        again = html == big and i != 3
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    folder, manifest = warc.write_archives(pages, archive_bytes=200)
    assert manifest.count() > 1
    back = warc.read_archives(spark, folder, manifest, payloads=True).where("record_type = 'response'").collect()
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest for r in back)
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(records: list[bytes], raw: bytes = b"dictionary content") -> bytes:
    encoder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    return warc.dictionary_frame(raw) + b"".join(map(encoder.compress, records))


HEAD = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Date": "2024-01-01T00:00:00Z"}


def test_reader_accepts_plain_and_compressed_dictionaries():
    record = warc.build_record(HEAD, b"body")
    data = archive([record, record])
    assert [b for _, b in warc.read_archive(data)] == [b"body"] * 2
    raw = b"dictionary content"
    plain = struct.pack("<II", warc.DICT_FRAME, len(raw)) + raw + data[len(warc.dictionary_frame(raw)) :]
    assert [b for _, b in warc.read_archive(plain)] == [b"body"] * 2


@pytest.mark.parametrize("size", [0, 1, 300, 200_000])
def test_frames_end_where_they_end(size):
    body = np.random.default_rng(size).integers(0, 256, size, np.uint8).tobytes()
    frames = [zstandard.ZstdCompressor(write_checksum=c, write_content_size=s).compress(body) for c in (0, 1) for s in (0, 1)]
    data, at = memoryview(b"".join(frames)), 0
    for f in frames:
        at = warc.frame_end(data, at)
        assert data[:at] == b"".join(frames)[:at] and at >= len(f)
    assert at == len(data)


def test_reader_rejects_damage():
    record = warc.build_record(HEAD, b"body")
    good = archive([record])
    digest = HEAD | {"WARC-Payload-Digest": "sha256:" + "0" * 64}
    bad = [
        good[:-2],
        good[8:],
        b"",
        archive([b"WARC/0.9" + record[8:]]),
        archive([record.replace(b"Content-Length: 4", b"Content-Length: 5")]),
        archive([record.replace(b"WARC-Date", b"Other-Dat")]),
        archive([warc.build_record(digest, b"body")]),
        archive([warc.build_record(HEAD | {"Payload-Length": "5"}, b"body")]),
        good[:-6] + bytes([good[-6] ^ 1]) + good[-5:],
    ]
    for data in bad:
        with pytest.raises(ValueError):
            list(warc.read_archive(data))
