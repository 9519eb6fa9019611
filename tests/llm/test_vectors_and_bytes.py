"""Hard negatives, rank-file BPE and whitening."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import SF001
from tierline.llm import byte_bpe, hard_negatives, oracle, queries, whitening

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# --- hard negatives --------------------------------------------------------------------

def brute_negatives(rows, anchors, k=5):
    """rows: (id or None, label, vector), all usable; anchors: places of rows."""
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for a in anchors:
        aid, label, x = rows[a]
        scored = [(sum(int(p) * int(q) for p, q in zip(x, y)), i, other) for n, (i, other, y) in enumerate(rows) if n != a and len(x) == len(y)]
        for p, pid, _ in sorted((s for s in scored if s[2] == label), key=order)[:k]:
            inside = sorted((s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:k]
            out += [(aid, pid, r + 1, nid, p, s) for r, (s, nid, _) in enumerate(inside)]
    return sorted(out, key=repr)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    for size, block in ((1_024, 1_024), (60, 8)):       # the second: several groups and blocks, salted cells
        monkeypatch.setattr(hard_negatives, "GROUP", size)
        monkeypatch.setattr(hard_negatives, "ANCHORS", block)
        base = rng.integers(-40, 40, (12, 16))
        rows = [(i, int(rng.integers(0, 4)), (base[rng.integers(0, 12)] + rng.integers(-6, 7, 16)).astype(float).tolist()) for i in range(400)]
        rows[100:140] = [(i, i % 4, rows[0][2]) for i in range(100, 140)]      # copies of an anchor: ties
        df = spark.createDataFrame([(i, c, v, "x") for i, c, v in rows], "vec_id long, label int, v array<double>, score string")
        got = hard_negatives.mine(df, "vec_id", F.col("label"), F.col("v"), F.col("vec_id") % 10 == 0).collect()
        want = brute_negatives(rows, [i for i in range(400) if i % 10 == 0])
        assert sorted(map(tuple, got), key=repr) == want and len(want) > 100


def test_bounds_spare_scores_and_lose_nothing():
    rng = np.random.default_rng(6)
    centres = rng.integers(-60, 60, (20, 32))
    vectors = (centres[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, (3000, 32))).astype(float)
    anchors, labels = vectors[:200], rng.integers(0, 5, 3000)
    full = vectors @ anchors.T
    ranges = [[(int(0.8 * p), int(p))] for p in np.sort(full, axis=0)[-5]]
    counts = {}
    for a, _, at, scores in hard_negatives.negatives_of(vectors, labels, anchors, labels[:200], ranges, np.zeros(3000, dtype=bool), np.arange(3000), 5, counts):
        (lo, hi), = ranges[a]
        ok = [i for i in range(3000) if labels[i] != labels[a] and lo <= full[i, a] <= hi]
        assert at.tolist() == sorted(ok, key=lambda i: (-full[i, a], i))[:5] and scores.tolist() == full[at, a].tolist()
    assert counts["pairs"] == 600_000 and counts["scored"] < 0.2 * counts["pairs"]


def test_hard_negatives_of_messy_rows(spark):
    rows = [(0, 1, [3.0, 1.0]), (1, 1, [3.0, 0.0]), (2, 2, [2.0, 2.0]), (3, 2, [2.0, 2.0]), (None, 2, [2.0, 2.0]), (None, 1, [2.9e0 * 0 + 3.0, 0.0]), (4, 1, [3.0]),
            (100, 1, [3.0, 1.0]), (100, 1, [3.0, 1.0]), (200, 9, [2.0 ** 31, 1.0]), (201, 9, [2.0 ** 31, 1.0]), (202, 8, [2.0 ** 31, -1.0]), (300, 5, [-1.0, 0.0]), (301, 5, [1.0, 0.0])]
    bad = [(400, None, [1.0, 1.0]), (5, 2, None), (6, 2, [1.0, None]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]), (500, 1, None)]
    schema = "vec_id long, label int, v array<double>, row string, anchor_id int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], schema)
    got = hard_negatives.mine(df, "vec_id", F.col("label"), F.col("v"), F.col("vec_id") % 100 == 0).collect()
    want = brute_negatives(rows, [n for n, r in enumerate(rows) if r[0] is not None and r[0] % 100 == 0])
    assert sorted(map(tuple, got), key=repr) == want and any(r.negative_id is None for r in got) and any(r.positive_id is None for r in got)
    assert hard_negatives.mine(df.limit(0), "vec_id", F.col("label"), F.col("v"), F.col("vec_id") % 100 == 0).collect() == []
    assert [r.negative_score for r in got if r.anchor_id == 200] == [2 ** 62 - 1]


def test_hard_negatives_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    want = sorted(con.sql(oracle.ORACLES["op11_hard_negatives"]).fetchall())
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, SF001).collect())) == want and want


# --- BPE over rank files ---------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def hashed(texts, library):
    ids = [library.encode_ordinary(t or "") for t in texts]
    return [(len(i), hashlib.sha256(np.array(i, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in zip(ids, texts)]


def test_ids_equal_the_library(library):
    bpe, rng = byte_bpe.load(RANKS, PATTERN), random.Random(3)
    letters = ["abcdefghij", "aab", "etaoinshr ", "\x00\x1c\x85   \t\n", "né😀日本́ß", "0123456789 .,'sl"]
    texts = ["", " ", "a", "<|endoftext|>", "it's we'll \n\n  x", "a" * 257, "ab" * 3000, "  " * 400, "\U0010ffff͸"]
    texts += ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randint(0, 300))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (*range(1, 70), 255, 256, 257, 5000)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert [bpe.decode(x) for x in bpe.encode(texts)] == [t.encode() for t in texts]


def test_long_texts_and_a_full_cache_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART", 64)
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 2_000)
    monkeypatch.setattr(byte_bpe, "CELLS", 256)
    bpe, rng = byte_bpe.ByteBpe(RANKS, PATTERN), random.Random(4)
    texts = [" ".join("".join(rng.choice("aeioutnrs") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    with pytest.raises(ValueError, match="isn't in the rank file"):
        bpe.decode(np.array([50_256], dtype="<u4").tobytes())


def test_million_letters_in_one_piece_take_seconds(library):
    text = "".join(random.Random(1).choice("abcde") for _ in range(300_000))
    bpe = byte_bpe.load(RANKS, PATTERN)
    assert bpe.decode(bpe.encode([text])[0]) == text.encode()


def test_rank_bpe_of_messy_rows(spark, library):
    texts = ["", None, "x" * 300_000, "same text", "same text", "é\n"]
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.digests(df, RANKS, PATTERN).collect()}
    assert got == dict(zip([None, 1, 2, 3, 4, 5], hashed(texts, library)))
    assert byte_bpe.digests(df.limit(0), RANKS, PATTERN).collect() == []
    back = byte_bpe.decoded(byte_bpe.encoded(df, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert {r.doc_id: bytes(r.data) for r in back} == {i or None: (t or "").encode() for i, t in enumerate(texts)}
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.data) for r in byte_bpe.decoded(nulls, RANKS, PATTERN).collect()] == [b"", b""]


def test_query_encodes_all_documents(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_byte_bpe(spark, SF001).collect()}
    pdf = pd.read_parquet(f"{SF001}/documents.parquet")
    assert got == dict(zip(pdf["doc_id"], hashed(pdf["text"], library)))


# --- whitening -------------------------------------------------------------------------

def brute_whitening(vectors, k=4):
    """n, sums, eigenvalues, vectors (columns), trace of the distinct rows, by a dense solver."""
    fit = np.unique(vectors, axis=0)
    centred = fit - fit.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(fit))
    return fit, values[::-1][:k], directions[:, ::-1][:, :k], values.sum()


@pytest.mark.parametrize("values", [[9, 7, 5, 3, 2, 1], [5, 5, 5, 5, 1, 0], [4, 4 - 1e-7, 4 - 2e-7, 1, 1, 1], [1e8, 1, 1e-3, 1e-3, 0, 0], [3, 0, 0, 0, 0, 0], [2] * 6,
                                    list(range(64, 0, -1)), [1 + 1e-3 * i for i in range(40)], [7], [3, 1]])
def test_eigenpairs_of_given_spectra(values):
    values = np.array(sorted(values, reverse=True), dtype=float)
    d = len(values)
    turn, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    tri = whitening.tridiagonal(matrix)
    for shift in np.linspace(-1, values[0] + 1, 37) + 0.0123:
        assert whitening.count_below(tri, shift) == (values < shift).sum()
    for k in (1, 4, d):
        found, vectors = whitening.eigenpairs(matrix, k)
        k = min(k, d)
        assert np.allclose(found, values[:k], atol=1e-13 * values[0] * d)
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10
        assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * values[0] * d
    low, high = values[-1] - 1, values[0] + 1
    with pytest.raises(RuntimeError, match="by inertia"):
        whitening.feast(matrix, low, high, d - 1 if d > 1 else 0)      # a miscount is seen


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(8)
    data = rng.standard_normal((600, 10)) @ np.diag([9, 7, 5, 4, 3, 2, 1, 1, 0.5, 0.1]) * 0.3
    data[500:] = data[0]                                # copies count once in the fit
    rows = [(i, v.tolist(), "x") for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>, n string")
    x = np.floor(256 * data).astype(int)
    fit, values, directions, trace = brute_whitening(x)
    got = whitening.whiten(df, F.col("e")).collect()
    assert len(got) == 2400 and {r.n for r in got} == {len(fit)} == {500}
    want = (x - fit.mean(axis=0)) @ directions / np.sqrt(values)
    table = np.full((600, 4), np.nan)
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum((500 * int(v) - int(s)) ** 2 for v, s in zip(x[r.vec_id], fit.sum(axis=0)))
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 and r.identity_error < 1e-9
    assert np.abs(table * np.sign((table * want).sum(axis=0)) - want).max() < 1e-9


def test_whitening_of_messy_rows(spark):
    bad = [(7, None), (8, [1.0, None, 0.0]), (9, [float("nan"), 0.0, 0.0]), (10, [float("-inf"), 0.0, 0.0]), (11, [])]
    schema = "vec_id long, embedding array<double>, component string"
    flat = spark.createDataFrame([(*r, "x") for r in [(1, [0.5, 0.0, 0.25]), (None, [0.0, 0.0, 0.25]), (1, [0.5, 0.0, 0.25]), *bad]], schema)
    got = whitening.whiten(flat, F.col("embedding")).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, int(r.deviation)) for r in got) == sorted((i, c, 2, 128 ** 2) for i in (0, 1, 1) for c in (1, 2, 3))
    assert all((abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12) if r.component == 1 else (r.whitened is None and r.explained == 0) for r in got)
    one = whitening.whiten(flat.where("vec_id = 1"), F.col("embedding")).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(None, None, None, 0)] * 6
    none = whitening.whiten(flat.where("embedding is null"), F.col("embedding"))
    assert none.collect() == [] and none.dtypes == whitening.whiten(flat, F.col("embedding")).dtypes
    with pytest.raises(ValueError, match="several lengths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"), F.col("embedding"))
    huge = whitening.Whitening(1 << 40, [5, 3], np.zeros(0), np.zeros((2, 0)), 0.0)
    assert huge.deviation(np.array([[255, -7]])) == [((255 << 40) - 5) ** 2 + ((-7 << 40) - 3) ** 2]


def test_whitening_query(spark):
    got = queries.op13_whitening(spark, SF001)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    pdf = pd.read_parquet(f"{SF001}/embeddings.parquet")
    x = np.floor(256 * np.stack(pdf["embedding"]).astype(float))
    fit, values, directions, trace = brute_whitening(x)
    want = (x - fit.mean(axis=0)) @ directions / np.sqrt(values)
    table = np.zeros_like(want)
    place = {v: i for i, v in enumerate(pdf["vec_id"])}
    for r in got.collect():
        table[place[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 and r.identity_error < 1e-9
    assert np.abs(table * np.sign((table * want).sum(axis=0)) - want).max() < 1e-8
