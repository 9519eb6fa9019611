"""Operators over documents: brute-force versions on small tables, and rows that real corpora hold."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tests.conftest import SF001, rows
from tierline.llm import bpe, linking, mixing, near_dedup, quality_rules, sharding, substring_dedup, toxicity
from tierline.llm.shared import WORD_RE, lowered, word_hashes

PATH = corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER)

# The columns of documents and others whose names the operators use inside.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       *[T.StructField(c, T.StringType()) for c in ("id", "size", "rate", "copies", "row", "doc", "spans", "new", "p", "shard", "bucket")]])


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def messy_rows():
    base, long = prose(80, 1), prose(9000, 2)
    passage = prose(60, 3)
    near = base.split()
    near[40] = "changed"
    texts = [(1, base, "a"), (2, base, "a"), (3, " ".join(near), "b"), (4, None, "b"), (5, "", None), (6, " \n\t ", "a"), (7, long, "a"),
             (8, "one", "b"), (9, "one", None), (10, "x" * 40_000, "b"), (11, prose(30, 4) + " " + passage + " " + prose(30, 5), "a"),
             (12, prose(25, 6) + "\n" + passage.upper() + " " + prose(9, 7), "b"), (None, base, "a"), (None, None, None), (1, base, "a"),
             (13, prose(100, 8), None), (14, "the " * 300, "c"), (15, "<|endoftext|> 'll é   \U0001f600 don't", "c")]
    return [(i, t, "en", s, None if t is None else len(t), *["x"] * 11) for i, t, s in texts]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD_RE.findall(text or "")


# --- mixing ------------------------------------------------------------------------

def water_fill(sizes, weights, cap):
    out, open_, total = {}, dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [weights[k % len(weights)] for k in range(len(sizes))])), sum(sizes.values())
    while open_:
        level = (total - sum(out.values())) / sum(open_.values())
        over = [s for s, w in open_.items() if level * w > cap * sizes[s]]
        if not over:
            return out | {s: level * w for s, w in open_.items()}
        for s in over:
            out[s] = cap * sizes[s]
            del open_[s]
    return out


def test_mix_meets_targets_and_cap(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = mixing.mix(docs).collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size and r.rate <= 3
    want = water_fill(sizes, (5, 2, 1), 3)
    asked = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        asked[r.source] = asked.get(r.source, 0) + r.size * r.rate
    for s in sizes:
        assert asked[s] == pytest.approx(want[s], rel=1e-6)  # the dual is solved
        assert taken[s] == pytest.approx(want[s], rel=0.1)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_of_messy_rows(messy, empty):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    assert {r.doc_id: r.size for r in rows if r.doc_id in (4, 5, 6, 8)} == {4: 0, 5: 0, 6: 0, 8: 1}
    assert mixing.mix(empty).collect() == []
    out = mixing.mixed_documents(messy)
    assert out.columns == messy.columns and out.count() == sum(r.copies for r in rows)


# --- sharding ----------------------------------------------------------------------

def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.array([*range(3000), (1 << 64) - 1], dtype=np.uint64)
    for n in (1, 2, 8, 9, 100):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    eight, nine = sharding.jump_hash(keys, 8), sharding.jump_hash(keys, 9)
    assert set(nine[eight != nine]) == {8}


def test_shards(messy, empty):
    rows = sharding.shard(messy, 8).collect()
    assert len(rows) == messy.count()
    for k in range(8):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    texts = dict((r[0], r[1]) for r in messy_rows())
    for r in rows:
        assert r.shard == jump((r.doc_id or 0), 8) and r.grown_shard == jump((r.doc_id or 0), 9)
        if r.doc_id is not None:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert sharding.shard(empty, 8).collect() == []


# --- quality rules ---------------------------------------------------------------------

def measures(text):
    text, w = text or "", words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    again = {g for g in grams if grams.count(g) > 1} if len(grams) < 400 else {g for g in set(grams) if grams.count(g) > 1}
    hit = {i + k for i, g in enumerate(grams) if g in again for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_ledger(spark, empty):
    texts = [r[1] for r in messy_rows() if r[0] != 7] + ["a b c d e f a b c d e f", "x y z\nx y z\n\n \nx y z\r", "### $$$ %%", "a a a a a a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    book = quality_rules.ledger(docs)
    for r in book.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(texts[r.doc_id]), texts[r.doc_id]
    kept = {(r.policy, r.without): r.kept for r in quality_rules.ablation(book).collect()}
    failed = [r.failed for r in book.collect()]
    for (policy, without), n in kept.items():
        mask = quality_rules.mask(x for x in quality_rules.POLICIES[policy] if x != without)
        assert n == sum(f & mask == 0 for f in failed)
    assert quality_rules.verdicts(empty).collect() == []


# --- near duplicates -------------------------------------------------------------------

def brute_components(texts, pct=75):
    low = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for i, t in texts:
        w = words((t or "").translate(low))
        sets[i] = sets.get(i, set()) | ({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= pct * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for group in range(25):
        base = prose(rng.choice([1, 3, 6, 20, 60, 200]), 100 + group).split()
        for _ in range(rng.choice([1, 2, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = "new" + str(rng.random())
            rows.append((n, " ".join(w)))
            n += 1
    # chains: each is near the next one only
    w = prose(120, 77).split()
    for _ in range(12):
        rows.append((n, " ".join(w)))
        n += 1
        w = w[5:] + prose(5, n).split()
    got = near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_of_messy_rows(messy, empty):
    got = near_dedup.components(messy).collect()
    assert len(got) == messy.count()
    want = brute_components([r[:2] for r in messy_rows() if r[0] is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    out = near_dedup.dedup(messy)
    assert out.columns == messy.columns
    assert {2, 3, 9}.isdisjoint(r.doc_id for r in out.select("doc_id").collect())
    assert near_dedup.components(empty).collect() == [] and near_dedup.dedup(empty).collect() == []


def test_sketch_fills_and_estimates():
    a = np.unique(word_hashes(b" ".join(b"w%d" % i for i in range(1000)))[0])
    b = np.unique(word_hashes(b" ".join(b"w%d" % i for i in range(200, 1200)))[0])
    for elements in (a[:1], a[:3], a[:200], a):
        assert (near_dedup.sketch(elements) != np.uint64((1 << 64) - 1)).all()
    same = (near_dedup.sketch(a) == near_dedup.sketch(b)).mean()
    assert abs(same - 800 / 1200) < 0.15
    # a subset never has a lesser coordinate
    assert (near_dedup.sketch(a[:500]) >= near_dedup.sketch(a)).all()


def test_word_hashes_tell_words_apart():
    rng = random.Random(3)
    long = "x" * 3_000_000
    text = "".join(rng.choice("aZ \t\n\x0b\x0c\r\x1c\x85\xa0\u0130\u212a\x00") for _ in range(20_000)) + f" {long} y{long} {long}y\n" + "w " * 700_000
    data = lowered(text)
    found = WORD_RE.findall(text.translate({i: i + 32 for i in range(65, 91)}))
    hashes, starts = word_hashes(data)
    assert [data[s:s + len(w.encode())].decode() for s, w in zip(starts, found)] == found and len(starts) == len(found)
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))
    assert [len(x) for x in word_hashes(b"") + word_hashes(b" \n")] == [0] * 4


def test_find_links_across_blocks_connects_as_brute_force():
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(40), rng.randint(5, 12))), dtype=np.int64) for _ in range(60)]
    ids = list(range(60))
    for side in (np.zeros(60, int), np.array([i % 2 for i in ids])):
        found = linking.find_links(ids, [i if i > 3 else 0 for i in ids], sets, side, 50)
        label = {i: (i if i > 3 else 0) for i in ids}

        def classes(links):
            parent = dict(label)
            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x
            parent |= {0: 0}
            for a, b in links:
                parent[root(label[a])] = root(label[b])
            return {frozenset(i for i in ids if root(label[i]) == root(label[k])) for k in ids}
        every = [(i, j) for i in ids for j in ids if i < j and (not side.any() or side[i] != side[j])
                 and (c := len(set(sets[i]) & set(sets[j]))) * 100 >= 50 * (len(sets[i]) + len(sets[j]) - c)]
        assert classes(found) == classes(every)


# --- substring dedup -------------------------------------------------------------------

def test_embedded_passage_is_cut_once(messy, empty):
    rows = {r.doc_id: r for r in substring_dedup.trimmed(messy).collect() if r.doc_id is not None}
    texts = {r[0]: r[1] for r in messy_rows()}
    assert rows[11].removed_words == 0 and rows[11].text == texts[11]
    assert rows[12].removed_words == 60 and rows[12].first_doc_ids == [11]
    assert rows[12].text == prose(25, 6) + "\n" + prose(9, 7)
    assert rows[2].text == "" and rows[2].first_doc_ids == [1]
    assert rows[1].removed_words == rows[7].removed_words == rows[13].removed_words == rows[14].removed_words == rows[9].removed_words == 0
    assert rows[3].first_doc_ids == [1] and rows[3].text == ""  # a similar line
    out = substring_dedup.dedup(messy)
    assert out.columns == messy.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert 2 not in kept and kept[12].n_chars == len(kept[12].text) and kept[4].text is None
    assert substring_dedup.trimmed(empty).collect() == [] and substring_dedup.dedup(empty).collect() == []


def test_all_stretches_that_come_again_are_cut(spark):
    rng = random.Random(9)
    passages = [prose(n, 200 + n) for n in (50, 51, 55, 70, 120, 49)]
    rows = [(i, "\n".join(prose(rng.randint(3, 40), 1000 * i + k) + " " + rng.choice(passages) + " " + prose(rng.randint(0, 9), 1000 * i + 500 + k) for k in range(3)))
            for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first, want = {}, {}
    for i, t in rows:
        w = words(t)
        want[i] = set()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k:k + 50]), i) != i:
                want[i] |= set(range(k, k + 50))
    for r in substring_dedup.trimmed(docs, pct=100).collect():
        w = words(dict(rows)[r.doc_id])
        assert words(r.text) == [x for k, x in enumerate(w) if k not in want[r.doc_id]]


def brute_alike(rows):
    """The words of each document that stand in a 50-word stretch that is alike (0.75) to one of an earlier document, and begins and ends as it does."""
    grams = {i: [tuple(w[k:k + 5]) for k in range(len(w) - 4)] for i, t in rows for w in [words(t)]}
    want = {i: set() for i, _ in rows}
    for i, g in grams.items():
        for j in range(i):
            h = grams[j]
            for k in range(len(g) - 45):
                one = g[k:k + 46]
                mine = set(one)
                for m in [m for m in range(len(h) - 45) if one[0] in h[m:m + 3]]:
                    common = len(mine & set(h[m:m + 46]))
                    if 100 * common >= 75 * (92 - common) and one[-1] in h[m + 43:m + 49]:
                        want[i] |= set(range(k, k + 50))
    return want


def test_stretches_alike_are_cut_wherever_they_stand(spark):
    """Against all pairs of 50-word stretches at 0.75 that begin and end alike; passages are wrapped, embedded and edited."""
    rng = random.Random(21)
    passages = [prose(n, 700 + n) for n in (55, 60, 64, 90, 130)]
    rows = []
    for i in range(24):
        w = passages[i % 5].split()
        for k in range(len(w) // 70 + 1 if i >= 5 else 0):
            at = min(30 + 55 * k + rng.randrange(3), len(w) - 12)
            w[at:at + rng.choice([0, 1, 1, 1])] = ["edit%d" % rng.randrange(10 ** 6)]
        if i % 3 == 1:
            w = [x + "\n" * (k % 9 == 8) for k, x in enumerate(w)]  # wrapped over short lines
        rows.append((i, " ".join([prose(rng.randint(3, 40), 9000 + i), *w, prose(rng.randint(0, 30), 9500 + i)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_alike(rows)
    got = {r.doc_id: r for r in substring_dedup.trimmed(docs).collect()}
    assert sum(map(len, want.values())) > 1000 and all(want[i] for i in range(5, 24))
    for i, t in rows:
        w = words(t)
        assert words(got[i].text) == [x for k, x in enumerate(w) if k not in want[i]], i


def test_halves_held_first_elsewhere_hide_no_passage(spark):
    """Documents that come first hold the pieces of a passage far apart; later ones hold it whole, and edited: nothing may hide behind the pieces."""
    rng = random.Random(33)
    rows = []
    for n in (56, 56, 60, 70, 96):
        w = prose(n, 4000 + len(rows)).split()
        k = n // 2 if n < 96 else 48
        rows.append((len(rows), " ".join([prose(9, len(rows)), *w[:k], prose(80, 5000 + len(rows)), *w[k:], prose(9, 6000 + len(rows))])))
        rows.append((len(rows), " ".join([prose(7, len(rows)), *w, prose(5, 7000 + len(rows))])))
        for _ in range(3):
            e = list(w)
            e[rng.randrange(n // 2 - 4, n // 2 + 4)] = "edit%d" % rng.randrange(10 ** 6)
            rows.append((len(rows), " ".join([prose(rng.randint(3, 30), 8000 + len(rows)), *e, prose(5, 9000 + len(rows))])))
    want = brute_alike(rows)
    got = {r.doc_id: r for r in substring_dedup.trimmed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cut = {i: len(words(t)) - len(words(got[i].text)) for i, t in rows}
    assert all(cut[i] <= len(want[i]) for i, _ in rows)
    assert all(len(want[5 * g + 2]) >= 50 and cut[5 * g + 2] == len(want[5 * g + 2]) for g in range(5)), (cut, {i: len(x) for i, x in want.items()})
    assert sum(cut.values()) >= 0.95 * sum(map(len, want.values()))


# --- toxicity --------------------------------------------------------------------------

def test_chain_on_held_out_documents(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic, low = rng.random() < 0.3, rng.random() < 0.3
        w = prose(60, 5000 + i).split() + (["zonkish" + rng.choice("abc"), "flurb"] if toxic else []) + (["buy", "pills"] if low else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, 0 if low else 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels[:400] + labels[:5] + [(None, 1, 1), (7, None, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, known, toxicity.table_categories(known))
    assert chain.categories == ("low_quality", "toxic") and len(chain.models[1].earlier) == 1
    got = {r.doc_id: r for r in toxicity.scores(docs, chain).collect()}
    for i, quality, toxic in labels[400:]:
        assert (got[i].p_toxic >= 0.5) == bool(toxic) and (got[i].p_low_quality >= 0.5) == (quality == 0)


def test_toxicity_of_messy_rows(spark, messy, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(messy, none, toxicity.table_categories(none))
    assert toxicity.clean(messy, chain).count() == messy.count()  # no labels: nothing is toxic
    some = spark.createDataFrame([(1, 1, 1), (7, 1, 0), (11, 0, 0), (13, 1, 0), (4, 1, 0)], none.schema)
    chain = toxicity.train(messy, some, toxicity.table_categories(some))
    assert toxicity.scores(messy, chain).count() == messy.count()
    out = toxicity.clean(messy, chain)
    assert out.columns == messy.columns
    assert toxicity.scores(empty, chain).collect() == []


# --- BPE -------------------------------------------------------------------------------

def test_bpe_equals_the_library(spark, messy, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(PATH)
    own = bpe.load(PATH)
    rng = random.Random(3)
    alphabet = "abcdeABZ éßñ中文😀́  \x85\x1c\t\n\r 0123456789'.,!?-_<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [r[1] or "" for r in messy_rows()] + ["it's we'll I'd", "  two  spaces ", "a" * 5000, "ab" * 2000, " " * 3000, "<|endoftext|><|endoftext|>x"]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == want, t
        assert own.decode(want) == lib.decode(want, skip_special_tokens=False) == t
    for t in texts[:300]:
        data = t.encode()
        assert own.merge_short(data) == own.merge_long(data)
    rows = {r.doc_id: r for r in bpe.digests(messy, PATH).collect()}
    for i, t in [r[:2] for r in messy_rows()]:
        if i is not None:
            ids = lib.encode(t or "", add_special_tokens=False).ids
            assert rows[i].n_tokens == len(ids)
            assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decoded(bpe.encoded(messy, PATH), PATH).collect()}
    assert back[12] == dict(r[:2] for r in messy_rows())[12] and back[4] == ""
    assert bpe.digests(empty, PATH).collect() == []


# --- the pipeline ----------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.cut(stage(spark, before, SF001), f"test-{name}")
        assert after.columns == columns, name
        if name == "near_dedup":
            want = {i for i, (_, c) in brute_components([(r.doc_id, r.text) for r in before.collect()]).items() if i == c}
            assert {r.doc_id for r in after.collect()} == want
        before = after
    assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0
    rows = corpus_pipeline.encode(spark, after, SF001)
    sent = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in after.collect()}
    got = rows.collect()
    assert len(got) == after.count() and all(r.decoded_sha256 == sent[r.doc_id] and len(r.ids) == r.n_tokens for r in got)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").where(F.col("toxic") == 1).collect()}
    assert len(toxic & set(sent)) <= 0.1 * len(toxic)


def test_cells_are_met_whole_and_compared_alike_by_either_way(spark, monkeypatch):
    """Cells run over batches of rows as dealt; the product of small cells finds the links that the index finds; no group is a call of its own."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.choice(40, 25)).astype(np.int64) for _ in range(30)]
    labels = [k % 4 for k in range(30)]
    for side in (np.zeros(30, dtype=int), np.arange(30) % 2):
        found = []
        for dense in (0, 10 ** 6):
            monkeypatch.setattr(linking, "DENSE", dense)
            found.append(linking.find_links(list(range(30)), labels, sets, side, 35))
        assert found[0] == found[1] and found[0]
    cells = pd.DataFrame({"bucket": [1, 1, 1, 2, 2, 5], "i": [0, 0, 1, 0, 0, 0], "id": range(6)})
    for size in (1, 2, 3, 4, 6):
        runs = linking.runs_of((cells.iloc[k:k + size] for k in range(0, 6, size)), ["bucket", "i"])
        assert [list(r["id"]) for r in runs] == [[0, 1], [2], [3, 4], [5]]
    nodes = spark.createDataFrame([(k, 3, [7]) for k in range(4)], "id long, n long, bands array<long>")
    sets = spark.createDataFrame([(k, [1, 2, 3 + k]) for k in range(4)], "id long, elements array<long>")
    buckets = nodes.select("id", F.lit(7).cast("long").alias("bucket"))
    pivots = spark.createDataFrame([(7, 0)], "bucket long, pivot long")
    labels = spark.createDataFrame([], "id long, component long")
    more = linking._rest(buckets, pivots, labels, nodes, lambda ids: sets.join(ids, "id"), 50)
    assert {x for r in more.collect() for x in r} == {1, 2, 3}
    assert "FlatMapGroupsInPandas" not in more._jdf.queryExecution().executedPlan().toString()


def test_first_places_need_no_sorted_aggregate(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = [(int(d), int(k), int(p)) for d, k, p in zip(rng.integers(0, 9, 300), rng.integers(0, 60, 300), rng.integers(0, 99, 300))]
    plans, cut = [], substring_dedup.cut
    monkeypatch.setattr(substring_dedup, "cut", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), cut(df, name))[1])
    got = substring_dedup._beside_first(spark.createDataFrame(data, "doc long, key long, place int"), "key", "keys")
    first, several = {}, {}
    for d, k, p in data:
        first[k] = min(first.get(k, (d, p)), (d, p))
        several.setdefault(k, set()).add(d)
    assert rows(got, "doc", "key", "place", "keeper", "there") == sorted([(d, k, p, *first[k]) for d, k, p in data if len(several[k]) > 1], key=repr)
    assert plans and not any("SortAggregate" in p for p in plans)


def test_texts_are_exchanged_once_and_overlapping_spans_are_one(spark):
    """Joins by the id read the bucketed texts as they lie; a long passage that differs around its middle is a few spans, not one per stretch."""
    passage = prose(400, 77)
    texts = [(i, f"{prose(30, 60 + i)} {passage} {prose(30, 80 + i)}") for i in range(3)] + [(9, None)]
    docs = spark.createDataFrame(texts, "doc long, text string")
    placed = substring_dedup.cut_by(docs, "texts", "doc")
    assert rows(placed) == rows(docs) and not [t for t in spark.catalog.listTables() if t.name.startswith("texts_")]
    asked = spark.createDataFrame([(1, [2])], "doc long, wanted array<long>").groupBy("doc").agg(F.first("wanted").alias("wanted"))
    plan = substring_dedup.by_hash(placed, asked, "doc")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    listed = substring_dedup.cut(substring_dedup.listed(docs, docs.schema["doc"].dataType, 50), "listed")
    found = substring_dedup._equal_stretches(listed, docs, docs.schema["doc"].dataType, 50).collect()
    covered = {i: set() for i in range(3)}
    for r in found:
        assert r.keeper == 0
        covered[r.doc] |= set(range(r.begin, r.end))
    assert covered == {0: set(), 1: set(range(30, 430)), 2: set(range(30, 430))}
    assert len(found) <= 2 * 9  # of one document, one at most for each 50 words that spans begin in


def test_workers_keep_no_pieces_after_a_task(monkeypatch):
    monkeypatch.setattr(bpe, "_over", lambda rows, run, *rest: run)
    for task, given in ((bpe.digests(None, PATH), {"id": ["1"], "x": ["a few words"]}), (bpe.encoded(None, PATH), {"id": ["1"], "x": ["a few words"]})):
        assert len(list(task(iter([pd.DataFrame(given)])))) == 1
        assert not bpe.load(PATH).known
