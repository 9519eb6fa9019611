"""Registered queries on the whole sf0.001 tables against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from tests.conftest import SF001
from tierline.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _documents():
    pdf = pd.read_parquet(f"{SF001}/documents.parquet")
    return {int(i): (t if isinstance(t, str) else None, s if isinstance(s, str) else None) for i, t, s in zip(pdf["doc_id"], pdf["text"], pdf["source"])}


def test_mixing_keeps_its_constraints(spark):
    docs = _documents()
    got = {r.doc_id: r for r in queries.op1_mixing(spark, SF001).collect()}
    assert set(got) == set(docs)
    size = {i: len(WORD.findall(t or "")) for i, (t, _) in docs.items()}
    of = Counter()
    for i, (_, s) in docs.items():
        of[s] += size[i]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight, target, open_ = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, set(names)
    while True:     # targets above 3 times their source's size stop there, the rest share again
        left = sum(of.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * of[s]}
        if not over:
            break
        target |= {s: 3 * of[s] for s in over}
        open_ -= over
    target |= share
    taken = Counter()
    for i, r in got.items():
        assert (r.size, r.source_size) == (size[i], of[docs[i][1]]) and abs(r.target - target[docs[i][1]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[docs[i][1]] += r.taken
    longest = Counter()
    for i, (_, s) in docs.items():
        longest[s] = max(longest[s], size[i])
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 2 * longest[s]) for s in names)


def test_shards_follow_the_key(spark):
    docs = _documents()
    got = queries.op2_sharding(spark, SF001).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots = {}
    for r in got:
        raw = None if docs[r.doc_id][0] is None else docs[r.doc_id][0].encode()
        assert r["size"] == 1 + len(raw or b"") and (raw is None or r.text_crc32 == zlib.crc32(raw))
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_components_equal_all_pairs(spark):
    sets = {}
    for i, (t, _) in _documents().items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    at = {i: i for i in sets}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                at[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op8_near_dedup(spark, SF001).collect()}
    assert got == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_tokens_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    library.no_truncation()
    library.no_padding()
    want = {}
    for i, (t, _) in _documents().items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_bpe(spark, SF001).collect()}
    assert got == want
