"""Registered queries over whole tables of sf0.001 against plain Python (those with SQL are compared in ``test_catalog``)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from quarry.llm import packing, quality
from quarry.llm.queries import QUERIES, URL_RULES

DIR = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{DIR}/{name}.parquet").select(*columns).collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return dict(rows(spark, "documents", "doc_id", "text"))


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", name).group(1)) for name in QUERIES] == list(range(1, 14))


def test_op2(spark):
    got = {r.page_id: r for r in QUERIES["op2_url_filter"](spark, DIR).collect()}
    pages = dict(rows(spark, "pages", "page_id", "url"))
    assert set(got) == set(pages)
    for i, url in pages.items():
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(FOLD)
        fits = [(len(r), r, v) for v, r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.split("/", 1)[1])]
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, max(fits)[1] if fits else None)
        assert got[i].verdict == max(fits)[2] if fits else got[i].verdict in ("allow", "block") and got[i].score is not None


def test_op3(spark):
    got = QUERIES["op3_mixing"](spark, DIR).collect()
    docs = {i: (t, s) for i, t, s in rows(spark, "documents", "doc_id", "text", "source")}
    sizes = Counter()
    for t, s in docs.values():
        sizes[s] += len(words(t))
    assert len(got) == len(docs)
    for r in got:
        size = len(words(docs[r.doc_id][0]))
        assert r.size == size and r.source_size == sizes[docs[r.doc_id][1]] and r.taken == r.copies * size and 0 <= r.copies <= 3
    for source in sizes:
        own = [r for r in got if docs[r.doc_id][1] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert own[0].target <= 3 * own[0].source_size + 1e-6
    assert math.isclose(sum({docs[r.doc_id][1]: r.target for r in got}.values()), sum(sizes.values()))
    assert sorted(got) == sorted(QUERIES["op3_mixing"](spark, DIR).collect())


def check_pieces(got):
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins)


def test_op5(spark, documents):
    got = QUERIES["op5_best_fit_packing"](spark, DIR).collect()
    tokenizer = packing.WordTokenizer(packing.vocabulary_path()).tokenizer
    want = Counter()
    for i, text in documents.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            want[i, k, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert check_pieces(got) <= math.ceil(sum(r.length for r in got) / 2048) * 1.03


def test_op6(spark):
    turns = defaultdict(list)
    for c, n, role, text in rows(spark, "conversations", "conv_id", "turn", "role", "text"):
        turns[c].append((n, role or "", text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in QUERIES["op6_chat_windows"](spark, DIR).collect()}
    assert set(got) == set(turns)
    for c, own in turns.items():
        learned = "".join(t for _, role, t in sorted(own) if role == "assistant")
        text = "".join(f"{role}\n{t}\n" for _, role, t in sorted(own))
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (text, learned)]
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(own), sha[0], len(learned), sha[1])
        assert got[c].formatted_chars >= len(text)


def test_op7(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op7_ppm_scores"](spark, DIR).collect()}
    counts, ends = Counter(), 0
    train = {i for i in documents if zlib.crc32(str(i).encode()) % 10}
    for i in train:
        counts.update(words((documents[i] or "").translate(FOLD)))
        ends += 1
    total = sum(counts.values()) + ends
    kinds = len(counts) + 1
    assert set(got) == set(documents)
    for i, text in documents.items():
        own = [counts[w] for w in words((text or "").translate(FOLD))] + [ends]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in own)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i not in train, len(own), sum(c > 0 for c in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0


def test_op8(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op8_simhash_near_dedup"](spark, DIR).collect()}
    prints = {}
    for i, text in documents.items():
        w = words((text or "").translate(FOLD))
        grams = [" ".join(w[j:j + 4]) for j in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64)
        prints[i] = sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(grams))
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints and all(len(r.fingerprint) == 16 for r in got.values())
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert {i: r.component_id for i, r in got.items()} == {i: find(i) for i in ids}


def test_op10(spark):
    table = {i: v for i, v in rows(spark, "embeddings", "vec_id", "embedding")}
    usable = {i: v for i, v in table.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(usable))
    x = np.array([usable[i] for i in ids], float)
    got = defaultdict(list)
    for r in QUERIES["op10_kmeans_tree_search"](spark, DIR).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = dict(zip(ids.tolist(), (x @ x[np.searchsorted(ids, q)]).tolist()))
        best = sorted((i for i in score if i != q), key=lambda i: (-score[i], i))[:20]
        found.sort()
        assert [k for k, _, _ in found] == list(range(1, 21)) and all(math.isclose(score[i], s, rel_tol=1e-12) for _, i, s in found)
        assert [i for _, i, _ in found] == [i for _, i, _ in sorted(found, key=lambda f: (-f[2], f[1]))]
        hits += len({i for _, i, _ in found} & set(best))
    assert hits >= 0.9 * 20 * len(got)


def test_pipeline_run(spark, documents):
    import corpus_pipeline as cp
    got = cp.run(spark, DIR).collect()
    check_pieces(got)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    clean = {r.doc_id for r in quality.judge(docs, lang="lang").where("kept").select("doc_id").collect()}
    ids = {r.doc_id for r in got}
    assert ids and ids <= clean
    component = {r.doc_id: r.component_id for r in QUERIES["op8_simhash_near_dedup"](spark, DIR).collect()}
    assert len({component[i] for i in ids}) == len(ids)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.piece].append((r.start, r.length, r.ids_crc32))
    assert all(1 <= len(v) <= 3 and len(set(v)) == 1 for v in pieces.values())  # whole copies, at most three of a document
