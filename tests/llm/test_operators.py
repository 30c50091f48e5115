"""Each operator against brute force on a small table with nulls, ties, repeated rows and clashing names."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import ann, chat, digests, licenses, lm, mixing, packing, quality, resampling, simhash, substring, urls
from quarry.llm.common import connected_components
from quarry.session import scratch_path


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_licenses_match_exact_containment(docs, empty):
    got = {(r.doc_id, r.license): (r.containment, r.first_word) for r in licenses.scan(docs).collect()}
    assert got == {(45, "mit-line"): (1.0, 0)}
    assert licenses.scan(empty).count() == 0
    assert licenses.collision_probability(0.19) > 0.99999
    with pytest.raises(ValueError):
        licenses.scan(docs, {"short": "two words"})


def test_versions_and_families_are_told_apart(spark):
    names = ["gpl-2.0-line", "gpl-3.0-line", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "cc0-1.0", "epl-2.0", "unlicense"]
    rows = [(i, "some words before. " * i + licenses.TEMPLATES[n] + " and after it " * 9) for i, n in enumerate(names)]
    rows.append((99, licenses.TEMPLATES["gpl-2.0-line"] + " filler" * 80 + " " + licenses.TEMPLATES["gpl-3.0-line"]))
    got = defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].add(r.license)
    for i, n in enumerate(names):
        assert n in got[i] and got[i] <= {n, "gpl"}, (n, got[i])
    assert got[99] == {"gpl-2.0-line", "gpl-3.0-line"}


def test_license_scan_finds_all_partial_copies(spark):
    notice = licenses.TEMPLATES["mit"].split()
    rows = [(i, " ".join(["filler%d" % j for j in range(i * 3)] + notice[:len(notice) * (70 + i) // 100] + ["end"] * 50)) for i in range(31)]
    got = {r.doc_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("license = 'mit'").collect()}
    shingles = len(notice) - 4
    want = {i for i in range(31) if (len(notice) * (70 + i) // 100 - 4) / shingles >= 0.8}
    assert abs(len(got) - len(want)) <= 1 and got <= want | {min(want) - 1}


def test_url_rules_and_models(spark):
    rules = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))
    rows = ["http://a.com/x", "http://EXAMPLE.com/en/1?q", "https://www.example.com/en/2", "http://x.net/es/1", "http://x.net/de/1",
            "no scheme", None, "http://com", "http://acom/x", "http://a.com?x", "://a.com/p#f", "http://u.com/en/a://b"]
    rows += [f"http://good{i}.com/nice/{i}" for i in range(40)] + [f"http://bad{i}.net/es/spam/{i}" for i in range(40)]
    df = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(rows)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(df, rules).collect()}
    assert [got[i].url_rule for i in range(4)] == ["com/", "example.com/en/", "www.example.com/en/", "net/es/"]
    assert [got[i].url_verdict for i in range(4)] == ["allow", "block", "allow", "block"]
    assert (got[5].url_host, got[5].url_path, got[6].url_host, got[6].url_verdict) == ("", "", "", got[5].url_verdict)
    assert (got[7].url_rule, got[8].url_rule, got[9].url_rule, got[10].url_rule) == (None, None, None, "com/")
    assert got[4].url_score is not None and got[0].url_score is None
    assert got[5].url_score == got[6].url_score == 0.0  # judged by the model like any other
    assert urls.judge(df.where("false"), rules).count() == 0
    assert {r.url_verdict for r in urls.judge(df.where("page_id in (0, 4)"), rules).collect()} == {"allow"}


def test_no_single_url_displaces_the_sample(spark):
    def rows(texts, accepted):
        return spark.createDataFrame([(t, accepted) for t in texts], "text string, accepted boolean")

    first = F.xxhash64("text", F.lit(5))
    good, bad = rows([f"good{i}.com/nice" for i in range(10, 100)], True), rows([f"bad{i}.net/spam" for i in range(40)], False)
    hot = good.orderBy(first).limit(1).crossJoin(spark.range(200)).select("text", "accepted")
    ratio, _ = urls.fit(good.unionByName(hot).unionByName(bad), sample_rows=20)
    assert len(ratio.accepted.next[b"good"]) > 1
    long = rows([f"good.com/{i}" + "x" * 5000 for i in range(3000)], True).orderBy(first).limit(1)
    assert long.select(first).first()[0] < good.agg(F.min(first)).first()[0]
    ratio, _ = urls.fit(good.unionByName(long).unionByName(bad), sample_bytes=4000)
    assert len(ratio.accepted.next[b"good"]) > 1


def test_byte_model_is_a_distribution_and_separates():
    good, bad = [b"good/%d/page" % i for i in range(50)], [b"spam/x%d/win" % i for i in range(50)]
    m = urls.ByteModel(good, 5)
    for context in (b"", b"good/", b"zzz", b"od"):
        assert math.isclose(sum(m.probability(context, c) for c in range(256)), 1.0, rel_tol=1e-9)
    ratio = urls.Ratio(m, urls.ByteModel(bad, 5))
    a, b = ratio([b"good/777/page", b"spam/x777/win"])
    assert a > 0 > b and b < urls.threshold([a, b], [True, False]) < a


def test_mixing_meets_targets(docs, empty):
    rows = mixing.mix(docs).collect()
    size = lambda t: len(split(t))
    assert len(rows) == docs.count() and all(r.mix_size == size(r.text) for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r.source] += r.mix_size
    names = sorted((s for s in sums if s is not None)) + [None]
    weight, left, open_, target = dict(zip(names, (5, 2, 1, 5))), sum(sums.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sums[s]}
        for s in over or set(open_):
            target[s] = 3.0 * sums[s] if over else level * weight[s]
            left -= target[s]
        open_ -= over or set(open_)
    most = max(r.mix_size for r in rows)
    for s in names:
        own = [r for r in rows if r.source == s]
        assert all(math.isclose(r.mix_target, target[s], rel_tol=1e-9) and r.mix_source_size == sums[s] for r in own)
        assert abs(sum(r.mix_taken for r in own) - target[s]) <= most / 2 + 1
        assert all(r.mix_taken in (0, r.mix_size, 2 * r.mix_size, 3 * r.mix_size) for r in own)
        assert len({r.mix_copies for r in own if r.mix_size}) <= 2
    again = {(r.doc_id, r.text): r.mix_taken for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.text): r.mix_taken for r in rows}
    assert mixing.mix(empty).count() == 0


def test_equal_rows_are_taken_one_by_one(spark):
    rows = [(1, "a " * 50, "x", 1.5, "p")] * 300 + [(i, "b " * 50, "x", 2.5, "q") for i in range(2, 102)] + [(0, "c " * 4000, "y", 0.0, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target double, `key_b` string").repartition(7)
    got = mixing.mix(df, weights=(1.0, 1.0))
    assert got.columns == [*df.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken"]
    rows = got.collect()
    assert len(rows) == 401 and Counter((r.doc_id, r.target) for r in rows) == Counter((r[0], r[3]) for r in df.collect())
    for source in "xy":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.mix_taken for r in own) - own[0].mix_target) <= own[0].mix_size / 2 + 1
    again = Counter((r.doc_id, r.mix_copies) for r in mixing.mix(df, weights=(1.0, 1.0)).collect())
    assert again == Counter((r.doc_id, r.mix_copies) for r in rows)
    with pytest.raises(ValueError):
        mixing.mix(df.withColumn("mix_key", F.lit(1)))


NAMES = ("a.b", "target", "size_b", "source_size", "key_b", "high_b", "before", "length", "start", "host", "score", "n_words")


def test_extra_columns_keep_their_names_and_values(spark, docs):
    import corpus_pipeline as cp
    base = docs.drop("n_words").limit(40)
    df = base.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES])

    def check(out, *without):
        rows, names = out.collect(), [n for n in NAMES if n not in without]
        assert rows and set(names) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        at = {n: out.columns.index(n) for n in names}
        assert all(r[at[n]] == f"{n}:{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in names)

    check(mixing.mix(df))
    check(quality.judge(df, prefix="rule_"))
    check(urls.judge(df.withColumnRenamed("text", "url"), (("allow", "com/"),)))
    check(substring.dedup(df))
    check(packing.pack(df.drop("length", "start"), keep=[n for n in NAMES if n not in ("length", "start")]), "length", "start")
    check(resampling.resample(df, base.select("text")))
    check(digests.deliver(df, digests.DigestIndex(spark, scratch_path(spark, "names")), 1))
    table = df.withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long")})
    for _, stage in cp.STAGES[:-1]:
        table = stage(spark, table, "")
        check(table)


def test_quality_counts(docs, empty):
    with pytest.raises(ValueError):
        quality.judge(docs)
    rows = quality.judge(docs, prefix="q_").collect()
    assert len(rows) == docs.count() and quality.judge(empty, prefix="q_").count() == 0
    for r in rows:
        w, t = split(r.text), r.text or ""
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if split(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert (r.q_n_words, r.q_word_chars, r.q_n_symbols, r.q_n_dup_lines, r.q_n_repeat_words) == want
        assert r.q_base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.q_base_failed and r.q_kept)


def test_packing_round_trip(docs, empty):
    tokenizer = packing.WordTokenizer(packing.vocabulary_path())
    rows = packing.pack(docs, tokens=256, documents=8, keep=["source"]).collect()
    bins = defaultdict(list)
    texts = Counter()
    pieces = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256 and len(b) <= 8
    for d in docs.collect():
        texts[np.array([*tokenizer.tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    single = {k: b"".join(p.ids for p in sorted(v, key=lambda p: p.start)) for k, v in pieces.items() if k not in (5, None)}
    assert all(texts[v] for v in single.values()) and len(single) == docs.where("doc_id not in (5)").count()
    assert packing.pack(empty).count() == 0


def test_tokenizer_equals_the_library():
    tokenizer = packing.WordTokenizer(packing.vocabulary_path())
    odd = ["", "a\tb c d\x85e\x1cf  g \x01 h\x01", "Été ΑΣ. it's I'LL <|endoftext|>x <|startoftext|>", "é ́x", "日本 語1234 ½ ﬁ",
           "ªº µ ² İstanbul ŉ a-b c.d (e) 'tis 12.5%", "x" * 3000, "Word, word. word! (word)"]
    for t, raw in zip(odd, tokenizer.encode(odd)):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_holds_every_capacity(score):
    rng = np.random.default_rng(1)
    length = rng.integers(1, 100, 500)
    items = np.stack([length, np.ones(500), length ** 2.0], axis=1)
    capacity = np.array([100, 5, 6000.0 + 100 ** 2])
    where, n = packing.best_fit(items, capacity, np.array([1, 0.1, 0.1]), score)
    for b in range(n):
        assert (items[where == b].sum(axis=0) <= capacity + 1e-6).all() and (where == b).any()


def test_packing_does_not_depend_on_partitions(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")

    def count(parts):
        rows = packing.pack(table.repartition(parts, "doc_id")).select("sequence_id", "offset", "length").collect()
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for b in bins.values():
            assert [o for o, _ in sorted(b)] == [0, *np.cumsum([n for _, n in sorted(b)])[:-1]] and sum(n for _, n in b) <= 2048
        return len(bins), len(rows), sum(r.length for r in rows)

    one, many = count(1), count(100)
    assert one[1:] == many[1:] and many[0] <= one[0] + 1 and one[0] <= math.ceil(one[2] / 2048) * 1.02
    with pytest.raises(ValueError):
        packing.pack(table.withColumn("length", F.lit(1)), keep=["length"])


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_equals_trying_every_bin(score):
    rng = np.random.default_rng(8)
    items = np.stack([rng.integers(1, 60, 400), np.ones(400), rng.integers(1, 40, 400)], axis=1).astype(float)
    capacity, weights = np.array([100.0, 6.0, 70.0]), np.array([1.0, 0.5, 0.25])
    size, bins, want = items / capacity, [], np.empty(400, int)
    for i in sorted(range(400), key=lambda i: -size[i].max()):
        fits = [b for b in range(len(bins)) if (bins[b] >= size[i] - 1e-12).all()]
        worth = {b: (((bins[b] - size[i]) ** 2) @ weights if score == "norm" else -((bins[b] * size[i]) @ weights)) for b in fits}
        if not fits:
            bins.append(np.ones(3))
        want[i] = min(fits, key=lambda b: worth[b]) if fits else len(bins) - 1
        bins[want[i]] = bins[want[i]] - size[i]
    got, n = packing.best_fit(items, capacity, weights, score)
    used = np.stack([np.bincount(got, items[:, c]) for c in range(3)], axis=1)
    assert (used <= capacity + 1e-9).all() and abs(n - len(bins)) <= 1
    assert score == "dot" or (got == want).mean() > 0.9


def test_chat_round_trip(spark):
    text = r"</s>[INST] ok [/INST] \ \\ <\s> <|im_end|> <<SYS>> [\INST] <<s>"
    rows = [(1, i, ("system", "user", "assistant")[0 if i == 0 else 1 + (i + 1) % 2], f"{text} {i} " + "word " * (i * 9)) for i in range(12)]
    rows += [(2, 0, "system", "alone"), (None, 3, None, None), (3, 0, "assistant", ""), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"),
             (4, 0, "user", "long " * 900), (4, 1, "assistant", "answer")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    made = chat.windows(df, budget=400, history=100)
    turns, learned = defaultdict(list), defaultdict(str)
    for r in chat.read_back(made).orderBy("window").collect():
        turns[r.conv_id] += [(t.role, t.text) for t in r.turns]
        learned[r.conv_id] += "".join(r.learned)
    want = defaultdict(list)
    for c, _, role, t in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", t or ""))
    assert turns == want
    assert all(learned[c] == "".join(t for role, t in v if role == "assistant") for c, v in want.items())
    for r in made.collect():
        new = r.n_turns - r.n_repeated
        assert r.tokens <= 400 or (r.n_repeated <= 1 and new <= 2)
    first = made.where("conv_id = 1").collect()
    assert len(first) > 3 and all(r.formatted.startswith(chat.START + "system") for r in first) and any(r.n_repeated > 1 for r in first)
    assert chat.windows(df.where("false")).count() == 0


def test_chat_budget_counts_texts_without_spaces_and_long_system_turns(spark):
    rows = [(1, 0, "system", "s " * 300)] + [(1, i, "user", "hello there " * 20) for i in range(1, 20)]
    rows += [(2, i, ("user", "assistant")[i % 2], "\u4e2d\u6587" * 1500) for i in range(40)]
    rows += [(3, 0, "system", "s " * 200)] + [(3, i, ("user", "assistant")[i % 2], "w " * (30 * i)) for i in range(1, 15)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in made:
        assert r.tokens <= chat.BUDGET or r.n_turns - r.n_repeated == 1 or (r.conv_id == 3 and r.n_turns <= 2)
    assert len([r for r in made if r.conv_id == 2]) == 40 and max(len(r.formatted) for r in made) < 4000
    assert not any(r.formatted.startswith(chat.START + "system") for r in made if r.conv_id == 1 and r.window > 1)
    assert all(r.formatted.startswith(chat.START + "system") for r in made if r.conv_id == 3)
    with pytest.raises(ValueError):
        chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=100, history=60)


def test_scores_equal_a_plain_trie(docs, empty):
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0
    order = 3
    got = [r for r in lm.score(docs, train, order=order, block_bytes=20_000).collect()]
    all_docs = [(d.doc_id, d.text, d.t) for d in docs.select("doc_id", "text", train.alias("t")).collect()]
    words, tree = Counter(), defaultdict(Counter)
    coded = lambda t: [256] * order + list(lower(t).encode()) + [256]
    for _, t, learn in all_docs:
        if learn:
            words.update([*split(lower(t)), None])
            s = coded(t)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    tree[tuple(s[i - k:i])][s[i]] += 1
    total, kinds = sum(words.values()), len(words)
    want = []
    for i, t, learn in all_docs:
        tokens = [*split(lower(t)), None]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        s, p = coded(t), 0.0
        for at in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                children = tree.get(tuple(s[at - k:at]), {})
                live = {c: n for c, n in children.items() if c not in gone}
                if live and s[at] in live:
                    p += math.log10((2 * live[s[at]] - 1) / (2 * sum(live.values())))
                    break
                if live:
                    p += math.log10(len(live) / (2 * sum(live.values())))
                gone |= set(children)
            else:
                p -= math.log10(257 - len(gone))
        want.append((str(i), not learn, len(tokens), sum(words[w] > 0 for w in tokens), total, base, p))
    have = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got))
    for a, b in zip(have, sorted(want)):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-5, abs_tol=1e-4)
    assert len(have) == len(want) and lm.score(empty, train).count() == 0


def brute_fingerprint(text, n=4):
    w = split(lower(text))
    if not w:
        return 0
    grams = [w[i:i + n] for i in range(len(w) - n + 1)] if len(w) >= n else [w]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_all_pairs(docs, empty):
    for limit in (simhash.MAX_BUCKET, 1):
        rows = simhash.near_duplicates(docs, max_bucket=limit).collect()
        assert len(rows) == docs.count()
        texts = [(d.doc_id, brute_fingerprint(d.text)) for d in docs.collect()]
        group = list(range(len(texts)))
        for _ in texts:
            for i, (_, a) in enumerate(texts):
                group[i] = min(group[j] for j, (_, b) in enumerate(texts) if (a ^ b).bit_count() <= 4)
        least = {g: min((t[0] for t, h in zip(texts, group) if h == g and t[0] is not None), default=None) for g in group}
        want = sorted((str(i), f, least[g]) for (i, f), g in zip(texts, group))
        assert sorted((str(r.doc_id), r.fp % 2 ** 64, r.component_id) for r in rows) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_component_stays(spark, docs, empty):
    """Null ids, rows that repeat an id under other texts, and rows equal in all columns, against all pairs."""
    base, late = docs.where("doc_id = 20").first().text, "late " * 30 + "row"
    own = [(50, late, "s0", 1), (20, late, "s1", 1), (20, base, "s0", 1), (20, base, "s0", 1), (60, "six of one " * 9, "s0", 1),
           (60, "six of one " * 9, "s0", 1), (None, "no id at all " * 9, "s0", 1), (None, "no id at all " * 9, "s0", 1),
           (None, "no id at all " * 9, None, 1), (None, base, "s2", 1), (70, "other " * 40, "s0", 1), (5, "other " * 40, "s0", 1)]
    table = docs.unionByName(spark.createDataFrame(own, docs.schema)).withColumn("m", F.create_map(F.lit("k"), "text"))
    rows = [(r.doc_id, r.text, r.source, r.n_words) for r in table.repartition(5).collect()]
    prints = [brute_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min(group[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 4) for a in prints]
    for limit in (simhash.MAX_BUCKET, 1):
        got = simhash.keep_one(table, max_bucket=limit)
        assert got.columns == table.columns
        got = [(r.doc_id, r.text, r.source, r.n_words) for r in got.collect()]
        assert set(got) <= set(rows) and len(got) == len(set(got))
        assert Counter(group[rows.index(r)] for r in got) == Counter(set(group))
        for r in got:
            mates = [x[0] for x, g in zip(rows, group) if g == group[rows.index(r)] and x[0] is not None]
            assert r[0] == min(mates, default=None)
    again = simhash.keep_one(table.repartition(7)).collect()
    assert Counter((r.doc_id, r.text, r.source, r.n_words) for r in again) == Counter(got)
    assert simhash.keep_one(empty).count() == 0


def test_masks_cover_every_small_difference():
    masks = [m % 2 ** 64 for m in simhash.masks()]
    rng = np.random.default_rng(4)
    for _ in range(2000):
        bits = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not m & bits for m in masks)


def test_substrings_equal_brute_force(docs, empty):
    rows = substring.dedup(docs, span=50).collect()
    assert len(rows) == docs.count() and substring.dedup(empty).count() == 0
    inf = 2 ** 63 - 1
    items = sorted(((d.doc_id if d.doc_id is not None else inf), d.text) for d in docs.fillna("", ["text"]).collect())
    first, want = {}, []
    for i, t in items:
        w = split(t)
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p:p + 50]), i)
    for i, t in items:
        w = split(t)
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p:p + 50])] < i for q in range(p, p + 50)}
        want.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    assert sorted((r.doc_id if r.doc_id is not None else inf, r.sub_words, r.sub_removed, r.sub_kept) for r in rows) == sorted(want)


def test_spans_are_verified_at_their_source(spark):
    texts = {1: "a b c d e f g", 2: "x b c d y", 3: "b c d"}
    packed = spark.createDataFrame([(i, 10 * i, t) for i, t in texts.items()], "doc long, key long, sub_text string").mapInArrow(
        substring._packed, "doc long, key long, sub_packed binary").withColumnRenamed("sub_packed", "packed")
    spans = [(2, 20, 1, 3, 1, 10, 1), (3, 30, 0, 3, 1, 10, 1), (2, 20, 1, 3, 1, 10, 2), (3, 30, 0, 2, 2, 20, 1), (3, 30, 0, 2, 2, 20, 0)]
    df = spark.createDataFrame(spans, "doc long, key long, start long, words long, source long, source_key long, source_start long")
    got = sorted(map(tuple, substring.verified(df, packed).collect()))
    assert got == sorted([spans[0], spans[1], spans[3]])


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (102, 100), (5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[500:560] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1020, [0.0] * 16, 1), (1040, [float("nan")] * 16, 1), (1060, [1.0], 1), (None, x[1].tolist(), 1), (3, x[3].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=10, leaf=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y, hits = x.astype(float), 0
    assert set(got) == set(range(0, 600, 20))
    for q, found in got.items():
        s = y @ y[q]
        want = sorted((j for j in range(600) if j != q), key=lambda j: (-round(s[j], 9), j))[:10]
        hits += len({j for j, _ in found} & set(want))
        assert len(found) == 10 and all(abs(s[j] - v) < 1e-9 for j, v in found)
    assert hits / (10 * len(got)) >= 0.9
    assert [j for j, _ in got[520]] == [0, *range(500, 509)]
    assert ann.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.search(df.where("vec_id < 4"), F.col("vec_id") == 0, k=10).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as cp
    table = docs.drop("n_words").withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long")})
    got, names = table, table.columns
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, got, "").cache()
        assert got.columns == names
    ids = {r.doc_id for r in got.collect()}
    assert not ids & {40, 41, 42, 43, 44, 45, 46} and len(ids & {20, 21, 22, 23}) <= 1
    assert cp.STAGES[-1][1](spark, got, "").count() >= got.count()


