"""Training-data operators against brute force and exact round trips, on small
tables with nulls, empty and long texts, ties, repeated rows and extra columns
with clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from ledgerwatch.llm import bpe, chat, embed_dedup, exact_dedup, groups, langid, licenses, minhash, mixing, packing, token_lm
from ledgerwatch.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, key string, size long, bands string, ids string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def rows():
    rng = random.Random(4)
    vocab = ["w%d" % i for i in range(400)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 90))) for _ in range(12)]
    out = [(i, t, "en", "a") for i, t in enumerate(base)]
    for i in range(40):                                    # near copies around the threshold
        part = base[i % 12].split(" ")
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = rng.choice(vocab)
        out.append((100 + i, " ".join(part), "en", rng.choice(["a", "b", None])))
    out += [(200 + i, base[0].upper() if i % 2 else base[0], "fr", "hot") for i in range(30)]
    out += [(300, None, None, None), (301, "", "en", "b"), (302, " \t\n", "en", "b"), (303, "one two", "en", "b"), (304, "One  two", None, "b"),
            (305, "x" * 50_000, "en", "b"), (306, "é" * 700 + " 中文 <|endoftext|> 's", "fr", "b"), (None, base[1], "en", "a"), (None, None, None, None),
            (5, base[5], "en", "a"), (307, "123 456 !", "en", "b")]
    return [(*r, "k", 7, "z", "q") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def unite(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_chain_star_and_nulls(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(200, 200), (None, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 131)}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(docs, k, percent):
    sets = {}
    for doc, text, *_ in rows():
        w = words(text)
        s = {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        if doc is not None:
            sets[doc] = s
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = unite(sets, links)
    got = minhash.near_duplicates(docs, k, percent).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_minhash_bucket_blocks_are_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(40)]
    got = minhash._linked(sets[:15], sets[15:], 60)
    for i, x in enumerate(sets[:15]):
        for j, y in enumerate(sets[15:]):
            both = len(np.intersect1d(x, y))
            assert got[i, j] == (100 * both >= 60 * (len(x) + len(y) - both))


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 2 ** 63, 2000).astype(np.uint64))
    a, b = minhash.sketch(x[:1800], 512), minhash.sketch(x[200:], 512)
    assert abs((a == b).mean() - 0.8) < 0.08
    assert minhash.sketch(x[:1], 512).max() < np.iinfo(np.uint64).max


@pytest.mark.parametrize("share", [1e-3, 0.2])
def test_exact_dedup_report_and_rows(docs, share):
    groups = {}
    for doc, text, *_ in rows():
        groups.setdefault(lower(text), []).append(doc)
    got = exact_dedup.duplicate_report(docs, share).collect()
    assert len(got) == len(rows()) and sum(r.kept for r in got) == len(groups)
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (max(known, default=None), len(ids)) and (not r.kept or r.doc_id == r.keep_id)
    kept = exact_dedup.exact_dedup(docs, share)
    assert kept.columns == docs.columns
    assert sorted(lower(r.text) for r in kept.collect()) == sorted(groups)


def test_heavy_digests_are_exactly_the_frequent_ones(spark):
    data = [("h%d" % (i % 2), i) for i in range(200)] + [("r%d" % i, i) for i in range(300)]
    df = spark.createDataFrame(data, "sha string, doc_id long").repartition(5)
    assert {r.sha: (r.keep_id, r.group_size) for r in exact_dedup.heavy_digests(df, 0.1).collect()} == {"h0": (198, 100), "h1": (199, 100)}


def test_chat_round_trip(spark):
    odd = ["", None, "plain", "<turn user>\nx</turn>\n", "<\\turn a>", "<\\\\/turn>", "a<part/>b", "</turn", "<", "\\", "é<turn ", "<<part/>>", "x" * 30_000]
    rng, data = random.Random(2), []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            data.append((conv, turn, rng.choice(["user", "assistant", "sys>\ntem", None]), rng.choice(odd), 1))
    data += [(None, 0, "user", "x", 1), (70, None, "assistant", "n", 1), (70, None, "assistant", "n", 1)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, turns long")
    want = {}
    for conv, turn, role, text, _ in sorted(data, key=lambda r: (r[0] is None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    got = chat.read_conversations(chat.format_conversations(df)).collect()
    assert len(got) == len(want)
    for r in got:
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.formatted.count("</turn>\n") == sum(i == 0 or want[r.conv_id][i - 1][0] != x[0] for i, x in enumerate(want[r.conv_id]))


def test_best_fit_takes_the_least_sufficient_space():
    rng = random.Random(3)
    for length in (1, 2, 7, 16, 100):
        for _ in range(60):
            sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 40))]
            where, free = packing.best_fit(sizes, length), []
            for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
                fit = [f for f in free if f >= sizes[i]]
                if where[i] < len(free):
                    assert free[where[i]] == min(fit)
                    free[where[i]] -= sizes[i]
                else:
                    assert not fit and where[i] == len(free)
                    free.append(length - sizes[i])


def test_packing_is_lossless(docs):
    ids = {}
    for r in bpe.encode(docs).collect():
        ids.setdefault(r.doc_id, []).append(list(r.ids))
    seen = {}
    for r in packing.pack_documents(docs, length=64, group_tokens=3000).collect():
        line = np.frombuffer(r.input_ids, np.uint16)
        assert len(line) == 64 and r.cu_seqlens[-1] == r.n_tokens and list(r.position_resets) == list(r.cu_seqlens[:-1])
        assert (line[r.n_tokens:] == packing.PADDING).all()
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:]):
            seen.setdefault(doc, []).append((at, line[a:b].tolist()))
    for doc, all_of in ids.items():
        want = sorted((at, x[at: at + 64]) for x in all_of for at in range(0, len(x), 64))
        assert sorted(seen.get(doc, [])) == want


def test_bpe_equals_the_library(docs, monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(bpe.default_path())
    tool.no_truncation()
    tool.no_padding()
    got = bpe.round_trip(docs).collect()
    assert len(got) == len(rows())
    for r in got:
        want = tool.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == tool.decode(want, skip_special_tokens=False)
    rng, vocab = random.Random(1), bpe.vocabulary(bpe.default_path())
    pool = "abcXYZ  \n\t\r\x0b\x0c\x1c\x85\xa0​　'sretvmld'012½²٣éßñ中😀.,!?<|>_" + "́"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["a" * 3000, "ab" * 400, "<|endoftext|>" * 2]
    ids, ends = vocab.encode_batch(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [e.ids for e in tool.encode_batch(texts, add_special_tokens=False)]
    assert bpe.decode(bpe.encode(docs)).where("not (decoded <=> coalesce(text, ''))").isEmpty()


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    center = rng.normal(size=(30, 16))
    data = [(i, (center[i % 30] + 0.05 * rng.normal(size=16)).tolist()) for i in range(600)] + [(1000 + i, rng.normal(size=16).tolist()) for i in range(300)]
    data += [(2000 + i, data[0][1]) for i in range(50)] + [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None] * 16), (3005, [1.0, 2.0]),
             (None, data[0][1]), (3006, [2 * x for x in data[3][1]])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<double>, a int, copies int")
    good = [(i, np.array(v)) for i, v in data if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= 0.95
    names = [i for i, _ in good]
    comp = unite(names, [(names[a], names[b]) for a, b in zip(*np.nonzero(near)) if a < b])
    links = dict(zip(names, (near.sum(axis=1) - 1).tolist()))
    got = embed_dedup.near_duplicates(df).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), comp.get(r.vec_id, r.vec_id))


def test_embedding_slices_of_many_shards(spark, monkeypatch):
    """Small slices, so that several tasks search each shard, give the same
    rows; a third of all vectors are copies of one."""
    rng = np.random.default_rng(8)
    center = rng.normal(size=(12, 8))
    data = [(i, (center[i % 12] + 0.06 * rng.normal(size=8)).tolist()) for i in range(240)] + [(500 + i, center[0].tolist()) for i in range(120)]
    data += [(900 + i, rng.normal(size=5).tolist()) for i in range(20)] + [(900, center[1].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = sorted(tuple(r) for r in embed_dedup.near_duplicates(df).collect())
    monkeypatch.setattr(embed_dedup, "SHARD_ROWS", 30)
    monkeypatch.setattr(embed_dedup, "SLICE_ROWS", 60)
    assert sorted(tuple(r) for r in embed_dedup.near_duplicates(df).collect()) == want
    names = [(i, str(v)) for i, v in data]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in data]
    near = [[b for b in range(len(data)) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95] for a in range(len(data))]
    comp = unite(range(len(data)), [(a, b) for a in range(len(data)) for b in near[a] if a < b])
    least = {c: min(names[a][0] for a in comp if comp[a] == c) for c in set(comp.values())}
    assert sorted((names[a][0], len(near[a]) - 1, least[comp[a]]) for a in comp) == [w[:3] for w in want]


def test_hot_groups_are_joined_where_they_lie(spark):
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"g{i // 2}") for i in range(400)] + [(5000, None), (5001, "alone")]
    df = spark.createDataFrame(rows, "id long, name string")
    grouped = df.where("name is not null and name <> 'alone'").groupBy("name").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    got = groups.with_groups(df, grouped, ["name"], share=0.1)
    least = {n: min(i for i, m in rows if m == n) for _, n in rows if n not in (None, "alone")}
    want = {(i, n, least[n]) for i, n in rows if n in least}
    assert {(r.id, r.name, r.least) for r in got.collect()} == want and got.count() == len(want)


def test_minhash_third_of_one_text_and_repeated_ids(spark):
    text = "one two three four five six seven eight nine ten"
    data = [(i, text.upper() if i % 2 else text) for i in range(100, 200)] + [(300 + i, f"{text} number {i} and {i * 7} more {i * 11}") for i in range(150)]
    data += [(100, text)] * 5 + [(100, "another text of this same identifier that nobody else in here has"), (None, text), (7, ""), (8, None)]
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(got) == len(data)
    assert {r.component_id for r in got if r.doc_id is not None and 100 <= r.doc_id < 200} == {100}
    assert all(r.kept for r in got if r.doc_id in (None, 7, 8))


def test_mixing_reaches_targets(docs, spark):
    got = mixing.assign(docs).collect()
    size = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        size.setdefault(r.source, []).append(r)
    total = sum(r.size for r in got)
    assert total == sum(len(words(t)) for _, t, *_ in rows())
    assert abs(sum(rs[0].target for rs in size.values()) - 1.5 * total) < 1e-6
    level = {}
    for i, s in enumerate(sorted(size, key=lambda s: (s is None, s))):
        rs = size[s]
        assert rs[0].source_size == sum(r.size for r in rs) and sum(r.taken for r in rs) == int(rs[0].target)
        if rs[0].target < 2 * rs[0].source_size - 1e-9:
            level[s] = rs[0].target / (3, 1, 2)[i % 3]
    assert max(level.values()) - min(level.values()) < 1e-6
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and abs(sum(len(words(r.text)) for r in mixed.collect()) - 1.5 * total) < 400
    assert [tuple(r) for r in got] == [tuple(r) for r in mixing.assign(docs.repartition(7)).collect()]


def test_the_number_of_ranges_changes_no_result(spark, monkeypatch):
    docs = spark.createDataFrame([(None if i % 3 == 0 else i, "a" if i % 4 else None, "w " * (i % 7) + str(i % 50)) for i in range(600)],
                                 "doc_id long, source string, text string")
    got = [tuple(r) for r in mixing.assign(docs).collect()]
    monkeypatch.setattr(mixing, "_digits", lambda rows, range_rows: 5)
    assert [tuple(r) for r in mixing.assign(docs).collect()] == got
    ranges = mixing._sized(docs.where("doc_id is null"), []).select("spot").distinct().count()
    assert ranges == docs.where("doc_id is null").select("text").distinct().count() > 100     # rows without id aren't one range


def test_ranges_follow_the_rows():
    assert [mixing._digits(n, 1 << 16) for n in (0, 1 << 28, (1 << 28) + 1, 1 << 32, 10**12)] == [3, 3, 4, 4, 6]


def test_second_passes_keep_the_schedule(spark):
    size = {"a": 100, "b": 1000, "c": 300}
    docs = spark.createDataFrame([(1000 * i + j, s, "w " * 10) for i, (s, n) in enumerate(size.items()) for j in range(n)], "doc_id long, source string, text string")
    plan = mixing.assign(docs).collect()
    order = [r.doc_id for r in mixing.mixed(docs).collect()]
    assert order == [i for _, i in sorted((at, r.doc_id) for r in plan for at in (r.position, r.again) if at is not None)]
    # c is doubled and its weight holds: the n-th tenth of its words comes at n tenths of the training time
    held = [r for r in plan if r.source == "c"]
    assert all(r.taken == 20 and abs(r.again - r.position - 0.5) < 1e-9 for r in held)
    # every source covers its schedule: words so far are the demand at that time, to within a document
    for s, fade in zip(size, mixing.FADES):
        times = sorted(at for r in plan if r.source == s for at in (r.position, r.again) if at is not None)
        target = next(r.target for r in plan if r.source == s)
        assert max(abs(target * ((1 - fade) * u + fade * u * u) - 10 * k) for k, u in enumerate(times)) < 10


def test_licenses_equal_brute_force(spark):
    rng = random.Random(6)
    notice = licenses.TEMPLATES["MIT-notice"].split()
    texts = [None, "", "Released under the MIT License.", "x " * 30 + "released under THE mit license. y"]
    for i in range(60):
        part = list(notice)
        for _ in range(rng.randint(0, 6)):
            part[rng.randrange(len(part))] = "zz%d" % rng.randint(0, 99)
        texts.append(" ".join(["f%d" % rng.randint(0, 500) for _ in range(rng.randint(0, 300))] + part + ["g%d" % rng.randint(0, 500) for _ in range(rng.randint(0, 300))]))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(df).collect()}
    five = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    sets = {n: five(words(t)) for n, t in licenses.TEMPLATES.items()}
    want = set()
    for i, t in enumerate(texts):
        here = five(words(t))
        want |= {(i, n) for n, s in sets.items() if len(s & here) >= 0.8 * len(s)}
    assert got == want and (2, "MIT") in got


def test_licenses_in_comments_and_families(spark):
    def comment(text, mark):
        part = text.split()
        return "int x;\n" + "\n".join(mark + " ".join(part[i: i + 12]) for i in range(0, len(part), 12)) + "\nint y;"
    names = sorted(n for n in licenses.TEMPLATES if len(licenses.TEMPLATES[n].split()) > 15)
    assert {"BSD-3-Clause", "LGPL-2.1-notice", "LGPL-3.0-notice", "AGPL-3.0-notice", "Unlicense", "EPL-2.0"} <= set(names)
    texts = [(mark, n, comment(licenses.TEMPLATES[n], mark)) for mark in ("", " * ", "# ", "// ", "//", "-- ") for n in names]
    texts += [("", "MIT", "Released under the MIT License, see below"), ("", "MIT", "// Released under the\n// (MIT) License")]
    df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(texts)], "doc_id long, text string")
    got = {}
    for r in licenses.scan_licenses(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, (mark, name, text) in enumerate(texts):
        assert [r.license for r in got[i]] == [name], (mark, name)
        assert got[i][0].containment == 1.0
        span = text.split()[got[i][0].start_word: got[i][0].end_word]
        bare = [w.strip("*#/-,.()") for w in span]
        assert [w for w in bare if w] == [w.strip("*#/-,.()") for w in licenses.TEMPLATES[name].split()] or name == "MIT"
    both = spark.createDataFrame([(1, licenses.TEMPLATES["GPL-2.0-notice"] + " " + licenses.TEMPLATES["GPL-3.0-notice"] + " x " + licenses.TEMPLATES["MIT-notice"])], "doc_id long, text string")
    assert sorted(r.license for r in licenses.scan_licenses(both).collect()) == ["GPL-2.0-notice", "GPL-3.0-notice", "MIT-notice"]
    table = spark.createDataFrame([("own", "a b c d e f g"), (None, "x y"), ("none", None)], "license string, text string")
    more = spark.createDataFrame([(1, "* a b c\n* d e f g."), (2, "Released under the MIT License.")], "doc_id long, text string")
    assert [(r.doc_id, r.license, r.start_word, r.end_word) for r in licenses.scan_licenses(more, table).collect()] == [(1, "own", 1, 9)]


def test_forward_backward_and_language(spark):
    rng = np.random.default_rng(0)
    counts = np.array([0, 1, 600, 255, 256, 257, 0, 11])
    n = counts.sum()
    e, trans, prior = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, at = langid.posteriors(e, counts, trans, prior), 0
    for c in counts:
        a, ahead = np.exp(prior), []
        for t in range(c):
            a = (a @ np.exp(trans)) * np.exp(e[at + t])
            a /= a.sum()
            ahead.append(a)
        b = np.ones(3)
        for t in range(c - 1, -1, -1):
            p = ahead[t] * b
            assert np.allclose(p / p.sum(), got[at + t], atol=1e-9)
            b = np.exp(trans) @ (np.exp(e[at + t]) * b)
            b /= b.sum()
        at += c
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table)
    r = langid.predict(table, model).join(table.select("doc_id", "lang"), "doc_id").toPandas()
    assert (r.lang_pred == r.lang)[r.held_out].mean() > 0.97 and 0 < r.held_out.mean() < 0.5
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 34 !", "x"), (None, "the and of", "x")], "doc_id long, text string, words string")
    pred = {x.doc_id: x.lang_pred for x in langid.predict(odd, model).collect()}
    assert [pred[i] for i in (1, 2, 3)] == ["und"] * 3 and pred[None] in model["languages"]
    mixed = spark.createDataFrame([(1, "the ing and tion of the ering thation " * 5 + "der schung und einkeit lichung die " * 5)], "doc_id long, text string")
    assert [s.lang for s in langid.label_words(mixed, model).first().segments] == ["en", "de"]


def test_language_sample_is_never_rounded_to_nothing(spark):
    # 2.9 of about 3,000,000 documents of each language: less than a millionth
    many = spark.range(9_000_000).selectExpr("id as doc_id", "if(id % 2 = 0, 'aa', 'bb') as lang", "if(id % 2 = 0, 'one two', 'drei vier') as text")
    model = langid.fit(many, 2.9)
    assert model["languages"] == ["aa", "bb"] and model["weights"].any(axis=0).all()
    odd = spark.createDataFrame([(1, "one two"), (2, "drei vier")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(odd, model).collect()} == {1: "aa", 2: "bb"}
    assert langid.largest_hash(500, 400) == 2 ** 63 - 1 and langid.largest_hash(500, 10 ** 12) > -2 ** 63
    with pytest.raises(ValueError, match="aa"):
        langid.fit(many.limit(1000), 1e-9)


def test_language_of_scripts_without_ascii_separators(spark):
    rng = random.Random(8)
    signs = {"ja": [chr(c) for c in range(0x3041, 0x3091)], "zh": [chr(c) for c in range(0x4E00, 0x4F00)], "en": list("abcdefgh ")}
    texts = [(i, lang, "".join(rng.choice(signs[lang]) for _ in range(3000))) for i, lang in enumerate(["ja", "zh", "en"] * 20)]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    model = langid.fit(docs)
    got = langid.predict(docs, model).join(docs, "doc_id").collect()
    assert model["languages"] == ["en", "ja", "zh"] and all(r.lang_pred == r.lang for r in got)
    parts = langid.Words(["\u4e2d\u6587\u3001\u4e2d\uff0c\u6587\u3000\u4e2d\u2019a b\u00a0\u00e9", "\U00010100\U00020000"])
    spans = [bytes(parts.raw[a:b]).decode() for a, b in zip(parts.start, parts.end)]
    assert spans == ["\u4e2d\u6587", "\u4e2d", "\u6587", "\u4e2d", "a", "b", "\u00e9", "\U00020000"] and parts.counts.tolist() == [7, 1]


def test_code_switched_text_of_many_languages_stays(spark):
    heard = {lang: " ".join(a + b for b in "aeiou" for a in signs) for lang, signs in (("aa", "bcdf"), ("bb", "ghjk"), ("cc", "lmnp"), ("dd", "qrst"))}
    model = langid.train([(lang, text) for lang, text in heard.items() for _ in range(50)], sorted(heard))
    docs = spark.createDataFrame([(1, " ".join(heard.values())), (2, heard["aa"]), (3, "1 2"), (4, None)], "doc_id long, text string")
    scores = {r.doc_id: max(r.lang_scores) for r in langid.label_words(docs, model).collect()}
    assert scores[1] < 0.35 and {r.doc_id for r in langid.identified(docs, model=model).collect()} == {1, 2}


def test_empty_tables(empty, spark):
    for out in (minhash.near_duplicates(empty), exact_dedup.duplicate_report(empty), exact_dedup.exact_dedup(empty), mixing.assign(empty), mixing.mixed(empty),
                packing.pack_documents(empty), bpe.round_trip(empty), licenses.scan_licenses(empty), langid.predict(empty), langid.identified(empty), token_lm.score_documents(empty),
                chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
                embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert out.count() == 0


def test_pipeline_on_odd_rows(spark, docs):
    import corpus_pipeline as p

    kept, at = docs, {}
    for name, stage in p.STAGES:
        out = stage(spark, kept, "")
        assert name == p.STAGES[-1][0] or out.columns == docs.columns
        at[name], kept = [r.asDict() for r in out.collect()], out
        kept = spark.createDataFrame(out.collect(), out.schema)
    letters = [r for r in rows() if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert len(at["language_id"]) == len(letters)
    assert len(at["exact_dedup"]) == len({lower(r[1]) for r in letters})
    assert all(r["round_trip"] for r in at["bpe_tokens"])


def test_a_repeated_id_loses_no_other_text(spark):
    import corpus_pipeline as p

    rng = random.Random(9)
    a, b = (" ".join(f"{c}{rng.randrange(900)}" for _ in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a, "x"), (2, a + " more", "y"), (2, b, "z"), (None, a, "n"), (None, b + " end", "m")], "doc_id long, text string, number string")
    kept = p.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.text[0] for r in kept.collect()) == ["a", "b"]
    assert p.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_exact_dedup_keeps_a_settled_row_of_ties(spark):
    rows = [(1, "Same", str(i)) for i in range(40)] + [(2, "other", "x")]
    kept = [exact_dedup.exact_dedup(spark.createDataFrame(random.Random(i).sample(rows, len(rows)), "doc_id long, text string, extra string").repartition(3), share).collect() for i in range(3) for share in (1e-3, 0.9)]
    assert all(sorted(map(tuple, k)) == sorted(map(tuple, kept[0])) and len(k) == 2 for k in kept)


def test_packed_ids_as_wide_as_the_vocabulary():
    assert packing.id_type(50_000, 0) is np.uint16 and packing.id_type(65_536, 65_535) is np.uint16
    assert packing.id_type(65_537, 0) is np.int32 and packing.id_type(50_000, 70_000) is np.int32 and packing.id_type(10, -1) is np.int32
    lines = list(packing._lines([(1, np.array([70_000, 5], np.int32))], 4, 0, packing.id_type(70_001, 0)))
    assert np.frombuffer(lines[0].column("input_ids")[0].as_py(), np.int32).tolist() == [70_000, 5, 0, 0]


def test_embeddings_of_any_size_and_length(spark):
    base = [0.3, -0.7, 0.2, 0.9]
    data = [(i, [x * size for x in base]) for i, size in enumerate((1e200, 2e200, 3e-100, 1e-200, 1.0))] + [(9, [float("inf"), 1.0, 0.0, 0.0]), (10, [1.0, 1.0]), (11, [1e-300, 1e-300]), (12, [-1.0, 1.0]), (13, [5e-324, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    assert all(got[i] == (4, 0) for i in range(5)) and got[9] == (0, 9) and got[10] == got[11] == (1, 10) and got[12] == (0, 12) and got[13] == (0, 13)


def test_crf_gradient_equals_enumeration():
    import itertools

    rng, counts, k = np.random.default_rng(0), np.array([4, 1, 3]), 3
    e, trans, prior, truth = rng.normal(size=(8, k)), 2 * rng.normal(size=(k, k)), rng.normal(size=k), rng.integers(0, k, 8)

    def likelihood():
        out, at = 0.0, 0
        for c in counts.tolist():
            def score(lab):
                inner = sum(trans[lab[i], lab[i + 1]] for i in range(c - 1)) + sum(e[at + i, lab[i]] for i in range(c))
                return np.log(np.exp(prior + trans[:, lab[0]]).sum()) + inner
            out += score(truth[at: at + c]) - np.log(sum(np.exp(score(lab)) for lab in itertools.product(range(k), repeat=c)))
            at += c
        return out
    grads = langid.chain_gradient(e, counts, truth, trans, prior)
    for array, grad in zip((e, trans, prior), grads):
        for i in np.ndindex(array.shape):
            old, side = array[i], []
            for by in (1e-5, -1e-5):
                array[i] = old + by
                side.append(likelihood())
            array[i] = old
            assert abs((side[0] - side[1]) / 2e-5 - grad[i]) < 1e-6
    assert np.allclose(langid.posteriors(e, counts, trans, prior), langid.expectations(e, counts, trans, prior)[0])


def test_words_of_no_language_go_and_missing_labels_are_filled(spark):
    even = {"languages": ["aa", "bb"], "weights": np.zeros((1 << langid.TABLE_BITS, 2), np.float32), "trans": np.zeros((2, 2)), "prior": np.zeros(2)}
    docs = spark.createDataFrame([(1, "one two", None, 7), (2, "drei vier", "bb", 8), (None, "one", None, 9), (4, None, "aa", 1), (5, "12", None, 2)], "doc_id long, text string, lang string, words int")
    assert langid.identified(docs, model=even).count() == 0
    model = langid.train([("aa", "one two")] * 40 + [("bb", "drei vier")] * 40, ["aa", "bb"])
    got = sorted((r.words, r.doc_id, r.lang) for r in langid.identified(docs, model=model).collect())
    assert got == [(7, 1, "aa"), (8, 2, "bb"), (9, None, "aa")]
    many = spark.range(1200).selectExpr("id as doc_id", "concat('l', id) as lang", "'one' as text")
    with pytest.raises(ValueError, match="512"):
        langid.fit(many)


def test_long_texts_are_scored_by_pieces(spark, monkeypatch):
    texts = ["abc abd " * 300, "x", None, "", "abd " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = token_lm.fit(docs)
    whole = token_lm.Line([("", texts[0], "")], model.ids())
    want = token_lm.log_probability(model, *whole.windows(whole.spot)).sum()
    monkeypatch.setattr(token_lm, "SLICE", 100)
    parts = [token_lm.Line([p], model.ids()) for p in token_lm._pieces(texts[0])]
    assert len(parts) == 24 and abs(sum(token_lm.log_probability(model, *p.windows(p.spot)).sum() for p in parts) - want) < 1e-3
    got = {r.doc_id: r for r in token_lm.score_documents(docs, model).collect()}
    assert abs(got[0].log_likelihood - want) < 1e-2 and got[2].n_tokens == 0 and got[4].n_tokens == 2800
    assert token_lm.score_documents(spark.createDataFrame([(None, "ab")], "doc_id long, text string"), model).first().doc_id is None
