"""Conversation repair, URL filters and importance resampling against brute
force, with nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns with clashing names."""

import collections
import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest

from ledgerwatch.llm import conversation_repair as C
from ledgerwatch.llm import resampling as R
from ledgerwatch.llm import url_filter as U

STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}      # of the grammar (s?(ua)+)?


def brute_repair(initials, forced, truncated):
    """Cheapest (cost, audit) by a search over all edit strings in order of cost."""
    heap, found, least = [(0, "", 0, 0)], [], None
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if least is not None and cost > least:
            break
        if i == len(initials) and state in (0, 3):
            least, found = cost, found + [audit]
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            if not forced[i]:
                cut = 5 if truncated[i] else 0
                if (state, initials[i]) in STEPS:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, STEPS[state, initials[i]]))
                for r in "ua":
                    if (state, r) in STEPS:
                        heapq.heappush(heap, (cost + cut + 1, audit + "R", i + 1, STEPS[state, r]))
        for r in "ua":
            if (state, r) in STEPS and audit.count("I") < 4:
                heapq.heappush(heap, (cost + 5, audit + "I", i, STEPS[state, r]))
    return least, min(found)


def test_repairs_are_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(600):
        initials = [rng.choice("suaaut ") for _ in range(rng.randint(0, 6))]
        forced = [rng.random() < 0.2 for _ in initials]
        truncated = [not f and rng.random() < 0.3 for f in forced]
        assert C.cheapest(initials, forced, truncated) == brute_repair(initials, forced, truncated)


def test_long_repairs_are_filled_again_from_kept_rows(monkeypatch):
    rng = random.Random(2)
    initials = [rng.choice("ua") if rng.random() < 0.1 else "ua"[i % 2] for i in range(900)]
    forced = [rng.random() < 0.05 for _ in initials]
    truncated = [not f and rng.random() < 0.05 for f in forced]
    cost, audit = C.cheapest(initials, forced, truncated)
    monkeypatch.setattr(C.math, "isqrt", lambda n: n)          # all rows in one block
    assert (cost, audit) == C.cheapest(initials, forced, truncated)
    role, state = iter(zip(initials, forced, truncated)), 0
    spent, left = 0, sum(e != "D" for e in audit)
    for e in audit:
        want = "a" if left % 2 else "u"
        spent += {"D": 2, "I": 5, "K": 0, "R": 1}[e]
        if e != "I":
            c, gone, cut = next(role)
            assert e == "D" or not gone
            spent += 5 if cut and e != "D" else 0
        if e != "D":
            state = STEPS[state, c if e == "K" else want]
            left -= 1
    assert spent == cost and state == 3 and next(role, None) is None


TURNS = "conv_id long, turn long, role string, text string, step int, audit string, digest string"
SPACES = " \t\n\x0b\x0c\r"


def turns():
    rng = random.Random(3)
    out = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 6)):
            text = rng.choice(["Fine.", "Why?", "Cut off", " \t", "", "Again.", None, "é中!", "End. \n", "x" * 3000 + "."])
            out.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), text))
    out += [(99, i, "ua"[i % 2].replace("u", "user").replace("a", "assistant", 1) if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(500)]
    return [(*r, 1, "a", "d") for r in out]


def expected(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)."""
    convs, out = collections.defaultdict(list), {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        convs[conv].append((turn, role, text))
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, text in some:
            body = text.strip(SPACES)
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in some]
        forced, cut = [f in ("b", "d") for f in faults], [f == "t" for f in faults]
        cost, audit = brute_repair(initials, forced, cut) if len(some) < 7 else C.cheapest(initials, forced, cut)
        numbers = [r[0] for r in some if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        lines, i, left = [], 0, sum(e != "D" for e in audit)
        for e in audit:
            name = "assistant" if left % 2 else "user"
            left -= e != "D"
            if e == "I":
                lines.append(f"{name}:")
                continue
            if e != "D":
                lines.append(f"{some[i][1] if e == 'K' else name}:{some[i][2]}")
            i += 1
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, lines)
    return out


def test_conversations_equal_brute_force(spark):
    rows = turns()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    want = expected(rows)
    got = C.digests(df).collect()
    assert len(got) == len(want)
    for r in got:
        *audit, lines = want[r.conv_id]
        assert list(r)[1:-1] == audit and r.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert {tuple(r)[0]: tuple(r)[1:] for r in C.audits(df).collect()} == {c: tuple(v[:-1]) for c, v in want.items()}
    repaired = collections.defaultdict(list)
    for r in sorted(C.repair(df).where("edit <> 'D'").collect(), key=lambda r: r.step):
        repaired[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: v[-1] for c, v in want.items() if v[-1]} == repaired


def test_damage_and_conversations_without_rows(spark):
    df = spark.createDataFrame([(c, t, "user" if t % 2 == 0 else "assistant", "So. It is!") for c in range(60) for t in range(3)], "conv_id long, turn long, role string, text string")
    damaged = collections.defaultdict(list)
    for conv, turn, role, text in df.collect():
        code = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if code == 1 else text.replace(".", "").replace("!", "") if code == 2 else text
        damaged[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    got = collections.defaultdict(list)
    for r in C.damaged(df).where("not dropped").collect():
        got[r.conv_id].append((r.turn, r.role, r.text))
    assert {c: sorted(v) for c, v in got.items()} == {c: sorted(v) for c, v in damaged.items() if v}
    only = spark.createDataFrame([(5, 0, "user", "x", True), (5, 1, "user", "y", True), (6, 0, "user", "Hi.", False)], "conv_id long, turn long, role string, text string, gone boolean")
    rows = {r.conv_id: tuple(r) for r in C.digests(only, dropped="gone").collect()}
    assert rows[5] == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows[6][6:8] == (2, "D")
    assert C.digests(spark.createDataFrame([], TURNS)).count() == 0 == C.repair(spark.createDataFrame([], TURNS)).count()
    null = spark.createDataFrame([(None, None, None, None)], "conv_id long, turn long, role string, text string")
    assert C.damaged(null).count() in (1, 2) and C.digests(C.damaged(null), "dropped").first().conv_id is None


def glob_regex(glob):
    out = ""
    for token in re.findall(r"(?s)\*\*|\*|\?|\\.|.", glob):
        out += "(?s:.*)" if token == "**" else "[^/]*" if token == "*" else "[^/]" if token == "?" else re.escape(token[-1])
    return re.compile(out + r"\Z")


def test_automaton_equals_regular_expressions(monkeypatch):
    rng = random.Random(4)
    signs = ["a", "b", "/", ".", "é", "中", "*", "?"]
    globs = ["".join(rng.choice([*signs, "*", "**", "?", "\\*", "\\?", "\\\\"]) for _ in range(rng.randint(0, 9))) for _ in range(120)] + ["", "**", "a" * 150 + "*", "*" + "b" * 70 + "**"]
    texts = ["".join(rng.choice(signs[:6]) for _ in range(rng.randint(0, 12))) for _ in range(200)] + ["", "a" * 150, "a" * 149, "x" + "b" * 70 + "/c", "*?\\"]
    raws = [t.encode() for t in texts]
    raw, offsets = np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])
    want = [[bool(glob_regex(g).match(t)) for g in globs] for t in texts]
    few = ["ab" * 20_000 + "c", "ab" * 20_000]                # the last rows of a batch are walked alone
    long = np.frombuffer("".join(few).encode(), np.uint8), np.array([0, 40_001, 80_001])
    assert U.Automaton(["**c", "ab**", "*b", "a*b?", "b**"]).matches(*long).tolist() == [[True, True, False, True, False], [False, True, True, False, False]]
    assert U.Automaton(globs).matches(raw, offsets).tolist() == want
    monkeypatch.setattr(U, "PACK_STATES", 100)
    assert len(U.packs(globs)) > 5
    assert U.first_match(U.packs(globs), raw, offsets).tolist() == [w.index(True) if any(w) else -1 for w in want]


def test_urls_equal_brute_force(spark):
    hosts = ["a.net", "net", "x.example.net", "example.net", "EXAMPLE.com", "a.b.org", "org", "xorg", "anet", "", "m.ads-track.example.com", "net:80", "é.net", "adserver.io"]
    paths = ["", "/", "/en/1", "/EN/1", "/fr/2", "/de/", "/de", "/x.net/y", "/fr/" + "z" * 20_000, "/?q=://c.net/", "?x=/en/", "#/en/"]
    urls = [None, "", "no scheme", "://net/", "http://"] + [f"http://{h}{p}" for h in hosts for p in paths] + ["https://a.net/http://example.com/de/"] * 2
    pages = spark.createDataFrame([(i if i != 7 else None, u, "h", "r", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, canonical int").repartition(3)
    rules = [r.partition("/")[::2] + (v,) for r, v in U.RULES]

    def judged(url):
        m = re.search(r"(?s)://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(f"{h}/{p}", v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule = max(fits, key=lambda f: len(f[0]), default=None)
        ads = ".ads-" in "." + host or ".adserver." in "." + host
        return host, path, rule and rule[0], rule[1] if rule else "block" if ads else "allow"
    got = sorted((r.host, r.path, r.rule or "", r.verdict) for r in U.judge(pages).collect())
    assert got == sorted((h, p, r or "", v) for h, p, r, v in map(judged, urls))
    assert U.judge(pages.limit(0)).count() == 0
    own = U.judge(pages, rules=(("net/", "block"), ("a.net/", "keep")), globs=(("**/fr/**", "odd"), ("?.net", "bare")), default="ask").collect()
    assert {r.verdict for r in own} == {"block", "keep", "odd", "ask"} and all(r.rule == "a.net/" for r in own if r.host == "a.net" and r.path.startswith("/"))


def test_checksums_equal_the_library():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 2_600_000).astype(np.uint8)
    cuts = np.unique(np.concatenate([[0, 5, 6, 300_000, 1_600_000, 2_599_998], rng.integers(1_600_000, 2_599_998, 3000), rng.integers(6, 300_000, 3000)]))
    start, end = cuts[:-1], cuts[1:] - ((np.diff(cuts) > 1) & (rng.random(len(cuts) - 1) < 0.5))
    assert R.crc32_spans(data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    assert R.length_constants(np.array([0, 1, 127, 128, 1000, 70_000])).tolist() == [zlib.crc32(bytes(n)) for n in (0, 1, 127, 128, 1000, 70_000)]


DOCS = "doc_id long, text string, score double, rank int, mark string, words int, weight int"


def sample_docs():
    rng = random.Random(6)
    vocab = ["alpha", "Beta", "gamma3", "δέλτα", "中文", "e" * 400, "x1", "don't"]
    texts = [" ".join(rng.choice(vocab) + rng.choice(["", ",", " -", "."]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    out = list(enumerate(texts)) + [(200, None), (201, ""), (202, " .,! "), (203, "word"), (None, texts[3]), (None, texts[4]), (None, None), (5, texts[5]), (5, texts[5]), (5, texts[9]),
                                    (204, "y" * 30_000 + " z " * 20_000), (205, "w" * 5000)]
    return [(i, t, 1.0, 2, "m", 3, 4) for i, t in out]


def brute_resample(docs, target, percent=25, least=20, buckets=10_000):
    def marks(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(x.encode()) % buckets for x in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]
    read = [(i, *marks(t)) for i, t in docs]
    s, t = collections.Counter(m for r in read for m in r[2]), collections.Counter(m for x in target for m in marks(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for i, words, found in read:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((o for o in out if o[4] >= least), key=lambda o: (-o[3], o[0] is not None, o[0] or 0))
    drawn = collections.Counter((o[:4], n + 1) for n, o in enumerate(able[:percent * len(able) // 100]))
    return collections.Counter(o[:4] for o in out), drawn


@pytest.mark.parametrize("piece", [1 << 20, 3000])
def test_resampling_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE", piece)         # local workers fork from here or read the default; both must agree
    rows, target = sample_docs(), ["alpha beta gamma3", None, "中文 中文 x1", ""]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    bench = spark.createDataFrame([(t, "x") for t in target], "text string, bucket string")
    for percent in (25, 100, 0):
        got = R.resample(df, bench, percent=percent).collect()
        every, drawn = brute_resample([r[:2] for r in rows], target, percent)
        assert collections.Counter(tuple(r)[:4] for r in got) == every
        ranks = collections.Counter((tuple(r)[:4], r["rank"]) for r in got if r["rank"] is not None)
        assert sorted(n for _, n in ranks) == list(range(1, sum(drawn.values()) + 1))
        key = lambda c: sorted((n, k[3]) for k, n in c)
        assert key(ranks) == key(drawn)
    assert R.resample(df.limit(0), bench).count() == 0 and R.resample(df, bench.limit(0)).count() == len(rows)


def test_pieces_of_a_long_text_give_the_same_features(monkeypatch):
    import pyarrow as pa

    text = " ".join(["one", "two", "é" * 900, "z" * 5000, "Three-four"] * 300)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a b", text, None, "c"])})

    def gather():
        out = collections.Counter()
        for row, low, offsets, carried in R._pieces(batch):
            mark, owner, words = R.features(low, offsets, carried)
            out.update(zip((owner + row).tolist(), mark.tolist()))
            out.update({("words", row + i): int(n) for i, n in enumerate(words)})
        return +out
    whole = gather()
    monkeypatch.setattr(R, "PIECE", 2000)
    assert gather() == whole and whole["words", 1] == 1800
