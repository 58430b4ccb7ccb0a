"""The code point model against hand computation, and on texts that differ only
in their order, digits or punctuation."""

import random

import numpy as np
import pyarrow as pa

from ledgerwatch.llm import queries, token_lm


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    model = token_lm.Model(np.arange(300), rng.integers(1, 50, 300))
    window, token = rng.integers(0, model.size, (20, token_lm.WINDOW)), rng.integers(1, model.size - 1, 20)
    grad, flat = token_lm.gradient(model, model.flat.astype(np.float64), window, token), model.flat.astype(np.float64)
    for at in rng.choice(np.flatnonzero(grad), 40).tolist():
        sides = []
        for by in (1e-5, -1e-5):
            model.flat = flat.copy()
            model.flat[at] += by
            sides.append(-token_lm.log_probability(model, window, token).mean())
        assert abs((sides[0] - sides[1]) / 2e-5 - grad[at]) < 1e-6
    model.flat = flat
    every = np.arange(model.size)
    assert abs(np.exp(token_lm.log_probability(model, np.repeat(window[:1], len(every), axis=0), every)[1:-1]).sum() - 1) < 0.05


def test_order_digits_and_punctuation_count(spark, tmp_path):
    rng = random.Random(5)
    signs = ["".join(chr(rng.randint(0x4E00, 0x4F00)) for _ in range(4)) for _ in range(30)]
    chinese = ["。".join(rng.choice(signs) for _ in range(60)) for _ in range(60)]
    facts = [" ".join("in 1984, (a)" for _ in range(30)) for _ in range(60)]
    shuffled = ["".join(rng.sample(t, len(t))) for t in chinese[:10]]
    odd = [facts[0].replace("1984", "4198"), facts[0].replace(",", ";"), None, "", "\U0001F600"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(chinese + facts)], "doc_id long, text string, n_tokens int")
    model = token_lm.fit(docs)
    test = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*chinese[:10], *shuffled, facts[0], *odd, chinese[0]])], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_lm.score_documents(test, model).collect()}
    mean = lambda ids: np.mean([got[i].mean_log_likelihood for i in ids])
    assert mean(range(10)) > 1 + mean(range(10, 20))
    assert got[20].log_likelihood > 10 + max(got[21].log_likelihood, got[22].log_likelihood)
    assert got[23].n_tokens == got[24].n_tokens == 0 and got[23].mean_log_likelihood is None and got[25].n_tokens == 1 and got[26].log_likelihood == got[0].log_likelihood
    ids = model.ids()[[ord(c) for c in chinese[0]]].tolist()
    line = [0] * 3 + ids + [0] * 3
    window = np.array([line[i - 3: i] + line[i + 1: i + 4] for i in range(3, 3 + len(ids))])
    assert abs(token_lm.log_probability(model, window, np.array(ids)).sum() - got[0].log_likelihood) < 1e-2
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op6_lm_scoring(spark, str(tmp_path)).where("log_likelihood < 0").count() == 120


def test_a_large_vocabulary_keeps_windows_apart():
    texts = ["".join(chr(0x4E00 + (7 * i + j) % 900) for j in range(50)) for i in range(30)] + ["", "ab"]
    model = token_lm.Model(np.arange(0x4E00, 0x4E00 + 900), np.ones(900))
    line = token_lm.Line([("", t, "") for t in texts], model.ids())
    spot, where = token_lm._distinct(line, model.size)
    (window, token), count = line.windows(spot), np.bincount(where)
    seen = {}
    for t in texts:
        ids = [0] * 3 + model.ids()[[ord(c) for c in t]].tolist() + [0] * 3 if t else [0] * 6
        for i in range(3, len(ids) - 3):
            key = tuple(ids[i - 3: i + 4])
            seen[key] = seen.get(key, 0) + 1
    assert {(*x[:3], t, *x[3:]): n for x, t, n in zip(window.tolist(), token.tolist(), count.tolist())} == seen and line.counts.sum() == len(where)


def test_every_window_is_learned_from(spark):
    texts = ["ab" * 50_000, "", None, "xyz", *["one text of many " * 20] * 40]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    pieces = docs.mapInArrow(token_lm._deal(3), "place long, turn int, before string, text string, after string").collect()
    assert sum(len(p.text) for p in pieces) == sum(len(t or "") for t in texts) and {p.turn for p in pieces} == {0, 1, 2}
    whole = texts[0]
    longs = [p for p in pieces if set(p.text) <= set("ab")]
    assert all(len(p.text) <= token_lm.DEALT and p.before + p.text + p.after in whole for p in longs) and sum(p.before == "" for p in longs) == 1
    model = token_lm.Model(np.arange(32, 123), np.ones(91))
    rows = spark.createDataFrame(pieces, "place long, turn int, before string, text string, after string")
    parts = rows.mapInArrow(token_lm._round(spark.sparkContext.broadcast(model), 0), "place int, level int, part binary, weight double")
    assert parts.where("place = 0").agg({"weight": "sum"}).first()[0] == sum(len(t or "") for t in texts)


def test_equal_windows_learned_together_count_by_their_number():
    texts = ["so it is and so it was, " * 40, "x", *["a line of many, " * 9] * 30]
    for vocabulary in (np.arange(32, 123), np.arange(32, 932)):         # whole windows as keys, and fingerprints
        model = token_lm.Model(vocabulary, np.ones(len(vocabulary)))
        ids, counts = model.ids(), token_lm.Counts(model, model.ids())
        pieces = [("", t, "") for t in texts]
        counts.add(pieces[:20])
        counts.add(pieces[20:])
        tokens, (column, lot, copies) = counts.tokens, counts.lots()
        line = token_lm.Line(pieces, ids)
        assert tokens == round(float(copies.sum())) == len(line.spot) and copies.max() <= token_lm.LOT and len(lot) < tokens / 8 and not counts.rows
        rows, p = column[:, lot].astype(np.intp), model.parts(model.flat.astype(np.float64))
        together, apart = np.zeros(len(model.flat)), token_lm.gradient(model, model.flat.astype(np.float64), *line.windows(line.spot))
        d = model.parts(together)
        for name, where, values in token_lm.gradients(model, p, rows[:-1].T, rows[-1], copies):
            d[name][where] = values
        assert np.allclose(together, apart, rtol=0, atol=1e-6) and np.abs(apart).max() > 1e-3


def test_a_large_partition_is_learned_from_whole_in_fewer_steps(spark, monkeypatch):
    monkeypatch.setattr(token_lm, "LEAST_STEPS", 1)
    monkeypatch.setattr(token_lm, "PLAIN", 1 << 12)
    monkeypatch.setattr(token_lm, "MIXED", 1 << 12)
    monkeypatch.setattr(token_lm, "GROUPED", 1 << 15)
    monkeypatch.setattr(token_lm, "HELD", 40)
    monkeypatch.setattr(token_lm, "BATCH", 64)
    steps = []

    class Counted(token_lm.Learner):
        def learn(self, *rows):
            super().learn(*rows)
            steps.append(len(rows[1]))

    class Shared:
        value = token_lm.Model(np.arange(32, 123), np.ones(91))

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(token_lm, "Learner", Counted)
    monkeypatch.setattr("pyspark.TaskContext", Task)
    texts = ["one text of many " * 20] * 400
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 400), pa.array(texts), pa.array([""] * 400)], ["before", "text", "after"])
    got = list(token_lm._round(Shared, 0)(iter([batch])))
    assert got[0].column("weight").to_pylist()[0] == sum(map(len, texts)) and len(steps) < sum(map(len, texts)) / token_lm.BATCH / 4
