import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import language_model as L


def brute(texts):
    """Interpolated modified Kneser-Ney over bytes, order three, straight from its definition."""
    three = Counter()
    for t in texts:
        b = b"\0\0" + t.encode()
        three.update(b[i : i + 3] for i in range(len(b) - 2))
    two, one = Counter(g[1:] for g in three), Counter()
    one = Counter(g[1:] for g in two)

    def discounts(c):
        n = Counter(c.values())
        n1, n2, n3, n4 = (n[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        raw = [i - (i + 1) * y * (b / a) if a else i / 2 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]

    tables = []
    for c in (one, two, three):
        d, total, held = discounts(c), defaultdict(int), defaultdict(float)
        for g, n in c.items():
            total[g[:-1]] += n
            held[g[:-1]] += d[min(n, 3) - 1]
        tables.append((c, d, total, held))

    def p(g):
        if not g:
            return 1 / 256
        c, d, total, held = tables[len(g) - 1]
        h = g[:-1]
        if h not in total:
            return p(g[1:])
        n = c.get(g, 0)
        return ((n - d[min(n, 3) - 1]) if n else 0) / total[h] + held[h] / total[h] * p(g[1:])

    return p


def test_probabilities_agree_with_the_definition(spark):
    texts = ["the cat sat on the mat", "the bat", "a cat, a hat", "", "été là"]
    orders = L.fit(spark, spark.createDataFrame([(t,) for t in texts], "text string"))
    logs, p = L.log_table(orders), brute(texts)
    rng = np.random.default_rng(0)
    some = [b"the", b"\0\0t", b"\0th", b"zzz", b"cat", b"at\0", b" a "] + [bytes(rng.integers(0, 256, 3).tolist()) for _ in range(50)]
    for g in some:
        assert math.isclose(math.exp(logs[int.from_bytes(g, "big")]), p(g), rel_tol=1e-4)
    assert abs(np.exp(logs).reshape(-1, 256).sum(axis=1) - 1).max() < 1e-3


def test_perplexities_of_documents(spark, docs, rows):
    orders = L.fit(spark, docs.select("text"))
    logs = L.log_table(orders)
    got = L.perplexities(docs.select("doc_id", "lang", "text"), orders, "text").collect()
    want = Counter()
    for r in rows:
        b = b"\0\0" + (r[1] or "").encode()
        v = [logs[int.from_bytes(b[i : i + 3], "big")] for i in range(len(b) - 2)]
        want[r[0], len(v), round(math.exp(-sum(map(float, v)) / len(v)), 4) if v else None] += 1
    assert Counter((r.doc_id, r.n_bytes, r.perplexity and round(r.perplexity, 4)) for r in got) == want


def test_held_out_documents(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeilmnorst"), rng.integers(2, 8))) for _ in range(200)]
    good = [" ".join(rng.choice(words, 80)) for _ in range(300)]
    bad = ["".join(chr(int(c)) for c in rng.integers(33, 126, 400)) for _ in range(40)]
    rows = [(i, t, "en", 1 if i < 300 else 0) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good long")
    labels = docs.where("doc_id % 2 = 0").select("doc_id", F.col("good").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    out = L.judge(docs.drop("good"), labels).join(docs, "doc_id").where("doc_id % 2 = 1")
    assert out.where("kept AND good = 0").count() == 0
    assert out.where("NOT kept AND good = 1").count() <= 3


def test_defined_cases(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    out = L.judge(docs, none)
    assert out.where("NOT kept").count() == out.where("n_bytes = 0").count()
    every = docs.select("doc_id", F.lit(1).cast("long").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    assert L.judge(docs, every).count() == docs.count()
    kept = L.keep_fluent(docs, every)
    assert kept.columns == docs.columns and kept.where("text IS NULL OR text = ''").count() == 0
    assert L.judge(no_docs, none).count() == 0
    assert L.keep_fluent(no_docs, every).count() == 0


def chained(rng, follow, n):
    at, out = int(rng.integers(len(follow))), []
    for _ in range(n):
        out.append(at)
        at = int(rng.choice(follow[at]))
    return out


def test_word_salad_and_repeated_words_are_not_kept(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeilmnorst"), rng.integers(3, 8))) for _ in range(200)]
    follow = (np.arange(200)[:, None] + rng.integers(1, 200, (200, 3))) % 200  # never itself
    good = [[words[k] for k in chained(rng, follow, 100)] for _ in range(400)]
    salad = [list(rng.permutation(t)) for t in good[:50]]
    stuck = [[t[0]] * 100 for t in good[50:80]]
    rows = [(i, " ".join(t), "en", int(i < 400)) for i, t in enumerate(good + salad + stuck)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good long")
    labels = docs.where("good = 1 AND doc_id % 2 = 0").select("doc_id", F.col("good").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    out = L.judge(docs.drop("good"), labels).join(docs.select("doc_id", "good"), "doc_id")
    assert out.where("kept AND good = 0").count() == 0
    assert out.where("NOT kept AND good = 1").count() <= 6


def brute_words(texts, spelled):
    """Log of the probability of each word's place, from the definition; ``spelled`` gives that of the spelling."""
    three = Counter()
    for t in texts:
        w = ["<s>", "<s>", *t.split()]
        three.update(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    two = Counter(g[1:] for g in three)
    tables = []
    for c in (Counter(g[1:] for g in two), two, three):
        n = Counter(c.values())
        n1, n2, n3, n4 = (n[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        raw = [i - (i + 1) * y * (b / a) if a else i / 2 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        d = [min(max(x, 0.1), i) for i, x in enumerate(raw, 1)]
        total, held = Counter(), Counter()
        for g, k in c.items():
            total[g[:-1]] += k
            held[g[:-1]] += d[min(k, 3) - 1]
        tables.append((c, d, total, held))

    def p(g):
        if not g:
            return spelled
        c, d, total, held = tables[len(g) - 1]
        h = g[:-1]
        if not total[h]:
            return p(g[1:])
        k = c[g]
        return ((k - d[min(k, 3) - 1]) if k else 0) / total[h] + held[h] / total[h] * p(g[1:])

    return p


def test_word_probabilities_agree_with_the_definition(spark):
    texts = ["the cat sat on the mat", "the cat sat", "the bat", "a cat sat on a hat", "été là", ""]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, model int")
    orders, model = L.fit(spark, df.select("text")), L.fit_words(df)
    logs = L.log_table(orders)
    asked = ["the cat sat on a mat", "zebra  the cat\n", " ", "", "on"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.perplexity) for r in L.fluency(docs, model, orders, "text", F.lit(0)).collect()}
    for i, t in enumerate(asked):
        b, at, total = b"\0\0" + t.encode(), 0, 0.0
        each = [float(logs[int.from_bytes(b[k : k + 3], "big")]) for k in range(len(b) - 2)]
        words, spelled = ["<s>", "<s>", *t.split()], {}
        for k, w in enumerate(t.split()):
            at = t.index(w, at)
            spelled[k] = range(at, at + len(w))
            at += len(w)
        total = sum(each) - sum(each[j] for r in spelled.values() for j in r)
        for k, r in spelled.items():
            total += math.log(brute_words(texts, math.exp(sum(each[j] for j in r)))(tuple(words[k : k + 3])))
        if t:
            assert got[i][0] == len(t) and math.isclose(got[i][1], math.exp(-total / len(t)), rel_tol=1e-6), t
        else:
            assert got[i] == (0, None)


def test_more_than_64_languages_have_thresholds_of_their_own(spark):
    rng = np.random.default_rng(7)
    rows = [(10 * k + i, " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(10 + k)), f"l{k}") for k in range(70) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).cast("long").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    out = L.judge(docs, labels, least=2).join(docs.select("doc_id", "lang"), "doc_id").collect()
    worst = {k: max(r.perplexity for r in out if r.lang == k) for k in {r.lang for r in out}}
    assert all(math.isclose(r.threshold, 1.25 * worst[r.lang]) for r in out)


def test_the_model_is_small_and_no_question_moves_it(spark):
    rng = np.random.default_rng(11)
    texts = [" ".join(map(str, rng.integers(0, 20_000, 2000))) for _ in range(40)]
    model = L.fit_words(spark.createDataFrame([(t, 1) for t in texts], "text string, model int"))
    asked = spark.range(8).select(F.col("id").cast("int").alias("shard"), "id")
    joined = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(lambda a, b: a.select(["id"]), "id long")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    keys = 40 * 2000 * 2  # nearly all pairs and trigrams occur once
    size = model.where("kind > 1").agg(F.sum(F.octet_length("entries"))).first()[0]
    assert 6 * keys < size < 10 * keys


def test_words_are_named_by_their_bytes_alone():
    import pyarrow as pa

    words = [b"", b"a", b"b", b"ab", b"ba", b"a" * 24, b"a" * 25, b"a" * 300, b"a" * 24 + b"b", "é".encode()]
    names = L._hashes(pa.array(words, pa.large_binary()))
    assert len(set(names.tolist())) == len(words)
    for k, w in enumerate(words):
        assert L._hashes(pa.array([b"other", w], pa.large_binary()))[1] == names[k]
        assert L._hashes(pa.array([b"x" * 30, w], pa.large_binary()).slice(1))[0] == names[k]
