import math
import re
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_agree_with_brute_force(spark, docs, rows):
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    got = Q.apply_rules(docs, labels).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    have = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key)
    assert have == sorted(((r[0], *brute(r[1])) for r in rows), key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels only the base rules decide


def test_allowed_is_the_exact_binomial_bound(spark):
    cases = [(n, risk, level) for n in (1, 50, 300, 458, 459, 2000, 20000) for risk in (0.01, 0.05) for level in (0.05, 0.001)]
    df = spark.createDataFrame([(n,) for n in {c[0] for c in cases}], "n long")
    for risk in (0.01, 0.05):
        for level in (0.05, 0.001):
            got = dict(df.select("n", Q.allowed(F.col("n"), risk, F.lit(math.log(level)))).collect())
            for n, k in got.items():
                total, best = 0.0, -1
                for j in range(int(n * risk) + 1):
                    total += math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(risk) + (n - j) * math.log1p(-risk))
                    if total <= level:
                        best = j
                assert k == best, (n, risk, level)


def test_certified_cutoffs_reject_junk_and_few_good_documents(spark):
    good, junk = "plain words of a text " * 12, "bad*** text### with$$$ symbols%%% " * 15
    rows = [(i, (f"w{i} " + " ".join(f"{x}{i}{j}" for j, x in enumerate(good.split()))), "en") for i in range(1200)]
    rows += [(5000 + i, " ".join(f"{x}{j}" for j, x in enumerate(junk.split())), "en") for i in range(200)]
    rows += [(9000 + i, " ".join(f"{x}{j}" for j, x in enumerate(junk.split())), "fr") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 5000).cast("long").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    out = Q.apply_rules(docs, labels).groupBy((F.col("doc_id") / 5000).cast("int").alias("g"), "kept").count().collect()
    by = {(r.g, r.kept): r["count"] for r in out}
    assert by == {(0, True): 1200, (1, False): 200 + 0, (1, True): 30}  # no good labels in fr: nothing certified


def test_filter_keeps_columns_and_empty_tables(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert Q.keep_good(no_docs, labels).columns == no_docs.columns
    assert Q.keep_good(no_docs, labels).count() == 0
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert all(brute(r.text)[0] >= 50 for r in kept.collect())


def test_more_than_64_strata_have_cutoffs_of_their_own(spark):
    def text(i, sign):
        return " ".join(f"w{i}x{j}{sign if j % 2 else ''}" for j in range(60))

    rows = [(100 * k + i, text(i, "***" if i >= 30 or k == 70 else ""), f"l{k:02}", int(i < 30)) for k in range(70) for i in range(36)]
    # One language whose good documents look as bad ones do elsewhere, with fewest labels; one without labels.
    rows += [(8000 + i, text(i, "***"), "odd", 1) for i in range(26)]
    rows += [(9000 + i, text(i, "***"), "new", None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality long")
    labels = docs.select("doc_id", "quality", F.lit(0).cast("long").alias("toxic"))
    out = Q.apply_rules(docs.drop("quality"), labels, control=Q.Risk(risk=0.3)).join(docs.select("doc_id", "quality", "lang"), "doc_id")
    assert out.where("NOT kept AND quality = 1").count() == 0
    assert out.where("kept AND quality = 0").count() == 0
    assert out.where("kept AND lang = 'new'").count() == 5


def test_repeated_and_conflicting_labels_change_nothing(spark):
    """A hundred good labels certify nothing at one per cent, and neither do they ten times over."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(100)]
    rows += [(500 + i, " ".join(f"w{i}y{j}***" for j in range(60)), "en") for i in range(50)]
    docs = spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 500)) for r in rows], "doc_id long, quality long")
    many = labels
    for _ in range(9):
        many = many.unionByName(labels)
    torn = labels.unionByName(labels.where("doc_id >= 500").withColumn("quality", F.lit(1).cast("long")))
    for some in (labels, many, torn):
        assert Q.apply_rules(docs, some).where("NOT kept").count() == 0
    loose = Q.Risk(risk=0.1)
    once, often = (sorted(map(tuple, Q.apply_rules(docs, some, control=loose).collect())) for some in (labels, many))
    assert once == often and sum(not r[8] for r in once) == 50
    assert Q.apply_rules(docs, torn, control=loose).where("NOT kept").count() == 0
