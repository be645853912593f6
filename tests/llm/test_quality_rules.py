import random
import re
from collections import Counter

import cases
import numpy as np

from meterqa.llm import quality


def counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


TEXTS = ["a a a", "a a a a", "a b c a b c", "x y z w x y z", "# * $ % & | < > é", "l\nl\n \nl\r\nl", "\n\n", "a b c d a b c b c d"]


def test_counts_against_brute_force(spark):
    texts = [r[1] for r in cases.odd_documents()] + TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", quality.text_counts(docs.text).alias("c")).collect()
    assert {r["doc_id"]: tuple(r["c"]) for r in got} == {i: counts(t) for i, t in enumerate(texts)}


def quantile(x, share):
    """The value that ``percentile_approx`` gives on few rows."""
    x = np.sort(x)
    return x[max(int(np.ceil(share * len(x))) - 1, 0)]


def robust(x):
    """Minimum covariance determinant as the operator defines it, with matrices."""
    floors = np.diag(np.square(quality.FLOORS))

    def fit(rows):
        return rows.mean(0), np.cov(rows.T, bias=True) + floors

    def distance(m, s):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)

    med = np.array([quantile(c, 0.5) for c in x.T])
    mad = np.array([max(quantile(abs(c - m), 0.5) * 1.4826, f) for c, m, f in zip(x.T, med, quality.FLOORS, strict=True)])
    found = []
    for m, s in ((med, np.diag(mad**2)), fit(x)):
        for _ in range(quality.STEPS):
            d = distance(m, s)
            m, s = fit(x[d <= quantile(d, quality.CORE)])
        found.append((np.linalg.slogdet(s)[1], m, s))
    _, m, s = min(found, key=lambda f: f[0])
    d = distance(m, s)
    m, s = fit(x[d <= quality.CHI2_975 * quantile(d, 0.5) / quality.CHI2_HALF])
    return distance(m, s)


def test_verdicts_against_matrices(spark):
    import random

    rng = random.Random(12)
    rows = []
    for i in range(300):
        lang, source = rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b"])
        text = cases.prose(rng, rng.randint(40, 120))
        if i % 11 == 0:
            text = " ".join(w + "***" for w in text.split())
        rows.append((i, text, lang, source, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, m int")
    got = {r["doc_id"]: r for r in quality.quality_verdicts(docs, least=60).collect()}
    stats = {r[0]: counts(r[1]) for r in rows}
    passed = {i: c[0] >= 50 and 100 * c[4] <= 50 * c[0] for i, c in stats.items()}
    sizes = Counter((r[2], r[3]) for r in rows if passed[r[0]])
    small = {k: n for k, n in sizes.items() if n < 60}
    by_lang = Counter()
    for (lang, _), n in small.items():
        by_lang[lang] += n
    rest = sum(n for n in by_lang.values() if n < 60)
    groups = {}
    for r in rows:
        key = (r[2], r[3])
        if key not in small:
            group = (0, *key)
        elif by_lang[r[2]] >= 60:
            group = (1, r[2])
        else:
            group = (2,) if rest >= 60 else None
        groups[r[0]] = group
    assert len({g for g in groups.values()}) > 2
    for group in set(groups.values()) - {None}:
        ids = [i for i, g in groups.items() if g == group and passed[i]]
        vectors = np.array([
            [np.log1p(c[0]), np.log(c[1] / c[0]), np.sqrt(c[2] / c[1]), np.sqrt(c[3] / c[5]), np.sqrt(c[4] / c[0])]
            for c in (stats[i] for i in ids)
        ])
        for i, d in zip(ids, robust(vectors), strict=True):
            assert np.isclose(got[i]["distance2"], d, rtol=1e-6, atol=1e-9)
            assert got[i]["kept"] == (d <= quality.CUT)
    assert all(not got[i]["kept"] and got[i]["base_failed"] for i in stats if not passed[i])
    junk = [i for i in range(0, 300, 11) if passed[i] and groups[i]]
    assert junk and all(not got[i]["kept"] for i in junk)


def test_duplicate_lines_and_repeats_alone_reject(spark):
    """Documents that pass the base rules and differ from a clean group in lines that recur, or in repeated words, or in both."""
    import random

    rng = random.Random(5)
    prose = lambda n: cases.prose(rng, n, vocabulary=3000).split()
    lines = lambda words: "\n".join(" ".join(words[i : i + 10]) for i in range(0, len(words), 10))
    rows = [(i, lines(prose(rng.randint(70, 130)))) for i in range(300)]
    rows += [(1000 + i, lines(prose(60)) + "\nrr" * 40) for i in range(3)]
    for i in range(3):
        words = prose(100)
        rows.append((2000 + i, lines(words[:54] + words[:23] + words[54:77])))
    for i in range(3):
        words = prose(100)
        # Each short line recurs between words that do not.
        rows.append((3000 + i, "\n".join(x for w in words for x in (w, "k3"))))
    docs = spark.createDataFrame([(*r, "en", "a") for r in rows], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [i for i, r in got.items() if i >= 1000 and r["kept"]] == []
    assert sum(r["kept"] for i, r in got.items() if i < 1000) >= 297


def test_odd_rows(spark):
    docs = cases.odd_table(spark)
    got = quality.quality_verdicts(docs)
    names = ("doc_id", *quality.COUNTS)
    want = [(r[0], *counts(r[1])[:5]) for r in cases.odd_documents()]
    assert cases.tuples(got, *names) == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    assert got.filter("kept and base_failed").count() == 0
    assert got.filter("distance2 is null and not base_failed").count() == 0  # few documents have the estimate of all
    left = quality.passing(docs)
    assert left.columns == docs.columns
    assert cases.tuples(left, "doc_id") == cases.tuples(got.filter("kept"), "doc_id")
    assert quality.quality_verdicts(cases.empty_table(spark)).count() == 0
    assert quality.passing(cases.empty_table(spark)).count() == 0


def test_few_documents_with_an_outlier(spark):
    rng = random.Random(21)
    rows = [(i, cases.prose(rng, rng.randint(80, 120)), f"l{i % 3}", f"s{i % 7}") for i in range(60)]
    rows.append((60, " ".join("#$%" * 12 for _ in range(90)), "l1", "s2"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.quality_verdicts(docs).collect()}
    rows[60] = (60, " ".join(f"#${chr(97 + i % 26)}%{i}#" for i in range(90)), "l1", "s2")
    again = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    odd = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.quality_verdicts(again).collect()}
    assert got[60][0] and odd[60] == (False, False)
    assert sum(kept for i, (_, kept) in odd.items() if i < 60) >= 58
    alone = spark.createDataFrame(rows[:1], "doc_id long, text string, lang string, source string")
    assert [(r["kept"], r["distance2"]) for r in quality.quality_verdicts(alone).collect()] == [(True, 0.0)]



def test_native(spark):
    plan = quality.passing(cases.odd_table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
