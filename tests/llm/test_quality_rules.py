import math
import random
import re
from collections import Counter

from drivelake.llm import quality_rules as Q
from drivelake.llm import queries


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(w, w[1:], w[2:]))
    count, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), n < 50 or 100 * len(cover) > 50 * n


def counts(text):
    classes = [len(re.findall(p, text)) for p in ("[a-z]", "[A-Z]", r"[^\x00-\x7F]", "[0-9]", r"[\x20\x09-\x0D]", "[#*$%&|<>]")]
    return [*classes, len(text) - sum(classes)]


def distance(p, q):
    return math.sqrt(sum((a / 2 * math.log2(2 * a / (a + b)) if a else 0) + (b / 2 * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)))


def test_query_base_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r[0]: tuple(r[1:7]) for r in queries.QUERIES["op10_quality_rules"](spark, sf_dir).collect()}
    assert got == {r.doc_id: base(r.text or "") for r in docs}


def test_distances_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.assess(spark, spark.read.parquet(f"{sf}/documents.parquet")).collect()
    langs = Counter(r.lang for r in docs.values())
    words = {x: Counter() for x in langs}
    for r in docs.values():
        words[r.lang].update(re.findall(r"[^\x20\x09-\x0D]+", r.text.lower()))
    common = {x: [w for w, _ in sorted(c.items(), key=lambda i: (-i[1], i[0].encode()))[: Q.COMMON]] for x, c in words.items()}
    passed = [r for r in docs.values() if not base(r.text)[5]]
    refs = {}
    for x in langs:
        own = [r for r in passed if r.lang == x]
        median = []
        for i in range(7):
            share = sorted(counts(r.text)[i] / len(r.text) for r in own)
            median.append(share[math.ceil(len(share) / 2) - 1])
        total, hit = 0, Counter()
        for r in own:
            w = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
            total += len(w)
            hit.update(v for v in w if v in common[x])
        q = [hit[w] / total for w in common[x]]
        refs[x] = [m / sum(median) for m in median], [*q, 1 - sum(q)]
    for r in rows:
        text = docs[r.doc_id].text
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        if len(w) < Q.MIN_WORDS:
            assert r.class_distance is None and not r.kept
            continue
        p = [w.count(v) / len(w) for v in common[r.lang]]
        a, b = distance([c / len(text) for c in counts(text)], refs[r.lang][0]), distance([*p, 1 - sum(p)], refs[r.lang][1])
        assert abs(a - r.class_distance) < 1e-3 and abs(b - r.common_distance) < 1e-6
        assert r.kept == (not r.base_failed and a <= Q.MAX_CLASSES and b <= Q.MAX_COMMON)


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    found = Q.assess(spark, spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in found if r.quality], [r.kept for r in found if not r.quality]
    assert sum(good) >= 0.998 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["a ", "b ", "c\n", "\n", " \t", "x", "é", "#", "\x0b", " ", "\r\n"], k=rng.randint(0, 120))) for _ in range(300)]
    texts += ["same " * 60, "a b " * 40_000, " \n ", "\n\n"]
    docs = spark.createDataFrame([(i, t, rng.choice(["en", None, "xx"])) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.assess(spark, docs).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}
    rows = Q.assess(spark, odd_docs).collect()
    assert sorted(r.n_words for r in rows) == sorted(base(r.text or "")[0] for r in odd_docs.collect())
    assert Q.assess(spark, no_docs).count() == 0
    assert Q.kept(spark, odd_docs).columns == odd_docs.columns and Q.kept(spark, no_docs).columns == no_docs.columns


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.QUERIES["op10_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clean_documents_of_a_small_language_stay(spark):
    rng = random.Random(5)
    latin = ["the", "of", "and", *("".join(rng.choices("abcdefghij", k=6)) for _ in range(300))]
    greek = ["και", "το", "της", *("".join(rng.choices("αβγδεζηθικ", k=6)) for _ in range(300))]
    prose = lambda words: " ".join(rng.choices(words[:3], k=1)[0] if rng.random() < 0.3 else rng.choice(words) for _ in range(120))
    junk = lambda: " ".join("".join(rng.choices("#*$%&|<>", k=6)) for _ in range(120))
    rows = [(i, prose(latin), "en") for i in range(4500)]
    rows += [(5000 + i, prose(greek), "el") for i in range(40)] + [(5100, junk(), "el")]  # under 1 % of the rows
    rows += [(5200 + i, prose(greek), "rare") for i in range(5)] + [(5300 + i, prose(greek), None) for i in range(5)]  # nothing to judge by
    got = {r.doc_id: r for r in Q.assess(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i, _, _ in rows if i != 5100) and not got[5100].kept and not got[5100].base_failed
    assert got[5000].class_distance < 0.1 and got[5200].class_distance is None and got[5300].common_distance is None
