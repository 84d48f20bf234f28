import hashlib
import math
import random
import re
from collections import Counter

import regex

from drivelake.llm import queries
from drivelake.llm import sanitise as S


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    spans = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            spans.append((m.start(), 2, "card", m.end()))
    spans += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(spans)


def text_of(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def want(rows):
    return sorted(((d is not None, d or 0), *[sum(x[2] == k for x in base(t or "")) for k in S.KINDS], hashlib.sha256(text_of(base(t or "")).encode()).hexdigest()) for d, t in rows)


def given(rows):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = queries.QUERIES["op8_sanitise"](spark, sf)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = found.collect()
    assert given(rows) == want([(r.doc_id, r.text) for r in docs])
    texts = {r.doc_id: r.text for r in docs}
    told = told_words(texts.values())
    assert {r.doc_id: r.spans for r in rows} == {i: all_spans(t, told) for i, t in texts.items()}


def test_odd_texts(spark, odd_docs, no_docs):
    rng = random.Random(8)
    bits = ["a", "1", "22", "255", "256", ".", "@", "-", " ", "+", "%", "_", "x.y", "4111 1111 1111 1111", "a@b.c", "+1 (555) 010-9999", "10.0.0.1", "é", "\U0001f600", "\n", "("]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(1500)]
    texts += ["x@y.zz%foo@bar.com", "a" * 20_000 + "@", "1." * 20_000, "a@" + "b." * 20_000 + "c", "1 " * 20_000, "0010.000255.1.2", "9" * 5000 + ".1.1.1", "+" + "1" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    assert given(S.findings(spark, docs).collect()) == want([(r.doc_id, r.text) for r in docs.collect()])
    assert S.findings(spark, no_docs).count() == 0


def told_words(texts):
    """The disclosing words by brute force: every word of a text with entities against each of them."""
    texts = set(texts)
    n = len(texts)
    words = {t: {w for w in regex.findall(r"\p{L}{3,}", t.lower())} for t in texts}
    ents = {t: {(k, t[a:b].lower()) for a, _, k, b in base(t)} for t in texts}
    df, held, both = Counter(w for t in texts for w in words[t]), Counter(e for t in texts for e in ents[t]), Counter()
    for t in texts:
        both.update((w, e) for w in words[t] for e in ents[t])
    out = set()
    for (w, e), c in both.items():
        ic = math.log2(n / held[e])
        if ic > 0 and math.log2(n * (S.ONCE if c == 1 else c - S.DISCOUNT) / (df[w] * held[e])) >= S.DISCLOSED * ic:
            out.add(w)
    return out


def all_spans(text, told):
    spans = base(text)
    found = [(m.start(), 4, "term", m.end()) for m in regex.finditer(r"\p{L}{3,}", text) if m[0].lower() in told]
    return text_of(sorted(spans + [t for t in found if not any(b[0] < t[3] and t[0] < b[3] for b in spans)]))


def check_all(spark, rows):
    """Spans of (doc_id, text) against brute force; the disclosing words."""
    told = told_words([t or "" for _, t in rows])
    got = {r.doc_id: r.spans for r in S.findings(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: all_spans(t or "", told) for i, t in rows}
    return told


COMMON = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]


def test_words_that_disclose_an_entity(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(COMMON, k=30))) for i in range(200)]
    rows += [(200 + i, f"{' '.join(rng.choices(COMMON, k=5))} Zorblax called ann@ex.org about quibbling {' '.join(rng.choices(COMMON, k=20))} Farawayword") for i in range(4)]
    rows += [(300, "Zorblax alone"), (301, "one lonely rareword near bob@ex.org")]
    assert check_all(spark, rows) == {"zorblax", "called", "about", "quibbling", "farawayword", "ann", "org"}  # parts of the address too
    docs = spark.createDataFrame([(i, t, "k", i) for i, t in rows], "doc_id long, text string, kind string, start long")
    clean = {r.doc_id: r for r in S.sanitised(spark, docs).collect()}
    assert "[EMAIL]" in clean[200].text and "[NAME]" in clean[200].text and not re.search("quibbling|Zorblax|Faraway", clean[200].text)
    assert clean[0].text == rows[0][1] and clean[300].text == "[NAME] alone" and clean[301].text == "one lonely rareword near [EMAIL]" and clean[200].kind == "k"


def test_names_near_an_entity_of_one_text(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(COMMON, k=30))) for i in range(300)]
    rows += [(400, f"{COMMON[0]} Quendolin {COMMON[1]} bob@ex.org {COMMON[2]}"), (401, f"{COMMON[3]} Marvolo {COMMON[4]} +1 555 010 9999 {COMMON[5]}"), (402, f"Marvolo {COMMON[6]} +1 555 010 9999")]
    once = {r.doc_id: r.spans for r in S.findings(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert once[400] == "term:4:13,email:18:28" and once[401] == "term:4:11,phone:16:31" and once[402] == "term:0:7,phone:12:27"
    copies = rows + [(500 + i, rows[300][1]) for i in range(200)]  # these neither add support nor make the entity common
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.findings(spark, docs).collect()}
    assert all(got[i] == once[i if i < 500 else 400] for i, _ in copies)
    assert {r.doc_id: r.text for r in S.sanitised(spark, docs).collect()}[400] == f"{COMMON[0]} [NAME] {COMMON[1]} [EMAIL] {COMMON[2]}"


def test_disclosing_words_at_all_their_places(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(COMMON, k=30))) for i in range(300)]
    gap = " ".join(COMMON[:30])
    far = f"Quendolin bob@ex.org {gap} Quendolin {gap} quendolin"
    rows += [(400, far), (401, f"bob@ex.org {gap} Quendolin {gap}")]  # in the second text only far from the entity
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.findings(spark, docs).collect()}
    at = [m.start() for m in re.finditer("(?i)quendolin", far)]
    assert got[400] == ",".join([f"term:{at[0]}:{at[0] + 9}", "email:10:20", *[f"term:{i}:{i + 9}" for i in at[1:]]])
    assert got[401] == f"email:0:10,term:{rows[301][1].index('Q')}:{rows[301][1].index('Q') + 9}"
    clean = {r.doc_id: r.text for r in S.sanitised(spark, docs).collect()}
    assert clean[400] == f"[NAME] [EMAIL] {gap} [NAME] {gap} " and clean[401] == f"[EMAIL] {gap} [NAME] {gap}"


def test_names_far_from_the_entity_and_in_other_texts(spark):
    """A name forty words from the only address; a name in one text with the address and in one without."""
    rng = random.Random(6)
    gap = " ".join(rng.choices(COMMON, k=40))
    rows = [(i, " ".join(rng.choices(COMMON, k=30))) for i in range(600)]
    rows += [(700, f"Ottoline {gap} ann@ex.org")]
    rows += [(800 + i, f"Perpetua writes from {gap} eve@ex.org number{'abcdef'[i]}") for i in range(4)] + [(810, f"{gap} Perpetua {COMMON[0]}")]
    assert {"ottoline", "perpetua"} <= check_all(spark, rows)


def test_spans_of_a_table_by_brute_force(spark):
    """All spans of the documents of sf0.001, and how many names of two and three texts that stand with one address are found."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(7)
    rows = [(100_000 + i, " ".join(rng.choices(COMMON, k=9))) for i in range(22_000)]
    names = ["".join(rng.choices("abcdefghij", k=9)).capitalize() for _ in range(60)]
    for i, name in enumerate(names):  # a name with one address in one text, without it in one or two more
        rows += [(20_000 + 10 * i + k, f"{' '.join(rng.choices(COMMON, k=9))} {name}" + (f" a{i}@ex.org" if not k else "")) for k in range(2 + i % 2)]
    told = check_all(spark, docs + rows)
    assert sum(n.lower() in told for n in names[::2]) == 30  # two texts: all, from 21,600 texts on
    assert sum(n.lower() in told for n in names[1::2]) == 0  # three texts take a larger corpus: N ** 0.15 * 0.448 >= 3, some 320,000 texts


def test_a_text_of_many_entities(spark):
    """2,000 addresses and 2,000 words in one text make one pair of classes, not four million."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklm", k=8)) for _ in range(2000)]
    big = " ".join(f"{w} u{i}@ex.org" for i, w in enumerate(words))
    rows = [(i, " ".join(rng.choices(COMMON, k=20))) for i in range(300)] + [(900, big)]
    assert set(words) <= check_all(spark, rows)
