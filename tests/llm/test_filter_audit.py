"""The audit against every order applied document by document, and the recursive walk alone."""

import re
from itertools import permutations

from oddsflow.llm import filter_audit
from oddsflow.llm.queries import op12_filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def fails(text, copied):
    words = WORD.findall(text)
    out = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
           "D": bool(re.search(r"[#$%&*|]", text)), "E": copied}
    return {k for k, v in out.items() if v}


def brute(docs, labels):
    """Rows (part, order, step, measures...) by applying every order to every document."""
    smallest, good, toxic = {}, {}, {}
    for i, _, t in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    for i, q, x in labels:
        good[i], toxic[i] = good.get(i) or q == 1, toxic.get(i) or x == 1
    parts = {}
    for i, lang, t in docs:
        t = t or ""
        failed = fails(t, i is not None and smallest[t] < i)
        parts.setdefault(lang or "", []).append((failed, bool(i is not None and good.get(i)), bool(i is not None and toxic.get(i))))
    out, shapley = {}, {}
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before, now = set(order[:step - 1]), set(order[:step])
                hit = [(f, g, x) for f, g, x in rows if letter in f]
                gone = [r for r in hit if not r[0] & before]
                out[part, order, step] = [sum(not f & now for f, _, _ in rows), len(gone), len(hit) - len(gone), sum(f == {letter} for f, _, _ in hit),
                                          sum(g for _, g, _ in gone), sum(x for _, _, x in gone)]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_every_order_applied(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [(1, "en", long), (2, "en", long), (2, "fr", long), (2, "fr", long), (None, "fr", long), (None, None, ""), (3, "en", None), (4, None, ""), (5, "", "A B C #"),
            (6, "de", "same " * 300), (7, "de", "SAME " * 300 + "$"), (8, "de", "SAME " * 300 + "$"), (9, "de", " \t\r\n\x0b\x0c"), (10, "de", "\x1cx\x85"), (0, "en", "É" * 9)]
    docs += [(100 + k, "hot", "copied | text") for k in range(300)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (8, 0, 1), (7, 1, None), (None, 1, 1), (120, 1, 1), (120, 1, 1), (10**6, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, lang string, text string").selectExpr("*", "1 as mask", "'x' as part", "2 as n").repartition(4)
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*MEASURES, "shapley")) for r in filter_audit.audit(d, l).collect()}
    assert got == brute(docs, labels)
    assert filter_audit.audit(d.limit(0), l).collect() == []
    none = filter_audit.audit(d, l.limit(0)).where("good_lost + toxic_lost > 0")
    assert none.collect() == []


def test_walk_holds_each_prefix_once(spark):
    cells = spark.createDataFrame([("p", m, 1, 0, 0) for m in (0, 5, 31)], "part string, mask int, n long, good long, toxic long")
    rows = filter_audit.enumerate_steps(cells).collect()
    assert len(rows) == 3 * (5 + 20 + 60 + 120 + 120) == len({(r.prefix, r.mask) for r in rows})
    for r in rows:
        bit = lambda c: 1 << "ABCDE".index(c)
        before, last = sum(bit(c) for c in r.prefix[:-1]), bit(r.prefix[-1])
        assert (r.kept, r.removed, r.redundant, r.alone) == (
            not r.mask & (before | last), bool(r.mask & last) and not r.mask & before, bool(r.mask & last and r.mask & before), r.mask == last)


def test_query_on_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    got = {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*MEASURES, "shapley")) for r in op12_filter_audit(spark, sf).collect()}
    assert got == brute(docs, labels)
