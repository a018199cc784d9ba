"""The filter audit against plain rules, document by document and order by order."""

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from shelfwise.llm import filter_audit

ROWS = [
    (1, None, "a"), (2, "", "a"), (3, "same text", "a"), (4, "same text", None), (4, "same text", ""), (5, "same text", "b"), (None, "same text", "b"), (None, None, "b"), (6, "X" * 9000 + " y", "a"),
    (7, "word " * 300, "a"), (8, " ".join(f"w{i}" for i in range(250)), "a"), (9, " ".join(f"w{i}" for i in range(250)), "b"), (10, "a|b", "b"), (11, "Ab\x0bCd ef É", "b"), (12, "same text", "a"), (12, "same text", "a"),
]
LABELS = [(3, 1, 0), (3, 0, 1), (5, 0, 0), (8, 1, 1), (12, 1, None), (None, 1, 1), (99, 1, 1)]


def plain(rows, labels):
    least, failed = {}, []
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        mine = [x for x in labels if i is not None and x[0] == i]
        failed.append((source or "", {f for f in bad if bad[f]}, any(q == 1 for _, q, _ in mine), any(x == 1 for _, _, x in mine)))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in failed}:
        for order in map("".join, permutations("ABCDE")):
            here = [x for x in failed if x[0] == part]
            left = here
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(removed)
                all_failing = sum(f in x[1] for x in here)
                out[part, order, step] = [len(left), len(removed), all_failing - len(removed), sum(x[1] == {f} for x in here), sum(x[2] for x in removed), sum(x[3] for x in removed)]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_equals_plain_rules(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("n", "mask", "sha", "part", "salt", "first", "good", "toxic", "a.b")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("salt", F.lit(3))
    got = filter_audit.audit(docs, labels).collect()
    want = plain(ROWS, LABELS)
    assert len(got) == len(want) == 3 * 600
    assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in got} == want


def test_intervals_are_where_a_mask_leaves():
    orders = filter_audit.ORDERS
    left = {(mask, r): s for mask, s, a, b in filter_audit.intervals() for r in range(a, b)}
    assert len(left) == 31 * 120 and orders == sorted(orders)
    for (mask, r), step in left.items():
        assert step == 1 + min(k for k, f in enumerate(orders[r]) if mask >> "ABCDE".index(f) & 1)


def test_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    rows = filter_audit.audit(docs, labels.where("false")).where("part = 'a' AND step = 5").collect()
    assert len(rows) == 120 and all(r["good_lost"] == r["toxic_lost"] == 0 and r["kept"] == rows[0]["kept"] for r in rows)
