import itertools
import re

from pyspark.sql import functions as F

from sitepulse.llm import audit
from tests.llm.conftest import same_rows

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Every order walked through, document by document."""
    texts = [(d, t or "", s or "") for d, t, s in rows]
    fails = []
    for d, t, _ in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and any(t == u and e is not None and e < d for e, u, _ in texts)})
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    removed, out = {}, {}
    for part in {s for _, _, s in texts}:
        own = [(d, f) for (d, _, s), f in zip(texts, fails) if s == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if f[letter]]
                left = [(d, f) for d, f in left if not f[letter]]
                removed[part, letter] = removed.get((part, letter), 0) + len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f[letter] for _, f in own) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
    return {(p, o, s, *v, removed[p, o[s - 1]]) for (p, o, s), v in out.items()}


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
         "good_lost", "toxic_lost", "shapley"]


def many(*words):
    return " ".join(words) + " " + " ".join(f"word{i}" for i in range(60))


ROWS = [
    (1, many(), "s1"), (2, many(), "s1"), (3, many(), "s2"), (3, many(), "s2"), (3, many("x"), "s2"),
    (4, None, "s1"), (5, "", None), (6, "", ""), (None, many(), "s1"), (None, "short", "s1"),
    (None, "short", "s1"), (7, "short", "s1"), (8, "SHORT #", "s2"), (9, "SHORT #", "s2"),
    (10, "a " * 400, "s2"), (11, "a " * 400 + "|", "s3"), (12, "AB " * 300_000, "s3"),
    (13, "one\x0btwo\x85three " * 30, "s3"), (0, "AB " * 300_000, "s1"),
]
JUDGED = [(2, 1, 0), (3, 1, 1), (3, 0, 0), (9, None, 1), (10, 1, None), (99, 1, 1), (None, 1, 1)]


def test_brute_force_and_sql(spark, documents, folder):
    docs, labels = documents(ROWS), spark.createDataFrame(JUDGED, LABELS)
    at = folder(documents=docs, labels=labels)
    out = audit.op13_filter_audit(spark, at)
    assert {tuple(r) for r in out.select(*NAMES).collect()} == brute(ROWS, JUDGED)
    same_rows(out, at, audit.SQL)


def test_shuffled_and_salted(spark, documents, folder, monkeypatch):
    """Without a broadcast of the repeated hashes, and with a hot text in many groups."""
    monkeypatch.setattr(audit, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(audit, "SALTED", 2)
    rows = ROWS + [(i, many("hot"), "s1") for i in range(100, 140)]
    docs, labels = documents(rows), spark.createDataFrame(JUDGED, LABELS)
    out = audit.op13_filter_audit(spark, folder(documents=docs, labels=labels))
    assert {tuple(r) for r in out.select(*NAMES).collect()} == brute(rows, JUDGED)


def test_sample_against_sql(spark):
    at = "/root/testdata/sf0.001"
    same_rows(audit.op13_filter_audit(spark, at), at, audit.SQL)


def test_empty_and_clashing_columns(spark, documents, folder, tmp_path):
    labels = spark.createDataFrame([], LABELS)
    none = audit.orders(audit.combinations(documents([]), labels))
    assert none.columns == NAMES and none.count() == 0
    docs = documents(ROWS).withColumns({c: F.lit("x") for c in (
        "part", "hash", "bits", "n", "words", "salt", "copies", "low", "groups", "good", "rows")})
    extra = spark.createDataFrame(JUDGED, LABELS).withColumn("good", F.lit("x"))
    out = audit.op13_filter_audit(spark, folder(documents=docs, labels=extra))
    assert {tuple(r) for r in out.select(*NAMES).collect()} == brute(ROWS, JUDGED)
