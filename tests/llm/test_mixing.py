from sitepulse.llm import mixing
from tests.llm.conftest import SF, same_rows


def test_query_against_sql(spark):
    same_rows(mixing.op5_source_mix(spark, SF), SF, mixing.SQL)


def slow_targets(sizes, weights=(5, 2, 1)):
    """Deal, cap, and deal the excess again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, capped = dict.fromkeys(names, 0.0), set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        if not open_:
            return {s: 2.0 * sizes[s] for s in names}
        unit = left / sum(weight[s] for s in open_)
        target = {s: 2.0 * sizes[s] if s in capped else weight[s] * unit for s in names}
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def check(rows):
    sizes, targets, taken = {}, {}, {}
    largest = 0
    for r, source in rows:
        sizes[source] = sizes.get(source, 0) + r["size"]
        targets[source] = r["target"]
        taken[source] = taken.get(source, 0) + r["taken"]
        largest = max(largest, r["size"])
        assert r["taken"] <= 2 * r["size"]
    expected = slow_targets(sizes)
    for s in sizes:
        assert abs(targets[s] - expected[s]) < 1e-6 * max(1, expected[s])
        assert abs(taken[s] - targets[s]) <= largest / 2 + 1e-6


def test_targets_and_budgets(spark, documents):
    docs = documents([(i, "w " * (i % 17), ["a", "b", "c", "d", None, "\U0001F600", "￿"][
        min(6, i % 23)]) for i in range(3000)])
    source = {i: ["a", "b", "c", "d", None, "\U0001F600", "￿"][min(6, i % 23)]
              for i in range(3000)}
    sizes = mixing.sized(docs)
    out = mixing.mix(sizes, mixing.budgets(sizes)).collect()
    assert len(out) == 3000
    check([(r, source[r["doc_id"]]) for r in out])


def test_ranges_of_a_large_source(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_RANGE", 10)
    docs = documents([(i, "w " * (1 + i % 7), "hot" if i % 3 else "b") for i in range(900)])
    sizes = mixing.sized(docs)
    out = mixing.mix(sizes, mixing.budgets(sizes))
    check([(r, "hot" if r["doc_id"] % 3 else "b") for r in out.collect()])
    again = mixing.mix(sizes.repartition(13), mixing.budgets(sizes))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_odd_rows(spark, documents):
    docs = documents([(1, None, "a"), (2, "", "a"), (3, "x y", "b"), (3, "x y", "b"),
                      (None, "z", None), (5, "q " * 100_000, "c")]).selectExpr(
        "*", "1 as size", "2 as target", "'k' as mix_key", "3 as n_docs")
    sizes = mixing.sized(docs)
    rows = mixing.mix(sizes, mixing.budgets(sizes)).collect()
    assert len(rows) == 6
    assert {r["target"] for r in rows if r["doc_id"] in (1, 2)} == {0.0}
    out = mixing.mix_stage(spark, docs, "")
    assert out.columns == docs.columns


def test_empty_and_sizeless_tables(documents):
    for docs in (documents([]), documents([(1, None), (2, " ")])):
        sizes = mixing.sized(docs)
        rows = mixing.mix(sizes, mixing.budgets(sizes)).collect()
        assert len(rows) == docs.count() and all(r["taken"] == 0 for r in rows)


def test_stage_repeats_documents(spark, documents):
    docs = documents([(i, f"w{i} " * 5, "a" if i < 10 else "b") for i in range(100)])
    sizes = mixing.sized(docs)
    copies = {r["doc_id"]: r["copies"] for r in
              mixing.mix(sizes, mixing.budgets(sizes)).collect()}
    out = mixing.mix_stage(spark, docs, "").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in out} == {d: c for d, c in copies.items() if c}


def test_rows_of_one_id_in_any_order(spark, documents):
    """Rows without an id have keys of their own: another input order gives the same rows."""
    rows = [(None, f"t{i} " * (1 + i % 9), "a" if i % 3 else "b") for i in range(400)]
    rows += [(7, "same text here", "a")] * 50 + [(None, "w " * 6, "b")] * 50
    found = []
    for order in (rows, rows[::-1], rows[200:] + rows[:200]):
        sizes = mixing.sized(documents(order).repartition(5))
        out = mixing.mix(sizes, mixing.budgets(sizes)).collect()
        assert len(out) == len(rows)
        found.append(sorted(map(tuple, out), key=str))
    assert found[0] == found[1] == found[2]


def test_equal_rows_end_where_single_ones_do(spark, documents, folder, monkeypatch):
    """Cutting among equal rows by division is the same as walking over them one by one."""
    monkeypatch.setattr(mixing, "EXPANDED", 7)
    rows = [(1, "w " * 3, "a")] * 61 + [(2, "v " * 5, "a")] * 37 + [(3, "x", "b")] * 100
    rows += [(i, "u " * (i % 4), "c") for i in range(100, 130)]
    at = folder(documents=documents(rows))
    same_rows(mixing.op5_source_mix(spark, at), at, mixing.SQL)


def test_stage_meets_the_budget_with_repeated_ids(spark, documents):
    """One id with many different texts: each text is taken as often as decided for it."""
    rows = [(None, f"t{i} " * (1 + i % 9), "a") for i in range(120)]
    rows += [(4, f"s{i} " * (1 + i % 5), "b") for i in range(80)] + [(5, "same", "b")] * 30
    docs = documents(rows).selectExpr("*", "1 as rows", "'x' as row", "2 as copies", "3 as id")
    sizes = mixing.sized(docs)
    decided = mixing.mix(sizes, mixing.budgets(sizes)).collect()
    out = mixing.mix_stage(spark, docs, "")
    assert out.columns == docs.columns
    emitted = sum(len((r["text"] or "").split()) for r in out.collect())
    assert emitted == sum(r["taken"] for r in decided)
    check([(r, "b" if r["doc_id"] in (4, 5) else "a") for r in decided])
