import difflib
import random

from sitepulse.llm import lines
from tests.llm.conftest import SF

LONG = ["this line has quite a few words number %d so that a block of it is long enough to "
        "matter here" % i for i in range(40)]


def run(docs, **kw):
    return {r["doc_id"]: r for r in lines.dedup_lines(docs, **kw).collect()}


def test_blocks_go_from_the_later_document(documents):
    a = "\n".join(["first own words", *LONG[:4], "tail of a"])
    b = "\n".join(["opening of b", LONG[1], LONG[2], "", LONG[3], "end of b"])
    c = "\n".join([LONG[3], LONG[1]])
    got = run(documents([(1, a), (2, b), (3, c), (4, "nothing shared")]))
    assert got[1]["text"] == a and got[1]["n_removed"] == 0 and got[4]["n_removed"] == 0
    assert got[2]["text"] == "opening of b\nend of b" and got[2]["partners"] == [1]
    assert got[2]["n_removed"] == 4 and got[2]["n_lines"] == 6
    # Crossing lines can't both be aligned.
    assert got[3]["n_removed"] == 1 and got[3]["partners"] == [1]


def test_short_blocks_stay(documents):
    got = run(documents([(1, "good morning\nx y"), (2, "good morning\nz")]))
    assert got[2]["n_removed"] == 0
    assert run(documents([(1, "good morning\nx y"), (2, "good morning\nz")]),
               least=2)[2]["text"] == "z"


def test_copies_and_common_lines(documents):
    """A third of the documents are copies, and one passage stands in all the others."""
    rnd = random.Random(1)
    copy = "\n".join(LONG[:10])
    rows = [(i, copy) for i in range(0, 150)]
    rows += [(i, f"own {i} {rnd.random()}\n{LONG[20]}\nmore {i}") for i in range(150, 450)]
    got = run(documents(rows))
    assert got[0]["text"] == copy and all(got[i]["text"] == "" for i in range(1, 150))
    assert got[150]["n_removed"] == 0
    assert all(got[i]["n_removed"] == (1 if len(LONG[20].split()) >= lines.MIN_WORDS else 0)
               for i in range(151, 450))


def test_every_line_with_an_earlier_holder_gets_a_partner(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lines.line_rows(docs)
    met = {(r["doc_id"], r["partner"]) for r in lines.pairs(rows).collect()}
    holder, expected = {}, set()
    for r in sorted(rows.collect(), key=lambda r: r["doc_id"]):
        for line in r["lines"]:
            if line is not None and holder.setdefault(line, r["doc_id"]) != r["doc_id"]:
                expected.add((r["doc_id"], holder[line]))
    assert met == expected


def slow(texts, least):
    """Align each document with every earliest holder of its lines."""
    out, holder = {}, {}
    for d in sorted(texts):
        raw = texts[d].split("\n")
        clean = [x.strip(" \t\n\x0b\x0c\r") or None for x in raw]
        partners = {holder[x] for x in clean if x is not None and x in holder}
        gone = set()
        for p in partners:
            other = [x.strip(" \t\n\x0b\x0c\r") or None for x in texts[p].split("\n")]
            words = [len((x or "").split()) for x in clean]
            for s, e in lines.common_blocks(other, clean, words, least):
                gone |= set(range(s, e + 1))
        out[d] = "\n".join(x for i, x in enumerate(raw) if i not in gone)
        for x in clean:
            if x is not None:
                holder.setdefault(x, d)
    return out


def test_query_against_brute_force(spark):
    import hashlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = slow({r["doc_id"]: r["text"] or "" for r in docs}, lines.MIN_WORDS)
    got = {r["doc_id"]: r for r in lines.op9_line_dedup(spark, SF).collect()}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in expected.items()} == {
        d: r["kept_sha256"] for d, r in got.items()}


def test_patience_is_a_common_subsequence():
    rnd = random.Random(5)
    for _ in range(300):
        a = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 14))]
        b = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 14))]
        got = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    a, b = list("abcdefgh"), list("abXcdYefgh")
    blocks = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
    assert lines.patience(a, b) == [(m.a + k, m.b + k) for m in blocks for k in range(m.size)]


def test_odd_rows(documents):
    long = "\n".join(LONG[:3])
    docs = documents([(None, long), (1, None), (2, ""), (3, long), (3, long), (4, f" {LONG[0]} \r"),
                      (5, "\n".join(LONG[i % 7] for i in range(5000)))]).selectExpr(
        "*", "1 as n_lines", "2 as partners", "'x' as key", "3 as _text_key", "4 as lines")
    rows = lines.dedup_lines(docs).collect()
    assert len(rows) == 7
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["text"] == long and by_id[3]["text"] == long
    assert by_id[1]["text"] is None and by_id[2]["text"] == ""
    assert by_id[4]["n_removed"] == (1 if len(LONG[0].split()) >= lines.MIN_WORDS else 0)


def test_empty_table(documents):
    assert lines.dedup_lines(documents([])).count() == 0


def all_earlier(texts, least=lines.MIN_WORDS):
    """Align each document with every earlier one."""
    out = {}
    for d, text in texts.items():
        clean = [x.strip() or None for x in text.split("\n")]
        words = [len((x or "").split()) for x in clean]
        gone = set()
        for p in (p for p in texts if p < d):
            other = [x.strip() or None for x in texts[p].split("\n")]
            for s, e in lines.common_blocks(other, clean, words, least):
                gone |= set(range(s, e + 1))
        out[d] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def test_passage_of_lines_with_other_earliest_holders(documents):
    """The lines have earlier holders one by one; only a later document holds the passage."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    texts = {1: f"{a}\nfar\naway\n{b}", 2: f"two\n{a}\n\n{b}\nend", 3: f"three\n{a}\n{b}",
             11: c, 12: f"{c}\nx\n{b}", 13: f"{b}\n{c}\nthirteen", 14: f"own\n{b}\n{c}"}
    got = run(documents(list(texts.items())))
    assert {d: r["text"] for d, r in got.items()} == all_earlier(texts)
    assert got[3]["text"] == "three" and got[3]["partners"] == [2]
    assert got[14]["text"] == "own" and got[14]["partners"] == [13]


def test_runs_against_all_earlier_documents(documents):
    """Passages cut from one sequence of lines, so that blocks never cross."""
    rnd = random.Random(8)
    pool = [" ".join(f"w{k}x{i}" for i in range(rnd.choice([2, 5, 9, 25]))) for k in range(60)]
    texts = {}
    for d in range(60):
        parts, at = [], 0
        while at < len(pool):
            n = rnd.randint(1, 6)
            parts += pool[at:at + n] + [f"own {d} {at}"]
            at += n + rnd.randint(0, 25)
        texts[d] = "\n".join(parts)
    got = run(documents(list(texts.items())))
    assert {d: r["text"] for d, r in got.items()} == all_earlier(texts)


def test_passage_that_occurs_twice(documents):
    """No line is unique on both sides: the passage stands twice in one of the documents."""
    p = LONG[:3]
    twice = ["u", *p, "v", *p, "w"]
    once = ["x", *p, "y"]
    got = run(documents([(1, "\n".join(once)), (2, "\n".join(twice))]))
    assert got[2]["n_removed"] == 3 and got[2]["text"].split("\n") == ["u", "v", *p, "w"]
    got = run(documents([(1, "\n".join(twice)), (2, "\n".join(["s", *once]))]))
    assert got[2]["text"] == "s\nx\ny"
    got = run(documents([(1, "\n".join(["r", *twice])), (2, "\n".join(["s", *p, "", *p, "t"]))]))
    assert got[2]["text"] == "s\n\nt"


def test_fallback_finds_the_heaviest_common_run():
    rnd = random.Random(6)
    for _ in range(300):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(0, 14))] for _ in range(2))
        words = [rnd.randint(1, 5) for _ in b]
        runs = [(sum(words[j:j + n]), n) for n in range(1, 15) for j in range(len(b) - n + 1)
                if any(a[i:i + n] == b[j:j + n] for i in range(len(a) - n + 1))]
        best = max(runs, default=(0, 0))[0]
        got = lines._heaviest(a, b, words, 4)
        assert (got is None) == (best < 4)
        if got:
            i, j, n = got
            assert a[i:i + n] == b[j:j + n] and sum(words[j:j + n]) == best


def test_pairs_are_all_earliest_holders(documents):
    """Every shared line, however common, brings its first holder, and nothing else does."""
    texts = {d: "\n".join(f"line {(d * k) % 17}" for k in range(1, 9)) for d in range(1, 60)}
    rows = lines.line_rows(documents([*texts.items(), (None, "line 3"), (70, ""), (70, None)]))
    got = {(r["doc_id"], r["partner"]) for r in lines.pairs(lines.stored(rows, "rows")).collect()}
    first, expected = {}, set()
    for d, text in sorted(texts.items()):
        for line in set(text.split("\n")):
            first.setdefault(line, d)
            if first[line] < d:
                expected.add((d, first[line]))
    assert got == expected
