import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import defects, markup, mixing, personal, repetition
from millrace.llm.queries import QUERIES, SQL


def test_registered():
    assert {f"p{n}_found" for n in (1, 2, 3, 5, 7, 10)} | {"p4_batches", "p8_ids", "p9_mix"} <= set(QUERIES) and set(SQL) <= set(QUERIES)


# --- Markup ---


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("<p>a</p> &nbsp;", ["html"]),
        ("Scope\n====\n\n**bold", ["markdown"]),
        ("```html\n<b>x</b>\n```", ["markdown"]),
        ("h2. Steps\n{code:html}\n<b>x</b>\n{code}", ["wiki"]),
        (r"删除\texttt{<b>} $S_{a} = \sqrt{Q}$", ["latex"]),
        ("vector<int> <job-name> 6*5*38 $49 __init__.py C:\\x\\bin [5] a < b && c\n- x\n1. y", []),
        ("", []),
        (None, []),
    ],
)
def test_markup_kinds(text, kinds):
    assert [k for (k,) in markup.kinds(text)] == kinds


@pytest.mark.parametrize(
    "text,clean",
    [
        ("<h2>T</h2><p>a &amp; b</p><ol><li>x<li>y</ol>", "§2 T\n\na & b\n\n1. x\n2. y"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a\tb\n\nc"),
        ("## T\n\n**b** [t](http://u) `c*d`\n\n- x\n\n|a|b|\n|---|---|\n|1|2|", "§2 T\n\nb t (http://u) c*d\n\n- x\n\na\tb\n\n1\t2"),
        ("== T ==\n'''b''' [[x|y]] {{a|b}}", "§2 T\n\nb y a b"),
        ("\\section{T}\n\\begin{enumerate}\n\\item x\n\\item y\n\\end{enumerate}\n$a_{i} \\le \\frac{\\alpha}{2}$", "§1 T\n\n1. x\n\n2. y\n\na_i ≤ (α)/(2)"),
        ("```py\nx = '<b>'\n```", "    x = '<b>'"),
        ("plain text\n\n\n\nstays", "plain text\n\n\n\nstays"),
        (None, None),
        ("", ""),
    ],
)
def test_converted(text, clean):
    assert markup.convert(text)[0] == clean


def test_losing_paths_are_voted_by_host(spark):
    menu = '<div class="menu9"><a href="/">home</a><a href="/x">all</a></div>'
    pages = [("h", f'{menu}<div class="main"><p>text number {i}</p></div>') for i in range(5)] + [("other", '<div class="menu1">real prose here</div>'), (None, None), ("h", ""), ("h", "no tag")]
    df = spark.createDataFrame([(i, h, t, "x") for i, (h, t) in enumerate(pages)], "id long, host string, text string, clean string")
    lost = {r["host"]: set(r["losing"]) for r in markup.losing_paths(df, "host", "text").collect()}
    assert lost == {"h": {"div.menu0/a"}}
    got = {r["id"]: r for r in markup.clean_text(df, ["id"], "text", "host").collect()}
    assert got[0]["clean"].strip() == "text number 0" and got[5]["clean"].strip() == "real prose here" and got[6]["clean"] is None and got[7]["clean"] == ""
    assert markup.clean_text(df.limit(0), ["id"], "text").count() == 0


# --- Personal data ---


def test_mentions():
    find = personal.finder(["沈蕴之", "陆砚秋", "Ferris Ashdune", "Verity Grauwald"])
    text = "值班人沈砚秋，电话 161 7982 1354 ，a.b [at] kb [dot] example ，身份证440199199705120687 。Ferris Grauwald, 12 Old Mill Road. SSN 933-54-5285. Dr. Quenby Jutterstedt reviewed"
    assert Counter(k for k, _, _ in find(text)) == Counter(person=3, phone=1, email=1, id_number=2, address=1)
    assert find("Build 16032517919 at 10.94.243.201, x@v6.19.15, root@node-3, 2025-07-10 12:41:44, Trace 700428199001011331") == []
    assert personal.masked("mail a@b.example", find("mail a@b.example")) == "mail [EMAIL]" and find(None) == find("") == []


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 10**20), st.data())
def test_feistel_is_a_permutation(bound, data):
    n = data.draw(st.integers(0, bound - 1))
    f = personal.Feistel(b"k")
    assert 0 <= f.forward(n, bound, "t") < bound and f.inverse(f.forward(n, bound, "t"), bound, "t") == n


def test_pseudonyms_keep_their_format():
    f = personal.Feistel(b"k")
    assert sorted(f.forward(i, 1000) for i in range(1000)) == list(range(1000))
    p = lambda v: personal.pseudonym("phone", v, f)
    bare = p("16179821354")
    assert p("161 7982 1354").replace(" ", "") == bare == p("+86-161-7982-1354")[3:].replace("-", "") and bare.isdigit() and bare != "16179821354"
    assert p("(571) 555-0143")[0] == "(" and p("+1 571 555 0143")[3:].replace(" ", "") == p("571-555-0143").replace("-", "")
    body = "44019919970512068"
    number = body + personal.check_sign(body)
    new = personal.pseudonym("id_number", number, f)
    assert personal.citizen_number(number) and personal.citizen_number(new) and new != number and personal.permuted_citizen(new, f, True) == number
    wrong = body + ("1" if number[-1] != "1" else "2")
    assert len(personal.pseudonym("id_number", wrong, f)) == 10  # a digest
    assert personal.pseudonym("email", "A@b.example", f) == personal.pseudonym("email", "a@B.example", f)
    assert personal.pseudonym("email", "a@b.example", personal.Feistel(b"other")) != personal.pseudonym("email", "a@b.example", f)


def test_masked_rows(spark):
    df = spark.createDataFrame([(1, "mail a@b.example and a@b.example", "z"), (2, None, "z"), (3, "", "z"), (3, "nothing", "z")], "id long, text string, masked string")
    rows = personal.mask_personal(df, ["id"], "text", ["", None]).collect()
    first = next(r for r in rows if r["id"] == 1)
    assert len(rows) == 4 and first["kinds"] == ["email", "email"] and len(set(first["masked"].split(" and "))) == 2 and first["masked"].count("[EMAIL:") == 2
    assert next(r for r in rows if r["id"] == 2)["masked"] is None


# --- Defective pairs ---

Q = "How do I verify that the lease is gone?"
QA = "qa_id long, query string, answer string, truncated boolean, defect string"


def found(spark, rows):
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], QA)
    out = {}
    for r in defects.defective(df).collect():
        out.setdefault(r["qa_id"], set()).add(r["defect"])
    return [out.get(i, set()) for i in range(len(rows))]


def test_a_long_word_is_examined_in_time():
    began = time.process_time()
    assert defects.language("x" * 20000 + " the disk is full and the node was lost") == "en"
    assert time.process_time() - began < 2


def test_sentences_end_as_their_marks_say():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choices("ab。！？.!? \n\t　", k=rng.randint(0, 30)))
        assert defects.sentences(text) == re.split(r"(?<=[。！？])|(?<=[.!?])\s+|\n+", text)


def test_names_are_no_prose():
    rng = random.Random(10)
    slow = re.compile(r"[A-Za-z0-9_.:-]*[/\\=@][A-Za-z0-9_./:\\=-]*|[A-Za-z_]*[\d_][A-Za-z0-9_]*")
    for _ in range(3000):
        text = "".join(rng.choices("abC_9-./:=@\\ 中٣７~", k=rng.randint(0, 30)))
        assert defects._NOT_PROSE.sub(" ", text) == slow.sub(" ", text)


def test_defects_of_a_pair(spark):
    rows = [
        (Q, None, False),
        (Q, "n/a", True),
        (Q, "Yes, it is.", True),
        (Q, "I'm sorry, but I can't help with x.", None),
        (Q, 'If the console says "Sorry, I can\'t open x", the token is stale, so sign in again.', False),
        (Q, "Question: " + Q, False),
        (Q, "这个开关仅对备份快照生效，修改后需要等待传播。", False),
        (Q, "Look at the log.\n\n```bash\nrun x", False),
        (None, "Yes, it is.", False),
    ]
    assert found(spark, rows) == [{"empty_answer"}, {"empty_answer", "truncated"}, {"truncated"}, {"refusal"}, set(), {"copies_query"}, {"other_language"}, {"truncated"}, set()]
    assert found(spark, []) == []


def test_templates_reveal_refusals(spark):
    vague = [(q, f"This goes against my guidelines, so {n} stays out of bounds.", False) for q, n in ((Q, "Alpha-1"), ("Why is the queue slow today?", "Beta-gw"), ("What does the error code mean here?", "Gamma-x"))]
    plain = [(Q, "The lease is gone when the table is empty.", False)]
    assert found(spark, vague + plain) == [{"refusal"}] * 3 + [set()]
    assert found(spark, vague[:1] + plain) == [set(), set()]  # no template yet


def test_broken_off_by_other_openings(spark):
    whole = [(Q, f"Regression runs cover {i} mixes and build {i} is gone for good.", False) for i in range(25)]
    assert found(spark, whole + [(Q, "Yes, it is. Regression runs cover 7 mixes", False), (Q, "Regression runs cover 7 mixes and build 3 is gone for good", False)])[-2:] == [{"truncated"}, set()]


# --- Repetition ---


def test_repeated_characters():
    once = "".join(chr(0x4E00 + i) for i in range(40))
    assert repetition.repeated(once) == (0, 40) and repetition.repeated(once + " \n" + once) == (40, 81)
    assert repetition.repeated("a" * 40) == (39, 40) and repetition.repeated(None) == (0, 0)


def test_trees_lose_no_case_and_are_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((800, 5)) * [1, 1, 1, 1, 9]
    y = ((x[:, 0] >= 0.4) ^ (rng.random(800) < 0.15)).astype(float)  # wrong labels can't lose a case either
    trees = repetition.fit(x, y)
    least = trees.least_score(0, 0.4)
    new = rng.random((5000, 5)) * [1, 1, 1, 1, 12]
    new[:1000, 0] = 0.4
    scores = trees.score(new)
    assert (scores[new[:, 0] >= 0.4] >= least).all() and (scores < least).any()
    for f in range(4):
        up = new.copy()
        up[:, f] += rng.random(5000)
        assert (trees.score(up) >= scores - 1e-12).all()
    one = repetition.fit(x, np.zeros(800))
    assert len(set(one.score(x).tolist())) == 1 and one.least_score(0, 0.4) <= one.score(x)[0]
    assert repetition.fit(np.empty((0, 5)), np.empty(0)).score(x[:2]).shape == (2,)


def naive(text):
    s = " ".join((text or "").lower().split())
    seen, hit = set(), set()
    for i in range(len(s) - 29):
        if s[i : i + 30] in seen:
            hit.update(range(i, i + 30))
        seen.add(s[i : i + 30])
    return len(hit) / len(s) if s else 0.0


def test_found_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [None, "", "  ", "short"]
    for _ in range(120):
        unit = "".join(rng.choice(list("abcdefgh \n"), int(rng.integers(20, 90))))
        texts.append(unit * int(rng.integers(1, 4)) + "".join(rng.choice(list("ijklmnop "), int(rng.integers(0, 200)))))
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    monkeypatch.setattr(repetition, "table", lambda *a: df)
    got = {r["doc_id"] for r in repetition.p10_found(spark, "").collect()}
    assert got == {i for i, t in enumerate(texts) if naive(t) >= 0.4} and len(got) > 10
    assert repetition.repetition(df.limit(0), "doc_id", "text").count() == 0


# --- Mixing ---

COUNTED = "doc_id long, source string, tokens long, weight double"


def test_mix(spark):
    rows = [(i, "a", 10, 1.0) for i in range(100)] + [(i, "b", 10, 0.5) for i in range(100, 120)] + [(i, "c", 10, 1.0) for i in range(120, 130)]
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 3), ("gone", 0.3, 2), ("c", 0.0, 2)], "source string, target_share double, max_repeats int")
    got = mixing.mixed(spark, spark.createDataFrame(rows, COUNTED), targets).collect()
    tokens = Counter()
    for r in got:
        tokens[r.source] += r.tokens * r.times
    assert set(tokens) == {"a", "b"} and tokens["b"] == 600 and tokens["a"] == 900
    assert max(r.times for r in got if r.source == "a") == 1 and max(r.times for r in got) == 3
    assert len({r.doc_id for r in got}) == len(got)
    assert mixing.mixed(spark, spark.createDataFrame([], COUNTED), targets).count() == 0


def test_weights_decide_the_sample(spark):
    rows = [(i, "a", 1, 1e-6 if i % 2 else 1.0) for i in range(2000)] + [(i, "b", 1, 1.0) for i in range(2000, 2500)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    got = [r for r in mixing.mixed(spark, spark.createDataFrame(rows, COUNTED), targets).collect() if r.source == "a"]
    assert len(got) == 500 and all(r.doc_id % 2 == 0 for r in got)
