import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sinks import exports as E
from millrace.sources import files
from millrace.streaming import journal


def docx(*blocks):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{''.join(blocks)}</w:body></w:document>")
    return out.getvalue()


P = '<w:p>{}<w:r><w:t>{}</w:t></w:r></w:p>'
H1 = '<w:pPr><w:pStyle w:val="Heading1"/></w:pPr>'


def test_discovery_and_loading(spark, tmp_path):
    (tmp_path / "a" / ".hidden").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    for name, data in {
        "a/one.MD": "# 一".encode(),
        "a/.hidden/no.md": b"x",
        "a/index.html": b"<h1>T</h1><p>a <b>b</b></p><ul><li>x</li></ul><pre>c  d</pre>",
        "b/old.txt": "中文".encode("gb18030"),
        "b/w.docx": docx(P.format(H1, "Head"), P.format("", "text")),
        "b/bad.docx": b"no zip",
        "b/p.pdf": b"%PDF",
        "b/skip.png": b"img",
        "root.md": b"r",
    }.items():
        (tmp_path / name).write_bytes(data)
    found = files.with_topics(files.discover(spark, str(tmp_path))).cache()
    topics = {r["rel_path"]: r["topic"] for r in found.collect()}
    assert topics == {"a/one.MD": "a__one", "a/index.html": "a", "b/old.txt": "b__old", "b/w.docx": "b__w", "b/bad.docx": "b__bad", "b/p.pdf": "b__p", "root.md": "root"}
    texts = {r["rel_path"]: r for r in files.load(found).collect()}
    assert texts["a/index.html"]["text"] == "# T\n\na b\n\n- x\n\n```\n\nc d\n\n```" and texts["b/old.txt"]["text"] == "中文"
    assert texts["b/w.docx"]["text"] == "# Head\n\ntext" and texts["b/bad.docx"]["error"] == "invalid DOCX" and texts["b/p.pdf"]["text"] is None
    before = {r["rel_path"]: r["source_sha"] for r in files.bundle_hashes(found).collect()}
    (tmp_path / "b/skip.png").write_bytes(b"other")
    after = {r["rel_path"]: r["source_sha"] for r in files.bundle_hashes(found).collect()}
    assert {k for k in before if before[k] != after[k]} == {k for k in before if k.startswith("b/") or k == "root.md"}
    assert files.discover(spark, str(tmp_path / "missing")).count() == 0


def test_topics_that_meet(spark):
    df = spark.createDataFrame([("x/a/b.md",), ("y/a/b.md",), ("z.md",)], "rel_path string")
    got = {r["rel_path"]: r["topic"] for r in files.with_topics(df).collect()}
    assert got["z.md"] == "z" and got["x/a/b.md"].startswith("a__b__") and got["x/a/b.md"] != got["y/a/b.md"]


def event(**e):
    return (json.dumps(e, ensure_ascii=False) + "\n").encode()


def test_journal_by_offset(tmp_path):
    p = tmp_path / "j.jsonl"
    first = event(kind="stage", topic="甲", stage="parse", status="ok")
    p.write_bytes(first + b"not json\n" + b"[1]\n" + b'{"kind": "sta')
    rows, at = journal.read_from(str(p), 0)
    assert [r[0] for r in rows] == [1] and at == len(first) + 13
    with open(p, "ab") as f:
        f.write(b'ge"}\n')
    rows, end = journal.read_from(str(p), at)
    assert [r[0] for r in rows] == [at + 1] and end == p.stat().st_size
    p.write_bytes(first)
    assert len(journal.read_from(str(p), end)[0]) == 1 and journal.read_from(str(tmp_path / "none"), 5) == ([], 5)


def test_journal_stream(spark, tmp_path):
    p = tmp_path / "j.jsonl"
    for status in ("start", "done"):
        assert journal.append(str(p), {"kind": "stage", "topic": "a", "stage": "parse", "status": status})
    journal.append(str(p), {"kind": "concurrency", "topic": "a", "stage": "parse", "status": "5"})
    q = journal.keep_view(journal.follow(spark, str(p)), "view", str(tmp_path / "cp"))
    try:
        q.processAllAvailable()
        assert [r["status"] for r in spark.table("view").collect()] == ["done"]
        journal.append(str(p), {"kind": "stage", "topic": "a", "stage": "parse", "status": "again"})
        q.processAllAvailable()
        assert [r["status"] for r in spark.table("view").collect()] == ["again"]
    finally:
        q.stop()


SOURCES = "array<struct<topic:string,heading_path:string,section_sid:string,source_excerpt:string>>"


def test_export(spark, tmp_path):
    s = [("m/1", "m / A", "1.2", "secret")]
    qa = spark.createDataFrame(
        [("u1", 'say "hi"', "a,b\nc", ["other"], s, "m/1", "approved", None), ("u2", "no", "x", [], s, "m/1", "failed_review", True)],
        f"unit_id string, query string, answer string, paraphrases array<string>, sources {SOURCES}, topic string, publication_status string, semantic_ok boolean",
    )
    sop = spark.createDataFrame(
        [(1, "1.2 T", "# T\nbody", ["q?"], s, "approved", True, True), (2, "1.2 T", "# U", [], s, "pending", None, True), (3, "x", "# V", [], s, "approved", True, False)],
        f"sop_id long, title string, markdown string, entry_questions array<string>, sources {SOURCES}, publication_status string, semantic_ok boolean, struct_ok boolean",
    )
    known = spark.createDataFrame([], "token string, value string")
    out = str(tmp_path / "out")
    assert E.export(qa, sop, known, out, ["sop_id"]) == {"qa_rows": 2, "sop_files": 2}
    assert sorted(p.name for p in (tmp_path / "out/sop").iterdir()) == ["m_1__1.2-2.md", "m_1__1.2.md"]
    assert "secret" not in "".join(p.read_text() for p in (tmp_path / "out/metadata").glob("part-*"))
    assert E.archive(out, str(tmp_path / "o.zip")) >= 4
    with zipfile.ZipFile(tmp_path / "o.zip") as z:
        csv = next(n for n in z.namelist() if n.endswith(".csv"))
        assert z.read(csv).decode() == '﻿"Query","Answer","Module"\n"say ""hi""","a,b\nc","m/1"\n"other","a,b\nc","m/1"\n'
    open_ = qa.withColumn("answer", F.lit("see 〔IP:abcdef〕"))
    (tmp_path / "out/sop/kept").write_text("old")
    with pytest.raises(ValueError, match="abcdef"):
        E.export(open_, sop, known, out, ["sop_id"])
    assert (tmp_path / "out/sop/kept").read_text() == "old"
    merged = E.merged_files(sop).collect()
    assert [(r["name"], r["units"]) for r in merged] == [("m_1.md", 2)] and merged[0]["body"].startswith("# m/1\n\n## T\nbody\n\n## U")


def test_rehydrated(spark):
    df = spark.createDataFrame([('{"qa": [{"query": "q", "answer": "a"}], "sop": [{"title": "t", "semantic_ok": false}]}',), ("broken",)], "value string")
    qa, sop = E.rehydrated(df)
    q, s = qa.first(), sop.first()
    assert (qa.count(), sop.count()) == (1, 1) and q["semantic_ok"] is True and q["publication_status"] == "approved" and s["semantic_ok"] is False and s["publication_status"] == "pending"
