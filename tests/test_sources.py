"""Sources of files: tasks, memory, archives, workbooks, documents, pages, databases."""

import io
import json
import sqlite3
import zipfile

from pyspark.sql import functions as F

from loomtrace.sources import files as S


def packed(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, body in members.items():
            archive.writestr(name, body)
    return buffer.getvalue()


def test_tasks_and_memory(spark, tmp_path):
    for domain, name, body in (("a", "t1", {"id": "t1", "source": "u", "config": ["launch(x)"], "evaluator": {"eval": "f(1)"}}), ("a", "t2", {"source": ["u", "v"], "evaluator": {"eval": "g()", "postconfig": ["h()"]}}), ("b", "t3", {"id": "x"})):
        (tmp_path / "tasks" / domain).mkdir(parents=True, exist_ok=True)
        (tmp_path / "tasks" / domain / f"{name}.json").write_text(json.dumps(body, indent=1))
    (tmp_path / "tasks" / "b" / "bad.json").write_text("{")
    rows = {r.id: r for r in S.read_tasks(spark, str(tmp_path / "tasks")).collect()}
    assert set(rows) == {"t1", "t2", "x"} and json.loads(rows["t2"].source) == ["u", "v"] and rows["x"].domain == "b" and rows["x"].config == []
    assert rows["t1"].evaluator.eval == "f(1)" and rows["t1"].domain == "a"
    (tmp_path / "memory.json").write_text(json.dumps({"entries": [{"id": "1", "verified": True}, {"id": "2", "executable": False, "solvable": None}]}))
    found = {r.id: (r.executable, r.solvable) for r in S.read_memory(spark, str(tmp_path / "memory.json")).collect()}
    assert found == {"1": (True, False), "2": (False, None)}


def test_parsers(spark, tmp_path):
    sheet = '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="AB2"><f>1+1</f><v>2</v></c><c r="C3" t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>'
    book = packed({
        "xl/workbook.xml": '<workbook xmlns:r="u"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<R><R Id="r1" Target="worksheets/s.xml"/></R>',
        "xl/sharedStrings.xml": "<sst><si><t>hel</t><t>lo</t></si></sst>", "xl/worksheets/s.xml": sheet,
    })
    (tmp_path / "b.xlsx").write_bytes(book)
    (tmp_path / "bad.xlsx").write_bytes(b"no archive")
    rows = S.parsed(S.binary_files(spark, str(tmp_path), "*.xlsx"), S.workbook_cells, S.CELLS).collect()
    cells = {(r.row, r.col): (r.kind, r.text, r.number, r.formula) for r in rows if r.error is None}
    assert cells == {(1, 1): ("s", "hello", None, None), (2, 28): ("n", "2", 2.0, "1+1"), (3, 3): ("inlineStr", "in", None, None)}
    assert [r.error for r in rows if r.error] and len(rows) == 4

    word = packed({"word/document.xml": '<d xmlns:w="w"><w:p><w:r><w:rPr><w:b/><w:sz w:val="28"/></w:rPr><w:t>one</w:t></w:r><w:r><w:t> two</w:t></w:r></w:p><w:p/></d>'})
    runs = list(S.document_runs(word))
    assert runs[0] == ("word/document.xml", 0, 0, "one", {"b": "true", "sz": "28"}) and runs[1][3] == " two" and runs[2][1] == 1
    nodes = list(S.page_nodes(b"<html><p class=x>a<br>b</p><p>c &amp; d</p></html>"))
    assert [(n[1], n[2], n[3]) for n in nodes] == [(0, "html", ""), (1, "p", "ab"), (2, "br", ""), (1, "p", "c & d")] and nodes[1][4] == {"class": "x"}
    assert [m[:2] for m in S.archive_members(packed({"b": "22", "a": "1"}))] == [("a", 1), ("b", 2)]
    db = sqlite3.connect(":memory:")
    db.execute("create table t(a, b)")
    db.execute("insert into t values (1, null), (2, 'x')")
    assert list(S.database_rows("select * from t order by a")(db.serialize())) == [(0, {"a": "1", "b": None}), (1, {"a": "2", "b": "x"})]
    assert list(S.tree_rows({"type": "directory", "name": "d", "children": [{"type": "file", "name": "f"}]})) == [("d", 0, "directory"), ("d/f", 1, "file")]


def test_text_of_bytes(spark):
    rows = spark.createDataFrame([(b"\xc3\xa9",), (b"\xe9",)], "content binary")
    assert [r[0] for r in rows.select(S.text_of(F.col("content"))).collect()] == ["é", "é"]
