"""Sources of files in any folder that Spark reads: task trees, archives, workbooks, documents, databases, pages.

Files are scanned as bytes and parsed a batch at a time into long rows with a path
and positional keys; whatever compares them is plain DataFrame code. A file that
cannot be parsed gives one row whose ``error`` says why.
"""

from __future__ import annotations

import io
import os
import re
import sqlite3
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.operators import memory
from loomtrace.sources.snapshots import KeyedStore

TASK = "id string, snapshot string, instruction string, source string, config array<string>, related_apps array<string>, trajectory string, evaluator struct<postconfig: array<string>, eval: string>"


def read_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Task files ``folder/domain/name.json``, one object each, with ``domain`` and the file's name for a missing id.

    ``source`` is text; a list of sources is kept as its JSON text. Files that are not
    JSON are left out.
    """
    rows = spark.read.schema(TASK + ", _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    rows = rows.withColumn("file", F.col("_metadata.file_path"))
    stem = F.regexp_extract("file", r"([^/]+)\.json$", 1)
    rows = rows.withColumn("domain", F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)).withColumn("id", F.coalesce("id", stem))
    return rows.filter("_bad is null").withColumn("config", F.coalesce("config", F.array().cast("array<string>"))).drop("_bad")


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a memory file {entries: [...]}; older ones have ``verified`` for ``executable``, and no ``solvable``."""
    fields = ("id: string", "domain: string", "instruction: string", "evaluator_eval: string", "code_score: double", "code_steps: int", "executable: boolean", "verified: boolean", "solvable: boolean", "failure_reasons: array<string>")
    rows = spark.read.schema(f"entries array<struct<{', '.join(fields)}>>").option("multiLine", True).json(path)
    found = rows.select(F.posexplode("entries").alias("seq", "e")).select("seq", "e.*")
    old = F.col("executable").isNull() & F.col("solvable").isNull()
    return found.withColumn("solvable", F.when(old, F.lit(False)).otherwise(F.col("solvable"))).withColumn("executable", F.coalesce("executable", "verified")).drop("verified")


def result_store(spark: SparkSession, path: str, order: tuple[str, ...] = ("finished_at",), buckets: int = 64) -> KeyedStore:
    """Results by id, in versions: the row that is last in ``order`` counts, and what was there before stays unless it is replaced."""
    return KeyedStore(spark, path, ["id"], order, buckets)


def write_results(results: DataFrame, path: str, order: tuple[str, ...] = ("finished_at",)) -> None:
    """Results as JSON lines in place of those at ``path``: the last row of each id by ``order`` only."""
    memory.upsert(results, ["id"], list(order)).drop("first_seen").write.mode("overwrite").json(path)


def append_steps(steps: DataFrame, path: str) -> None:
    """Rollout steps appended as JSON lines."""
    steps.write.mode("append").json(path)


def binary_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, length, content) of the files below a folder."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return rows.select("path", "length", "content")


def text_of(content: Column) -> Column:
    """Bytes as text: UTF-8 if they are that, else Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def parsed(files: DataFrame, parse: Callable[[bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """(path, *schema, error): the rows that ``parse`` makes of each file's bytes."""
    names = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", schema)]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch.path, batch.content, strict=True):
                try:
                    rows = [(path, *r, None) for r in parse(bytes(content))]
                except Exception as error:  # a broken file must not end the scan
                    rows = [(path, *[None] * len(names), f"{type(error).__name__}: {error}"[:200])]
                if rows:
                    yield pd.DataFrame(rows, columns=["path", *names, "error"]).astype(object)

    return files.select("path", "content").mapInPandas(scan, f"path string, {schema}, error string")


# --- parsers --------------------------------------------------------------------

MEMBERS = "name string, size long, content binary"
CELLS = "sheet string, row long, col long, kind string, text string, number double, formula string"
RUNS = "part string, paragraph long, run long, text string, style map<string,string>"
NODES = "node long, depth long, tag string, text string, attributes map<string,string>"


def archive_members(data: bytes) -> Iterator[tuple]:
    """Files of a ZIP (or EPUB) or TAR archive, by name."""
    if data[:4] in (b"PK\x03\x04", b"PK\x05\x06"):
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            for info in sorted(archive.infolist(), key=lambda x: x.filename):
                if not info.is_dir():
                    yield info.filename, info.file_size, archive.read(info)
    else:
        with tarfile.open(fileobj=io.BytesIO(data)) as archive:
            for member in sorted(archive.getmembers(), key=lambda x: x.name):
                if member.isfile():
                    yield member.name, member.size, archive.extractfile(member).read()


def _bare(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _attributes(element) -> dict[str, str]:
    return {_bare(k): v for k, v in element.attrib.items()}


def _number(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def workbook_cells(data: bytes) -> Iterator[tuple]:
    """Cells of an XLSX workbook; shared and inline strings are resolved, positions count from 1."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        read = lambda name: ElementTree.fromstring(book.read(name))
        names = set(book.namelist())
        shared = ["".join(t.text or "" for t in s.iter() if _bare(t.tag) == "t") for s in read("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        targets = {r.attrib["Id"]: r.attrib["Target"] for r in read("xl/_rels/workbook.xml.rels")}
        for sheet in (e for e in read("xl/workbook.xml").iter() if _bare(e.tag) == "sheet"):
            target = targets[next(v for k, v in sheet.attrib.items() if _bare(k) == "id")]
            for cell in (e for e in read(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter() if _bare(e.tag) == "c"):
                letters, row = re.fullmatch(r"([A-Z]+)(\d+)", cell.attrib["r"]).groups()
                col = 0
                for c in letters:
                    col = col * 26 + ord(c) - 64
                parts = {_bare(e.tag): e for e in cell}
                kind, raw = cell.attrib.get("t", "n"), parts["v"].text if "v" in parts else None
                if kind == "s" and raw is not None:
                    raw = shared[int(raw)]
                elif kind == "inlineStr":
                    raw = "".join(t.text or "" for t in cell.iter() if _bare(t.tag) == "t")
                yield sheet.attrib["name"], int(row), col, kind, raw, _number(raw) if kind == "n" else None, parts["f"].text if "f" in parts else None


def document_runs(data: bytes) -> Iterator[tuple]:
    """Runs of a DOCX or ODT document or of the slides of a PPTX, with the properties of each run."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        names = archive.namelist()
        parts = [n for n in ("word/document.xml", "content.xml") if n in names] or sorted((n for n in names if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        for part in parts:
            root, at = ElementTree.fromstring(archive.read(part)), -1
            for element in root.iter():
                if _bare(element.tag) not in ("p", "h"):
                    continue
                at += 1
                runs = [r for r in element if _bare(r.tag) in ("r", "span")]
                if not runs:
                    yield part, at, 0, "".join(element.itertext()), _attributes(element)
                for k, run in enumerate(runs):
                    style = _attributes(run)
                    for properties in (e for e in run if _bare(e.tag) == "rPr"):
                        style |= _attributes(properties)
                        for e in properties:
                            style[_bare(e.tag)] = next(iter(e.attrib.values()), "true")
                    yield part, at, k, "".join(t.text or "" for t in run.iter() if _bare(t.tag) in ("t", "span")), style


class _Walker(HTMLParser):
    """Elements in document order, with their own text."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        self.rows.append([len(self.rows), len(self.open), tag, "", {k: v or "" for k, v in attrs}])
        if tag not in self.VOID:
            self.open.append(len(self.rows) - 1)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[k]][2] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if self.open:
            self.rows[self.open[-1]][3] += data


def page_nodes(data: bytes) -> Iterator[tuple]:
    """Elements of an HTML page in order, with depth, stripped own text and attributes."""
    walker = _Walker()
    walker.feed(data.decode("utf-8", "replace"))
    for node, depth, tag, text, attributes in walker.rows:
        yield node, depth, tag, text.strip(), attributes


def database_rows(sql: str) -> Callable[[bytes], Iterator[tuple]]:
    """A parser that runs one query on a SQLite file and gives (row, fields as a map of texts)."""

    def parse(data: bytes) -> Iterator[tuple]:
        connection = sqlite3.connect(":memory:")
        connection.deserialize(data)
        cursor = connection.execute(sql)
        names = [d[0] for d in cursor.description]
        for n, row in enumerate(cursor):
            yield n, {k: None if v is None else str(v) for k, v in zip(names, row, strict=True)}

    return parse


ROWS = "row long, fields map<string,string>"


def tree_rows(tree: dict, depth: int = 0, path: str = "") -> Iterator[tuple]:
    """(path, depth, type) of a directory tree {type, name, children}."""
    here = os.path.join(path, tree.get("name", ""))
    yield here, depth, tree.get("type")
    for child in tree.get("children") or ():
        yield from tree_rows(child, depth + 1, here)
