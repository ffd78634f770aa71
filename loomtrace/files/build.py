"""Small office files and pictures as bytes, for results that are handed on as files."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import escape, quoteattr

import numpy as np

from loomtrace.files.workbooks import coordinate

_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def package(parts: Mapping[str, str | bytes]) -> bytes:
    """A ZIP archive of the parts, the same bytes for the same parts."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(zipfile.ZipInfo(name), body)
    return out.getvalue()


def relations(targets: Sequence[tuple[str, str, str]]) -> str:
    """The relations (id, kind, target) of a part."""
    rows = "".join(f'<Relationship Id="{i}" Type="{_OFFICE}/{kind}" Target={quoteattr(t)}/>' for i, kind, t in targets)
    return f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rows}</Relationships>'


def workbook(sheets: Mapping[str, Sequence[Sequence[object]]], extra: Mapping[str, str] | None = None, parts: Mapping[str, str] | None = None) -> bytes:
    """A workbook of sheets of rows of numbers, texts and nulls; ``extra`` is XML after a sheet's cells, ``parts`` are more parts."""
    found: dict[str, str | bytes] = {}
    names = list(sheets)
    entries = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1))
    found["xl/workbook.xml"] = f'<workbook xmlns:r="{_OFFICE}"><sheets>{entries}</sheets></workbook>'
    found["xl/_rels/workbook.xml.rels"] = relations([(f"r{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(names) + 1)])
    for i, name in enumerate(names, 1):
        rows = []
        for r, row in enumerate(sheets[name], 1):
            cells = []
            for c, v in enumerate(row, 1):
                style, v = v if isinstance(v, tuple) else (0, v)
                at = f'r="{coordinate(r, c)}" s="{style}"'
                if isinstance(v, str):
                    cells.append(f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>')
                elif v is not None:
                    cells.append(f"<c {at}><v>{float(v)!r}</v></c>")
            rows.append(f'<row r="{r}">{"".join(cells)}</row>')
        found[f"xl/worksheets/sheet{i}.xml"] = f'<worksheet xmlns:r="{_OFFICE}"><sheetData>{"".join(rows)}</sheetData>{(extra or {}).get(name, "")}</worksheet>'
    return package({**found, **(parts or {})})


def document(paragraphs: Sequence[str], tables: Sequence[Sequence[Sequence[str]]] = (), raw: str = "") -> bytes:
    """A text document; a paragraph that begins with ``<`` is XML as it stands."""
    one = lambda p: p if p.startswith("<") else f"<p><r><t>{escape(p)}</t></r></p>"
    grid = "".join("<tbl>" + "".join("<tr>" + "".join(f"<tc>{one(c)}</tc>" for c in row) + "</tr>" for row in t) + "</tbl>" for t in tables)
    return package({"word/document.xml": f"<document><body>{''.join(map(one, paragraphs))}{grid}{raw}</body></document>"})


def shape(text: str | None = None, rect: Sequence[int] = (0, 0, 100, 100), run: str = "", paragraph: str = "", kind: str = "sp", inner: str = "") -> str:
    """The XML of a shape of a slide; ``run`` and ``paragraph`` are attributes or properties of its one run and paragraph."""
    x, y, w, h = rect
    frame = f'<xfrm><off x="{x}" y="{y}"/><ext cx="{w}" cy="{h}"/></xfrm>'
    body = "" if text is None else f"<txBody><p>{paragraph}<r><rPr {run}>{inner}</rPr><t>{escape(text)}</t></r></p></txBody>"
    if kind == "grpSp":
        return f"<grpSp><grpSpPr>{frame}</grpSpPr>{inner}</grpSp>"
    if kind == "graphicFrame":
        return f"<graphicFrame>{frame}{inner}</graphicFrame>"
    return f"<{kind}><spPr>{frame}</spPr>{body}</{kind}>"


def deck(slides: Sequence[Sequence[str]], backgrounds: Sequence[str | None] = (), notes: Sequence[str | None] = (), extra: Sequence[str] = (), size: tuple[int, int] = (9144000, 6858000)) -> bytes:
    """A deck of slides of shapes (``shape``), with solid backgrounds and notes by number."""
    ids = "".join(f'<sldId id="{255 + i}" r:id="r{i}"/>' for i in range(1, len(slides) + 1))
    parts: dict[str, str | bytes] = {
        "ppt/presentation.xml": f'<presentation xmlns:r="{_OFFICE}"><sldIdLst>{ids}</sldIdLst><sldSz cx="{size[0]}" cy="{size[1]}"/></presentation>',
        "ppt/_rels/presentation.xml.rels": relations([(f"r{i}", "slide", f"slides/slide{i}.xml") for i in range(1, len(slides) + 1)]),
    }
    for i, shapes in enumerate(slides, 1):
        colour = backgrounds[i - 1] if i <= len(backgrounds) else None
        ground = "" if colour is None else f'<bg><bgPr><solidFill><srgbClr val="{colour}"/></solidFill></bgPr></bg>'
        more = extra[i - 1] if i <= len(extra) else ""
        parts[f"ppt/slides/slide{i}.xml"] = f"<sld><cSld>{ground}<spTree>{''.join(shapes)}</spTree></cSld>{more}</sld>"
        if i <= len(notes) and notes[i - 1] is not None:
            parts[f"ppt/slides/_rels/slide{i}.xml.rels"] = relations([("n1", "notesSlide", f"../notesSlides/notesSlide{i}.xml")])
            parts[f"ppt/notesSlides/notesSlide{i}.xml"] = f'<notes><cSld><spTree><sp><nvSpPr><nvPr><ph type="body"/></nvPr></nvSpPr><txBody><p><r><t>{escape(notes[i - 1])}</t></r></p></txBody></sp></spTree></cSld></notes>'
    return package(parts)


def png(samples: np.ndarray, filters: Sequence[int] = (0,)) -> bytes:
    """A picture of height x width x 1 to 4 channels of bytes; lines take the filters (0 to 2) in turn."""
    height, width, channels = samples.shape
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    rows, body = samples.reshape(height, -1), b""
    for y in range(height):
        kind, line = filters[y % len(filters)], rows[y]
        if kind == 1:
            line = np.concatenate([line[:channels], line[channels:] - line[:-channels]])
        elif kind == 2:
            line = line - (rows[y - 1] if y else 0)
        body += bytes([kind]) + line.astype(np.uint8).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")
