"""Text documents (DOCX, ODT) read from their bytes."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property
from xml.etree.ElementTree import Element

from loomtrace.files.package import Package, attribute, bare, child, children, inside, is_on, text_of, value

# Lengths of the format are in twentieths of a point, and lines in parts of 240.
_LINE = 240


@dataclass
class Run:
    root: Element = field(repr=False)
    text: str = ""

    @property
    def _about(self) -> Element | None:
        return child(self.root, "rPr")

    def on(self, name: str) -> bool | None:
        return is_on(self._about, name)

    @property
    def font(self) -> str | None:
        return value(self._about, "rFonts", name="ascii")

    @property
    def points(self) -> float | None:
        size = value(self._about, "sz")
        return None if size is None else float(size) / 2

    @property
    def color(self) -> tuple[int, int, int] | None:
        code = value(self._about, "color")
        return None if code in (None, "auto") else tuple(int(code[i : i + 2], 16) for i in (0, 2, 4))

    @property
    def subscript(self) -> bool:
        return value(self._about, "vertAlign") == "subscript"

    @property
    def highlight(self) -> str | None:
        return value(self._about, "highlight")


@dataclass
class Paragraph:
    root: Element = field(repr=False)

    @cached_property
    def runs(self) -> list[Run]:
        return [Run(r, _said(r)) for r in children(self.root, "r")]

    @cached_property
    def text(self) -> str:
        """The texts of runs, and of those inside links."""
        return "".join(_said(r) for e in self.root for r in ([e] if bare(e.tag) == "r" else children(e, "r") if bare(e.tag) == "hyperlink" else []))

    @property
    def alignment(self) -> str | None:
        return value(self.root, "pPr", "jc")

    @property
    def line_spacing(self) -> tuple[str, float] | None:
        """(how, lines or twentieths of a point)."""
        spacing = child(self.root, "pPr", "spacing")
        line = attribute(spacing, "line")
        how = attribute(spacing, "lineRule", "auto")
        return None if line is None else ("lines", float(line) / _LINE) if how == "auto" else ("points", float(line))

    @property
    def tabs(self) -> list[tuple[str, int]]:
        """(alignment, place) of the tab stops that count."""
        found = [(attribute(t, "val"), int(attribute(t, "pos", "0"))) for t in children(self.root, "pPr", "tabs", "tab")]
        return [t for t in found if t[0] != "clear" and t != ("left", 0)]


def _said(run: Element) -> str:
    """The characters of a run: breaks and tabs count as such."""
    as_text = {"tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-"}
    return "".join(e.text or "" if bare(e.tag) == "t" else as_text.get(bare(e.tag), "") if attribute(e, "type") != "page" else "" for e in run)


class Document:
    """A DOCX document; ``paragraphs`` are those of the body, not of its tables."""

    def __init__(self, data: bytes):
        self.package = Package(data)
        self.root = self.package.xml("word/document.xml")
        self.body = child(self.root, "body")

    @cached_property
    def paragraphs(self) -> list[Paragraph]:
        return [Paragraph(p) for p in children(self.body, "p")]

    @property
    def texts(self) -> list[str]:
        return [p.text for p in self.paragraphs]

    @cached_property
    def tables(self) -> list[list[list[list[Paragraph]]]]:
        """Rows of cells of paragraphs; a cell that spans columns stands in each of them."""
        found = []
        for table in children(self.body, "tbl"):
            rows = []
            for row in children(table, "tr"):
                cells = []
                for cell in children(row, "tc"):
                    span = int(value(cell, "tcPr", "gridSpan") or 1)
                    cells += [[Paragraph(p) for p in children(cell, "p")]] * span
                rows.append(cells)
            found.append(rows)
        return found

    @property
    def images(self) -> list[bytes]:
        return [self.package.read(t) for t in self.package.related("word/document.xml", "image") if t in self.package.names]

    @property
    def footers(self) -> list[str]:
        """The first paragraph of each section's footer; a section without one has that of the one before."""
        targets = self.package.relations("word/document.xml")
        found, last = [], ""
        for section in inside(self.root, "sectPr"):
            for ref in children(section, "footerReference"):
                if attribute(ref, "type", "default") == "default":
                    footer = self.package.xml(targets[attribute(ref, "id")][1])
                    last = next((Paragraph(p).text for p in children(footer, "p")), "")
            found.append(last)
        return found

    @property
    def text_width(self) -> int:
        """The width of the first section between its margins, in twentieths of a point."""
        section = next(iter(inside(self.root, "sectPr")))
        margin = child(section, "pgMar")
        return int(value(section, "pgSz", name="w")) - int(attribute(margin, "left")) - int(attribute(margin, "right"))

    @property
    def page_breaks(self) -> int:
        return sum(attribute(b, "type") == "page" for p in self.paragraphs for r in p.runs for b in inside(r.root, "br"))


def odt_paragraphs(data: bytes) -> list[str]:
    return ["".join(p.itertext()) for p in inside(Package(data).xml("content.xml"), "p")]


def odt_backgrounds(data: bytes) -> set[str | None]:
    """The background colours of the styles of spans."""
    root = Package(data).xml("content.xml")
    styles = {attribute(s, "name"): [attribute(p, "background-color") for p in s] for s in inside(child(root, "automatic-styles"), "style")}
    return {c for s in inside(root, "span") for c in styles.get(attribute(s, "style-name"), ())}


def paragraphs_of(data: bytes) -> list[str]:
    """The texts of the paragraphs of a DOCX or ODT document."""
    package = Package(data)
    return Document(data).texts if "word/document.xml" in package.names else odt_paragraphs(data)
