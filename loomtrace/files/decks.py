"""Slide decks as facts, and whether two decks state the same ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import zip_longest
from xml.etree.ElementTree import Element

from loomtrace.files.package import Package, attribute, bare, child, children, inside, text_of, value

_RECT = ("left", "top", "width", "height")


@dataclass
class Run:
    text: str
    font: str | None
    size: str | None
    bold: bool
    italic: bool
    underline: str | None
    strike: str
    color: str | None


@dataclass
class Paragraph:
    alignment: str
    level: int
    runs: list[Run]
    text: str


@dataclass
class Shape:
    """``kind`` is text, picture, table, group, media, graphic or line; ``freeform`` marks drawn outlines."""

    kind: str
    rect: tuple[int, int, int, int]
    text: str | None = None
    paragraphs: list[Paragraph] = field(default_factory=list)
    cells: list[list[list[Paragraph]]] = field(default_factory=list)
    inner: list[Shape] = field(default_factory=list)
    freeform: bool = False
    bold_fill: str | None = None


@dataclass
class Slide:
    shapes: list[Shape]
    background: str | None
    notes: str
    bullets: list[tuple[str, str, str]]
    root: Element | None = None


def _flag(properties: Element | None, name: str) -> bool:
    return attribute(properties, name, "0") in ("1", "true")


def _paragraphs(body: Element | None) -> list[Paragraph]:
    found = []
    for p in children(body, "p"):
        runs = []
        for r in children(p, "r"):
            rp = child(r, "rPr")
            runs.append(Run(text_of(r, "t"), value(rp, "latin", name="typeface"), attribute(rp, "sz"), _flag(rp, "b"), _flag(rp, "i"), attribute(rp, "u"), attribute(rp, "strike", "noStrike"), value(rp, "solidFill", "srgbClr")))
        about = child(p, "pPr")
        text = "".join("\v" if bare(e.tag) == "br" else text_of(e, "t") for e in p if bare(e.tag) in ("r", "br", "fld"))
        found.append(Paragraph(attribute(about, "algn", "l"), int(attribute(about, "lvl", "0")), runs, text))
    return found


def _rect(element: Element) -> tuple[int, int, int, int]:
    frame = child(element, "spPr", "xfrm") if child(element, "spPr") is not None else child(element, "xfrm")
    frame = frame if frame is not None else child(element, "grpSpPr", "xfrm")
    off, ext = child(frame, "off"), child(frame, "ext")
    return tuple(int(attribute(e, n, "0")) for e, n in ((off, "x"), (off, "y"), (ext, "cx"), (ext, "cy")))


def _shape(element: Element) -> Shape | None:
    tag = bare(element.tag)
    rect = _rect(element)
    if tag == "sp":
        body = child(element, "txBody")
        paragraphs = _paragraphs(body)
        return Shape("text", rect, "\n".join(p.text for p in paragraphs), paragraphs, freeform=child(element, "spPr", "custGeom") is not None, bold_fill=value(element, "spPr", "solidFill", "srgbClr"))
    if tag == "pic":
        media = inside(child(element, "nvPicPr"), "videoFile", "audioFile")
        return Shape("media" if media else "picture", rect)
    if tag == "graphicFrame":
        table = next(iter(inside(element, "tbl")), None)
        if table is not None:
            return Shape("table", rect, cells=[[_paragraphs(child(c, "txBody")) for c in children(row, "tc")] for row in children(table, "tr")])
        return Shape("graphic", rect)
    if tag == "grpSp":
        return Shape("group", rect, inner=_shapes(element))
    return Shape("line", rect) if tag == "cxnSp" else None


def _shapes(tree: Element | None) -> list[Shape]:
    return [s for s in map(_shape, tree if tree is not None else ()) if s is not None]


def _solid(root: Element | None) -> str | None:
    return value(root, "cSld", "bg", "bgPr", "solidFill", "srgbClr")


def _bullets(root: Element | None) -> list[tuple[str, str, str]]:
    """(level, character, text) of each paragraph with a text, wherever it stands in the slide."""
    found = []
    for p in inside(root, "p"):
        about, text = child(p, "pPr"), text_of(p, "t")
        if text.strip():
            found.append(("none" if about is None else attribute(about, "lvl", "0"), value(about, "buChar", name="char") or "none", text))
    return found


def read_deck(data: bytes) -> list[Slide]:
    package = Package(data)
    main = "ppt/presentation.xml"
    targets = package.relations(main)
    slides = []
    for entry in children(package.xml(main), "sldIdLst", "sldId"):
        part = targets[next(v for k, v in entry.attrib.items() if k.endswith("}id"))][1]
        root = package.xml(part)
        background = _solid(root)
        if child(root, "cSld", "bg") is None:  # that of the master
            for layout in package.related(part, "slideLayout"):
                background = next(filter(None, (_solid(package.xml(m)) for m in package.related(layout, "slideMaster"))), None)
        notes = [s for n in package.related(part, "notesSlide") for s in inside(package.xml(n), "sp") if value(s, "nvSpPr", "nvPr", "ph", name="type") == "body"]
        slides.append(Slide(_shapes(child(root, "cSld", "spTree")), background, "\n".join(p.text for s in notes for p in _paragraphs(child(s, "txBody"))), _bullets(root), root))
    return slides


def text_shapes(shapes: list[Shape]) -> list[Shape]:
    """Shapes with a text, also those inside groups."""
    return [t for s in shapes for t in ([s] if s.text is not None else text_shapes(s.inner))]


def _underlines(a: str | None, b: str | None) -> bool:
    """A missing underline equals every one but the single line."""
    mean = lambda u: {"none": False, "sng": True}.get(u, u)
    if a is None or b is None:
        return mean(a if b is None else b) is not True
    return mean(a) == mean(b)


# Places, in the units of slides, beyond which moved shapes must lie, and texts that two tasks single out.
MOVED_DOWN, MOVED_RIGHT, MOVED_UP = 3_600_000, 4_320_000, 1_980_000
TITLE, EXEMPT = "Product Comparison", "Elaborate on what you want to discuss."

#: Checks and whether they run unless an option says otherwise.
CHECKS = {
    "number_of_slides": True, "shape": True, "text": True, "indent": True, "font_name": True, "font_size": True, "font_bold": True, "font_italic": True,
    "color_rgb": True, "font_underline": True, "strike_through": True, "alignment": True, "bullets": True, "background_color": True, "note": True,
    "title_bottom_position": False, "table_bottom_position": False, "right_position": False, "top_position": False, "shape_for_shift_size": False,
    "image_size": False, "modify_height": False,
}

#: Checks of runs by what must be equal.
_RUN_CHECKS: dict[str, Callable[[Run], object]] = {
    "font_name": lambda r: r.font, "font_size": lambda r: r.size, "font_bold": lambda r: r.bold, "font_italic": lambda r: r.italic, "strike_through": lambda r: r.strike,
}


def _same_color(a: Run, b: Run) -> bool:
    return a.color is None or b.color is None or a.color == b.color


def _same_texts(a: Shape, b: Shape, on: set[str]) -> bool:
    """The text, its paragraphs and their runs, as far as checks are on."""
    if ("text" in on and a.text.strip() != b.text.strip()) or len(a.paragraphs) != len(b.paragraphs):
        return False
    for p, q in zip(a.paragraphs, b.paragraphs, strict=True):
        if ("alignment" in on and p.alignment != q.alignment) or ("text" in on and p.text != q.text) or ("indent" in on and p.level != q.level) or len(p.runs) != len(q.runs):
            return False
        for r, s in zip(p.runs, q.runs, strict=True):
            if any(of(r) != of(s) for check, of in _RUN_CHECKS.items() if check in on):
                return False
            if ("color_rgb" in on and not _same_color(r, s)) or ("font_underline" in on and not _underlines(r.underline, s.underline)):
                return False
    return True


def _same_tables(a: Shape, b: Shape, on: set[str]) -> bool:
    shape_of = lambda cells: [[[len(p.runs) for p in cell] for cell in row] for row in cells]
    if shape_of(a.cells) != shape_of(b.cells):
        return False
    runs = lambda t: [r for row in t.cells for cell in row for p in cell for r in p.runs]
    return all(
        ("color_rgb" not in on or _same_color(r, s)) and r.bold == s.bold and r.italic == s.italic and _underlines(r.underline, s.underline) for r, s in zip(runs(a), runs(b), strict=True)
    )


def _placed(a: Shape, b: Shape, number: int, on: set[str], near: Callable[[float, float], bool]) -> bool:
    """Whether all checks of places and sizes that are on hold for a pair of shapes of slide ``number``."""
    alike = all(near(x, y) for x, y in zip(a.rect, b.rect, strict=True))
    both = lambda kind: a.kind == kind and b.kind == kind
    (left, top), (other_left, other_top) = a.rect[:2], b.rect[:2]
    texts = a.text is not None and b.text is not None
    neither = a.text is None and b.text is None
    same_text = texts and a.text == b.text
    tests = {
        "title_bottom_position": lambda: (a.text != TITLE or (top > other_top and top >= MOVED_DOWN)) if same_text else alike,
        "table_bottom_position": lambda: (top > other_top and top >= MOVED_DOWN) if number == 3 and both("table") else alike,
        "right_position": lambda: not (number == 2 and neither) or (left > other_left and left >= MOVED_RIGHT),
        "top_position": lambda: not (number == 2 and both("picture")) or (top < other_top and top <= MOVED_UP),
        "shape_for_shift_size": lambda: alike or (same_text and a.text == EXEMPT),
        "shape": lambda: alike,
        "image_size": lambda: all(near(x, y) for x, y in zip(a.rect[2:], b.rect[2:], strict=True)) if both("picture") else alike,
        "modify_height": lambda: near(a.rect[3], b.rect[3]) if neither or (a.freeform and b.freeform) else alike,
    }
    return all(test() for check, test in tests.items() if check in on)


def same_decks(a: bytes, b: bytes, approximately_tolerance: float = 0.005, **options: bool) -> bool:
    """Whether two decks agree in all checks of CHECKS that are on; an option ``examine_<check>`` switches one."""
    unknown = [o for o in options if o.removeprefix("examine_") not in CHECKS]
    if unknown:
        raise ValueError(f"no such options: {unknown}")
    on = {c for c, default in CHECKS.items() if options.get(f"examine_{c}", default)}
    near = lambda x, y: x == y or (x != 0 and y != 0 and abs(x - y) / max(abs(x), abs(y)) <= approximately_tolerance)
    one, two = read_deck(a), read_deck(b)
    if "number_of_slides" in on and len(one) != len(two):
        return False
    for number, (s, t) in enumerate(zip(one, two, strict=False), 1):
        if ("background_color" in on and s.background != t.background) or ("note" in on and s.notes.strip() != t.notes.strip()) or len(s.shapes) != len(t.shapes):
            return False
        for x, y in zip(s.shapes, t.shapes, strict=True):
            if not _placed(x, y, number, on, near):
                return False
            if x.kind == "table" and (y.kind != "table" or not _same_tables(x, y, on)):
                return False
            if x.text is not None and y.text is not None and not _same_texts(x, y, on):
                return False
        runs = any(p.runs for x in s.shapes if x.text is not None for p in x.paragraphs)
        if "bullets" in on and runs and s.bullets != t.bullets:
            return False
        deep = list(zip_longest(text_shapes(s.shapes), text_shapes(t.shapes)))
        if any(x is None or y is None for x, y in deep):
            return False
        # Texts inside groups too, if alignment counts.
        said = lambda x: (x.text.strip() if "text" in on else "", [p.alignment for p in x.paragraphs])
        if "alignment" in on and any(said(x) != said(y) for x, y in deep):
            return False
    return True
