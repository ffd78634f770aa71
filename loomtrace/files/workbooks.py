"""Workbooks read from their bytes, and the rules that compare them.

A rule names a sheet of the result or of the expected book by its place (``0``,
``RI0``, ``EI0``) or its name (``RNSheet1``, ``ENSheet1``). What a rule compares is read
into plain values by one function for each type.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from itertools import dropwhile
from xml.etree.ElementTree import Element

from loomtrace.files.package import Package, attribute, bare, child, children, inside, text_of, value
from loomtrace.files.values import fits_rule
from loomtrace.functions.rules import cell_range
from loomtrace.functions.text import indel

# Number formats that have numbers of their own in a workbook.
BUILT_IN_FORMATS = {
    0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?", 13: "# ??/??", 14: "mm-dd-yy", 15: "d-mmm-yy",
    16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm", 37: "#,##0 ;(#,##0)", 38: "#,##0 ;[Red](#,##0)",
    39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;[Red](#,##0.00)", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0", 48: "##0.0E+0", 49: "@",
}
#: Cells without a value on end after which a conditional format is no longer followed.
EMPTY_RUN = 50


def column_name(number: int) -> str:
    name = ""
    while number:
        number, rest = divmod(number - 1, 26)
        name = chr(65 + rest) + name
    return name


def coordinate(row: int, column: int) -> str:
    return f"{column_name(column)}{row}"


def cells_of(ranges: str | Sequence[str]) -> Iterator[tuple[int, int]]:
    for part in ranges.split() if isinstance(ranges, str) else ranges:
        r0, c0, r1, c1 = cell_range(part)
        yield from ((r, c) for r in range(r0, r1 + 1) for c in range(c0, c1 + 1))


@dataclass
class Cell:
    kind: str
    value: object
    style: int
    formula: str | None


@dataclass
class Font:
    name: str | None = None
    family: float | None = None
    color: str | None = None
    bold: bool = False
    italic: bool = False
    underline: str | None = None
    size: float | None = None


def _color(element: Element | None) -> str | None:
    """A colour as eight hex digits, or what its theme or number says."""
    if element is None:
        return None
    for name in ("rgb", "theme", "indexed"):
        if attribute(element, name) is not None:
            return attribute(element, name) if name == "rgb" else f"{name} {attribute(element, name)}"
    return None


def _font(element: Element | None) -> Font:
    number = lambda name: None if value(element, name) is None else float(value(element, name))
    on = lambda name: child(element, name) is not None and value(element, name) not in ("0", "false")
    line = child(element, "u")
    return Font(value(element, "name"), number("family"), _color(child(element, "color")), on("b"), on("i"), None if line is None else attribute(line, "val", "single"), number("sz"))


@dataclass
class Fill:
    kind: str | None
    foreground: str
    background: str


def _fill(element: Element | None) -> Fill:
    inner = next(iter(element), None) if element is not None else None
    plain = "00000000"
    return Fill(None if inner is None else bare(inner.tag), _color(child(inner, "fgColor")) or plain, _color(child(inner, "bgColor")) or plain)


@dataclass
class Sheet:
    """One sheet of a book; everything but its cells is read when a rule asks for it."""

    book: Book
    name: str
    part: str
    root: Element = field(repr=False)

    @cached_property
    def cells(self) -> dict[tuple[int, int], Cell]:
        found = {}
        for c in children(self.root, "sheetData", "row", "c"):
            row, column, _, _ = cell_range(attribute(c, "r"))
            kind, raw = attribute(c, "t", "n"), child(c, "v")
            text = None if raw is None else raw.text or ""
            if kind == "inlineStr":
                text = text_of(child(c, "is"), "t")
            elif kind == "s" and text is not None:
                text = self.book.strings[int(text)]
            value_: object = text
            if kind == "n":
                try:
                    value_ = float(text)
                except (TypeError, ValueError):
                    value_ = None
            elif kind == "b":
                value_ = text == "1"
            formula = child(c, "f")
            found[row, column] = Cell(kind, value_, int(attribute(c, "s", "0")), None if formula is None else formula.text or "")
        return found

    def raw(self, row: int, column: int) -> object:
        """The value as the file holds it: a number or a text; null for booleans and empty cells."""
        cell = self.cells.get((row, column))
        return None if cell is None or cell.kind == "b" else cell.value

    @cached_property
    def bounds(self) -> tuple[int, int]:
        return (max((r for r, _ in self.cells), default=0), max((c for _, c in self.cells), default=0))

    @cached_property
    def merged(self) -> set[tuple[int, int]]:
        """Cells of merged ranges but their first ones."""
        return {rc for m in children(self.root, "mergeCells", "mergeCell") for rc in list(cells_of(attribute(m, "ref")))[1:]}

    @cached_property
    def links(self) -> dict[tuple[int, int], str]:
        targets = self.book.package.relations(self.part)
        return {rc: targets.get(attribute(h, "id") or "", ("", attribute(h, "location", "")))[1] for h in children(self.root, "hyperlinks", "hyperlink") for rc in cells_of(attribute(h, "ref"))}

    # What rules compare, as plain values.

    def table(self, digits: int) -> list[list[object]]:
        """Rows from the first to the last that holds something, numbers rounded; whole numbers, booleans and texts as they are."""
        rows, columns = self.bounds
        shown = [[(c.value if (c := self.cells.get((r, k))) is not None and c.value != "" else None) for k in range(1, columns + 1)] for r in range(1, rows + 1)]
        rounded = [[round(x, digits) if isinstance(x, float) else x for x in row] for row in shown]
        while rounded and all(x is None for x in rounded[-1]):
            rounded.pop()
        width = max((k + 1 for row in rounded for k, x in enumerate(row) if x is not None), default=0)
        return [row[:width] for row in rounded]

    def sparklines(self) -> dict[str, str]:
        """The range that each sparkline shows, by its cell."""
        return {text_of(s, "sqref"): text_of(s, "f") for s in inside(self.root, "sparkline")}

    def freeze(self) -> str | None:
        pane = child(self.root, "sheetViews", "sheetView", "pane")
        return attribute(pane, "topLeftCell") if attribute(pane, "state") in ("frozen", "frozenSplit") else None

    def zoom(self) -> float:
        return float(value(self.root, "sheetViews", "sheetView", name="zoomScale") or 100)

    def validations(self) -> list[dict[str, object]]:
        """The attributes of each data validation."""
        flags = ("allowBlank", "showDropDown", "showInputMessage", "showErrorMessage")
        found = []
        for v in children(self.root, "dataValidations", "dataValidation"):
            row: dict[str, object] = {k: attribute(v, k) for k in ("type", "operator", "error", "errorTitle", "errorStyle", "prompt", "promptTitle", "imeMode")}
            row |= {k: attribute(v, k, "0") in ("1", "true") for k in flags}
            row |= {k: None if child(v, k) is None else text_of(v, k) for k in ("formula1", "formula2")}
            found.append(row | {"ranges": attribute(v, "sqref")})
        return found

    def rows_or_columns(self, what: str, properties: Sequence[str]) -> dict[object, dict[str, object]]:
        """Named properties of each row or span of columns that the sheet describes."""
        number = lambda x: None if x is None else float(x)
        on = lambda e, k: attribute(e, k, "0") in ("1", "true")
        if what == "row":
            items = {int(attribute(e, "r")): {"hidden": on(e, "hidden"), "collapsed": on(e, "collapsed"), "height": number(attribute(e, "ht"))} for e in children(self.root, "sheetData", "row")}
        else:
            items = {
                column_name(int(attribute(e, "min"))): {"width": number(attribute(e, "width")), "hidden": on(e, "hidden"), "collapsed": on(e, "collapsed"), "auto_size": on(e, "bestFit"), "min": int(attribute(e, "min")), "max": int(attribute(e, "max"))}
                for e in children(self.root, "cols", "col")
            }
        return {k: {p: item[p] for p in properties} for k, item in items.items()}

    def filters(self) -> dict[str, object]:
        """The filtered range, what each of its columns lets through, and its order."""
        root = child(self.root, "autoFilter")
        columns = {}
        for c in children(root, "filterColumn"):
            listed, custom = child(c, "filters"), child(c, "customFilters")
            columns[int(attribute(c, "colId"))] = (
                attribute(c, "hiddenButton"), attribute(c, "showButton"),
                None if listed is None else (attribute(listed, "blank"), frozenset(attribute(f, "val") for f in children(listed, "filter"))),
                None if custom is None else (attribute(custom, "and"), frozenset((attribute(f, "operator"), attribute(f, "val")) for f in children(custom, "customFilter"))),
            )
        sort = child(root, "sortState")
        order = None if sort is None else (sorted(sort.attrib.items()), [sorted(e.attrib.items()) for e in children(sort, "sortCondition")])
        return {"ref": attribute(root, "ref"), "columns": columns, "sort": order}

    def charts(self, properties: Sequence[str]) -> dict[str, dict[str, object]]:
        """Named properties of each chart, by the ranges of values and categories of its series."""
        found = {}
        for drawing in self.book.package.related(self.part, "drawing"):
            charts = self.book.package.relations(drawing)
            for frame in self.book.package.xml(drawing):
                for link in inside(frame, "chart"):
                    part = charts[attribute(link, "id")][1]
                    root = child(self.book.package.xml(part), "chart")
                    for plot in (e for e in child(root, "plotArea") if bare(e.tag).endswith("Chart")):
                        told = _chart_facts(root, plot, frame)
                        found[_series(plot)] = {p: told[p] for p in properties if p in told}
        return found

    def pivots(self, properties: Sequence[str]) -> dict[str, dict[str, object]]:
        """Named properties of each pivot table, by its source without the unused columns at its sides."""
        found = {}
        for part in self.book.package.related(self.part, "pivotTable"):
            root = self.book.package.xml(part)
            cache = self.book.package.xml(self.book.package.related(part, "pivotCacheDefinition")[0])
            source = child(cache, "cacheSource")
            sheet = child(source, "worksheetSource")
            chosen = [[(attribute(i, "h") in ("1", "true") or None, int(attribute(i, "x"))) for i in children(f, "items", "item") if attribute(i, "x") is not None] for f in children(root, "pivotFields", "pivotField")]
            used = [k for k, items in enumerate(chosen) if items]
            low, high = (used[0], len(chosen) - 1 - used[-1]) if used else (0, 0)
            r0, c0, r1, c1 = cell_range(attribute(sheet, "ref"))
            selection = chosen[low : len(chosen) - high]
            fields = lambda *path: [int(attribute(f, "x")) - low for f in children(root, *path)]  # noqa: E731, B023
            flag = lambda name, default: attribute(root, name, default) in ("1", "true")  # noqa: E731, B023
            told = {
                "name": attribute(root, "name"), "show_total": flag("visualTotals", "1"), "show_empty_row": flag("showEmptyRow", "0"), "show_empty_col": flag("showEmptyCol", "0"), "show_headers": flag("showHeaders", "1"),
                "location": sorted(child(root, "location").attrib.items()) if child(root, "location") is not None else None,
                "selection": selection if "ordered" in properties else [frozenset(s) for s in selection],
                "filter_fields": frozenset(int(attribute(f, "fld")) for f in children(root, "pageFields", "pageField")),
                "col_fields": fields("colFields", "field"), "row_fields": fields("rowFields", "field"),
                "data_fields": [(int(attribute(f, "fld")) - low, attribute(f, "name") if "data_fields_name" in properties else None, attribute(f, "subtotal", "sum"), attribute(f, "showDataAs", "normal")) for f in children(root, "dataFields", "dataField")],
            }
            wanted = {p for p in properties if p in told} | ({"selection", "filter_fields"} if "filter" in properties else set())
            found[f"{attribute(source, 'type')};{(r0, c0 + low)}:{(r1, c1 - high)};{attribute(sheet, 'sheet')}"] = {p: told[p] for p in wanted}
        return found

    def styles(self, properties: Sequence[str]) -> dict[tuple[int, int], list[object]]:
        """Named styles of all cells; where a conditional format is active, its own."""
        rows, columns = self.bounds
        found = {(r, c): [self.style(p, r, c) for p in properties] for c in range(1, columns + 1) for r in range(1, rows + 1)}
        for block in children(self.root, "conditionalFormatting"):
            for rule in children(block, "cfRule"):
                test = condition(attribute(rule, "type"), attribute(rule, "operator"), [e.text or "" for e in children(rule, "formula")], self)
                if test is None:
                    continue
                difference = self.book.differences[int(attribute(rule, "dxfId"))] if attribute(rule, "dxfId") is not None else None
                empty = 0
                for rc in cells_of(attribute(block, "sqref")):
                    own = self.raw(*rc)
                    if own is None:
                        empty += 1
                        if empty > EMPTY_RUN:
                            break
                    elif test(own):
                        found[rc] = [self.style(p, *rc, difference) for p in properties]
        return found

    def style(self, name: str, row: int, column: int, difference: Element | None = None) -> object:
        cell = self.cells.get((row, column))
        filled = cell is not None and cell.value is not None
        form = self.book.formats[cell.style] if cell is not None and cell.style < len(self.book.formats) else None
        if name == "merge":
            return (row, column) in self.merged
        if name == "hyperlink":
            return self.links.get((row, column), "") if filled else None
        if name == "number_format":
            if not filled or cell.kind != "n":
                return None
            return value(difference, "numFmt", name="formatCode") if difference is not None else self.book.number_format(form)
        if name in ("fill_type", "fgcolor", "bgcolor"):
            if difference is not None:
                fill = _fill(child(difference, "fill"))
                return fill.kind if name == "fill_type" else fill.background
            fill = self.book.fills[int(attribute(form, "fillId", "0"))] if form is not None and self.book.fills else _fill(None)
            return fill.kind or "patternFill" if name == "fill_type" else fill.foreground
        if not name.startswith("font_"):
            raise ValueError(f"no such style: {name}")
        font = _font(child(difference, "font")) if difference is not None else self.book.fonts[int(attribute(form, "fontId", "0"))] if form is not None and self.book.fonts else Font()
        return getattr(font, name.removeprefix("font_")) if filled else None


def condition(kind: str, operator: str | None, formulas: list[str], sheet: Sheet) -> Callable[[object], bool] | None:
    """The test of a conditional format of compared or contained values; null for other kinds."""
    constants = [_constant(f, sheet) for f in formulas]
    if kind == "cellIs":
        if any(c is None for c in constants):
            return None
        return lambda own: _compare(operator, own, constants)
    # A text format's formula holds the text in quotes: SEARCH("x",A1), LEFT(A1,1)="x".
    quoted = re.search(r'"((?:[^"]|"")*)"', formulas[0]) if formulas else None
    if kind in ("containsText", "notContainsText", "beginsWith", "endsWith") and quoted:
        wanted = quoted[1].replace('""', '"').lower()
        tests = {"containsText": lambda s: wanted in s, "notContainsText": lambda s: wanted not in s, "beginsWith": lambda s: s.startswith(wanted), "endsWith": lambda s: s.endswith(wanted)}
        return lambda own: tests[kind](str(own).lower())
    if kind in ("containsErrors", "notContainsErrors"):
        return lambda own: (isinstance(own, str) and own.startswith("#")) == (kind == "containsErrors")
    return None


def _constant(formula: str, sheet: Sheet) -> object:
    """The value of a number, a quoted text or a single cell; null for anything else."""
    text = formula.strip()
    if text.startswith('"') and text.endswith('"'):
        return text[1:-1].replace('""', '"')
    if re.fullmatch(r"\$?[A-Z]{1,3}\$?\d+", text):
        row, column, _, _ = cell_range(text)
        return sheet.raw(row, column)
    try:
        return float(text)
    except ValueError:
        return None


def _compare(operator: str | None, own: object, ref: list) -> bool:
    try:
        low, high = min(ref), max(ref)
        return {
            "lessThan": lambda: own < ref[0], "lessThanOrEqual": lambda: own <= ref[0], "equal": lambda: own == ref[0], "notEqual": lambda: own != ref[0],
            "greaterThan": lambda: own > ref[0], "greaterThanOrEqual": lambda: own >= ref[0], "between": lambda: low <= own <= high, "notBetween": lambda: own < low or own > high,
        }[operator]()
    except (TypeError, KeyError, ValueError):
        return False


def _series(plot: Element) -> str:
    """The ranges of values and categories of a chart's series."""
    at = lambda s, name: next((e.text or "" for ref in inside(child(s, name), "numRef", "strRef") for e in children(ref, "f")), "")
    return ";".join(f"{at(s, 'val') or at(s, 'yVal')},{at(s, 'cat')}" for s in children(plot, "ser"))


def _chart_facts(root: Element, plot: Element, frame: Element) -> dict[str, object]:
    title = lambda e: next((text_of(r, "t") for p in children(e, "title", "tx", "rich", "p") for r in children(p, "r")), None)
    axes = [e for e in child(root, "plotArea") if bare(e.tag) in ("valAx", "catAx", "dateAx", "serAx")]
    own = {attribute(i, "val") for i in children(plot, "axId")}
    axes = [a for a in axes if value(a, "axId") in own]
    by_kind = lambda *kinds: next((title(a) for a in axes if bare(a.tag) in kinds), None)
    values = [a for a in axes if bare(a.tag) == "valAx"]
    scattered = bare(plot.tag) in ("scatterChart", "bubbleChart")
    place = lambda corner, name: None if child(frame, corner, name) is None else int(child(frame, corner, name).text)
    extent = child(frame, "ext")
    return {
        "title": title(root), "legend": value(root, "legend", "legendPos") if child(root, "legend") is not None else None,
        "anchor": [attribute(frame, "editAs"), place("from", "col"), place("to", "row"), place("to", "col"), place("to", "row")],
        "width": attribute(extent, "cx"), "height": attribute(extent, "cy"), "type": bare(plot.tag), "direction": value(plot, "barDir"),
        "xtitle": title(values[0]) if scattered and values else by_kind("catAx", "dateAx"), "ytitle": title(values[-1]) if values else None, "ztitle": by_kind("serAx"),
    }


class Book:
    def __init__(self, data: bytes):
        self.package = Package(data)
        main = "xl/workbook.xml"
        targets = self.package.relations(main)
        self.sheets: dict[str, Sheet] = {}
        for entry in children(self.package.xml(main), "sheets", "sheet"):
            kind, part = targets[next(v for k, v in entry.attrib.items() if k.endswith("}id"))]
            if kind == "worksheet":
                self.sheets[attribute(entry, "name")] = Sheet(self, attribute(entry, "name"), part, self.package.xml(part))
        self.names = list(self.sheets)

    @cached_property
    def strings(self) -> list[str]:
        return [text_of(s, "t") for s in children(self.package.xml("xl/sharedStrings.xml"), "si")]

    @cached_property
    def _styles(self) -> Element | None:
        return self.package.xml("xl/styles.xml")

    @cached_property
    def formats(self) -> list[Element]:
        return children(self._styles, "cellXfs", "xf")

    @cached_property
    def fonts(self) -> list[Font]:
        return [_font(e) for e in children(self._styles, "fonts", "font")]

    @cached_property
    def fills(self) -> list[Fill]:
        return [_fill(e) for e in children(self._styles, "fills", "fill")]

    @cached_property
    def differences(self) -> list[Element]:
        return children(self._styles, "dxfs", "dxf")

    def number_format(self, form: Element | None) -> str:
        number = int(attribute(form, "numFmtId", "0"))
        own = {int(attribute(e, "numFmtId")): attribute(e, "formatCode") for e in children(self._styles, "numFmts", "numFmt")}
        return own.get(number, BUILT_IN_FORMATS.get(number, "General"))


class Pair:
    """The books of a result and of what is expected, with the printed texts of their sheets by name of the file beside."""

    def __init__(self, result: bytes, expected: bytes | None, stems: tuple[str, str] = ("", ""), printed: Mapping[str, str] | None = None):
        self.books = (Book(result), None if expected is None else Book(expected))
        self.stems, self.printed = stems, dict(printed or {})

    def find(self, place: int | str) -> tuple[int, str]:
        """(side, name) of a sheet that a rule names."""
        text = f"RI{place}" if isinstance(place, int) else place
        if text[:1] not in ("R", "E") or text[1:2] not in ("I", "N"):
            raise ValueError(f"no such sheet: {place}")
        side, rest = "RE".index(text[0]), text[2:]
        if text[1] == "N":
            return side, rest
        names = self.books[side].names if self.books[side] is not None else []
        return side, names[int(rest)] if int(rest) < len(names) else ""

    def sheet(self, place: int | str) -> Sheet | None:
        side, name = self.find(place)
        book = self.books[side]
        return None if book is None else book.sheets.get(name)

    def lines(self, place: int | str) -> list[str] | None:
        """The printed lines of a sheet, stripped, from the last that is not empty to the first."""
        side, name = self.find(place)
        text = self.printed.get(f"{self.stems[side]}-{name}.csv")
        return None if text is None else list(dropwhile(lambda x: not x, (x.strip() for x in reversed(text.splitlines()))))


def _fuzzy(pair: Pair, rule: Mapping) -> bool:
    one, two = pair.sheet(rule["sheet_idx0"]), pair.sheet(rule["sheet_idx1"])
    for r in rule["rules"]:
        for rc in cells_of(r["range"]):
            a, b = (_tidy(str(None if s is None else s.raw(*rc)), r) for s in (one, two))
            kind = r["type"]
            if not {"includes": lambda: b in a, "included_by": lambda: a in b, "exact_match": lambda: a == b, "fuzzy_match": lambda: 100 * indel(a, b) >= r.get("threshold", 85.0)}[kind]():  # noqa: B023
                return False
    return True


def _tidy(text: str, rule: Mapping) -> str:
    for old, new in rule.get("normalization", ()):
        text = text.replace(old, new)
    text = text.lstrip(rule["trim_leadings"]) if "trim_leadings" in rule else text
    text = text.rstrip(rule["trim_trailings"]) if "trim_trailings" in rule else text
    text = "".join(c for c in text if c not in rule.get("ignore_chars", ""))
    return text.lower() if rule.get("ignore_case", False) else text


def _cell_fits(pair: Pair, rule: Mapping) -> bool:
    sheet = pair.sheet(rule["sheet_idx"])
    if sheet is None:
        return False
    row, column, _, _ = cell_range(rule["coordinate"])
    return all(fits_rule(sheet.raw(row, column) if name == "value" else sheet.style(name, row, column), r["method"], r["ref"]) for name, r in rule["props"].items())


def _validations_fit(pair: Pair, rule: Mapping) -> bool:
    """There are at least as many validations as patterns, and each fits one."""
    sheet = pair.sheet(rule["sheet_idx"])
    if sheet is None:
        return False
    there = sheet.validations()
    return len(there) >= len(rule["dv_props"]) and all(any(all(fits_rule(v.get(k), r["method"], r["ref"]) for k, r in p.items()) for p in rule["dv_props"]) for v in there)


def _same(of: Callable[[Sheet, Mapping], object], missing: object = None) -> Callable[[Pair, Mapping], bool]:
    """Equality of what is read of two sheets; without a sheet there is ``missing``, or no equality."""

    def compare(pair: Pair, rule: Mapping) -> bool:
        sheets = [pair.sheet(rule[k]) for k in ("sheet_idx0", "sheet_idx1")]
        if missing is None and None in sheets:
            return False
        one, two = (missing if s is None else of(s, rule) for s in sheets)
        return one == two

    return compare


def _printed(pair: Pair, rule: Mapping) -> bool:
    one, two = (pair.lines(rule[k]) for k in ("sheet_idx0", "sheet_idx1"))
    if one is None or two is None:
        return False
    low = (lambda x: [y.lower() for y in x]) if rule.get("ignore_case", False) else (lambda x: x)
    return low(one) == low(two)


def _zoomed(pair: Pair, rule: Mapping) -> bool:
    sheet = pair.sheet(rule["sheet_idx"])
    return sheet is not None and fits_rule(sheet.zoom(), rule["method"], rule["ref"])


#: What each type of rule asks of a pair of books.
RULES: dict[str, Callable[[Pair, Mapping], bool]] = {
    "sheet_name": lambda pair, rule: pair.books[1] is not None and pair.books[0].names == pair.books[1].names,
    "sheet_data": _same(lambda s, r: s.table(r.get("precision", 4))),
    "sheet_print": _printed,
    "sheet_fuzzy": _fuzzy,
    "sparkline": _same(lambda s, r: s.sparklines(), {}),
    "chart": _same(lambda s, r: s.charts(r.get("chart_props", ())), {}),
    "style": _same(lambda s, r: s.styles(r.get("props", ())), {}),
    "freeze": _same(lambda s, r: s.freeze()),
    "zoom": _zoomed,
    "data_validation": _validations_fit,
    "row_props": _same(lambda s, r: s.rows_or_columns("row", r.get("props", ())), {}),
    "col_props": _same(lambda s, r: s.rows_or_columns("column", r.get("props", ())), {}),
    "filter": _same(lambda s, r: s.filters(), {}),
    "pivot_table": _same(lambda s, r: s.pivots(r.get("pivot_props", ())), {}),
    "check_cell": _cell_fits,
}


def same_books(result: bytes, expected: bytes | None, rules: Sequence[Mapping], stems: tuple[str, str] = ("", ""), printed: Mapping[str, str] | None = None) -> bool:
    """Whether a book satisfies all rules, of which each has a type of RULES."""
    unknown = [r["type"] for r in rules if r["type"] not in RULES]
    if unknown:
        raise ValueError(f"no such rules: {unknown}")
    pair = Pair(result, expected, stems, printed)
    return all(RULES[r["type"]](pair, r) for r in rules)
