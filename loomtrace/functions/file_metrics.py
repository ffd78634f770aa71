"""Metrics of the evaluator language over files: scores of the bytes that getters landed.

Parsing a document, a deck, a workbook or a picture is beyond built-in expressions, so
each metric is a Pandas function over Arrow batches of bytes; a row needs its own files
only. A file that is missing, or that cannot be read, scores 0.

``FILE_METRICS`` adds these to the namespace that ``plans.expression`` compiles against
(``EVALUATOR``); they carry ``takes_files``, so the compiler hands them landed files.
"""

from __future__ import annotations

import csv
import io
import json
import math
import os.path
import re
import sqlite3
import wave
import zipfile
from collections.abc import Callable, Mapping
from difflib import SequenceMatcher
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomtrace.files import pictures
from loomtrace.files.decks import read_deck, same_decks
from loomtrace.files.documents import Document, odt_backgrounds, paragraphs_of
from loomtrace.files.package import Package, attribute, child, inside, text_of, value
from loomtrace.files.values import fits_rule, records_fit
from loomtrace.files.workbooks import Book, same_books
from loomtrace.functions import images as I
from loomtrace.functions.mail import same_folders
from loomtrace.functions.metrics import METRICS
from loomtrace.functions.text import indel

FILE_METRICS: dict[str, Callable[..., Column]] = {}
#: The functions behind the metrics, on plain values.
PLAIN: dict[str, Callable[..., float]] = {}


def _is_landed(value_) -> bool:
    return not isinstance(value_, Column) and hasattr(value_, "lines_beside")


def _content(value_):
    return value_.content if _is_landed(value_) else value_


def file_metric(*names: str, beside: bool = False):
    """Registers a function of (bytes, bytes or rules, **options).

    With ``beside`` it also gets the stems of the files' names and the texts that came with them.
    """

    def register(function):
        for name in names or (function.__name__,):
            PLAIN[name] = function

            def score(result=None, expected=None, _function=function, **options):
                columns = [_content(x) for x in (result, expected)]
                if beside:
                    stems = tuple(os.path.splitext(x.names[0])[0] if _is_landed(x) else "" for x in (result, expected))
                    columns.append(F.map_concat(*[x.lines_beside for x in (result, expected) if _is_landed(x)]) if _is_landed(result) or _is_landed(expected) else None)
                    options = {**options, "stems": stems}
                return _scored(_function, columns, options)

            score.takes_files = True
            FILE_METRICS[name] = score
        return function

    return register


def _scored(function: Callable[..., float], columns: list, options: Mapping) -> Column:
    """The function over the given columns, with what is no column as it is; null for the first one scores 0."""
    places = [i for i, c in enumerate(columns) if isinstance(c, Column)]
    plain = {i: c for i, c in enumerate(columns) if not isinstance(c, Column)}
    given, n = dict(options), len(columns)

    @F.pandas_udf(DoubleType())
    def run(*series: pd.Series) -> pd.Series:
        return pd.Series([_safely(function, [plain.get(i) if i in plain else row[places.index(i)] for i in range(n)], given) for row in zip(*series, strict=True)], dtype=float)

    return run(*[columns[i] for i in places])


def _safely(function: Callable[..., float], values: list, options: Mapping) -> float:
    values = [_plain(v) for v in values]
    if values[0] is None:
        return 0.0
    try:
        return float(function(*values, **options))
    except Exception:  # a file that cannot be read must not end the batch
        return 0.0


def _plain(value_):
    if isinstance(value_, np.ndarray):
        return [_plain(v) for v in value_]
    return bytes(value_) if isinstance(value_, bytearray | memoryview) else value_


def _lines(data: bytes) -> list[str]:
    return _text(data).splitlines()


def _text(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _squeezed(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


# --- tables -----------------------------------------------------------------------


@file_metric(beside=True)
def compare_table(result, expected, printed=None, rules=(), stems=("", "")):
    return same_books(result, expected, rules, stems, dict(printed or {}))


@file_metric()
def compare_csv(result, expected, strict=True, ignore_case=False):
    """The lines of one of the expected files."""
    form = lambda line: (line if strict else line.strip()).lower() if ignore_case else (line if strict else line.strip())
    own = [form(x) for x in _lines(result)]
    return any(own == [form(x) for x in _lines(e)] for e in (expected if isinstance(expected, list) else [expected]) if e is not None)


@file_metric()
def check_csv(result, rules):
    return records_fit(list(csv.DictReader(io.StringIO(_text(result)))), rules)


@file_metric()
def compare_conference_city_in_order(result, rule):
    """Each of the expected cities, or one of several, occurs in its cell of C2:C22, in order."""
    book = Book(result)
    cells = [book.sheets[book.names[0]].raw(row, 3) for row in range(2, 23)]
    one = lambda wanted, got: any(w in (got or "") for w in ([wanted] if isinstance(wanted, str) else wanted))
    return all(one(w, c) for w, c in zip(rule["expected"], cells, strict=False))


@file_metric()
def run_sqlite3(result, rules):
    """The first value of a query of a database."""
    connection = sqlite3.connect(":memory:")
    connection.deserialize(result)
    return float(connection.execute(rules["sql"]).fetchone()[0] or 0)


# --- text documents -------------------------------------------------------------------


@file_metric()
def compare_docx_files(result, expected, ignore_blanks=True, ignore_case=False, ignore_order=False, content_only=False, fuzzy_match=False, delete_empty_lines=False):
    """Paragraphs under the chosen normal forms; order is dropped before case."""
    if isinstance(expected, list):
        return 0
    low = str.lower if ignore_case else str

    def form(data):
        found = paragraphs_of(data)
        found = sorted(found) if ignore_order else found
        return [p for p in found if p.strip()] if delete_empty_lines else found

    one, two = form(result), form(expected)
    whole = [low(_squeezed("\n".join(x))) for x in (one, two)]
    if content_only or (ignore_blanks and fuzzy_match):
        return indel(*whole)
    if ignore_blanks:
        return whole[0] == whole[1]
    if len(one) != len(two):
        return 0
    if fuzzy_match:
        return sum(indel(low(p), low(q)) for p, q in zip(one, two, strict=True)) / len(one) if one else 1
    return [low(p) for p in one] == [low(p) for p in two]


@file_metric()
def compare_docx_files_and_ignore_new_lines(result, expected, ignore_blanks=True):
    one, two = ([p for p in Document(x).texts if p] for x in (result, expected))
    return _squeezed("\n".join(one)) == _squeezed("\n".join(two)) if ignore_blanks else one == two


@file_metric()
def compare_init_lines(result, expected):
    return all(p == q for p, q in zip(Document(result).texts, Document(expected).texts, strict=False))


@file_metric()
def compare_docx_lines(result, expected):
    lines = lambda x: {p.strip() for p in Document(x).texts if p.strip()}
    return lines(result) == lines(expected)


@file_metric()
def compare_docx_tables(result, expected):
    cells = lambda x: [[["\n".join(p.text for p in c).strip() for c in row] for row in table] for table in Document(x).tables]
    return cells(result) == cells(expected)


@file_metric()
def compare_docx_images(result, expected):
    """As many pictures, of the same samples; those without a decoder by their bytes."""
    one, two = Document(result).images, Document(expected).images
    return len(one) == len(two) and all(_same_samples(a, b) for a, b in zip(one, two, strict=True))


def _same_samples(a: bytes, b: bytes) -> bool:
    if a == b:
        return True
    x, y = pictures.decode(a).samples, pictures.decode(b).samples
    return x.shape == y.shape and bool((x == y).all())


def _same_text(a: bytes, b: bytes) -> bool:
    return bool(compare_docx_files(a, b))


@file_metric()
def compare_line_spacing(result, expected):
    spacing = lambda x: [p.line_spacing for p in Document(x).paragraphs]
    return _same_text(result, expected) and spacing(result) == spacing(expected)


def _run_pairs(a: bytes, b: bytes):
    """Runs at the same places of the same paragraphs, as far as both go."""
    return [(r, s) for p, q in zip(Document(a).paragraphs, Document(b).paragraphs, strict=False) for r, s in zip(p.runs, q.runs, strict=False)]


@file_metric()
def compare_insert_equation(result, expected):
    return _same_text(result, expected) and any(inside(r.root, "object") and inside(s.root, "object") for r, s in _run_pairs(result, expected))


@file_metric()
def compare_contains_image(result, expected):
    return all(bool(inside(r.root, "graphicData")) == bool(inside(s.root, "graphicData")) for r, s in _run_pairs(result, expected))


@file_metric()
def compare_subscript_contains(result, expected):
    return any(r.subscript and s.subscript for r, s in _run_pairs(result, expected))


@file_metric()
def compare_font_names(result, rules):
    return all(r.font == rules["font_name"] for p in Document(result).paragraphs for r in p.runs)


@file_metric()
def has_page_numbers_in_footers(result, _=None):
    return all(any(c.isdigit() for c in text) for text in Document(result).footers)


@file_metric()
def is_first_line_centered(result, _=None):
    return Document(result).paragraphs[0].alignment == "center"


@file_metric()
def check_tabstops(result, expected, word_number_split_by_tabstop=None, index=0):
    """1 less the mean distance of the tab stops of paragraphs, as a share of the text's width."""
    one, two = ([p for p in Document(x).paragraphs if p.text.strip()] for x in (result, expected))
    if len(one) != len(two):
        return 0
    if word_number_split_by_tabstop is not None and any(len(p.text.split("\t")[index].split()) != word_number_split_by_tabstop for p in one):
        return 0
    if any([k for k, _ in p.tabs] != [k for k, _ in q.tabs] for p, q in zip(one, two, strict=True)):
        return 0
    far = sum(abs(s - t) for p, q in zip(one, two, strict=True) for (_, s), (_, t) in zip(p.tabs, q.tabs, strict=True))
    return 1 - far / Document(expected).text_width / len(one)


@file_metric()
def evaluate_colored_words_in_tables(result, expected, threshold=3.5):
    """Words of tables that begin with a vowel are red, the others blue."""
    runs = [r for t in Document(result).tables for row in t for c in row for p in c for r in p.runs if r.text]
    wanted = lambda r: (255, 0, 0) if r.text[0].lower() in "aeiou" else (0, 0, 255)
    return _same_text(result, expected) and all(colour_difference(r.color, wanted(r)) <= threshold for r in runs)


def _lab(rgb) -> tuple[float, float, float]:
    """The CIE L*a*b* values of an sRGB colour under daylight."""
    linear = [c / 12.92 if c <= 0.04045 else ((c + 0.055) / 1.055) ** 2.4 for c in (x / 255 for x in rgb)]
    # The matrix of sRGB and the white of D65.
    xyz = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]) @ linear / (0.95047, 1.0, 1.08883)
    f = [t ** (1 / 3) if t > 0.008856 else 7.787 * t + 16 / 116 for t in xyz]
    return 116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])


def colour_difference(a, b) -> float:
    """The CIEDE2000 difference of two sRGB colours."""
    (l1, a1, b1), (l2, a2, b2) = _lab(a), _lab(b)
    mean = (math.hypot(a1, b1) + math.hypot(a2, b2)) / 2
    g = 0.5 * (1 - math.sqrt(mean**7 / (mean**7 + 25.0**7)))
    a1, a2 = a1 * (1 + g), a2 * (1 + g)
    c1, c2 = math.hypot(a1, b1), math.hypot(a2, b2)
    h1, h2 = (math.degrees(math.atan2(y, x)) % 360 if x or y else 0.0 for x, y in ((a1, b1), (a2, b2)))
    turn = 0.0 if not c1 * c2 else (h2 - h1 + 180) % 360 - 180
    far = 2 * math.sqrt(c1 * c2) * math.sin(math.radians(turn) / 2)
    l_, c_ = (l1 + l2) / 2, (c1 + c2) / 2
    h_ = h1 + h2 if not c1 * c2 else (h1 + turn / 2) % 360
    cos = lambda degrees: math.cos(math.radians(degrees))
    t = 1 - 0.17 * cos(h_ - 30) + 0.24 * cos(2 * h_) + 0.32 * cos(3 * h_ + 6) - 0.20 * cos(4 * h_ - 63)
    sl, sc, sh = 1 + 0.015 * (l_ - 50) ** 2 / math.sqrt(20 + (l_ - 50) ** 2), 1 + 0.045 * c_, 1 + 0.015 * c_ * t
    rt = -math.sin(math.radians(60 * math.exp(-(((h_ - 275) / 25) ** 2)))) * 2 * math.sqrt(c_**7 / (c_**7 + 25.0**7))
    dl, dc, dh = (l2 - l1) / sl, (c2 - c1) / sc, far / sh
    return math.sqrt(dl**2 + dc**2 + dh**2 + rt * dc * dh)


@file_metric()
def check_highlighted_words(result, expected):
    """The same text, and no span on a yellow ground."""
    return _same_text(result, expected) and "#ffff00" not in odt_backgrounds(result)


@file_metric()
def compare_highlighted_text(result, expected):
    marked = lambda x: {text_of(r, "t") for r in inside(Document(x).root, "r") if value(r, "rPr", "highlight") not in (None, "none") and inside(r, "t")}
    return marked(result) == marked(expected)


@file_metric()
def evaluate_strike_through_last_paragraph(result, expected):
    return _same_text(result, expected) and all(r.on("strike") for r in Document(result).paragraphs[-1].runs)


@file_metric()
def evaluate_conversion(result, _=None):
    """No run of text is in capitals."""
    document = Document(result)
    cells = [p for t in document.tables for row in t for c in row for p in c]
    return not any(r.text.isupper() for p in [*cells, *document.paragraphs] for r in p.runs)


@file_metric()
def evaluate_spacing(result, _=None):
    """The first three paragraphs stand at one, two and one and a half lines."""
    return [p.line_spacing for p in Document(result).paragraphs[:3]] == [("lines", 1.0), ("lines", 2.0), ("lines", 1.5)]


@file_metric()
def check_italic_font_size_14(result, expected):
    return _same_text(result, expected) and all(r.points == 14 for p in Document(result).paragraphs for r in p.runs if r.on("i"))


@file_metric()
def evaluate_alignment(result, _=None):
    """In each sentence of three words or more the first three come before the others, with single spaces between."""

    def fits(sentence: str) -> bool:
        words = sentence.split()
        first, rest = " ".join(words[:3]), " ".join(words[3:])
        return len(words) < 3 or (first in sentence and rest in sentence and sentence.find(first) < sentence.find(rest))

    return all(fits(s) for text in Document(result).texts for s in text.split("."))


@file_metric()
def contains_page_break(result, rules=None):
    wanted, there = (rules or {}).get("page_break_count"), Document(result).page_breaks
    return there > 0 and wanted in (None, there)


def _train_ids(texts: list[str]) -> list[str]:
    """The second of four fields between commas of each line that has them."""
    return [parts[1].strip() for parts in (t.split(",") for t in texts) if len(parts) == 4]


@file_metric()
def check_no_duplicates(initial, processed):
    """The processed document has each train of the initial one, once."""
    ids = _train_ids(Document(processed).texts)
    return len(ids) == len(set(ids)) and set(ids) == set(_train_ids(Document(initial).texts))


@file_metric()
def compare_unique_train_records(result, expected):
    """Lines of the initial document (the second expected file), with each train of the golden one (the first) once."""
    if not isinstance(expected, list) or len(expected) < 2 or None in expected[:2]:
        return 0
    lines = lambda x: [t.strip() for t in Document(x).texts if t.strip()]
    own, gold, initial = lines(result), lines(expected[0]), lines(expected[1])
    ids = _train_ids(own)
    return set(own) <= set(initial) and len(ids) == len(set(ids)) and set(ids) == set(_train_ids(gold)) and len(own) == len(gold)


@file_metric()
def compare_references(result, expected, content_only=False, reference_indicator="References", reference_base_result=0.5):
    """The mean likeness of the references of two documents, rescaled from what the untouched file would get."""

    def listed(data):
        texts = Document(data).texts
        return [t for t in texts[texts.index(reference_indicator) + 1 :] if t.strip()] if reference_indicator in texts else None

    one, two = listed(result), listed(expected)
    if one is None or two is None:
        return one is two
    if len(one) != len(two):
        return 0
    mean = sum(map(indel, one, two)) / len(one)
    return (mean - reference_base_result) / (1 - reference_base_result) if mean >= reference_base_result + 0.01 else 0


@file_metric()
def fuzzy_place_math(result, rules):
    """The mean best likeness of the three words of a document to one of the answers."""
    words = [w for t in Document(result).texts for w in t.split()]
    return sum(max(indel(w, a) for a in rules["expected"]) for w in words) / 3 if len(words) == 3 else 0


# --- settings of office programs --------------------------------------------------------


def _registry(data: bytes, path: str, name: str) -> str | None:
    """The last value of a property of an item of a registry file."""
    from xml.etree import ElementTree

    found = None
    for item in inside(ElementTree.fromstring(data), "item"):
        if attribute(item, "path") == path:
            for prop in inside(item, "prop"):
                if attribute(prop, "name") == name:
                    found = next((v.text for v in inside(prop, "value")), found)
    return found


# Where office programs keep a setting.
@file_metric()
def find_default_font(result, rules):
    return _registry(result, "/org.openoffice.Office.Writer/DefaultFont", "Standard") == rules["font_name"]


@file_metric()
def check_presenter_console_disable(result, _=None):
    return (_registry(result, "/org.openoffice.Office.Impress/Misc/Start", "EnablePresenterScreen") or "").lower() == "false"


@file_metric()
def check_auto_saving_time(result, rules):
    return int(_registry(result, "/org.openoffice.Office.Common/Save/Document", "AutoSaveTimeIntervall")) == rules["minutes"]


# --- decks ------------------------------------------------------------------------------


@file_metric()
def compare_pptx_files(result, expected, **options):
    return same_decks(result, expected, **options)


def _slide_size(package: Package) -> tuple[int, int]:
    size = child(package.xml("ppt/presentation.xml"), "sldSz")
    return int(attribute(size, "cx")), int(attribute(size, "cy"))


@file_metric("check_slide_orientation_Portrait")
def is_portrait(result, _=None):
    width, height = _slide_size(Package(result))
    return width < height


def _first_pictures(data: bytes) -> list[tuple[bytes, tuple[int, int, int, int]]]:
    """(bytes, place) of the pictures of the first slide."""
    package, deck = Package(data), read_deck(data)
    part = next(t for k, t in package.relations("ppt/presentation.xml").values() if k == "slide" and t.endswith("slide1.xml"))
    targets = package.relations(part)
    found = [p for p in inside(package.xml(part), "pic") if not inside(child(p, "nvPicPr"), "videoFile", "audioFile")]
    blobs = [package.read(targets[attribute(next(iter(inside(p, "blip"))), "embed")][1]) for p in found]
    return list(zip(blobs, [s.rect for s in deck[0].shapes if s.kind == "picture"], strict=False))


@file_metric()
def check_image_stretch_and_center(result, expected):
    """The first picture of the original fills the slide and is centred, to half an inch."""
    original = _first_pictures(expected)
    place = next((rect for blob, rect in reversed(_first_pictures(result)) if original and blob == original[0][0]), None)
    if place is None:
        return 0
    left, top, width, height = place
    wide, high = _slide_size(Package(expected))
    return max(abs(width - wide), abs(height - high), abs(left - (wide - width) / 2), abs(top - (high - height) / 2)) <= 457_200


@file_metric()
def check_strikethrough(result, rules):
    """The first run of each named paragraph says whether it is struck through."""
    root = [s.root for s in read_deck(result)]
    for slide in rules["slide_index_s"]:
        shapes = [e for e in child(root[slide], "cSld", "spTree") if e.tag.endswith(("}sp", "}pic", "}graphicFrame", "}grpSp", "}cxnSp"))]
        for shape in rules["shape_index_s"]:
            paragraphs = inside(child(shapes[shape], "txBody"), "p")
            for paragraph in rules["paragraph_index_s"]:
                if attribute(child(paragraphs[paragraph], "r", "rPr"), "strike") is None:
                    return 0
    return 1


@file_metric()
def check_slide_numbers_color(result, _=None):
    """The number on the master's slides is red, where a slide shows a number."""
    package = Package(result)
    if not any(s.text is not None and s.text.isdigit() for slide in read_deck(result) for s in slide.shapes):
        return 0
    masters = package.related("ppt/presentation.xml", "slideMaster")
    numbers = [s for m in masters for s in inside(package.xml(m), "sp") if text_of(s, "t") in ("<number>", "‹#›")]
    return bool(numbers) and any(attribute(c, "val", "").upper() == "FF0000" for c in inside(numbers[0], "srgbClr"))


@file_metric()
def check_page_number_colors(result, rules):
    """The last but one solid colour of the first master is the named one."""
    colours = [attribute(c, "val") for f in inside(Package(result).xml("ppt/slideMasters/slideMaster1.xml"), "solidFill") for c in inside(f, "srgbClr")]
    # The first of the six digits was passed over by the rule as if a sign stood before them.
    code = colours[-2]
    r, g, b = (int(code[i : i + 2], 16) for i in (1, 3, 5))
    most = lambda x, *others: all(x > y + 50 for y in others)
    return {"red": most(r, g, b), "blue": most(b, g, r), "green": most(g, r, b), "black": max(r, g, b) < 50}.get(rules["color"], True)


@file_metric()
def check_transition(result, rules):
    """A slide's transition is of the named kind."""
    root = Package(result).xml(f"ppt/slides/slide{rules['slide_idx'] + 1}.xml")
    changes = inside(root, "transition")
    return bool(changes) and bool(inside(changes[0], rules["transition_type"]))


@file_metric()
def evaluate_presentation_fill_to_rgb_distance(result, rules):
    """1 less the mean distance of backgrounds from a colour; those without one, or of the original colour, are farthest."""

    def far(code: str | None) -> float:
        if code is None:
            return 1.0
        rgb = [int(code[i : i + 2], 16) for i in (0, 2, 4)]
        if rules.get("original_rgb") is not None and rgb == list(rules["original_rgb"]):
            return 1.0
        return math.dist(rgb, rules["rgb"]) / math.sqrt(3 * 255**2)

    slides = read_deck(result)
    return 1 - sum(far(s.background) for s in slides) / len(slides)


@file_metric()
def check_left_panel(tree, _=None):
    from xml.etree import ElementTree

    return any(attribute(e, "name") == "Slides View" for e in inside(ElementTree.fromstring(tree), "document-frame"))


# --- pictures -----------------------------------------------------------------------------


@file_metric()
def compare_images(result, expected, reference_base_result=None):
    """The structural similarity of grey pictures at the size of the one that is less wide, rescaled if a base is given."""
    if result is None or expected is None:
        return 0
    one, two = pictures.decode(result), pictures.decode(expected)
    size = min(one.size, two.size)
    like = pictures.similarity(*(pictures.resized(p.grey, size) for p in (one, two)))
    if reference_base_result is None:
        return like
    return (like - reference_base_result) / (1 - reference_base_result) if like >= reference_base_result + 0.01 else 0


@file_metric()
def compare_image_list(result, expected):
    """All pictures have the samples of their counterparts."""
    pairs = list(zip(result, expected, strict=False)) if isinstance(result, list) else [(result, expected)]
    return all(_same_samples(a, b) for a, b in pairs)


def _rgb(data: bytes) -> np.ndarray:
    return pictures.decode(data).rgb


@file_metric("check_structure_sim", "check_file_exists_and_structure_sim")
def check_structure_sim(result, expected):
    return pictures.same_structure(_rgb(result), _rgb(expected))


@file_metric()
def check_structure_sim_resized(result, expected):
    """What is not transparent of the result, at the size of the expected picture."""
    wanted, own = pictures.decode(expected), pictures.decode(result).content()
    return own is not None and pictures.same_structure(pictures.resized(own.rgb, wanted.size), wanted.rgb)


@file_metric()
def check_brightness_decrease_and_structure_sim(result, expected, threshold=0.03):
    """Darker, and alike once both are brought to one brightness."""
    one, two = pictures.decode(result), pictures.decode(expected)
    level = lambda p: float(p.grey.mean())
    brought = [np.minimum(255, np.floor(p.rgb * (128 / level(p)))).astype(np.uint8) for p in (one, two)]
    if one.size != two.size:
        brought[0] = pictures.resized(brought[0], two.size)
    return level(two) > level(one) and I.mean_square_error(*brought) < threshold


@file_metric()
def check_saturation_increase_and_structure_sim(result, expected):
    """More saturated, with alike hues and values."""
    one, two = pictures.decode(result).hsv, pictures.decode(expected).hsv
    same = all(pictures.same_structure(np.repeat(one[:, :, k : k + 1], 3, axis=2), np.repeat(two[:, :, k : k + 1], 3, axis=2)) for k in (0, 2))
    return two[:, :, 1].mean() < one[:, :, 1].mean() and same


@file_metric()
def check_contrast_increase_and_structure_sim(result, expected):
    one, two = pictures.decode(result), pictures.decode(expected)
    return I.contrast(two.samples) < I.contrast(one.samples) and pictures.same_structure(one.rgb, two.rgb, 0.65)


@file_metric()
def check_palette_and_structure_sim(result, expected):
    own = pictures.decode(result)
    return own.palette and pictures.same_structure(own.rgb, _rgb(expected))


@file_metric()
def check_image_mirror(result, expected):
    return pictures.same_structure(_rgb(result)[:, ::-1], _rgb(expected), 0.99)


@file_metric()
def check_green_background(result, expected):
    """The result is green wherever the expected picture is not black."""
    own, wanted = _rgb(result).astype(int), _rgb(expected)
    ground = wanted.any(axis=2)
    return bool(((own[:, :, 1] > own[:, :, 0]) & (own[:, :, 1] > own[:, :, 2]))[ground].all())


@file_metric()
def check_triangle_position(result, _=None):
    """The pixels of the second rarest colour lie around the middle, to a twentieth of the sides."""
    samples = pictures.decode(result).samples
    colours, counts = np.unique(samples.reshape(-1, samples.shape[2]), axis=0, return_counts=True)
    places = np.argwhere((samples == colours[np.argsort(counts)][1]).all(axis=2))
    sides = np.array(samples.shape[:2])
    return bool((np.abs(places.mean(axis=0) - sides / 2) < 0.05 * sides).all())


@file_metric()
def check_textbox_on_leftside(result, _=None):
    """Something dark stands in the first twentieth of the width."""
    dark = np.flatnonzero((pictures.decode(result).grey < 128).any(axis=0))
    return bool(len(dark)) and dark[0] < 0.05 * pictures.decode(result).size[0]


@file_metric()
def check_sharper(result, expected):
    return I.sharpness(pictures.decode(result).grey) > I.sharpness(pictures.decode(expected).grey)


@file_metric()
def increase_saturation(first, second):
    return pictures.decode(first).hsv[:, :, 1].mean() < pictures.decode(second).hsv[:, :, 1].mean()


@file_metric()
def decrease_brightness(first, second):
    return pictures.decode(first).grey.mean() > pictures.decode(second).grey.mean()


@file_metric()
def check_image_size(result, rule):
    """The sides, of what is not transparent if the rule says so."""
    own = pictures.decode(result)
    own = own.content() if rule.get("ignore_transparent", False) else own
    width, height = (0, 0) if own is None else own.size
    return rule.get("height") in (None, height) and rule.get("width") in (None, width)


@file_metric()
def check_image_file_size(result, rule):
    return len(result) < rule["max_size"]


# --- PDF, archives, books, sounds ------------------------------------------------------------


def _pdf_streams(data: bytes):
    """(dictionary, bytes) of the streams of a PDF file that are plain or deflated."""
    import zlib

    for m in re.finditer(rb"<<((?:[^<>]|<[^<]|>[^>]|<<.*?>>)*)>>\s*stream\r?\n", data, re.S):
        end = data.find(b"endstream", m.end())
        body = data[m.end() : end]
        if b"/FlateDecode" in m[1]:
            try:
                body = zlib.decompressobj().decompress(body)
            except zlib.error:
                continue
        yield m[1], body


_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def pdf_text(data: bytes) -> str:
    """The texts that the page contents of a PDF file show, of fonts whose codes are characters."""
    if not data.startswith(b"%PDF"):
        raise ValueError("not a PDF file")
    lines = []
    for about, body in _pdf_streams(data):
        if b"/Subtype" in about or b"/Type" in about or b"BT" not in body:
            continue
        for block in re.findall(r"BT(.*?)ET", body.decode("latin-1"), re.S):
            line = []
            for m in re.finditer(r"\(((?:\\.|[^\\()])*)\)|<([0-9A-Fa-f\s]+)>|(T\*|\bT[dDm]\b)", block, re.S):
                if m[3] and line and line[-1] != "\n":
                    line.append("\n")
                elif m[2] is not None:
                    line.append(bytes.fromhex(re.sub(r"\s", "", m[2]).ljust(2, "0")[: len(re.sub(r"\s", "", m[2])) // 2 * 2]).decode("latin-1"))
                elif m[1] is not None:
                    line.append(re.sub(r"\\([0-7]{1,3}|.)", lambda e: chr(int(e[1], 8)) if e[1][0] in "01234567" else _ESCAPES.get(e[1], e[1]), m[1], flags=re.S))
            lines.append("".join(line))
    return "\n".join(lines).strip()


@file_metric()
def compare_pdfs(result, expected):
    """The likeness of the texts of PDF files, the mean of several."""
    pairs = list(zip(result, expected, strict=False)) if isinstance(expected, list) else [(result, expected)]
    return sum(_safely(lambda a, b: indel(pdf_text(a), pdf_text(b)), [a, b], {}) for a, b in pairs) / len(pairs)


@file_metric()
def is_gold_text_included_in_pdf(result, expected):
    """The PDF's text has each key and value of the golden JSON object."""
    text = pdf_text(result)
    return all(str(k) in text and str(v) in text for k, v in json.loads(_text(expected)).items())


@file_metric()
def compare_pdf_content(result, expected, text_similarity_threshold=0.7):
    return indel(pdf_text(result), pdf_text(expected)) >= text_similarity_threshold


@file_metric()
def compare_pdf_images(result, expected):
    """The share of raw pictures of two PDF files that have near hashes; as many on both sides."""

    def shown(data):
        found = []
        for about, body in _pdf_streams(data):
            sides = [re.search(rb"/%s\s+(\d+)" % k, about) for k in (b"Width", b"Height")]
            if b"/Image" in about and all(sides):
                width, height = (int(s[1]) for s in sides)
                found.append(np.frombuffer(body[: width * height * (len(body) // (width * height))], np.uint8).reshape(height, width, -1))
        return found

    one, two = shown(result), shown(expected)
    if len(one) != len(two):
        return 0
    near = lambda a, b: (I.perceptual_hash(a.mean(axis=2)) ^ I.perceptual_hash(b.mean(axis=2))) & (2**64 - 1)
    return sum(near(a, b).bit_count() <= 5 for a, b in zip(one, two, strict=True)) / len(one) if one else 1


@file_metric()
def check_pdf_pages(result, rules):
    pages = len(re.findall(rb"/Type\s*/Page(?![A-Za-z])", b"".join([result, *(b for _, b in _pdf_streams(result))])))
    return fits_rule(pages, rules["relation"], rules["ref_value"])


def _members(data: bytes) -> dict[str, bytes]:
    from loomtrace.sources.files import archive_members

    return {name: content for name, _, content in archive_members(data)}


def _line_ratio(a: bytes, b: bytes) -> float:
    return SequenceMatcher(None, _lines(a), _lines(b)).ratio()


#: What compares the members of archives, by their type.
MEMBER_METRICS = {"text": "compare_text_file", "pdf": "compare_pdfs", "docx": "compare_docx_files", "ppt": "compare_pptx_files", "image": "compare_images", "csv": "compare_csv", "table": "compare_table", "audio": "compare_audios", "video": "compare_videos"}


@file_metric()
def compare_text_file(result, expected, ignore_blanks=False, ignore_case=False):
    one, two = _text(result), _text(expected)
    if ignore_blanks:
        one, two = (re.sub(r"\s+", " ", re.sub(r"[\t\n]", " ", x).strip()) for x in (one, two))
    return one.lower() == two.lower() if ignore_case else one == two


@file_metric()
def compare_archive(result, expected, file_path="", file_type="text", **options):
    """The mean score of the files of a folder of two archives, which must have the same names."""
    folder = lambda data: {n[len(file_path) :].lstrip("/"): c for n, c in _members(data).items() if n.startswith(file_path) and "/" not in n[len(file_path) :].lstrip("/")}
    one, two = folder(result), folder(expected)
    if sorted(one) != sorted(two):
        return 0
    compare = PLAIN[MEMBER_METRICS[file_type]]
    return sum(_safely(compare, [one[n], two[n]], options) for n in one) / len(one)


@file_metric()
def compare_zip_files(result, expected):
    """Two ZIP archives with the same files."""
    return _members(result) == _members(expected)


class _Spelling(HTMLParser):
    """A page with one tag to a line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.lines.append(f"<{tag} {sorted((k, v or '') for k, v in attrs)}>")

    def handle_endtag(self, tag):
        self.lines.append(f"</{tag}>")

    def handle_data(self, data):
        if data.strip():
            self.lines.append(data)


def _book_parts(data: bytes) -> list[list[str]]:
    """The lines of a book's table of contents, its package and its pages, by name; numbers of reading order and identifiers do not count."""
    found = {}
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        for name in book.namelist():
            if name in ("toc.ncx", "content.opf"):
                found[name] = [x for x in _lines(book.read(name)) if {"toc.ncx": "navPoint", "content.opf": "dc:identifier"}[name] not in x]
            elif name.endswith(".html"):
                page = _Spelling()
                page.feed(re.sub(r"[\r\n]", "", _text(book.read(name))))
                found[name] = page.lines
    return [found[n] for n in sorted(found)]


@file_metric()
def compare_epub(result, expected):
    """The mean likeness of the parts of two books, line by line."""
    one, two = _book_parts(result), _book_parts(expected)
    return sum(SequenceMatcher(None, a, b).ratio() for a, b in zip(one, two, strict=False)) / len(one) if one else 0


@file_metric()
def compare_htmls(result, expected, ignore_sdnum=False):
    """Pages of the same elements with the same attributes and texts, as far as both go."""
    from loomtrace.sources.files import page_nodes

    bare = lambda attributes: {k: v for k, v in attributes.items() if not (ignore_sdnum and k == "sdnum")}
    nodes = lambda data: [(tag, text, bare(attributes)) for _, _, tag, text, attributes in page_nodes(data)]
    return all(a == b for a, b in zip(nodes(result), nodes(expected), strict=False))


@file_metric()
def check_html_background_image(result, rule):
    """The body's inline style, or its first style sheet, names the picture as the background."""
    from loomtrace.sources.files import page_nodes

    nodes = list(page_nodes(result))
    styles = [text for _, _, tag, text, _ in nodes if tag == "style"] + [a.get("style", "") for _, _, tag, _, a in nodes if tag == "body"]
    return any(f"url('{rule['value']}')" in s for s in styles)


# Names of tags for the frames of sound files.
_TAGS = {"TIT2": "title", "TPE1": "artist", "TPE2": "albumartist", "TALB": "album", "TCON": "genre", "TRCK": "tracknumber", "TDRC": "date", "TYER": "date", "TCOM": "composer", "TPOS": "discnumber", "TCOP": "copyright", "TBPM": "bpm"}


def sound_tags(data: bytes) -> dict[str, str]:
    """The text frames of the tag at the beginning of an MP3 file."""
    if data[:3] != b"ID3":
        return {}
    whole = lambda b: sum(x << 7 * (len(b) - 1 - i) for i, x in enumerate(b))
    version, end, at, found = data[3], 10 + whole(data[6:10]), 10, {}
    wide = 3 if version == 2 else 4
    while at + 10 <= end and data[at : at + 1].strip(b"\0"):
        name = data[at : at + 4].decode("latin-1")
        size = whole(data[at + 4 : at + 8]) if version == 4 else int.from_bytes(data[at + 4 : at + 4 + wide], "big")
        body = data[at + 10 : at + 10 + size]
        if name in _TAGS and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}[body[0]], "replace")
            found[_TAGS[name]] = ",".join(x for x in text.split("\0") if x)
        at += 10 + size
    return found


@file_metric()
def check_mp3_meta(result, meta):
    tags = sound_tags(result)
    return all(fits_rule(tags.get(k, ""), r["method"], r["ref"]) for k, r in meta.items())


@file_metric()
def compare_audios(result, expected):
    """1 for the same bytes; of WAV sounds the likeness of their spectra along the best alignment; others need a decoder."""
    if result == expected:
        return 1

    def spectra(data):
        with wave.open(io.BytesIO(data)) as sound:
            samples = np.frombuffer(sound.readframes(sound.getnframes()), {1: np.uint8, 2: np.int16, 4: np.int32}[sound.getsampwidth()])
            mono = samples.reshape(-1, sound.getnchannels()).mean(axis=1)
        frames = np.lib.stride_tricks.sliding_window_view(mono, 2048)[::2048][:400]
        power = np.abs(np.fft.rfft(frames * np.hanning(2048), axis=1))
        bands = np.linspace(0, power.shape[1], 21).astype(int)
        return np.log1p(np.add.reduceat(power, bands[:-1], axis=1))

    cost, steps = I.warped_distance(spectra(result), spectra(expected))
    return max(0.0, 1 - cost / steps)


@file_metric("compare_videos", "compare_audios_by_dl_model")
def same_recording(result, expected, max_frames_to_check=100, threshold=5):
    """The same bytes; frames need a decoder."""
    return result == expected


# --- mail, data files, programs --------------------------------------------------------------


_PREFERENCE = re.compile(r'^user_pref\("(?P<key>(?:[^"]|\\")+)", (?P<value>.+)\);$')


@file_metric()
def check_thunderbird_prefs(result, rules):
    """Of the lines of a key the last counts where it is expected; no line of an unexpected one may fit."""
    last, found = {}, []
    for line in _lines(result):
        m = _PREFERENCE.match(line.strip())
        if m:
            last[m["key"]] = json.loads(m["value"])
            found.append((m["key"], last[m["key"]]))
    expect, unexpect = rules.get("expect", {}), rules.get("unexpect", {})
    fits = lambda v, r: fits_rule(v, r["method"], r["ref"]) if not r["method"].startswith("re") or isinstance(v, str) else False
    return all(k in last and fits(last[k], r) for k, r in expect.items()) and not any(k in unexpect and k not in expect and fits(v, unexpect[k]) for k, v in found)


_CONDITION = re.compile(r"""\b(?:AND|OR) \([\w ]+,[\w ']+,(?:"(?:[^"]|\\")+"|[^)]+)\)|\bALL\b""")


@file_metric()
def check_thunderbird_filter(result, rules):
    filters: list[dict] = []
    for line in _lines(result):
        key, _, rest = line.partition("=")
        text = rest[1:-1].replace('\\"', '"').replace("\\\\", "\\")
        if key == "name":
            filters.append({"name": text})
        elif key in ("enabled", "type", "action", "actionValue") and filters:
            filters[-1][key] = text
        elif key == "condition" and filters:
            filters[-1][key] = _CONDITION.findall(text)
    return records_fit([f for f in filters if "condition" in f], rules)


def check_thunderbird_folder(result=None, expected=None, **options):
    """1.0 if each mail folder holds the messages of the one expected; files of several names are compared in turn."""
    one, two = _content(result), _content(expected)
    if not any(_is_landed(x) and len(x.names) > 1 for x in (result, expected)):
        return same_folders(one, two, **options)
    pairs = F.transform(F.arrays_zip(one.alias("a"), two.alias("b")), lambda x: same_folders(x["a"], x["b"], **options))
    return F.coalesce(F.array_min(pairs), F.lit(0.0))


check_thunderbird_folder.takes_files = True
FILE_METRICS["check_thunderbird_folder"] = check_thunderbird_folder


@file_metric()
def check_json(result, rules, is_yaml=False):
    """Expected paths hold a value that fits, and unexpected ones none that does."""
    data = yaml.safe_load(_text(result)) if is_yaml else json.loads(_text(result))

    def at(path):
        now = data
        for key in path:
            try:
                now = now[int(key)] if isinstance(now, list) and str(key).isdigit() else now[key]
            except (KeyError, IndexError, TypeError):
                return False, None
        return True, now

    fits = lambda r: (lambda there, v: there and fits_rule(v, r["method"], r["ref"]))(*at(r["key"]))
    return all(fits(r) for r in rules.get("expect", ())) and not any(fits(r) for r in rules.get("unexpect", ()))


@file_metric("check_json_settings")
def check_json_settings(result, rules):
    """Every expected entry is in the JSON object."""
    data = json.loads(_text(result))
    return all(k in data and data[k] == v for k, v in rules["expected"].items())


@file_metric("check_json_keybindings")
def check_json_keybindings(result, rules):
    """The expected binding is one of the JSON array; a first comment line is passed over."""
    text = _text(result)
    for body in (text, text.partition("\n")[2]):
        try:
            return rules["expected"] in json.loads(body)
        except json.JSONDecodeError:
            continue
    return 0


@file_metric()
def is_included_all_json_objects(expected, result):
    one, two = json.loads(_text(expected)), json.loads(_text(result))
    return all(k in two and two[k] == v for k, v in one.items())


# What these metrics would need, by name.
UNABLE = {
    "check_python_file_by_test_suite": "running a test module of a task is left out",
    "check_python_file_by_gold_file": "the language defines no score for it",
    "compare_image_text": "there is no text recognition",
    "extract_answers_from_pdf": "it gives no score",
}


def _unable(name: str, reason: str):
    def refuse(*args, **options):
        raise ValueError(reason)

    refuse.takes_files = True
    FILE_METRICS[name] = refuse


for _name, _reason in UNABLE.items():
    _unable(_name, _reason)

#: Metrics by the names that evaluators call; those over files come before those over columns of the same name.
EVALUATOR: dict[str, Callable[..., Column]] = {**METRICS, **FILE_METRICS}
