"""Named metrics of the evaluator language, as functions that build Columns.

A metric takes what a getter landed (a Column: text, array, map or number) and rules
(plain values), and gives a score from 0 to 1. Null counts as a failed getter: 0.
``METRICS`` is the namespace that ``plans.expression`` compiles against. Metrics over
documents, sheets, slides and pages are aggregates over long rows and are composed
from ``operators.compare``; the ones here need only one row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtrace.functions import rules as R
from loomtrace.functions import text as T
from loomtrace.functions import urls as U

METRICS: dict[str, Callable[..., Column]] = {"infeasible": lambda *a, **k: F.lit(0.0)}


def metric(*names: str):
    def register(function):
        for name in names or (function.__name__,):
            METRICS[name] = function
        return function

    return register


def score(test: Column) -> Column:
    """1.0, or 0.0 for false and null."""
    return F.when(F.coalesce(test, F.lit(False)), 1.0).otherwise(0.0)


def _array(values: Sequence) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _as_array(value: Column | Sequence) -> Column:
    return value if isinstance(value, Column) else _array(value)


# --- values and lists -----------------------------------------------------------


@metric()
def check_include_exclude(result, rules):
    return R.includes(result, rules.get("include", ()), rules.get("exclude", ()))


@metric("exact_match")
def exact_match(result, rules):
    return result.eqNullSafe(F.lit(rules["expected"])).cast("double")


@metric()
def match_in_list(result, rules):
    wanted = rules["expected"]
    return score(F.lit(wanted).contains(result) if isinstance(wanted, str) else result.isin(*wanted))


@metric()
def is_in_list(result, rules):
    return score(F.array_contains(result, rules["expected"]))


@metric()
def literal_match(result, expected, type="str", ignore_case=False):  # noqa: A002  (the language's option)
    low = F.lower if ignore_case else (lambda x: x)
    if type == "str":
        return score(low(result.cast("string")) == low(expected if isinstance(expected, Column) else F.lit(str(expected))))
    if type == "list":  # landed lists are JSON text
        wanted = F.from_json(expected, "array<string>") if isinstance(expected, Column) else _array(list(map(str, expected)))
        own = F.from_json(result, "array<string>") if isinstance(expected, Column) else F.transform(result, lambda x: x.cast("string"))
        return score(F.transform(own, low) == F.transform(wanted, low))
    raise ValueError(f"no literal of type {type}")


@metric()
def fuzzy_match(result, rules):
    return F.coalesce(T.indel_ratio(result, F.lit(rules["expected"])), F.lit(0.0))


@metric("diff_text_file")
def diff_text_file(result, expected):
    return F.coalesce(T.line_ratio(result, expected), F.lit(0.0))


@metric("compare_answer", "compare_config")
def same(result, expected):
    """Equal texts; rules name the expected one as ``expected``."""
    return score(result == (expected["expected"] if isinstance(expected, Mapping) else expected))


@metric()
def compare_terminal_and_txt(text, output):
    """Equal texts, none of them empty."""
    return score((text == output) & (text != ""))


@metric()
def compare_text_file(result, expected, ignore_blanks=False, ignore_case=False):
    return F.when(result.isNull() | expected.isNull(), 0.0).otherwise(T.same_text(result, expected, ignore_blanks, ignore_case))


@metric("file_contains")
def file_contains(text, config):
    return R.includes(text, config["expected"])


@metric("is_extension_installed")
def is_extension_installed(text, rules):
    found = text.contains(rules["expected"])
    return score(found if rules["type"] == "contain" else ~found)


@metric("is_added_to_steam_cart")
def all_items(page, rule):
    return R.includes(page, rule["items"])


@metric("check_line_number")
def check_line_number(text, rules):
    """Lines with a time of day, hh:mm:ss, are as many as expected."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)"))
    return score(F.size(lines) == int(rules["expected"]))


@metric("check_list")
def check_list(text, rules):
    """Each expected pattern is found in some line and no unexpected one in any."""
    lines = F.split(text, "\n")
    some = lambda p: F.exists(lines, lambda x: x.rlike(R.java_pattern(p)))
    test = F.lit(True)
    for p in rules.get("expect", ()):
        test = test & some(p)
    for p in rules.get("unexpect", ()):
        test = test & ~some(p)
    return score(text.isNotNull() & test)


@metric("compare_python_pure_text")
def compare_python_pure_text(result, expected):
    """Scripts without a first line for the shell, codings in the first three, blank lines and trailing blanks."""
    def plain(text):
        lines = F.split(text, "\n")
        kept = F.filter(lines, lambda x, i: ~(((i == 0) & x.startswith("#!")) | ((i < 3) & x.rlike(r"^#.*coding[:=]"))))
        return F.array_join(F.filter(F.transform(kept, lambda x: F.regexp_replace(F.replace(x, F.lit("\t"), F.lit("    ")), r"\s+$", "")), lambda x: x != ""), "\n")

    return score(plain(result) == plain(expected))


@metric("compare_result_files")
def compare_result_files(result, expected):
    """The expected text is in the result if it is a number; else both are equal, trimmed."""
    a, b = T.stripped(result), T.stripped(expected)
    return score(F.when(b.try_cast("double").isNotNull(), a.contains(b)).otherwise(a == b))


# --- JSON -------------------------------------------------------------------------


@metric("check_json")
def check_json(text, rules):
    """Expected paths hold a value that fits; unexpected ones hold none that does."""
    test = text.isNotNull()
    for r in rules.get("expect", ()):
        found = R.json_at(text, r["key"])
        test = test & found.isNotNull() & R.rule(found, r["method"], r["ref"])
    for r in rules.get("unexpect", ()):
        found = R.json_at(text, r["key"])
        test = test & ~(found.isNotNull() & R.rule(found, r["method"], r["ref"]))
    return score(test)


@metric("check_json_settings", "is_included_all_json_objects")
def check_json_settings(text, rules):
    """Every expected entry is in the JSON object."""
    wanted = rules["expected"] if isinstance(rules, Mapping) else rules
    wanted = wanted if isinstance(wanted, Column) else F.create_map(*[F.lit(str(x)) for kv in wanted.items() for x in kv])
    return score(R.subset(wanted, F.from_json(text, "map<string,string>")))


FAILED = "__EVALUATION_FAILED__"


@metric("check_direct_json_object")
def check_direct_json_object(result, rules):
    """The expected fields are equal in the JSON object, or with ``expect_in_result`` occur in it.

    Single quotes of the result count as double ones. Fields are compared as JSON values;
    an absent one equals null only. An option ``ignore_list_order`` among the expected
    fields, or of the rules, compares sorted lists. An expected value that is the mark of
    a failed evaluation scores 0. Landed rules, a Column, are JSON text.
    """
    body = T.stripped(F.replace(result, F.lit("'"), F.lit('"')))
    if isinstance(rules, Column):
        expected, fields = (F.from_json(x, "map<string,string>") for x in (F.get_json_object(rules, "$.expected"), body))
        hit = F.forall(F.map_entries(expected), lambda e: (e["value"] != FAILED) & F.try_element_at(fields, e["key"]).eqNullSafe(e["value"]))
        return score(F.try_parse_json(body).isNotNull() & hit)
    expected = rules.get("expected", {})
    if FAILED in [v for v in expected.values() if isinstance(v, str)]:
        return F.lit(0.0)
    inside, unordered = rules.get("expect_in_result", False), rules.get("ignore_list_order", expected.get("ignore_list_order", False))
    test = F.try_parse_json(body).isNotNull()
    for key, wanted in expected.items():
        raw = _member(body, key)
        if inside:  # one of several values, or a part of a text or a member of a list
            items, text = F.from_json(raw, "array<string>"), F.when(~raw.startswith("["), F.get_json_object(body, f"$['{key}']"))
            found = lambda x, alone: F.coalesce(F.array_contains(items, x), F.lit(False)) | F.coalesce(alone, F.lit(False))  # noqa: E731, B023
            one = wanted if isinstance(wanted, Column) else str(wanted)
            hits = [found(x, text == x) for x in wanted] if isinstance(wanted, list) else [found(one, text.contains(one))]
            test = test & reduce(or_, hits, F.lit(False))
        elif unordered and isinstance(wanted, list):
            own = F.array_sort(F.transform(F.from_json(raw, "array<string>"), T.stripped))
            test = test & F.coalesce(own == F.array_sort(_array([x if isinstance(x, str) else _json(x) for x in wanted])), F.lit(False))
        else:
            test = test & _json_form(F.coalesce(raw, F.lit("null"))).eqNullSafe(_json_form(_column_json(wanted)))
    return score(test)


def _json(value) -> str:
    import json

    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _column_json(value) -> Column:
    """The JSON text of a plain value, of a Column of text or of a list with such Columns."""
    if isinstance(value, Column):
        return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")
    if isinstance(value, list) and any(isinstance(x, Column) for x in value):
        return F.to_json(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in value]))
    return F.lit(_json(value))


def _json_form(text: Column) -> Column:
    """JSON text in one spelling."""
    return F.to_json(F.try_parse_json(text))


def _member(body: Column, key: str) -> Column:
    """The field of a JSON object, as JSON text; null if it is absent."""
    fields = F.from_json(F.to_json(F.try_parse_json(body)), "map<string,variant>")
    return F.to_json(F.try_element_at(fields, F.lit(key)))


@metric("check_json_keybindings")
def check_json_keybindings(text, rules):
    """The expected binding is one of the JSON array; a first comment line is passed over."""
    wanted = F.create_map(*[F.lit(str(x)) for kv in rules["expected"].items() for x in kv])
    body = F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.regexp_replace(text, r"^[^\n]*\n", ""))
    return score(F.exists(F.from_json(body, "array<map<string,string>>"), lambda x: R.subset(wanted, x) & R.subset(x, wanted)))


# --- browser ------------------------------------------------------------------------


@metric("is_expected_active_tab", "compare_urls")
def is_expected_active_tab(url, rule):
    wanted = rule["url"] if isinstance(rule, Mapping) else rule
    return score(U.compare_form(url) == U.compare_form(F.lit(wanted)))


@metric("is_expected_active_tab_approximate")
def is_expected_active_tab_approximate(url, rule):
    return score(U.without_query(url) == U.without_query(F.lit(rule["url"])))


@metric("is_expected_url_pattern_match")
def is_expected_url_pattern_match(url, rules):
    test = url.isNotNull()
    for p in rules["expected"]:
        test = test & url.rlike(R.java_pattern(p))
    return score(test)


@metric("is_expected_search_query")
def is_expected_search_query(url, rules):
    return score(url.rlike(R.java_pattern(rules["expect"]["pattern"])))


@metric("is_expected_installed_extensions")
def is_expected_installed_extensions(installed, rules):
    return score(F.size(F.array_except(_array(rules["expected"]), installed)) == 0)


@metric("is_expected_tabs")
def is_expected_tabs(urls, rule):
    wanted = F.transform(_array(rule["urls"]), lambda x: U.compare_form(x))
    have = F.transform(urls, lambda x: U.compare_form(x))
    return score((F.size(have) == F.size(wanted)) & F.forall(have, lambda x: F.array_contains(wanted, x)))


@metric("is_expected_bookmarks")
def is_expected_bookmarks(roots, rule):
    """Names of folders or urls on the bookmark bar, or urls in its folder of liked authors, of the JSON text of bookmarks.

    Of liked authors' urls each place of the rule may have several spellings, one of which counts.
    """
    item = "struct<name:string,type:string,url:string"
    bar = F.from_json(F.get_json_object(roots, "$.bookmark_bar.children"), f"array<{item},children:array<{item}>>>>")
    of = lambda items, kind, field: F.transform(F.filter(items, lambda x: x["type"] == kind), lambda x: x[field])
    same = lambda a, b: F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(_array(b)))
    if rule["type"] == "bookmark_bar_folders_names":
        return score(same(of(bar, "folder", "name"), rule["names"]))
    if rule["type"] == "bookmark_bar_websites_urls":
        return score(same(of(bar, "url", "url"), rule["urls"]))
    if rule["type"] == "liked_authors_websites_urls":
        folder = F.get(F.filter(bar, lambda x: (x["type"] == "folder") & (x["name"] == "Liked Authors")), F.lit(0))
        urls = of(folder["children"], "url", "url")
        choices = [[u] if isinstance(u, str) else list(u) for u in rule["urls"]]
        each = [F.arrays_overlap(urls, _array(c)) for c in choices]
        known = F.forall(urls, lambda u: F.array_contains(_array([u for c in choices for u in c]), u))
        # One spelling of each place, and no two of one place.
        lone = [F.size(F.array_intersect(urls, _array(c))) == 1 for c in choices]
        return score(reduce(lambda a, b: a & b, [*each, *lone], known))
    raise TypeError(f"no bookmarks of type {rule['type']}")


@metric("is_cookie_deleted")
def is_cookie_deleted(domains, rule):
    bare = lambda x: F.regexp_replace(F.lower(x), r"^\.?(www\.)?", "")
    return score(~F.arrays_overlap(F.transform(domains, bare), F.transform(_array(rule["domains"]), bare)))


@metric("check_history_deleted")
def check_history_deleted(urls, rule):
    return score(~F.exists(_array(rule["keywords"]), lambda k: F.exists(urls, lambda u: u.contains(k))))


@metric("is_shortcut_on_desktop")
def is_shortcut_on_desktop(files, rule):
    """Some desktop file of the map has a line with the name, or with the command."""
    key = "Name" if "name" in rule else "Exec"
    return score(F.exists(F.map_values(files), lambda c: c.contains(f"{key}={rule.get('name', rule.get('exec'))}\n")))


@metric("check_enabled_experiments")
def check_enabled_experiments(experiments, rule):
    return score(F.transform(experiments, lambda x: F.substring_index(x, "@", 1)) == _array(rule["names"]))


@metric("check_font_size")
def check_font_size(sizes, rule):
    """The default size of a struct of font sizes, or a single size."""
    value = sizes["default_font_size"].cast("string").try_cast("double")
    return score((value > rule["min"]) & (value < rule["max"]) if rule["type"] == "range" else value == rule["value"])


# --- system and players ----------------------------------------------------------------


@metric("check_gnome_favorite_apps")
def check_gnome_favorite_apps(apps, rule):
    have = F.from_json(F.translate(apps, "'", '"'), "array<string>")
    wanted = _array(rule["expected"])
    return score((F.size(have) == F.size(wanted)) & (F.array_sort(F.array_distinct(have)) == F.array_sort(F.array_distinct(wanted))))


@metric("check_moved_jpgs")
def check_moved_jpgs(names, rule):
    wanted = _array(rule["expected"])
    return score((F.size(names) == F.size(wanted)) & (F.array_sort(F.array_distinct(names)) == F.array_sort(F.array_distinct(wanted))))


@metric("is_utc_0")
def is_utc_0(output):
    return score(F.get(F.split(output, "\n"), F.lit(3)).endswith("+0000)"))


@metric("check_text_enlarged")
def check_text_enlarged(factor):
    return score(factor.try_cast("double") > 1.0)


@metric("is_in_vm_clickboard")
def is_in_vm_clickboard(config, output):
    wanted = config["expected"]
    return R.includes(output, [wanted] if isinstance(wanted, str) else wanted)


@metric("is_vlc_playing")
def is_vlc_playing(xml, rule):
    """The status says playing, and the first place that names the file, or the one of the url, fits."""
    at = lambda name: F.nullif(F.xpath_string(xml, F.lit(f"/root/information/category[@name='meta']/info[@name='{name}']")), F.lit(""))
    playing = F.xpath_string(xml, F.lit("/root/state")) == "playing"
    if rule["type"] == "file_name":
        return score(playing & F.coalesce(*map(at, ("filename", "title", "uri", "location", "name"))).endswith(rule["file_name"]))
    if rule["type"] == "url":
        return score(playing & F.coalesce(*map(at, ("url", "uri", "location", "title", "filename"))).contains(rule["url"]))
    raise TypeError(f"no playing state of type {rule['type']}")


@metric("is_vlc_fullscreen")
def is_vlc_fullscreen(window, screen):
    return score((window["width"] == screen["width"]) & (window["height"] == screen["height"]))


def _setting(name: str, key: str, default: str, of: str):
    def check(text, rule):
        return score(T.last_setting(text, key, default) == str(rule[of]))

    METRICS[name] = check


for _name, _key, _default, _of in (
    ("is_vlc_recordings_folder", "input-record-path", "", "recording_file_path"), ("check_qt_bgcone", "qt-bgcone", "1", "expected_qt_bgcone"), ("check_qt_max_volume", "qt-max-volume", "125", "expected_qt_max_volume"),
    ("check_qt_minimal_view", "qt-minimal-view", "0", "expected_qt_minimal_view"), ("check_one_instance_when_started_from_file", "one-instance-when-started-from-file", "1", "expected_one_instance_when_started_from_file"),
):
    _setting(_name, _key, _default, _of)


@metric("check_global_key_play_pause")
def check_global_key_play_pause(text, rule):
    value = T.last_setting(text, "global-key-play-pause", None)
    return score(F.when(F.coalesce(value, F.lit("")) == "", "0").otherwise("1") == str(rule["expected_global_key_play_pause"]))


@metric("check_qt_slider_colours")
def check_qt_slider_colours(text, rule):
    value = T.last_setting(text, "qt-slider-colours", "153;210;153;20;210;20;255;199;15;245;39;29")
    if rule["type"] == "match":
        return score(value == rule["expected_qt_slider_colours"])
    return score(F.forall(F.split(value, ";"), lambda x: x.try_cast("int") < 100))


@metric("check_config_status")
def check_config_status(text, rule):
    """Some line of s-expressions begins with the key and ends with the value."""
    tokens = F.transform(F.split(text, "\n"), lambda x: F.split(F.trim(F.translate(x, "()", "")), r"\s+"))
    return score(F.exists(tokens, lambda t: (t[0] == rule["key"]) & (F.element_at(t, -1) == str(rule["value"]))))


@metric("check_image_file_size")
def check_image_file_size(size, rule):
    return score(size < rule["max_size"])


@metric("check_image_size")
def check_image_size(image, rule):
    test = F.lit(True)
    for side in ("width", "height"):
        if rule.get(side) is not None:
            test = test & (image[side] == rule[side])
    return score(test)


@metric("check_file_exists")
def check_file_exists(path_in_listing):
    return score(path_in_listing.isNotNull())


@metric("check_libre_locale")
def check_libre_locale(locale, rules):
    import fnmatch

    return score(F.exists(_array([fnmatch.translate(p).replace(r"\Z", r"\z") for p in rules["locale_set"]]), lambda p: F.regexp(locale, p)))


@metric("find_default_font", "check_presenter_console_disable")
def registry_value(xml, rules):
    """The value of one item of a registry file."""
    return score(F.xpath_string(xml, F.lit(rules["xpath"])) == str(rules["expected"]))


def css_path(selector: str) -> str:
    """A selector of tags, attributes with values, descendants and children as an XPath."""
    steps, path = re.findall(r"(>?)\s*((?:[\w*|-]+)?(?:\[[^\]]*\])*)\s*", selector.strip()), ""
    for direct, step in steps:
        if not step:
            continue
        tag = re.match(r"[\w*|-]*", step)[0].rsplit("|", 1)[-1]
        tests = "".join(f"[@*[name()='{name.replace('|', ':')}']='{value}']" if value else f"[@*[name()='{name.replace('|', ':')}']]" for name, value in re.findall(r"""\[\s*([\w|-]+)\s*(?:=\s*["']?([^"'\]]*)["']?)?\s*\]""", step))
        path += ("/" if direct else "//") + (tag if tag not in ("", "*") else "*") + tests
    return path


@metric("check_accessibility_tree")
def check_accessibility_tree(xml, rules):
    """The product over rules of the best text score among the elements that an XPath, or one of several selectors, gives.

    A text counts as equal, or with ``exact`` off by its likeness. Without an element the score is 0.
    """
    value = F.lit(1.0)
    for r in rules:
        paths = [re.sub(r"@(\w+):([\w-]+)", r"@*[name()='\1:\2']", r["xpath"])] if "xpath" in r else [css_path(s) for s in r["selectors"]]
        if "text" in r:
            texts = F.concat(*[F.xpath(xml, F.lit(p + "/text()")) for p in paths])
            if r.get("exact", True):
                hit = F.coalesce(F.array_contains(texts, r["text"]).cast("double"), F.lit(0.0))
            else:
                hit = F.coalesce(F.array_max(T.indel_ratios(texts, F.transform(texts, lambda _: F.lit(r["text"])))), F.lit(0.0))  # noqa: B023
        else:
            hit = reduce(or_, [F.xpath_boolean(xml, F.lit(p)) for p in paths]).cast("double")
        value = value * hit
    return F.coalesce(value, F.lit(0.0))


@metric("check_pdf_pages")
def check_pdf_pages(pages, rules):
    return score(R.rule(pages, rules["relation"], rules["ref_value"]))


@metric("check_mp3_meta")
def check_mp3_meta(tags, meta):
    """Every named tag of the map satisfies its rule."""
    test = F.lit(True)
    for k, r in meta.items():
        test = test & R.rule(F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit("")), r["method"], r["ref"])
    return score(test)


@metric("evaluate_conversion")
def evaluate_conversion(runs):
    """No run of text is in capitals."""
    return score(~F.exists(runs, lambda x: (x == F.upper(x)) & x.rlike("[A-Z]")))


@metric("has_page_numbers_in_footers")
def has_page_numbers_in_footers(footers):
    return score(F.forall(footers, lambda x: x.rlike(r"\d")))


@metric("compare_docx_lines")
def compare_docx_lines(a, b):
    lines = lambda x: F.array_sort(F.array_distinct(F.filter(F.transform(x, T.stripped), lambda y: y != "")))
    return score(lines(a) == lines(b))


@metric("compare_docx_files")
def compare_docx_files(a, b, ignore_blanks=True, ignore_case=False, ignore_order=False, content_only=False, fuzzy_match=False, delete_empty_lines=False):
    """Paragraphs of two documents, as arrays, under the chosen normal forms.

    Order is dropped before case. Blanks are ignored over the joined text; else there must
    be as many paragraphs, which are compared, or with ``fuzzy_match`` averaged, one by one.
    """
    low = F.lower if ignore_case else (lambda x: x)

    def form(x):
        x = F.array_sort(x) if ignore_order else x
        return F.filter(x, lambda p: T.stripped(p) != "") if delete_empty_lines else x

    a, b = form(a), form(b)
    one = lambda x: low(T.squeezed(F.array_join(x, "\n")))
    if content_only or (ignore_blanks and fuzzy_match):
        return F.when(a.isNull() | b.isNull(), 0.0).otherwise(T.indel_ratio(one(a), one(b)))
    if ignore_blanks:
        return score(one(a) == one(b))
    if fuzzy_match:
        ratios = T.indel_ratios(F.transform(a, low), F.transform(b, low))
        mean = F.when(F.size(a) == 0, 1.0).otherwise(F.aggregate(ratios, F.lit(0.0), lambda x, y: x + y) / F.size(a))
        return F.coalesce(F.when(F.size(a) == F.size(b), mean), F.lit(0.0))
    return score(F.transform(a, low) == F.transform(b, low))


@metric("compare_init_lines")
def compare_init_lines(a, b):
    n = F.least(F.size(a), F.size(b))
    return score(F.slice(a, F.lit(1), n) == F.slice(b, F.lit(1), n))


@metric("is_first_line_centered")
def is_first_line_centered(alignments):
    return score(F.lower(F.get(alignments, F.lit(0))) == "center")


@metric("check_slide_orientation_Portrait")
def is_portrait(size):
    return score(size["width"] < size["height"])


@metric("check_auto_saving_time")
def check_auto_saving_time(xml, rules):
    return score(F.xpath_int(xml, F.lit("//*[@*='AutoSaveTimeIntervall']//*[local-name()='value']")) == int(rules["minutes"]))


@metric("compare_references")
def compare_references(ratio, base=0.92):
    """The mean likeness of references, rescaled from what the untouched file would get."""
    return R.rescaled(ratio, base)
