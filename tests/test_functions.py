"""Rules, texts, urls, dates, metrics and pictures, case by case."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtrace.functions.mail import header, same_folders
from loomtrace.functions import images, rules, text, times, urls
from loomtrace.functions.metrics import METRICS
from loomtrace.plans.expression import ExpressionError, called_names, compile_expression, score_expression


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("method", "ref", "given", "wanted"), [
    ("eq", 1, "1.0", True), ("eq", "1", "1.0", False), ("ne", "a", "b", True), ("eq", None, None, True), ("le", 2, "x", False), ("lt", 3, "2.5", True), ("ge", "b", "b", True),
    ("approx:0.1", 1, "1.05", True), ("approx:0.1", 1, "no", False), ("range.te", (1, 2), "2", True), ("range.te", (1, 2), "1", False), ("range.ee", (1, 2), "1", True),
    ("re", r"a.c", "xabc", True), ("re.I", "ABC", "abc", True), ("re.S", "a.b", "a\nb", True), ("re", "a.b", "a\nb", False), ("str_list_eq", ["a", "b"], "'a, b'", True), ("str_set_eq", ["b", "a"], "a,b,a", True), ("str_set_eq", ["b"], None, False),
])
def test_rules(spark, method, ref, given, wanted):
    assert value(spark, rules.rule(F.lit(given).cast("string"), method, ref)) is wanted


def test_ranges_and_truth(spark):
    assert rules.cell_range("$B$2:AA10") == (2, 2, 10, 27)
    ranged = lambda got, inner, outer: value(spark, rules.rule(F.lit(got), "spreadsheet_range", (inner, outer)))
    assert ranged("B2:C3", "B2:C3", ["A1:D9"]) and not ranged("A1:E3", "A1:E3", "A1:D9")
    assert ranged("$A$1:C3 AB10", "B2 AB10", "A1:D9 AA1:AC20") and not ranged("A1:C3", "B2:D3", "A1:D9") and not ranged("x", "A1", "A1:D9")
    assert value(spark, rules.truthy_and(F.lit(0.5), F.lit(0.2))) == 0.2 and value(spark, rules.truthy_or(F.lit(0.0), F.lit(0.2))) == 0.2
    with pytest.raises(ValueError):
        rules.rule(F.lit(1), "like", "x")


@pytest.mark.parametrize(("a", "b", "ratio"), [("", "", 1.0), ("a", "", 0.0), ("abc", "abc", 1.0), ("kitten", "sitting", 8 / 13), ("lewenstein", "levenshtein", 18 / 21), ("ab" * 40, "ba" * 40, 158 / 160)])
def test_indel(a, b, ratio):
    assert text.indel(a, b) == pytest.approx(ratio) and text.indel(b, a) == pytest.approx(ratio)


def test_indel_against_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 12))) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert text.indel(a, b) == (1.0 if not a and not b else 2 * best[-1, -1] / (len(a) + len(b)))


@pytest.mark.parametrize(("action", "wanted"), [
    ("click(500, 500)", "click(630,350)"), ("scroll(0,0,down)", "scroll(0,0,-50)"), ("drag(0,0,1000,1000)", "drag(0,0,1260,700)"), ("click(a,b)", "wait()"), ("fly()", "wait()"), ("finish()", "finish()"), ("type(hello)", "type(hello)"), (None, "wait()"),
])
def test_actions(spark, action, wanted):
    assert value(spark, text.valid_action(F.lit(action).cast("string"), 1260, 700)) == wanted


@pytest.mark.parametrize(("a", "b", "same"), [
    ("https://www.airbnb.com/", "https://airbnb.de", True), ("google.com", "http://google.com/", True), ("http://a.com/x", "http://a.com/y", False), ("http://www.a.co.uk/P", "http://A.com/P", True), ("http://www.sub.a.co.uk", "http://sub.a.co.uk", False), ("http://a.com/P", "http://a.com/p", False), ("http://a.com?q=1", "http://a.com", False),
])
def test_urls(spark, a, b, same):
    assert value(spark, urls.compare_form(F.lit(a)) == urls.compare_form(F.lit(b))) is same


@pytest.mark.parametrize(("today", "phrase", "wanted"), [
    ("2024-12-31", "tomorrow", "2025-01-01"), ("2024-01-15", "31st next month", "2024-02-29"), ("2024-12-05", "5th next month", "2025-01-05"), ("2024-06-09", "this Friday", "2024-06-07"), ("2024-06-09", "next Monday", "2024-06-10"),
    ("2024-08-20", "first Monday 4 months later", "2024-12-02"), ("2024-04-20", "first Monday 8 months later", "2024-12-02"),
])
def test_days(spark, today, phrase, wanted):
    assert str(value(spark, times.relative_day(F.lit(today).cast("date"), phrase))) == wanted


def test_formats(spark):
    day = F.lit(datetime.date(2024, 3, 5))
    assert value(spark, times.formatted(day, "{DoW} {Day0D}/{Month0D} {DayD} {DayD}")) == "Tue 05/03 5 {DayD}"


def test_answers(spark):
    assert value(spark, text.json_of_answer(F.lit('x ```json\n[{"a": 1}]\n``` {"b": {"c": 2}}'))) in ('{"a": 1}', '{"b": {"c": 2}}')
    assert value(spark, text.json_of_answer(F.lit("none"))) is None
    assert value(spark, text.pad_left(F.array(*[F.lit(x).cast("long") for x in (1, 2, 3)]), 2)) == [2, 3]
    assert value(spark, text.pad_right(F.array(F.lit(1).cast("long")), 3, 9)) == [1, 9, 9]


@pytest.mark.parametrize(("name", "args", "wanted"), [
    ("exact_match", (F.lit, "a", {"expected": "a"}), 1.0), ("match_in_list", (F.lit, "a", {"expected": ["b", "a"]}), 1.0), ("check_list", (F.lit, "x1\ny", {"expect": [r"\d"], "unexpect": ["z"]}), 1.0), ("check_list", (F.lit, None, {"expect": []}), 0.0),
    ("check_json", (F.lit, '{"a": {"b": 3}}', {"expect": [{"key": ["a", "b"], "method": "ge", "ref": 3}]}), 1.0), ("check_json", (F.lit, "{}", {"expect": [{"key": ["a"], "method": "eq", "ref": 3}]}), 0.0),
    ("check_direct_json_object", (F.lit, '{"a": "x", "l": ["2", "1"]}', {"expected": {"a": "x", "l": ["1", "2"]}, "ignore_list_order": True}), 1.0), ("check_json_settings", (F.lit, '{"a": 1, "b": 2}', {"expected": {"a": 1}}), 1.0),
    ("is_expected_active_tab", (F.lit, "http://a.com/", {"url": "a.com"}), 1.0), ("check_qt_max_volume", (F.lit, "x=1", {"expected_qt_max_volume": 125}), 1.0), ("check_global_key_play_pause", (F.lit, "global-key-play-pause=p", {"expected_global_key_play_pause": 1}), 1.0),
    ("check_text_enlarged", (F.lit, "1.25"), 1.0), ("check_gnome_favorite_apps", (F.lit, "['b', 'a']", {"expected": ["a", "b"]}), 1.0), ("check_libre_locale", (F.lit, "en_US", {"locale_set": ["de*", "en_*"]}), 1.0), ("is_utc_0", (F.lit, "a\nb\nc\nx (UTC, +0000)"), 1.0),
    ("check_line_number", (F.lit, "01:02:03 a\nb\n23:59:59", {"expected": 2}), 1.0), ("check_accessibility_tree", (F.lit, "<a><b>x</b></a>", [{"xpath": "/a/b", "text": "x"}, {"xpath": "//b"}]), 1.0), ("check_config_status", (F.lit, "(theme  \"x\")\n(size 3)", {"key": "size", "value": 3}), 1.0),
    ("compare_result_files", (F.lit, " is 42 ", F.lit), 0.0),
])
def test_metrics(spark, name, args, wanted):
    make, given, *rest = args
    rest = [F.lit("43") if x is F.lit else x for x in rest]
    assert value(spark, METRICS[name](make(given).cast("string"), *rest)) == wanted


def test_expressions(spark):
    names = {"f": lambda x: F.lit(x), "g": lambda x, k=0: F.lit(x + k)}
    assert value(spark, compile_expression("f(0.5) and g(1, k=2) or f(9)", names)) == 3.0
    assert value(spark, compile_expression("f(0) or not f(0)", names)) == 1.0
    assert value(spark, compile_expression("f(None)", names)) == 0.0
    assert value(spark, score_expression("f(1)", names, F.lit("FAIL"))) == 0.0
    for bad in ("__import__('os')", "f(1).x", "h(1)", "f(", "[x for x in y]", "lambda: 1"):
        with pytest.raises(ExpressionError):
            compile_expression(bad, names)
    assert called_names("a(b(1)) and c.d(2)") == ["a", "b"] and called_names("a(") is None


def test_pictures():
    rng = np.random.default_rng(2)
    gray = rng.integers(0, 255, (40, 50))
    assert images.structural_similarity(gray, gray) == pytest.approx(1.0) and images.structural_similarity(gray, 255 - gray) < 0
    assert images.mean_square_error(gray, gray) == 0 and images.sharpness(np.full((9, 9), 7)) == 0
    assert images.brightness(np.full((2, 2, 3), 255)) == pytest.approx(255) and images.saturation(np.full((2, 2, 3), 9)) == 0
    assert bin((images.perceptual_hash(gray) ^ images.perceptual_hash(gray + 1)) & (1 << 64) - 1).count("1") <= 5
    cost, steps = images.warped_distance(np.eye(4), np.eye(4)[[0, 0, 1, 2, 3]])
    assert cost == pytest.approx(0) and steps == 5
    assert images.colour_distance(np.zeros((1, 3)), (255, 255, 255)) == pytest.approx(1)


def test_answers_and_calls_take_the_first_that_reads(spark):
    assert value(spark, text.json_of_answer(F.lit('{bad} then {"a": 1}'))) == '{"a": 1}'
    assert value(spark, text.json_of_answer(F.lit('```json\n{bad}\n``` ```json\n{"b": 2}\n``` {"a": 1}'))) == '{"b": 2}'
    assert value(spark, text.json_of_answer(F.lit(' [1, {"a": 2}] '))) == '[1, {"a": 2}]'
    from loomtrace.functions.actions import tool_call

    thought, name, arguments = tool_call(F.lit('Thought: no\nAction: first\nsecond line\n<tool_call>\n{"name": "go", "arguments": {"x": 1}}\n</tool_call>'))
    assert [value(spark, c) for c in (thought, name, arguments)] == ["first\nsecond line", "go", '{"x":1}']


def test_metrics_that_differed(spark):
    from loomtrace.functions import landed
    from loomtrace.functions.metrics import METRICS as M

    one = lambda name, got, *rest, **options: value(spark, M[name](F.lit(got) if isinstance(got, str) or got is None else got, *rest, **options))
    direct = lambda got, expected, **more: one("check_direct_json_object", got, {"expected": expected, **more})
    assert direct("{'a': true, 'b': [1, 'x'], 'c': 'y'}", {"a": True, "b": [1, "x"], "c": "y"}) == 1
    assert direct('{"a": "true"}', {"a": True}) == 0 and direct('{"a": 1}', {"a": 1, "z": None}) == 1 and direct("not", {}) == 0
    assert direct('{"a": "__EVALUATION_FAILED__"}', {"a": "__EVALUATION_FAILED__"}) == 0 and direct('{"a": "__EVALUATION_FAILED__"}', {"b": None}) == 1
    assert direct('{"a": ["q", "p"]}', {"a": ["p", "q"], "ignore_list_order": True}) == 0  # the option is a field like the others
    assert direct('{"a": ["q", "p"], "ignore_list_order": [true]}', {"a": ["p", "q"]}) == 0
    assert direct('{"a": ["q", "p"], "b": "some text"}', {"a": ["z", "p"], "b": "me te"}, expect_in_result=True) == 1
    assert direct('{"a": ["q"], "b": "some text"}', {"a": ["z", "p"], "b": "me te"}, expect_in_result=True) == 0
    assert direct(None, {"a": 1}) == 0
    assert one("check_line_number", "x12:30:60y\nno\n23:59:59", {"expected": 2}) == 1
    assert one("compare_terminal_and_txt", "", F.lit("")) == 0 and one("compare_terminal_and_txt", "a", F.lit("a")) == 1
    assert value(spark, M["check_font_size"](landed.font_sizes(F.lit('{"webkit": {"webprefs": {"default_font_size": 20}}}')), {"type": "value", "value": 20})) == 1
    bar = '{"bookmark_bar": {"children": [{"type": "folder", "name": "Liked Authors", "children": [{"type": "url", "name": "a", "url": "u1"}, {"type": "url", "name": "b", "url": "v2"}]}, {"type": "url", "name": "c", "url": "w"}]}}'
    for rule, wanted in (
        ({"type": "bookmark_bar_folders_names", "names": ["Liked Authors"]}, 1), ({"type": "bookmark_bar_websites_urls", "urls": ["w"]}, 1), ({"type": "bookmark_bar_websites_urls", "urls": ["x"]}, 0),
        ({"type": "liked_authors_websites_urls", "urls": ["u1", ["v1", "v2"]]}, 1), ({"type": "liked_authors_websites_urls", "urls": ["u1", ["v1"]]}, 0), ({"type": "liked_authors_websites_urls", "urls": ["u1"]}, 0),
    ):
        assert one("is_expected_bookmarks", bar, rule) == wanted, rule
    status = "<root><state>playing</state><information><category name='meta'><info name='{}'>/films/a.mp4</info></category></information></root>"
    for place in ("filename", "title", "uri", "location", "name"):
        assert one("is_vlc_playing", status.format(place), {"type": "file_name", "file_name": "a.mp4"}) == 1
    assert one("is_vlc_playing", status.format("location"), {"type": "url", "url": "films"}) == 1 and one("is_vlc_playing", status.format("other"), {"type": "file_name", "file_name": "a.mp4"}) == 0
    paragraphs = lambda *x: F.array(*map(F.lit, x))
    docs = lambda a, b, **o: value(spark, M["compare_docx_files"](paragraphs(*a), paragraphs(*b), **o))
    assert docs(("ab", "cd"), ("ab", "cx"), ignore_blanks=False, fuzzy_match=True) == 0.75
    assert docs(("ab", "cd"), ("ab",), ignore_blanks=False, fuzzy_match=True) == 0
    assert docs(("b", "A"), ("a", "B"), ignore_order=True, ignore_case=True) == 0 and docs(("b", "a"), ("A", "B"), ignore_order=True, ignore_case=True) == 1


def test_ranges_that_are_none(spark):
    for got in ("A1B2", "1A", "", " ", "A", "7", "A1:", "A1:B", None):
        assert value(spark, rules.rule(F.lit(got), "spreadsheet_range", ([], "A1:Z99"))) is False or got in ("", " ")
    assert value(spark, rules.rule(F.lit("$b$10:a1 aaa3"), "spreadsheet_range", (["B2", "A10", "AAA3"], "A1:AAZ10")))


def test_mail_folders(spark):
    mail = lambda status, body, keys="": f"From - Mon\r\nX-Mozilla-Status: {status}\r\nX-Mozilla-Status2: 00800000\r\nX-Mozilla-Keys: {keys}\r\n more\r\nSubject: hi\r\n there\r\n\r\n{body}\r\n"
    same = lambda a, b, **o: value(spark, same_folders(F.lit(a.encode()), F.lit(b.encode() if b is not None else None), **o))
    assert same(mail("0001", "one"), mail("0001", "two")) == 0.0 and same(mail("0001", "one"), mail("0001", "one")) == 1.0
    # Deleted ones do not count, nor do order and repetition, nor what the options leave out.
    assert same(mail("0009", "gone") + mail("0001", "b") + mail("0001", "a"), mail("0001", "a") + mail("0001", "b") + mail("0001", "a")) == 1.0
    assert same(mail("0009", "gone"), "", remove_deleted=True) == 1.0 and same(mail("0009", "gone"), "", remove_deleted=False) == 0.0
    assert same(mail("0001", "a") * 2, mail("0001", "a"), remove_duplicate=False) == 0.0
    assert same(mail("0001", "a"), mail("0011", "a")) == 0.0 and same(mail("0001", "a"), mail("0011", "a"), ignore_status=True) == 1.0
    assert same(mail("0001", "a", "x"), mail("0001", "a", "y")) == 0.0 and same(mail("0001", "a", "x"), mail("0001", "a", "y"), ignore_keys=True) == 1.0
    # A status in a body is no header, and a folder that is missing is like none.
    assert same("From - x\nA: b\n\nX-Mozilla-Status: 0009\n", "") == 0.0 and same("", None) == 0.0
    assert value(spark, header(F.lit(mail("0001", "a").replace("\r\n", "\n")), "subject")) == "hi there"
