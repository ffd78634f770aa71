"""Getters of the evaluator language over landed state.

A getter of the language asks a machine for something. Here what machines gave is
landed in two columns of an attempt's row: ``texts``, a map from keys to texts, and
``files``, a map from names to bytes. ``Landed`` names these columns, and a getter
builds the Column that stands for its result, a plain value where the configuration
alone holds it, or a ``LandedFile``.

Texts that several getters read have a key of their own: ``active_tab_url``,
``active_tab_html``, ``open_tabs``, ``accessibility_tree``, ``preferences``,
``local_state``, ``bookmarks``, ``terminal``, ``screen_size``, ``vm_window_size``.
Every other getter's result is landed under ``name|configuration`` as JSON with sorted
keys (``landed_key``). What is not landed is null, as of a getter that failed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtrace.functions import landed as L
from loomtrace.functions import times
from loomtrace.functions import urls as U
from loomtrace.sources.files import text_of


def landed_key(name: str, config: Mapping | None = None) -> str:
    return name if not config else f"{name}|{json.dumps(config, sort_keys=True, ensure_ascii=False)}"


@dataclass
class Landed:
    """The columns of an attempt, and the day from which relative days are counted."""

    texts: Column = field(default_factory=lambda: F.col("texts"))
    files: Column = field(default_factory=lambda: F.col("files"))
    today: Column = field(default_factory=F.current_date)

    def text(self, key: str) -> Column:
        return F.try_element_at(self.texts, F.lit(key))

    def file(self, *names: str, sheets: Sequence[str] = ()) -> LandedFile:
        return LandedFile(self, names, tuple(sheets))


@dataclass
class LandedFile:
    """Landed files by name; ``beside`` are the names of all files that came with them."""

    of: Landed
    names: tuple[str, ...]
    beside: tuple[str, ...] = ()

    @property
    def content(self) -> Column:
        """The bytes of the one file, or an array of those of several."""
        each = [F.try_element_at(self.of.files, F.lit(n)) for n in self.names]
        return each[0] if len(each) == 1 else F.array(*each)

    @property
    def text(self) -> Column:
        return text_of(self.content) if len(self.names) == 1 else F.transform(self.content, text_of)

    @property
    def lines_beside(self) -> Column:
        """A map from names to texts of the files beside."""
        names = [n for n in self.beside if n not in self.names]
        if not names:
            return F.create_map().cast("map<string,string>")
        return F.create_map(*[x for n in names for x in (F.lit(n), text_of(F.try_element_at(self.of.files, F.lit(n))))])


GETTERS: dict[str, Callable[..., object]] = {}


def getter(*names: str):
    def register(function):
        for name in names or (function.__name__,):
            GETTERS[name] = function
        return function

    return register


def _named(name: str):
    """A getter whose result is landed as it is."""

    def get(env: Landed, config: Mapping | None = None):
        return env.text(landed_key(name, config))

    GETTERS[name] = get


# Getters of live machines and sites, whose results are landed under their names.
LIVE = (
    "get_info_from_website", "get_active_tab_html_parse", "get_gotoRecreationPage_and_get_html_content", "get_chrome_saved_address",
    "get_number_of_search_results", "get_extensions_installed_from_shop", "get_conference_city_in_order", "get_default_video_player",
    "get_timezone_from_ip", "get_timezone_from_config", "get_replay", "get_content_from_vm_file", "get_vm_command_error",
)
for _name in LIVE:
    _named(_name)


# --- rules and days ---------------------------------------------------------------


@getter()
def get_rule(env: Landed, config: Mapping):
    return config["rules"]


@getter()
def get_time_diff_range(env: Landed, config: Mapping):
    return config.get("diff_range_in_minutes")


# Other names of days.
_DAYS = {"first monday four months later": "first Monday 4 months later", "first monday eight months later": "first Monday 8 months later", "this month": "today"}
_SPLIT = {"from": ("puDay", "puMonth", "puYear"), "to": ("doDay", "doMonth", "doYear")}


def _day(env: Landed, phrase: str, start: Column | None, from_phrase: str | None) -> Column:
    """The day of a phrase; the end of a span lies in the week of its start where both say so."""
    phrase = phrase.removesuffix(" split")
    week_day = phrase.split()[-1]
    monday_of = lambda day: F.date_sub(day, F.weekday(day))
    if start is not None and week_day in times.WEEKDAYS and from_phrase is not None:
        same = (phrase == "next Friday" and from_phrase.startswith("next Monday")) or (phrase == "next Sunday" and from_phrase in ("next Friday", "next Saturday")) or (phrase == "next week Sunday" and from_phrase.startswith("next week"))
        if same:
            return F.date_add(monday_of(start), times.WEEKDAYS.index(week_day))
    if phrase in ("next Friday", "next Saturday", "next Sunday"):  # of this week, unless it has come
        n = times.WEEKDAYS.index(week_day)
        return F.date_add(monday_of(env.today), F.when(F.weekday(env.today) < n, F.lit(n)).otherwise(F.lit(7 + n)))
    return times.relative_day(env.today, _DAYS.get(phrase, phrase))


@getter()
def get_rule_relativeTime(env: Landed | None = None, config: Mapping | None = None):
    """The rules with the days of the relative time in place of their patterns, as Columns."""
    if env is None or config is None:
        raise ValueError("the rules of a relative time are missing")
    rules = config["rules"]
    expected, relative = dict(rules["expected"]), rules["relativeTime"]
    start = None
    for end in ("from", "to"):
        if end not in relative:
            continue
        phrase = relative[end]
        day = _day(env, phrase, start, relative["from"] if end == "to" else None)
        keys = _SPLIT[end] if phrase.endswith(" split") else (end,) if "to" in relative else ("time",)
        for key in keys:
            shown = [times.formatted(day, p) for p in (expected[key] if isinstance(expected[key], list) else [expected[key]])]
            expected[key] = shown if isinstance(expected[key], list) else shown[0]
        start = day if end == "from" else start
    return {**rules, "expected": expected}


# --- files ------------------------------------------------------------------------


@getter("get_vm_file", "get_cloud_file")
def get_file(env: Landed, config: Mapping):
    """The file of a name, or of several those that the configuration gives."""
    dest = config["dest"]
    if not config.get("multi", False):
        return env.file(dest)
    given = config.get("gives", [0])
    return env.file(*[dest[i] for i in given], sheets=dest)


@getter()
def get_cache_file(env: Landed, config: Mapping):
    return env.file(config["path"])


@getter("get_gimp_config_file", "get_vscode_config", "get_vm_wallpaper", "get_vlc_config", "get_vlc_playing_info", "get_pdf_from_url", "get_background_image_in_slide", "get_audio_in_slide", "get_googledrive_file")
def get_by_dest(env: Landed, config: Mapping):
    """A file that an application or a site gave, by the name under which it is landed."""
    return env.file(config["dest"] if isinstance(config["dest"], str) else config["dest"][0])


# --- the machine ------------------------------------------------------------------


@getter()
def get_vm_command_line(env: Landed, config: Mapping):
    return env.text(landed_key("get_vm_command_line", {"command": config["command"]}))


@getter()
def get_vm_terminal_output(env: Landed, config: Mapping | None = None):
    return env.text("terminal")


@getter()
def get_accessibility_tree(env: Landed, config: Mapping | None = None):
    return env.text("accessibility_tree")


def _size(name: str):
    def get(env: Landed, config: Mapping | None = None):
        return F.from_json(env.text(landed_key(name, config)), "struct<width:long,height:long>")

    return get


GETTERS["get_vm_screen_size"] = lambda env, config=None: _size("screen_size")(env)
GETTERS["get_vm_window_size"] = _size("vm_window_size")


@getter()
def get_list_directory(env: Landed, config: Mapping):
    """The names in a folder, of its tree as JSON text."""
    tree = env.text(landed_key("get_list_directory", config))
    return F.transform(F.from_json(F.get_json_object(tree, "$.children"), "array<struct<name:string>>"), lambda x: x["name"])


@getter()
def get_shortcuts_on_desktop(env: Landed, config: Mapping | None = None):
    """Desktop files of the desktop, by name."""
    wanted = F.map_filter(env.files, lambda name, content: name.endswith(".desktop"))
    return F.transform_values(wanted, lambda name, content: text_of(content))


# --- the browser --------------------------------------------------------------------


def _preference(name: str, source: str = "preferences"):
    return lambda env, config=None: L.preference(env.text(source), name)


for _name in ("default_search_engine", "profile_name", "chrome_language", "enable_do_not_track", "enable_enhanced_safety_browsing"):
    GETTERS[f"get_{_name}"] = _preference(_name, "local_state" if _name == "chrome_language" else "preferences")
GETTERS["get_enabled_experiments"] = lambda env, config=None: F.from_json(L.preference(env.text("local_state"), "enabled_experiments"), "array<string>")
GETTERS["get_bookmarks"] = lambda env, config=None: F.coalesce(F.get_json_object(env.text("bookmarks"), "$.roots"), F.lit("{}"))
GETTERS["get_chrome_font_size"] = lambda env, config=None: L.font_sizes(env.text("preferences"))
GETTERS["get_enable_safe_browsing"] = lambda env, config=None: L.safe_browsing(env.text("preferences"))
GETTERS["get_new_startup_page"] = lambda env, config=None: L.new_startup_page(env.text("preferences"))
GETTERS["get_data_delete_automacally"] = lambda env, config=None: L.deletes_on_exit(env.text("preferences"))
GETTERS["get_find_unpacked_extension_path"] = lambda env, config=None: L.extensions(env.text("preferences"), ("path",))
GETTERS["get_find_installed_extension_name"] = lambda env, config=None: L.extensions(env.text("preferences"), ("manifest", "name"))


def _rows_of(name: str, key: str):
    """Landed rows of a browser's database as an array of the texts of one field."""
    return lambda env, config=None: F.transform(F.from_json(env.text(landed_key(name, config)), f"array<struct<{key}:string>>"), lambda x: x[key])


GETTERS["get_history"] = _rows_of("get_history", "url")
GETTERS["get_cookie_data"] = _rows_of("get_cookie_data", "host_key")


@getter()
def get_open_tabs_info(env: Landed, config: Mapping | None = None):
    return F.transform(F.from_json(env.text("open_tabs"), "array<struct<url:string,title:string>>"), lambda x: x["url"])


@getter()
def get_page_info(env: Landed, config: Mapping):
    """The HTML of a page that was asked for, of {title, url, content}."""
    return F.get_json_object(env.text(landed_key("get_page_info", config)), "$.content")


@getter("get_active_url_from_accessTree", "get_active_tab_info")
def get_active_url(env: Landed, config: Mapping | None = None):
    """The active tab's url, with the prefix that the address bar hides if it has no scheme."""
    url, prefix = env.text("active_tab_url"), (config or {}).get("goto_prefix", "https://")
    return F.when(url.rlike(r"^[A-Za-z][\w+.-]*:"), url).otherwise(F.concat(F.lit(prefix), url))


@getter()
def get_active_tab_url_parse(env: Landed, config: Mapping):
    """The first value of each key of the query, or empty, as a JSON object; keys may be renamed and values split at commas."""
    url = get_active_url(env, config)
    renamed = config.get("replace", {})
    value = lambda k: F.coalesce(U.query_value(url, _quoted(k)), F.lit(""))
    shown = (lambda x: F.split(x, ",")) if config.get("split_list", False) else (lambda x: x)
    fields = [shown(value(k)).alias(renamed.get(k, k)) for k in config["parse_keys"]]
    return F.when(url.isNotNull(), F.to_json(F.struct(*fields)))


def _quoted(key: str) -> str:
    """A key of a query as a pattern that also fits its encoded form."""
    return "(?:" + "|".join(re.escape(k) for k in dict.fromkeys((key, quote_plus(key)))) + ")"


@getter()
def get_url_dashPart(env: Landed, config: Mapping):
    """A part of the url between slashes, as text or in a JSON object."""
    url, index = get_active_url(env, config), int(config["partIndex"])
    parts = F.split(url, "/")
    part = F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))
    part = F.substring_index(part, "?", 1) if config.get("needDeleteId", False) else part
    if config["returnType"] == "string":
        return part
    return F.when(part.isNotNull(), F.to_json(F.struct(part.alias(config["key"]))))


# What a shop's url calls its discounts.
_HALF, _LESS, _NOT_HALF = "50_PERCENT_ off & more", ("30_PERCENT_ off & more", "20_PERCENT_ off & more"), "not_50_PERCENT_ off & more"


@getter("get_url_path_parse", "get_macys_product_url_parse")
def get_url_path_parse(env: Landed, config: Mapping):
    """What the path of a shop's url says of a product, as a JSON object without fields that it does not say.

    The first two parts on end that both have commas are names and their values.
    """
    url = get_active_url(env, config)
    path = F.try_url_decode(F.replace(F.regexp_extract(url, r"^[^?#]*?://[^/?#]*([^?#;]*)", 1), F.lit("+"), F.lit("%2B")))
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    first = F.get(F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.get(parts, i).contains(",") & F.get(parts, i + 1).contains(",")), F.lit(0))
    names, values = (F.transform(F.split(F.get(parts, first + n), ","), lambda x: F.trim(x)) for n in (0, 1))
    value = lambda key: F.nullif(F.get(values, F.array_position(names, key).cast("int") - 1), F.lit(""))
    yes = lambda *tests: F.when(F.coalesce(*[F.when(t, F.lit(True)) for t in tests], F.lit(False)), F.lit(True))
    fields = {
        "mens_clothing": yes(path.contains("mens-clothing")),
        "shirts": yes(path.contains("shirts"), value("Product_department").isin("shirts", "Shirts", "Shirt")),
        "short_sleeve": yes(path.contains("short-sleeve"), value("Sleeve_length").isin("short-sleeve", "Short Sleeve")),
    }
    for key in config["parse_keys"]:
        if key == "Price_discount_range":
            offers = F.transform(F.split(value(key), r"\|"), lambda x: F.trim(x))
            half = F.array_contains(offers, _HALF) & ~F.arrays_overlap(offers, F.array(*map(F.lit, _LESS)))
            fields[key] = F.when(half, F.lit(_HALF)).otherwise(F.lit(_NOT_HALF))
        elif key not in fields:
            fields[key] = value(key)
    return F.when(url.isNotNull(), F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])))
