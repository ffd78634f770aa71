"""Getters over landed texts: browser preferences, directory lists, registries and mail filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtrace.functions.rules import json_at

# Where the preferences hold a setting, and what counts where they do not.
PREFERENCES = {
    "default_search_engine": (("default_search_provider_data", "template_url_data", "short_name"), "Google"),
    "profile_name": (("profile", "name"), None),
    "chrome_language": (("intl", "app_locale"), "en-US"),
    "enabled_experiments": (("browser", "enabled_labs_experiments"), "[]"),
    "enable_do_not_track": (("enable_do_not_track",), "false"),
    "enable_enhanced_safety_browsing": (("safebrowsing", "enhanced"), "false"),
    "bookmarks": (("roots",), "{}"),
}
FONT_SIZES = {"default_fixed_font_size": 13, "default_font_size": 16, "minimum_font_size": 13}


def preference(text: Column, name: str) -> Column:
    """One setting of a preferences file, as text."""
    path, default = PREFERENCES[name]
    return F.coalesce(json_at(text, path), F.lit(default).cast("string"))


def font_sizes(text: Column) -> Column:
    """A struct of the three font sizes."""
    return F.struct(*[F.coalesce(json_at(text, ("webkit", "webprefs", k)).try_cast("int"), F.lit(v)).alias(k) for k, v in FONT_SIZES.items()])


def safe_browsing(text: Column) -> Column:
    """``true`` if safe browsing is on at all."""
    on = lambda k: F.coalesce(json_at(text, ("safebrowsing", k)) == "true", F.lit(False))
    return F.when(on("enhanced") | on("enabled"), "true").otherwise("false")


def new_startup_page(text: Column) -> Column:
    """``true`` where no session is restored, or the setting is 5."""
    value = json_at(text, ("session", "restore_on_startup"))
    return F.when(json_at(text, ("session",)).isNull() | (value == "5"), "true").otherwise("false")


def deletes_on_exit(text: Column) -> Column:
    return F.when(json_at(text, ("profile", "default_content_setting_values")).isNotNull(), "true").otherwise("false")


def extensions(text: Column, field: tuple[str, ...]) -> Column:
    """A field of each installed extension: ("path",) or ("manifest", "name")."""
    settings = F.from_json(json_at(text, ("extensions", "settings")), "map<string,string>")
    return F.filter(F.transform(F.map_values(settings), lambda x: F.get_json_object(x, "$." + ".".join(field))), lambda x: x.isNotNull())


def preference_line(line: Column) -> Column:
    """A struct (key, value) of a line ``user_pref("key", value);``; null for other lines."""
    pattern = r'^user_pref\("((?:[^"\\]|\\.)+)", (.+)\);$'
    return F.when(line.rlike(pattern), F.struct(F.regexp_extract(line, pattern, 1).alias("key"), F.regexp_extract(line, pattern, 2).alias("value")))


def mail_filters(text: Column) -> Column:
    """Filters of a mail client's file: an array of maps, each from one ``name`` line to the line before the next."""
    blocks = F.filter(F.split(text, r"(?m)^(?=name=)"), lambda x: x.startswith("name="))
    pairs = lambda block: F.filter(F.transform(F.split(block, "\n"), lambda l: F.struct(F.regexp_extract(l, r'^(\w+)="(.*)"$', 1).alias("k"), F.replace(F.regexp_extract(l, r'^(\w+)="(.*)"$', 2), F.lit('\\"'), F.lit('"')).alias("v"))), lambda p: p["k"] != "")  # noqa: E731, E741
    return F.transform(blocks, lambda b: F.map_from_entries(pairs(b)))


def filter_conditions(condition: Column) -> Column:
    """The parts ``AND (a,b,c)`` of a condition, without brackets around them."""
    return F.regexp_extract_all(condition, F.lit(r"\b((?:AND|OR) \([^)]*\)|ALL)"), 1)


def last_row(cells, by: list[str]):
    """The texts of the last row of each sheet of long cells, in the order of columns."""
    last = cells.groupBy(*by).agg(F.max("row").alias("row"))
    return cells.join(last, [*by, "row"]).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"]).alias("values"))


def image_uri(data: Column) -> Column:
    """A picture as a data URI."""
    return F.concat(F.lit("data:image/jpeg;base64,"), F.base64(data))
