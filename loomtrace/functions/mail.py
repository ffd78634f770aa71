"""Mail folders: one text of many messages, as arrays of messages with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The line before each message of a folder, in any case of letters.
_BETWEEN = r"(?i)(?:^|\n)from - [^\n]*(?:\n|$)"
#: The bit of a message's status, a hexadecimal number, that says that it is deleted but not yet gone.
_DELETED = 8


def text_of_folder(content: Column) -> Column:
    """Bytes as text with plain line ends: UTF-8 if they are that, else Latin-1."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content.cast("binary"), "ISO-8859-1"))
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _head(message: Column) -> Column:
    """The lines before the first empty one, each with a line end."""
    return F.concat(F.substring_index(F.concat(F.lit("\n"), message), "\n\n", 1), F.lit("\n"))


def header(message: Column, name: str) -> Column:
    """The value of a header, folded lines joined; null without one."""
    found = F.regexp_extract(_head(message), rf"(?i)\n{name}:((?:[^\n]*)(?:\n[ \t][^\n]*)*)\n", 1)
    return F.nullif(F.trim(F.regexp_replace(found, r"\n[ \t]+", " ")), F.lit(""))


def without_headers(message: Column, *names: str) -> Column:
    """The message without some headers."""
    head = _head(message)
    body = F.substr(message, F.length(head))
    left = head
    for name in names:
        left = F.regexp_replace(left, rf"(?i)\n{name}:[^\n]*(?:\n[ \t][^\n]*)*(?=\n)", "")
    return F.concat(F.substr(left, F.lit(2)), body)


def mail_messages(content: Column, ignore_status: bool = False, ignore_keys: bool = False, remove_deleted: bool = True, remove_duplicate: bool = True) -> Column:
    """The messages of a folder in order of their text, without what the options name; null for no folder."""
    parts = F.filter(F.split(text_of_folder(content), _BETWEEN), lambda m: F.trim(F.replace(m, F.lit("\n"), F.lit(""))) != "")
    if remove_deleted:
        status = lambda m: F.coalesce(F.conv(header(m, "X-Mozilla-Status"), 16, 10).cast("long"), F.lit(0).cast("long"))
        parts = F.filter(parts, lambda m: status(m).bitwiseAND(F.lit(_DELETED).cast("long")) == 0)
    gone = (["X-Mozilla-Status", "X-Mozilla-Status2"] if ignore_status else []) + (["X-Mozilla-Keys"] if ignore_keys else [])
    clean = F.transform(parts, lambda m: F.regexp_replace(without_headers(m, *gone) if gone else m, r"^\s+|\s+$", ""))
    return F.array_sort(F.array_distinct(clean) if remove_duplicate else clean)


def same_folders(result: Column, expected: Column, **options: bool) -> Column:
    """1.0 if two folders hold the same messages, else 0.0; a missing one is like none."""
    return F.coalesce((mail_messages(result, **options) == mail_messages(expected, **options)).cast("double"), F.lit(0.0))
