"""Actions of agents as structs, and code of actions repaired."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The verbs of the action language and what they do.
CLICKS = {"click": ("CLICK", "1"), "left_double": ("CLICK", "2"), "right_single": ("RIGHT_CLICK", "1"), "move": ("MOVE_TO", None)}
PLAIN = {"wait": "WAIT", "call_user": "FAIL", "finish": "DONE"}


def action_list(text: Column) -> Column:
    """An array of structs (action_type, parameters) for an action of one of twelve verbs; null for anything else.

    A drag and a scroll are two actions: the pointer moves first.
    """
    pattern = r"^(\w+)\(([^)]*)\)$"
    verb, inside = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    args = F.transform(F.split(inside, ","), lambda x: F.trim(x))
    whole = lambda i: F.get(args, F.lit(i)).try_cast("int").cast("string")

    def act(kind: str, *fields: tuple[str, Column]) -> Column:
        items = [x for k, v in fields for x in (F.lit(k), v)]
        return F.struct(F.lit(kind).alias("action_type"), (F.create_map(*items) if items else F.create_map().cast("map<string,string>")).alias("parameters"))

    place = (("x", whole(0)), ("y", whole(1)))
    made = F.lit(None)
    for name, kind in PLAIN.items():
        made = F.when(verb == name, F.array(act(kind))).otherwise(made)
    for name, (kind, clicks) in CLICKS.items():
        fields = (*place, ("num_clicks", F.lit(clicks))) if clicks == "2" else place
        made = F.when((verb == name) & whole(1).isNotNull(), F.array(act(kind, *fields))).otherwise(made)
    made = F.when((verb == "drag") & whole(3).isNotNull(), F.array(act("MOVE_TO", *place), act("DRAG_TO", ("x", whole(2)), ("y", whole(3))))).otherwise(made)
    made = F.when((verb == "scroll") & whole(2).isNotNull(), F.array(act("MOVE_TO", *place), act("SCROLL", ("dy", whole(2))))).otherwise(made)
    made = F.when(verb == "hotkey", F.array(act("HOTKEY", ("keys", F.array_join(args, ","))))).otherwise(made)
    made = F.when(verb == "type", F.array(act("TYPING", ("text", inside)))).otherwise(made)
    return F.when(verb == "press", F.array(act("PRESS", ("key", F.get(args, F.lit(0)))))).otherwise(made)


def split_actions(text: Column) -> Column:
    """The parts of an action string between ampersands, trimmed."""
    return F.transform(F.split(text, "&"), lambda x: F.trim(x))


def less_than_as_keys(code: Column) -> Column:
    """Code that types or presses ``<`` with that one key pressed by its combination instead."""
    return F.regexp_replace(code, r"""pyautogui\.press\(\s*['"](?:<|\\u003c)['"]\s*\)""", "pyautogui.hotkey('shift', ',')")


def tool_call(answer: Column) -> tuple[Column, Column, Column]:
    """(thought, name, arguments as JSON text) of an answer with a ``<tool_call>`` of JSON; the thought is all from ``Action:`` to the call."""
    body = F.regexp_extract(answer, r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>", 1)
    thought = F.regexp_extract(answer, r"(?s)Action:\s*(.*?)\s*(?=<tool_call>)", 1)
    return thought, F.get_json_object(body, "$.name"), F.get_json_object(body, "$.arguments")


def to_code(call: Column, width: int, height: int, grid: int = 999) -> Column:
    """The screen command of a tool call's arguments; null for a verb without one."""
    at = lambda i, size: (F.get_json_object(call, f"$.coordinate[{i}]").try_cast("double") * size / grid).cast("int").cast("string")
    place = F.concat(at(0, width), F.lit(", "), at(1, height))
    verb = F.get_json_object(call, "$.action")
    keys = F.concat(F.lit("'"), F.array_join(F.from_json(F.get_json_object(call, "$.keys"), "array<string>"), "', '"), F.lit("'"))
    command = lambda name, inside: F.concat(F.lit(f"pyautogui.{name}("), inside, F.lit(")"))
    out = F.when(verb == "left_click", command("click", place)).when(verb == "right_click", command("rightClick", place)).when(verb == "double_click", command("doubleClick", place))
    out = out.when(verb == "mouse_move", command("moveTo", place)).when(verb == "left_click_drag", command("dragTo", place)).when(verb == "key", command("hotkey", keys))
    out = out.when(verb == "type", command("typewrite", F.concat(F.lit("'"), F.get_json_object(call, "$.text"), F.lit("'")))).when(verb == "scroll", command("scroll", F.get_json_object(call, "$.pixels")))
    return out.when(verb == "wait", "WAIT").when((verb == "terminate") & (F.get_json_object(call, "$.status") == "failure"), "FAIL").when(verb == "terminate", "DONE")
