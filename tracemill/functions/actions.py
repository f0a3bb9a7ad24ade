"""Reading the actions that a desktop agent writes. Texts are parsed, never run."""

from __future__ import annotations

import ast
import json
import re
import sys
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.session import ship_by_value

_QUOTED = re.compile(r"^(\s*)(type|finished)\(content='(.*)'\)\s*$", re.S)
_HEADS = ("Reflection", "Thought", "Action_Summary")


def parse_call(text: str | None) -> dict | None:
    """``{function, args}`` of a call with constant keyword arguments; null for anything else."""
    try:
        call = ast.parse(text or "", mode="eval").body
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None
    if not isinstance(call, ast.Call):
        return None
    name = call.func.id if isinstance(call.func, ast.Name) else call.func.attr if isinstance(call.func, ast.Attribute) else None
    return {"function": name, "args": {k.arg: k.value.value if isinstance(k.value, ast.Constant) else None for k in call.keywords if k.arg}}


def escape_quotes(text: str) -> str:
    return re.sub(r"(?<!\\)'", r"\\'", text)


def split_text(text: str) -> dict:
    """reflection, thought and the action texts (separated by blank lines) of a model's reply."""
    t = text.strip()
    head = t.partition(":")[0]
    two = re.search(r"Reflection: (.+?)Action_Summary: (.+?)(?=\s*Action:|$)", t, re.S) if head == "Reflection" else None
    one = re.search(rf"{head if head in _HEADS[1:] else 'Thought'}: (.+?)(?=\s*Action:|$)", t, re.S) if not two and head != "Reflection" else None
    last = t.rsplit("Action:", 1)
    return {"reflection": two[1].strip() if two else None, "thought": two[2].strip() if two else one[1].strip() if one else None, "actions": last[1].split("\n\n") if len(last) == 2 else []}


def scale_box(text: str, width: float, height: float) -> list[float]:
    """Numbers of a box relative to the screen; a point becomes a box without extent."""
    n = [float(x) for x in re.sub(r"[()]", "", text).split(",")]
    rel = [x / (height if i % 2 else width) for i, x in enumerate(n)]
    return rel * 2 if len(rel) == 2 else rel


def structured(text: str | None, width: float = 1000, height: float = 1000) -> list[dict]:
    """One dict per readable action: reflection, thought, action_type and action_inputs (boxes scaled)."""
    if not text:
        return []
    s = split_text(text)
    out = []
    for a in s["actions"]:
        a = a.strip()
        m = _QUOTED.match(a)
        if m:
            a = f"{m[2]}(content='{escape_quotes(m[3])}')"
        call = parse_call(a.replace("\n", "\\n"))
        if call is None:
            continue
        inputs = {}
        for k, v in call["args"].items():
            if v in ("", None):
                continue
            v = v.lstrip() if isinstance(v, str) else str(v)
            try:
                inputs[k.strip()] = str(scale_box(v, width, height)) if "start_box" in k or "end_box" in k else v
            except ValueError:
                inputs[k.strip()] = v
        out.append({"reflection": s["reflection"], "thought": s["thought"], "action_type": call["function"], "action_inputs": json.dumps(inputs)})
    return out


def to_code(action_type: str | None, inputs: dict, width: int, height: int) -> str | None:
    """The automation call of an action as text; null for unknown ones."""

    def point(name: str) -> tuple[float, float]:
        b = [float(x) for x in re.findall(r"-?\d+(?:\.\d+)?(?:e-?\d+)?", str(inputs[name]))]
        b = b * 2 if len(b) == 2 else b
        return round((b[0] + b[2]) / 2 * width, 3), round((b[1] + b[3]) / 2 * height, 3)

    try:
        if action_type in ("click", "left_single", "left_double", "right_single", "hover"):
            x, y = point("start_box")
            call = {"click": "click({}, {}, button='left')", "left_single": "click({}, {}, button='left')", "left_double": "doubleClick({}, {}, button='left')", "right_single": "click({}, {}, button='right')", "hover": "moveTo({}, {})"}[action_type]
            return "pyautogui." + call.format(x, y)
        if action_type in ("drag", "select"):
            (a, b), (x, y) = point("start_box"), point("end_box")
            return f"pyautogui.moveTo({a}, {b})\npyautogui.dragTo({x}, {y}, duration=1.0)"
        if action_type == "hotkey":
            keys = str(inputs.get("key", inputs.get("hotkey", ""))).split()
            return f"pyautogui.hotkey({', '.join(repr(k) for k in keys)})" if keys else None
        if action_type in ("press", "keydown", "keyup", "release"):
            key = str(inputs.get("key", inputs.get("press", "")))
            return {"press": "pyautogui.press({!r})", "keydown": "pyautogui.keyDown({!r})", "keyup": "pyautogui.keyUp({!r})", "release": "pyautogui.keyUp({!r})"}[action_type].format(key)
        if action_type == "type":
            text = str(inputs.get("content", ""))
            enter = "\npyautogui.press('enter')" if text.endswith("\n") else ""
            return f"pyautogui.write({text.rstrip(chr(10))!r}, interval=0.1){enter}"
        if action_type == "scroll":
            way = str(inputs.get("direction", "")).lower()
            at = ", x={}, y={}".format(*point("start_box")) if "start_box" in inputs else ""
            return f"pyautogui.scroll({5 if 'up' in way else -5}{at})" if "up" in way or "down" in way else None
        return {"wait": "WAIT", "finished": "DONE", "call_user": "FAIL"}.get(action_type or "")
    except (KeyError, IndexError, ValueError):
        return None


# Names that models use for keys, and those of the automation library.
KEY_NAMES = {"arrowleft": "left", "arrowright": "right", "arrowup": "up", "arrowdown": "down", "space": " "}
#: actions that are an outcome instead of code
OUTCOMES = {"finished": "DONE", "wait": "WAIT", "call_user": "FAIL"}
_CLICKS = {"click": "click", "left_single": "click", "left_double": "doubleClick", "right_single": "click"}


def _middle(box: object, width: int, height: int) -> tuple[float, float]:
    n = [float(x) for x in re.findall(r"-?\d+(?:\.\d+)?(?:e-?\d+)?", str(box))]
    left, top, right, bottom = n * 2 if len(n) == 2 else n
    return round((left + right) / 2 * width, 3), round((top + bottom) / 2 * height, 3)


def _lines(kind: str | None, inputs: dict, width: int, height: int, paste: bool) -> str:
    """Code of one action, each line after a line end."""
    call = lambda name, *args: f"\npyautogui.{name}({', '.join(args)})"
    key = lambda *names: next((str(inputs[n]) for n in names if inputs.get(n)), "")
    if kind == "hotkey":
        keys = KEY_NAMES.get(key("key", "hotkey"), key("key", "hotkey"))
        parts = [" "] if keys == " " else [KEY_NAMES["space"] if k == "space" else k for k in keys.split()]
        return call("hotkey", *map(repr, parts)) if keys else ""
    if kind == "press":
        k = key("key", "press")
        return call("press", repr(KEY_NAMES.get(k, k))) if k else ""
    if kind in ("keyup", "keydown"):
        return call("keyUp" if kind == "keyup" else "keyDown", repr(str(inputs.get("key", ""))))
    if kind == "type":
        text = escape_quotes(str(inputs.get("content", "")))
        if not text:
            return ""
        ends = text.endswith(("\n", "\\n"))
        body = text.rstrip("\\n").rstrip("\n") if ends else text
        put = f"\nimport pyperclip\npyperclip.copy('{body}')" + call("hotkey", "'ctrl'", "'v'") if paste else call("write", f"'{body}'", "interval=0.1")
        return put + "\ntime.sleep(0.5)\n" + (call("press", "'enter'") if ends else "")
    if kind in ("drag", "select"):
        if not (inputs.get("start_box") and inputs.get("end_box")):
            return ""
        ends = [map(str, _middle(inputs[n], width, height)) for n in ("start_box", "end_box")]
        return call("moveTo", *ends[0]) + "\n" + call("dragTo", *ends[1], "duration=1.0") + "\n"
    if kind == "scroll":
        way = str(inputs.get("direction", "")).lower()
        place = [f"{n}={v}" for n, v in zip("xy", _middle(inputs["start_box"], width, height))] if inputs.get("start_box") else []
        return call("scroll", "5", *place) if "up" in way else call("scroll", "-5", *place) if "down" in way else ""
    if kind in (*_CLICKS, "hover"):
        at = [str(v) for v in _middle(inputs.get("start_box"), width, height)]
        if kind == "hover":
            return call("moveTo", *at)
        return call(_CLICKS[kind], *at, f"button='{'right' if kind == 'right_single' else 'left'}'")
    return f"\n# Unrecognized action type: {kind}"


def script(actions: list[dict], width: int, height: int, paste: bool = True) -> str | None:
    """One script of several actions: imports, what was observed and thought, then each action after a pause.

    An outcome (finished, wait, call_user) takes the place of all before it. Null where a box can't be read.
    """
    out = "import pyautogui\nimport time\n"
    try:
        for no, a in enumerate(actions):
            out += f"'''\nObservation:\n{a.get('observation') or ''}\n\nThought:\n{a.get('thought') or ''}\n'''\n" if no == 0 else "\ntime.sleep(1)\n"
            kind = a.get("action_type")
            out = OUTCOMES[kind] if kind in OUTCOMES else out + _lines(kind, a.get("action_inputs") or {}, width, height, paste)
    except (ValueError, TypeError):
        return None
    return out


def accessibility_table(xml: str | None) -> str:
    """Tab-separated rows (tag, name, text, class, description, position, size) of the nodes with a position and a name or text."""
    out = ["tag\tname\ttext\tclass\tdescription\tposition (top-left x&y)\tsize (w&h)"]
    try:
        nodes = ET.fromstring(xml or "").iter()
    except ET.ParseError:
        return out[0]
    for n in nodes:
        at = {k.rpartition("}")[2]: v for k, v in n.attrib.items()}
        name, text = at.get("name", ""), (n.text or "").strip()
        if "screencoord" in at and (name or text):
            quoted = text if '"' not in text else '"' + text.replace('"', '""') + '"'
            out.append("\t".join([n.tag.rpartition("}")[2], name, quoted, at.get("class", ""), at.get("description", ""), at["screencoord"], at.get("size", "")]))
    return "\n".join(out)


ship_by_value(sys.modules[__name__])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])



@F.pandas_udf(T.ArrayType(_texts("reflection", "thought", "action_type", "action_inputs")))
def structured_udf(text: pd.Series) -> pd.Series:
    return pd.Series([structured(t) for t in text])


@F.pandas_udf(_texts("function", "args"))
def parse_call_udf(text: pd.Series) -> pd.DataFrame:
    found = [parse_call(t) for t in text]
    return pd.DataFrame({"function": [f and f["function"] for f in found], "args": [json.dumps(f["args"], default=str) if f else None for f in found]})


@F.pandas_udf(T.StringType())
def to_code_udf(action_type: pd.Series, inputs: pd.Series) -> pd.Series:
    return pd.Series([to_code(a, json.loads(i) if i else {}, 1920, 1080) for a, i in zip(action_type, inputs)])


@F.pandas_udf(T.StringType())
def script_udf(reply: pd.Series) -> pd.Series:
    """The script of all actions of a reply on a screen of 1920 x 1080; boxes count thousandths."""

    def one(t):
        found = structured(t)
        return script([{**a, "action_inputs": json.loads(a["action_inputs"])} for a in found], 1920, 1080) if found else None

    return pd.Series([one(t) for t in reply], dtype=object)


@F.pandas_udf(T.StringType())
def accessibility_udf(xml: pd.Series) -> pd.Series:
    return pd.Series([accessibility_table(x) for x in xml])
