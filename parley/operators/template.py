"""Chat templates, as tokenizer files carry them, as one column expression.

The part of the template language that chat templates live by: loops over lists, if / elif / else, output of sums of texts, and
white space control. Conditions and outputs are Python expressions in shape, so Python's own syntax tree is walked.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.text import WS

TAG = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.DOTALL)
#: What a name stands for: a column, a plain value, or attributes of it (``loop.first``).
Names = dict[str, object]


def read_template(path: str) -> tuple[str, Names]:
    """The template of a file, and the texts of its special tokens: a tokenizer's JSON settings, or the template alone."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if not path.endswith(".json"):
        return text, {}
    settings = json.loads(text)
    tokens = {k: v["content"] if isinstance(v, dict) else v for k, v in settings.items() if k.endswith("_token") and v}
    if not isinstance(settings.get("chat_template"), str):
        raise ValueError(f"{path}: no chat template")
    return settings["chat_template"], tokens


def _tokens(template: str) -> list[tuple[str, str]]:
    """('text', ...), ('out', expression) and ('tag', statement) in order. A line break behind a statement goes, as does the
    blank before one that begins a line; a dash takes all white space on its side."""
    parts, out = TAG.split(template), []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            before, after = parts[i - 1] if i else "", parts[i + 1] if i + 1 < len(parts) else ""
            if before.startswith(("{%", "{#")):
                part = re.sub(r"\A\n", "", part)
            if after.startswith(("{%", "{#")) and not after.startswith("{%+"):
                at_line = r"(?:\A|(?<=\n))" if not before or before.startswith(("{%", "{#")) else r"(?<=\n)"
                part = re.sub(rf"{at_line}[ \t]+\Z", "", part)
            if before.endswith(("-%}", "-}}")):
                part = part.lstrip()
            if after.startswith(("{%-", "{{-")):
                part = part.rstrip()
            if part:
                out.append(("text", part))
        elif not part.startswith("{#"):
            inner = part[2:-2].strip("-+").strip()
            out.append(("out" if part.startswith("{{") else "tag", inner))
    return out


def _text(c: object) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


class _Compiler:
    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at = tokens, 0

    def block(self, *ends: str) -> list[Callable[[Names], Column]]:
        """Parts up to one of the statements ``ends``, which is left to be read; each gives a text for the names at hand."""
        parts: list[Callable[[Names], Column]] = []
        while self.at < len(self.tokens):
            kind, body = self.tokens[self.at]
            if kind == "tag" and body.split(None, 1)[0] in ends:
                return parts
            self.at += 1
            if kind == "text":
                parts.append(lambda names, body=body: F.lit(body))
            elif kind == "out":
                tree = ast.parse(body, mode="eval").body
                parts.append(lambda names, tree=tree: F.coalesce(_text(value(tree, names)).cast("string"), F.lit("None")))
            else:
                parts.append(self.statement(body))
        if ends:
            raise ValueError(f"the template ends before {' or '.join(ends)}")
        return parts

    def statement(self, body: str) -> Callable[[Names], Column]:
        if m := re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", body, re.DOTALL):
            inner = self.block("endfor")
            self.at += 1
            return _loop(m[1], ast.parse(m[2], mode="eval").body, inner)
        if m := re.fullmatch(r"if\s+(.+)", body, re.DOTALL):
            return self.choice(m[1])
        raise ValueError(f"a statement that is not supported: {body}")

    def choice(self, condition: str) -> Callable[[Names], Column]:
        cases = []
        while True:
            inner = self.block("elif", "else", "endif")
            cases.append((None if condition is None else ast.parse(condition, mode="eval").body, inner))
            word, *rest = self.tokens[self.at][1].split(None, 1)
            self.at += 1
            if word == "endif":
                break
            condition = rest[0] if word == "elif" else None

        def chosen(names: Names) -> Column:
            out = None
            for test, inner in cases:
                body = joined(inner, names)
                if test is None:
                    return out.otherwise(body)
                holds = value(test, names)
                holds = F.coalesce(holds, F.lit(False)) if isinstance(holds, Column) else F.lit(bool(holds))
                out = F.when(holds, body) if out is None else out.when(holds, body)
            return out.otherwise("")

        return chosen


def _loop(name: str, over: ast.expr, inner: list[Callable[[Names], Column]]) -> Callable[[Names], Column]:
    def looped(names: Names) -> Column:
        rows = value(over, names)

        def one(x: Column, i: Column) -> Column:
            loop = {"first": i == 0, "last": i == F.size(rows) - 1, "index0": i, "index": i + 1, "length": F.size(rows)}
            return joined(inner, names | {name: x, "loop": loop})

        return F.array_join(F.transform(rows, one), "")

    return looped


def joined(parts: list[Callable[[Names], Column]], names: Names) -> Column:
    return F.concat(*[p(names) for p in parts]) if parts else F.lit("")


FILTERS = {"trim": lambda c: F.regexp_replace(_text(c), rf"(?U)^[{WS}]+|[{WS}]+\z", ""), "upper": lambda c: F.upper(_text(c)), "lower": lambda c: F.lower(_text(c)), "length": lambda c: F.size(c)}


def _member(held: object, key: object) -> object:
    """A field by its name, or an element by its place; null where there is none."""
    return held[key] if isinstance(held, dict) else F.get(held, key) if isinstance(key, int) else held[key]


def value(tree: ast.expr, names: Names) -> object:
    """What an expression stands for."""
    match tree:
        case ast.Constant(value=v):
            return v
        case ast.Name(id="true" | "True"):
            return True
        case ast.Name(id="false" | "False"):
            return False
        case ast.Name(id=name):
            if name not in names:
                raise ValueError(f"the template names {name}, which is not given")
            return names[name]
        case ast.Attribute(value=of, attr=key):
            return _member(value(of, names), key)
        case ast.Subscript(value=of, slice=ast.Constant(value=key)):
            return _member(value(of, names), key)
        case ast.Subscript(value=of, slice=ast.UnaryOp(op=ast.USub(), operand=ast.Constant(value=int(back)))):
            return F.try_element_at(value(of, names), F.lit(-back))
        case ast.Subscript(value=of, slice=ast.Slice(lower=ast.Constant(value=low), upper=None, step=None)):
            held = value(of, names)
            return F.slice(held, low + 1, F.greatest(F.size(held), F.lit(0)))
        case ast.BinOp(left=a, op=ast.BitOr(), right=ast.Name(id=f)) if f in FILTERS:
            return FILTERS[f](value(a, names))
        case ast.BinOp(left=a, op=ast.Add(), right=b):
            return F.concat(_text(value(a, names)), _text(value(b, names)))
        case ast.Compare(left=a, ops=[op], comparators=[b]):
            x, y = value(a, names), value(b, names)
            if isinstance(op, ast.In):
                return F.contains(_text(y), _text(x))
            return {ast.Eq: lambda: _text(x) == _text(y), ast.NotEq: lambda: _text(x) != _text(y), ast.Gt: lambda: _text(x) > _text(y), ast.Lt: lambda: _text(x) < _text(y)}[type(op)]()
        case ast.BoolOp(op=op, values=values):
            out, *rest = [_text(value(v, names)) for v in values]
            for r in rest:
                out = out & r if isinstance(op, ast.And) else out | r
            return out
        case ast.UnaryOp(op=ast.Not(), operand=v):
            return ~_text(value(v, names))
    raise ValueError(f"an expression that is not supported: {ast.unparse(tree)}")


def compiled(template: str, messages: Column, add_generation_prompt: bool = False, **names: object) -> Column:
    """The text of a template over an array of messages; ``names`` gives special tokens and other values. Expressions only, so
    rendering is part of the plan. A missing content prints as None, as the language has it; a sum with one is null and
    prints the same. What the template needs beyond the supported part raises ValueError before anything runs."""
    parts = _Compiler(_tokens(template)).block()
    return joined(parts, {"messages": messages, "add_generation_prompt": add_generation_prompt, **names})
