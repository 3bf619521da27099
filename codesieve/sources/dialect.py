"""Regexes of rule packs, read as a tree and written anew for the JVM.

Packs are written in the dialect of Python's ``re``.  Java reads the same characters otherwise in places: brackets and ``&&``
inside classes, group names, comments, conditionals, a backreference before a digit, ``^`` after the last line end, ``\\Z``.
Therefore nothing is replaced in the text: it is parsed, and the tree is printed.  Groups are printed without names, so
their numbers stay; a group that a conditional asks for gets an empty group at its end, which is set exactly if it is.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle

try:
    from re import _constants as ops
    from re import _parser as regex_tree
except ImportError:  # Python 3.10
    import sre_constants as ops
    import sre_parse as regex_tree

# Workers get these functions by value: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of nodes go by name: the constants themselves cannot be sent to workers.
REPEATS = {"MAX_REPEAT": "", "MIN_REPEAT": "?", "POSSESSIVE_REPEAT": "+"}
ATOMIC = "ATOMIC_GROUP"
CATEGORIES = {"CATEGORY_DIGIT": "\\d", "CATEGORY_NOT_DIGIT": "\\D", "CATEGORY_SPACE": "\\s", "CATEGORY_NOT_SPACE": "\\S",
              "CATEGORY_WORD": "\\w", "CATEGORY_NOT_WORD": "\\W"}
#: Categories that hold the line end.
CROSSING = {"CATEGORY_SPACE", "CATEGORY_NOT_DIGIT", "CATEGORY_NOT_WORD"}
NOTHING = "(?!)"


def parsed(regex: str):
    """The tree of a regex; None if it is none of this dialect."""
    try:
        re.compile(regex)
        return regex_tree.parse(regex)
    except (re.error, RecursionError, OverflowError, TypeError):
        return None


def children(op, arg) -> list:
    """The trees inside a node."""
    if op is ops.SUBPATTERN:
        return [arg[3]]
    if op is ops.BRANCH:
        return list(arg[1])
    if op.name in REPEATS:
        return [arg[2]]
    if op in (ops.ASSERT, ops.ASSERT_NOT):
        return [arg[1]]
    if op is ops.GROUPREF_EXISTS:
        return [tree for tree in arg[1:] if tree is not None]
    return [arg] if op.name == ATOMIC else []


def nodes(tree: Iterable) -> Iterator[tuple]:
    """All nodes of a tree, in the order in which they are printed."""
    for op, arg in tree:
        yield op, arg
        for child in children(op, arg):
            yield from nodes(child)


class _Printer:
    """Prints one tree; ``whole_text`` lets ``^`` and ``$`` match at every line."""

    def __init__(self, tree, whole_text: bool):
        self.asked = {arg[0] for op, arg in nodes(tree) if op is ops.GROUPREF_EXISTS}
        self.numbers: dict[int, int] = {}
        self.marks: dict[int, int] = {}
        self._number(tree, 0)
        self.lines, self.dots, self.ignore_case = whole_text, False, False

    def _number(self, tree: Iterable, last: int) -> int:
        """Numbers of groups as Java counts them: by their opening brackets, empty groups included."""
        for op, arg in tree:
            group = arg[0] if op is ops.SUBPATTERN else None
            if group is not None:
                last = self.numbers[group] = last + 1
            for child in children(op, arg):
                last = self._number(child, last)
            if group in self.asked:
                last = self.marks[group] = last + 1
        return last

    def sequence(self, tree: Iterable) -> str:
        return "".join(self.node(op, arg) for op, arg in tree)

    def node(self, op, arg) -> str:
        if op is ops.LITERAL:
            return character(arg)
        if op is ops.NOT_LITERAL:
            return f"[^{character(arg)}]"
        if op is ops.ANY:
            return "(?s:.)" if self.dots else "."
        if op is ops.IN:
            return character_class(arg)
        if op is ops.BRANCH:
            return "(?:" + "|".join(self.sequence(option) for option in arg[1]) + ")"
        if op is ops.SUBPATTERN:
            return self.group(*arg)
        if op.name in REPEATS:
            return self.repeat(op, *arg)
        if op is ops.AT:
            return self.place(arg)
        if op in (ops.ASSERT, ops.ASSERT_NOT):
            sign = "=" if op is ops.ASSERT else "!"
            return f"(?{'<' if arg[0] < 0 else ''}{sign}{self.sequence(arg[1])})"
        if op is ops.GROUPREF:
            return f"(?:\\{self.numbers[arg]})"
        if op is ops.GROUPREF_EXISTS:
            mark = f"\\{self.marks[arg[0]]}"
            no = self.sequence(arg[2]) if arg[2] is not None else ""
            return f"(?:(?:{mark}){self.sequence(arg[1])}|(?!{mark}){no})"
        if op.name == ATOMIC:
            return f"(?>{self.sequence(arg)})"
        if op is ops.FAILURE:
            return NOTHING
        raise ValueError(f"cannot print {op}")

    def group(self, group: int | None, on: int, off: int, tree: Iterable) -> str:
        before = self.lines, self.dots, self.ignore_case
        self.lines = (self.lines or bool(on & re.MULTILINE)) and not off & re.MULTILINE
        self.dots = (self.dots or bool(on & re.DOTALL)) and not off & re.DOTALL
        self.ignore_case = (self.ignore_case or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE
        flags = "" if self.ignore_case == before[2] else "i" if self.ignore_case else "-i"
        if on & re.ASCII:
            flags = flags + "-U" if "-" not in flags else flags + "U"
        body = self.sequence(tree)
        self.lines, self.dots, self.ignore_case = before
        if flags:
            body = f"(?{flags}:{body})"
        if group is None:
            return body if flags else f"(?:{body})"
        return f"({body}{'()' if group in self.asked else ''})"

    def repeat(self, op, least: int, most: int, tree) -> str:
        body = self.sequence(tree)
        one = len(tree) == 1 and tree[0][0] in (ops.LITERAL, ops.NOT_LITERAL, ops.IN, ops.ANY, ops.SUBPATTERN, ops.BRANCH)
        if not one:
            body = f"(?:{body})"
        if most is ops.MAXREPEAT or most == ops.MAXREPEAT:
            times = {0: "*", 1: "+"}.get(least, f"{{{least},}}")
        else:
            times = "?" if (least, most) == (0, 1) else f"{{{least}}}" if least == most else f"{{{least},{most}}}"
        return body + times + REPEATS[op.name]

    def place(self, at) -> str:
        if at is ops.AT_BEGINNING:
            return "(?:^|(?<=\\n))" if self.lines else "^"
        if at is ops.AT_END:
            return "(?=\\n|\\z)" if self.lines else "$"
        return {ops.AT_BEGINNING_STRING: "\\A", ops.AT_END_STRING: "\\z", ops.AT_BOUNDARY: "\\b",
                ops.AT_NON_BOUNDARY: "\\B"}[at]


def character(code: int) -> str:
    """A character as Java reads it, inside and outside of classes."""
    char = chr(code)
    if char.isalnum() or char in "_ \"'`=:;,/<>%@~#!":
        return char if char not in "#" else "\\#"
    if 33 <= code < 127:
        return "\\" + char
    return {"\n": "\\n", "\t": "\\t", "\r": "\\r"}.get(char, f"\\x{{{code:x}}}")


def character_class(items: list) -> str:
    out, negated = "", False
    for op, arg in items:
        if op is ops.NEGATE:
            negated = True
        elif op is ops.LITERAL:
            out += character(arg)
        elif op is ops.RANGE:
            out += f"{character(arg[0])}-{character(arg[1])}"
        else:
            out += CATEGORIES[arg.name]
    return CATEGORIES[items[0][1].name] if len(items) == 1 and items[0][0] is ops.CATEGORY else f"[{'^' * negated}{out}]"


def java_spelling(regex: str, unicode: bool = False, whole_text: bool = False) -> str | None:
    """The regex for Java; None if it is none of the packs' dialect.

    ``whole_text`` lets ``^`` and ``$`` match at every line.  ``unicode`` widens ``\\w``, ``\\s``, ``\\b`` and the
    ignoring of case beyond ASCII.
    """
    tree = parsed(regex)
    if tree is None:
        return None
    flags = tree.state.flags
    printer = _Printer(tree, whole_text or bool(flags & re.MULTILINE))
    printer.dots, printer.ignore_case = bool(flags & re.DOTALL), bool(flags & re.IGNORECASE)
    wide = unicode and not flags & re.ASCII
    return f"(?d{'i' * printer.ignore_case}{'U' * wide}){printer.sequence(tree)}"


def crosses_lines(regex: str) -> bool:
    """True if a match of ``regex`` may hold a line end, so that single lines cannot show all its matches."""
    tree = parsed(regex)
    return tree is not None and _crosses(tree, bool(tree.state.flags & re.DOTALL))


def _crosses(tree: Iterable, dots: bool) -> bool:
    for op, arg in tree:
        if op is ops.LITERAL and arg == 10 or op is ops.NOT_LITERAL and arg != 10 or op is ops.ANY and dots:
            return True
        if op is ops.IN and _holds_line_end(arg):
            return True
        inside = dots
        if op is ops.SUBPATTERN:
            inside = (dots or bool(arg[1] & re.DOTALL)) and not arg[2] & re.DOTALL
        # What is looked at but not consumed counts too: the line alone does not show it.
        if any(_crosses(child, inside) for child in children(op, arg)):
            return True
    return False


def _holds_line_end(items: list) -> bool:
    found = any(op is ops.LITERAL and arg == 10 or op is ops.RANGE and arg[0] <= 10 <= arg[1]
                or op is ops.CATEGORY and arg.name in CROSSING for op, arg in items)
    return found != (items[0][0] is ops.NEGATE)
