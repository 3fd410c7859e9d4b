"""Secrets: fixed patterns, and literals that source or configuration text assigns to sensitive names.

The lexer reads ``name <operator> value`` pairs in the syntaxes common to code and configuration
(``=``, ``:``, ``:=``, ``=>``; quoted names; a type between name and ``=``; quoted, joined or bare
values). A second pass goes over tokens with a stack of brackets, so that literals of any string
kind reach their target through groups, lists, alternatives and continued lines; blocks of indented
lines, and names and values in the attributes and elements of a markup, are pairs as well. Names
assigned to names are followed to their literals. A literal is a secret if its target's name and its own shape score
high enough together.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame

from shelfwatch.llm.common import free_names, map_slices

# fixed values: the base patterns
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # runs as HEX finds them, of 24 and more
KINDS = ("assign", "access", "hex", "literal")

#: a text without any of these, lower-cased, has no base assignment
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

_STRING = r"(?:\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+')"
_NAME = r"[A-Za-z_](?:[A-Za-z0-9_]|[.-](?=[A-Za-z0-9_]))*+"
_BARE = r"[^\s\"'`,;(){}\[\]<>+]++"
_WORD = r"[A-Za-z_][A-Za-z_]*+(?:(?:\.|::)[A-Za-z_]++)*+[0-9]{0,3}(?![A-Za-z0-9_])"
# a declared type: a word with arguments, marks of references, arrays and options, alternatives
_ONE_TYPE = (
    r"(?:[&*]|\[[0-9]{0,9}\]|'[a-z_]++[ \t]++|(?:mut|const)[ \t]++){0,4}+" + _WORD
    + r"(?:\[(?:[^\[\]\n=]|\[[^\[\]\n=]{0,60}\]){0,60}\]|<(?:[^<>\n=]|<[^<>\n=]{0,60}>){0,60}>|\([0-9, ]{1,12}\)){0,3}+[?!]?"
)
_TYPE = rf"{_ONE_TYPE}(?:[ \t]*+\|[ \t]*+{_ONE_TYPE}){{0,4}}+"
# types that may follow a name without a colon; after var or const any type may
_PLAIN_TYPE = r"(?:\*|\[[0-9]{0,9}\]){0,2}+(?:string|str|text|bytes?|rune|any|interface\{\}|n?varchar2?|char|character varying)(?:\([0-9 ]{1,8}\))?"
_SET = r"[ \t]*+(?::=|=(?![=>~]))"
PAIR = re.compile(
    rf"(?<![A-Za-z0-9_.-])(?P<quote>[\"']?)(?P<name>{_NAME})(?P=quote)"
    rf"(?:\??[ \t]*+:[ \t]*+(?P<type>{_TYPE}){_SET}|[ \t]++(?P<plain>{_PLAIN_TYPE}){_SET}|(?:(?<=var)|(?<=const))[ \t]++(?P<declared>{_NAME})[ \t]++(?P<any>{_ONE_TYPE}){_SET}"
    rf"|[ \t]*+(?::=|=>|=(?!=)|:(?![:/])))[ \t]*+"
    rf"(?P<value>(?:{_STRING}(?![ \t]*+(?::|=>))|{_BARE})(?:[ \t]*+\+[ \t]*+(?:{_STRING}|{_NAME}))*+)"
)
TERM = re.compile(rf"(?P<string>{_STRING})|(?P<bare>{_BARE})")
_WHOLE_NAME = re.compile(rf"{_NAME}\Z")

_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
# how telling a part of a name is
_STRONG = {"password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "credential", "credentials", "passcode"}
_KEYED = {"api", "access", "private", "secret", "signing", "encryption", "auth", "service", "account", "storage"}
_WEAK = {"auth", "bearer", "authorization", "signature"}
#: a text without any of these, lower-cased and without separators, has no sensitive name
_TELLING = _STRONG | _WEAK | {"key"}
NAME_HINTS = tuple(sorted(h for h in _TELLING if not any(o in h for o in _TELLING - {h})))
_SEPARATORS = "_.-"
_OTHER_USE = {"count", "name", "length", "limit", "type", "id", "url", "uri", "path", "file", "field", "label", "hint", "policy", "expiry", "ttl", "max", "min", "size", "prompt", "index"}
_PLACEHOLDER = re.compile(r"example|changeme|change_me|placeholder|your|xxxx|\*\*\*|\$\{|\{\{|<|%\(|^(?:none|null|nil|true|false|undefined)$", re.I | re.A)
#: least joint score of a secret
ENOUGH = 5


def name_score(name: str) -> int:
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[-1] in _OTHER_USE:
        return 0
    joined = set(parts) | {a + b for a, b in zip(parts, parts[1:])}
    if joined & _STRONG or ("key" in parts and joined & _KEYED):
        return 3
    return 2 if joined & _WEAK else 0


def literal_score(value: str) -> int:
    if len(value) < 6 or _PLACEHOLDER.search(value):
        return -4
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    score = 1 + (entropy >= 3) + (n >= 16)
    score += any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return score - 2 * any(c.isspace() for c in value)


_MARKED = "|".join(rf"{q}(?:[^{q}\\\n]|\\.)*+{q}" for q in "\"'") + r"|`(?:[^`\\]|\\.)*+`"
_LONG = "|".join(rf"{q * 3}(?:[^{q}\\]|\\.|{q}(?!{q * 2}))*+{q * 3}" for q in "\"'")
_TOKENS = re.compile(
    rf"(?P<string>(?:(?<![A-Za-z0-9_])[rRbBuUfF]{{1,2}})?(?:{_LONG}|{_MARKED}))|(?P<name>{_NAME})|(?P<set>:=|=>|=(?![=~])|:(?![:/]))"
    r"|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<end>[;,])|(?P<line>\n)|(?P<other>\\\n|[^\s])",
    re.S,
)
#: after these a line goes on in the next one
_GOES_ON = {"set", "open", "other"}
_BLOCK = re.compile(
    rf"(?m)^(?P<indent>[ \t]*+)(?:-[ \t]++)?[\"']?(?P<name>{_NAME})[\"']?:[ \t]*+[|>][+-]?[0-9]?[ \t]*+\n"
    r"(?P<lines>(?:(?P=indent)[ \t]++\S[^\n]*+(?:\n|\Z))++)"
)
_ATTRIBUTES = re.compile(r"<[A-Za-z][^<>]*>")
_ATTRIBUTE = re.compile(r"\s(?P<key>[A-Za-z]++)\s*+=\s*+(?:\"(?P<a>[^\"]*+)\"|'(?P<b>[^']*+)')")
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})>\s*+(?P<value>[^<>\s]++)\s*+</(?P=name)>")


def _assigned(text: str) -> Iterator[tuple[str, int, int]]:
    """(target, start, end) of string literals, by one pass over the tokens.

    A string belongs to the target of the innermost bracket: groups and lists hand theirs on,
    arguments of a call and entries of a map have targets of their own.
    """
    stack: list[list] = [["top", None]]  # kind of bracket, target
    before, asked = None, False  # kind of the last token but line ends, and whether it is the sign of a choice
    tokens = _TOKENS.finditer(text)
    now = next(tokens, None)
    while now is not None:
        following = next(tokens, None)
        kind, context = now.lastgroup, stack[-1]
        if kind in ("name", "string") and not asked and following is not None and following.lastgroup == "set":
            context[1] = now["name"] or now["string"].lstrip("rRbBuUfF").strip("\"'`")
            before, asked, now = "set", False, next(tokens, None)
            continue
        if kind == "string" and context[1]:
            body = now["string"].lstrip("rRbBuUfF")
            marks = 3 if len(body) >= 6 and body[:3] in ('"' * 3, "'" * 3) else 1
            yield context[1], now.end() - len(body) + marks, now.end() - marks
        elif kind == "open":
            call = now["open"] != "{" and before in ("name", "close")
            own = "map" if now["open"] == "{" else "call" if call else "group"
            stack.append([own, context[1] if own == "group" else None])
        elif kind == "close" and len(stack) > 1:
            stack.pop()
        elif kind == "end" and (now["end"] == ";" or context[0] != "group"):
            context[1] = None
        elif kind == "line" and context[0] in ("top", "map") and before not in _GOES_ON:
            context[1] = None
        if kind != "line":
            before, asked = kind, now[0] == "?"
        now = following


def _blocks_and_markup(text: str) -> Iterator[tuple[str, int, int]]:
    """(name, start, end) of values in indented blocks, in attributes and in elements."""
    for m in _BLOCK.finditer(text):
        for line in re.finditer(r"\S(?:[^\n]*\S)?", m["lines"]):
            yield m["name"], m.start("lines") + line.start(), m.start("lines") + line.end()
    if "<" not in text:
        return
    for m in _ELEMENT.finditer(text):
        yield m["name"], m.start("value"), m.end("value")
    for tag in _ATTRIBUTES.finditer(text):
        found = {a["key"].lower(): a for a in _ATTRIBUTE.finditer(tag[0])}
        name = next((found[k] for k in ("key", "name", "id") if k in found), None)
        if name and (value := found.get("value")):
            group = "a" if value["a"] is not None else "b"
            yield name["a"] or name["b"] or "", tag.start() + value.start(group), tag.start() + value.end(group)


def _literals(text: str) -> list[tuple[int, int]]:
    """Literals in ``text`` that reach a sensitive name, directly or over other names."""
    values: dict[str, list[tuple[int, int]]] = {}
    refers: dict[str, set[str]] = {}
    for m in PAIR.finditer(text):
        # "a b = value": either word may be the name, the other one the type
        names = {m["declared"] or m["name"], m["plain"] or m["any"] or m["declared"] or m["name"]}
        groups = ["value"]
        if m["type"] and m["value"][0] not in "\"'":
            groups.append("type")  # no declaration for sure: "a: b = c" may assign b
        for name, group in ((n, g) for n in names for g in groups):
            at = m.start(group)
            for t in TERM.finditer(m[group]):
                if t["string"]:
                    values.setdefault(name, []).append((at + t.start() + 1, at + t.end() - 1))
                elif _WHOLE_NAME.match(t["bare"]):
                    refers.setdefault(name, set()).add(t["bare"])
                    values.setdefault(name, []).append((at + t.start(), at + t.end()))
                else:
                    values.setdefault(name, []).append((at + t.start(), at + t.end()))
    for name, i, j in (*_assigned(text), *_blocks_and_markup(text)):
        values.setdefault(name, []).append((i, j))
    found = set()
    for name in set(values) | set(refers):
        if not (weight := name_score(name)):
            continue
        seen, todo = {name}, [name]
        while todo:
            one = todo.pop()
            for i, j in values.get(one, ()):
                if text[i:j] not in values and weight + literal_score(text[i:j]) >= ENOUGH:
                    found.add((i, j))
            for other in refers.get(one, ()):
                if other in values and other not in seen:
                    seen.add(other)
                    todo.append(other)
    return sorted(found)


def spans(text: str | None) -> list[dict]:
    """All spans by start, then kind; ``from``/``to`` bound the secret itself inside the span.

    Positions are code points, ends exclusive. A null text has none. A literal inside a base span
    is not repeated.
    """
    text = text or ""
    low = text.lower()
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [("assign", m.start(), m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX_LONG.finditer(text)]
    for c in _SEPARATORS:
        low = low.replace(c, "")
    if any(h in low for h in NAME_HINTS):
        starts = sorted(s[1] for s in out)
        reach = list(accumulate((s[2] for s in sorted(out, key=lambda s: s[1])), max))
        for i, j in _literals(text):
            k = bisect_right(starts, i)
            if not k or reach[k - 1] < j:
                out.append(("literal", i, j, i, j))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [dict(zip(("kind", "start", "end", "from", "to"), s)) for s in out]


SPANS = "array<struct<kind:string,start:int,end:int,from:int,to:int>>"


def scan(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the spans of every whole text, none for null; repeated rows get the same ones.

    A column named like ``out`` is replaced. An empty table stays empty.
    """

    return map_slices(docs, f"`{out}` {SPANS}", text, lambda: lambda texts: {out: [spans(t) for t in texts]})


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; overlapping secrets as one.

    A null text stays null, and all columns stay, whatever their names. Repeated rows are treated
    alike; an empty table stays empty.
    """

    def clean(body: str | None) -> str | None:
        if not body:
            return body
        parts, at = [], 0
        for s in sorted((s["from"], s["to"]) for s in spans(body)):
            if s[0] >= at:
                parts += [body[at : s[0]], mark]
            at = max(at, s[1])
        return "".join(parts) + body[at:] if at else body

    names = [f"`{c}`" for c in docs.columns]
    (new,) = free_names(docs.columns, "clean")
    done = map_slices(docs, f"`{new}` string", text, lambda: lambda texts: {new: [clean(t) for t in texts]})
    return done.drop(text).withColumnRenamed(new, text).select(*names)
