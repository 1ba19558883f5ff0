"""Chat templates given as text, as tokenizers carry them, made into one column expression.

The language is a small part of the usual one, declared here; anything else fails when the template is
compiled, never while rows are rendered:

* ``{% for message in messages %} … {% endfor %}``, once, not nested;
* ``{% if … %}``, ``{% elif … %}``, ``{% else %}``, ``{% endif %}``, anywhere;
* ``{{ … }}`` with text literals, ``message['role']``, ``message['content']`` (or with a dot),
  ``messages[0]['role']``, ``bos_token``, ``eos_token``, joined by ``+``, with the filters ``trim``, ``upper``
  and ``lower``;
* conditions: ``==``, ``!=``, ``and``, ``or``, ``not``, parentheses, ``loop.first``, ``loop.last``,
  ``add_generation_prompt``, ``true``, ``false``.

White space goes as tokenizers set it: a line break behind a block tag is dropped, and so are blanks between
the start of a line and a block tag; a dash in a tag drops all white space on its side.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigris.functions import text as T

_TAG = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\})", re.S)
_WORD = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(\d+)|(==|!=|[\[\].+|()]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_FILTERS: dict[str, Callable[[Column], Column]] = {"trim": T.strip, "upper": F.upper, "lower": F.lower}
_FIELDS = ("role", "content")


@dataclass(frozen=True)
class _Scope:
    """What names mean at one place: the messages, and inside the loop the message and its place."""

    messages: Column
    bos: str
    eos: str
    open_reply: bool
    message: Column | None = None
    place: Column | None = None


class _Expression:
    """One expression as a column; reads its words from left to right."""

    def __init__(self, source: str, scope: _Scope):
        self.source, self.scope, self.words, at = source, scope, [], 0
        while source[at:].strip():
            found = _WORD.match(source, at)
            if not found:
                raise self.unknown(source[at:].strip()[:20])
            self.words.append(found.group().strip())
            at = found.end()

    def unknown(self, what: str) -> ValueError:
        return ValueError(f"chat template: {what!r} is not known here: {self.source.strip()!r}")

    def take(self, *wanted: str) -> str | None:
        return self.words.pop(0) if self.words and self.words[0] in wanted else None

    def need(self, *wanted: str) -> str:
        word = self.take(*wanted)
        if word is None:
            raise self.unknown(self.words[0] if self.words else "the end")
        return word

    def whole(self, rule: Callable[[], Column]) -> Column:
        found = rule()
        if self.words:
            raise self.unknown(self.words[0])
        return found

    def either(self) -> Column:
        found = self.both()
        while self.take("or"):
            found = found | self.both()
        return found

    def both(self) -> Column:
        found = self.negated()
        while self.take("and"):
            found = found & self.negated()
        return found

    def negated(self) -> Column:
        if self.take("not"):
            return ~self.negated()
        if self.take("("):
            found = self.either()
            self.need(")")
            return found
        flag = self.take("true", "True", "false", "False")
        if flag:
            return F.lit(flag.lower() == "true")
        if self.take("add_generation_prompt"):
            return F.lit(self.scope.open_reply)
        if self.scope.place is not None and self.take("loop"):
            self.need(".")
            end = F.lit(0) if self.need("first", "last") == "first" else F.size(self.scope.messages) - 1
            return self.scope.place == end
        left = self.joined()
        same = self.need("==", "!=") == "=="
        right = self.joined()
        return (left == right) if same else (left != right)

    def joined(self) -> Column:
        parts = [self.filtered()]
        while self.take("+"):
            parts.append(self.filtered())
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def filtered(self) -> Column:
        found = self.atom()
        while self.take("|"):
            found = _FILTERS[self.need(*_FILTERS)](found)
        return found

    def atom(self) -> Column:
        if self.words and self.words[0][0] in "'\"":
            return F.lit(re.sub(r"\\(.)", lambda escape: self.escaped(escape.group(1)), self.words.pop(0)[1:-1], flags=re.S))
        if self.take("bos_token"):
            return F.lit(self.scope.bos)
        if self.take("eos_token"):
            return F.lit(self.scope.eos)
        if self.scope.message is not None and self.take("message"):
            return self.field(self.scope.message)
        self.need("messages")
        self.need("[")
        if not (self.words and self.words[0].isdigit()):
            raise self.unknown(self.words[0] if self.words else "the end")
        number = int(self.words.pop(0))
        self.need("]")
        return self.field(F.get(self.scope.messages, F.lit(number)))

    def escaped(self, letter: str) -> str:
        if letter not in _ESCAPES:
            raise self.unknown("\\" + letter)
        return _ESCAPES[letter]

    def field(self, message: Column) -> Column:
        if self.take("."):
            name = self.need(*_FIELDS)
        else:
            self.need("[")
            name = self.need(*(f"{quote}{field}{quote}" for field in _FIELDS for quote in "'\""))[1:-1]
            self.need("]")
        return F.coalesce(message[name], F.lit(""))


def _pieces(source: str) -> list[str]:
    """Text and tags in turn, with the white space that tags take away gone."""
    parts = _TAG.split(source.removesuffix("\n"))
    for n in range(0, len(parts), 2):
        before, after = parts[n - 1] if n else "", parts[n + 1] if n + 1 < len(parts) else ""
        if before.endswith(("-%}", "-}}")):
            parts[n] = parts[n].lstrip()
        elif before.endswith("%}"):
            parts[n] = parts[n].removeprefix("\n")
        if after.startswith(("{%-", "{{-")):
            parts[n] = parts[n].rstrip()
        elif after.startswith("{%"):
            # At the start of a line, or of the template.
            kept = parts[n].rstrip(" \t")
            if kept.endswith("\n") or not kept and (not n or before.endswith("%}") and parts[n] != kept):
                parts[n] = kept
    return [part for part in parts if part]


class _Body:
    """Blocks as columns; reads pieces up to the tag that closes a block."""

    def __init__(self, source: str):
        self.pieces, self.looped = _pieces(source), False

    def tag(self, piece: str) -> str:
        return piece[2:-2].removeprefix("-").removesuffix("-").strip()

    def text(self, scope: _Scope, closing: tuple[str, ...]) -> tuple[Column, str]:
        """The text up to a closing tag, and that tag."""
        parts = [F.lit("")]
        while self.pieces:
            piece = self.pieces.pop(0)
            if piece.startswith("{{"):
                expression = _Expression(self.tag(piece), scope)
                parts.append(expression.whole(expression.joined))
            elif not piece.startswith("{%"):
                parts.append(F.lit(piece))
            elif (tag := self.tag(piece)).split(" ")[0] in closing:
                return F.concat(*parts), tag
            elif tag.split(" ")[0] == "if":
                parts.append(self.branches(tag.removeprefix("if"), scope))
            elif " ".join(tag.split()) == "for message in messages" and scope.message is None and not self.looped:
                self.looped = True
                parts.append(self.loop(scope))
            else:
                raise ValueError(f"chat template: {piece!r} is not known here")
        if closing:
            raise ValueError(f"chat template: {closing[-1]} is missing")
        return F.concat(*parts), ""

    def branches(self, condition: str, scope: _Scope) -> Column:
        chosen, tag = None, "if"
        while tag != "endif":
            if tag == "else":
                held, tag = self.text(scope, ("endif",))
                return chosen.otherwise(held)
            expression = _Expression(condition, scope)
            holds = expression.whole(expression.either)
            held, tag = self.text(scope, ("elif", "else", "endif"))
            chosen = F.when(holds, held) if chosen is None else chosen.when(holds, held)
            tag, condition = tag.split(" ")[0], tag.removeprefix("elif")
        return chosen.otherwise("")

    def loop(self, scope: _Scope) -> Column:
        # The loop's body is compiled inside the function that Spark calls with the turn and its place.
        closed: list[str] = []

        def turn(message: Column, place: Column) -> Column:
            inner = _Scope(scope.messages, scope.bos, scope.eos, scope.open_reply, message, place)
            held, tag = self.text(inner, ("endfor",))
            closed.append(tag)
            return held

        return F.array_join(F.transform(scope.messages, turn), "")


@dataclass(frozen=True)
class TextTemplate:
    """A template text with its special tokens; renders like a declared ``ChatTemplate``."""

    source: str
    bos_token: str = ""
    eos_token: str = ""

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        """The text of one record. Null roles and contents are empty text; null messages give null."""
        scope = _Scope(messages, self.bos_token, self.eos_token, add_generation_prompt)
        return F.when(messages.isNotNull(), _Body(self.source).text(scope, ())[0])
