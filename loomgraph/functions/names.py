"""Names with broken markup: entities, LaTeX, letters split by spaces.

What regular expressions of the JVM can say is said there; only values with a backslash or brace pass one tokenizer in
Arrow. The order is fixed by the results: entities, markup, white space, split letters, broken tail.
"""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.nt import strip
from loomgraph.functions.text import ASCII, arrow

#: Accent commands of LaTeX and their combining marks; letters with commands of their own; commands of
#: inline formulas and their signs.
ACCENTS = {'"': "̈", "'": "́", "’": "́", "´": "́", "`": "̀", "~": "̃", "c": "̧", "^": "̂", "v": "̌"}
LETTERS = {"ss": "ß", "SS": "ẞ", "o": "ø", "O": "Ø", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "aa": "å", "AA": "Å", "l": "ł", "L": "Ł", "i": "i", "j": "j"}
SIGNS = {"parallel": "∥"}

_MARKS = "[" + re.escape("".join(ACCENTS)) + "]"
_RUN = re.compile(r"(?:\\\s*)+")
_GAP = re.compile(r"\s*")


class Markup:
    """One pass over a text with LaTeX markup. ``done`` holds characters that are settled; ``at`` is the next one of
    ``text``. Backslashes come in runs, which a mark or command after them claims as a whole; a run that nothing claims
    stands for spaces, or for the character it protects."""

    def __init__(self, text: str, breaks: bool):
        self.text, self.at, self.breaks, self.done = text, 0, breaks, []

    def resolved(self) -> str:
        while self.at < len(self.text):
            if self.text[self.at] == "\\":
                self.command()
            else:
                self.plain(self.text[self.at])
                self.at += 1
        return "".join(self.done)

    def plain(self, c: str) -> None:
        """A character as it is; a closing brace takes the pair away if it holds one visible character or none."""
        held = self.done
        if c == "}" and held and held[-1] == "{":
            held.pop()
        elif c == "}" and len(held) > 1 and held[-2] == "{" and held[-1] != "}" and not held[-1].isspace():
            del held[-2]
        else:
            held.append(c)

    def command(self) -> None:
        run = _RUN.match(self.text, self.at)
        found = self.accented(self.at) or self.letter(run.end())
        if found:
            self.joined(*found)
        elif not self.formula(run.end()):
            self.protected(run)

    def joined(self, letter: str, end: int) -> None:
        """A letter takes the white space on both sides, and a brace before and after it."""
        while self.done and self.done[-1].isspace():
            self.done.pop()
        if self.done and self.done[-1] == "{":
            self.done.pop()
        self.done += letter
        self.at = _GAP.match(self.text, end).end()
        if self.text.startswith("}", self.at):
            self.at += 1

    def accented(self, at: int) -> tuple[str, int] | None:
        """The letter of an accent command at a place, and the place after it. The letter may be accented itself."""
        run = _RUN.match(self.text, at)
        mark = ACCENTS.get(self.text[run.end() : run.end() + 1]) if run else None
        if mark is None:
            return None
        at = _GAP.match(self.text, run.end() + 1).end()
        wrapped = self.text.startswith("{", at)
        at = _GAP.match(self.text, at + wrapped).end()
        dotless = self.text.startswith(("\\i", "\\j"), at)
        c = self.text[at + dotless : at + dotless + 1]
        base = (c, at + dotless + 1) if c.isalpha() else self.accented(at)
        if base is None:
            return None
        letter, end = base
        if wrapped:
            end = _GAP.match(self.text, end).end()
            if not self.text.startswith("}", end):
                return None
            end += 1
        return unicodedata.normalize("NFC", letter.replace("ı", "i") + mark), end

    def letter(self, at: int) -> tuple[str, int] | None:
        return next(((LETTERS[name], at + n) for n in (2, 1) if (name := self.text[at : at + n]) in LETTERS), None)

    def formula(self, at: int) -> bool:
        r"""``\( ... \)`` gives way to its content, which is read again."""
        end = self.text.find("\\)", at + 1)
        if not self.text.startswith("\\(", at - 1) or end < 0 or "\n" in self.text[at:end]:
            return False
        inside = re.sub(r"\\([A-Za-z]+)", lambda m: SIGNS.get(m[1], m[0]), self.text[at + 1 : end])
        self.text = self.text[: at - 1] + re.sub(r"\\\s+", " ", inside).strip() + self.text[end + 2 :]
        return True

    def protected(self, run: re.Match) -> None:
        next_ = self.text[run.end() : run.end() + 1]
        self.at = run.end()
        for m in re.finditer(r"(\\+)(\s*)", run[0]):
            n, last = len(m[1]), m.end() == len(run[0]) and not m[2]
            space = bool(m[2]) or last and next_ != "" and next_ in ",;:!"
            n -= space or last and next_ != "" and next_ in "&#%_{}"
            for c in " " * (n // 2) + "\\" * (n % 2) if self.breaks else "\\" * n:
                self.done.append(c)
            if space:
                self.done.append(" ")
                self.at += last


def markup_resolved(text: str, breaks: bool = True) -> str:
    """A text without accent commands, letter commands, escapes and single braces; breaks: a double backslash is a space."""
    return Markup(text, breaks).resolved()


def entities_decoded(x: Column, only: str | None = None) -> Column:
    """HTML entities as characters, backslashes before them dropped; texts without an ampersand stay in the JVM.
    only: one entity as it is written, semicolon and all; it alone is decoded, once, and everything else stays, backslashes
    and entities without their end too. That needs no Python."""
    if only is not None:
        return F.replace(x, F.lit(only), F.lit(html.unescape(only)))
    f = arrow(lambda t: html.unescape(re.sub(r"\\+(?=&(?:#\d+|#x[0-9A-Fa-f]+|[A-Za-z]+);)", "", t)))
    return F.when(F.contains(x, F.lit("&")), f(F.when(F.contains(x, F.lit("&")), x))).otherwise(x)


def repeated(x: Column, pattern: str, by: str, times: int) -> Column:
    """A replacement done again on its result, so that matches that share a border are all found."""
    for _ in range(times):
        x = F.regexp_replace(x, pattern, by)
    return x


def joined_umlauts(x: Column) -> Column:
    """A lone non-ASCII character between letters joined to both, up to four times."""
    return repeated(x, r"(?U)(?<=[A-Za-z])\s+([^\x00-\x7F])\s+(?=[A-Za-z])", "$1", 4)


def name_repaired(x: Column) -> Column:
    """A name without entities, LaTeX markup, split letters and a broken end; null stays null."""
    x = entities_decoded(x)
    marked = x.rlike(r"[\\{}]")
    x = F.when(marked, arrow(markup_resolved)(F.when(marked, x))).otherwise(x)
    x = joined_umlauts(strip(F.regexp_replace(x, r"(?U)\s{2,}", " ")))
    tail = rf"(?U)\s*\{{?\s*(?:\\\s*)+{_MARKS}?\s*$"
    return F.when(x.rlike(r"\\"), F.regexp_replace(F.regexp_replace(x, tail, ""), tail, "")).otherwise(x)


#: What tells that markup is left: a backslash at the end, a group that begins with a command, a quote at a brace, an accent
#: without letter, an accent before white space or brace.
CORRUPT = [r"\\$", r"\{\\", r"(?U)\{\s*[\"'`]|[\"'`]\s*\}", rf"(?U)\\++{_MARKS}\s*+(?!\p{{L}}|\{{\p{{L}}\}})", rf"(?U)(?:^|[^\\])\\{_MARKS}\s*[}}\s]"]


def name_corrupt(x: Column) -> Column:
    """Whether a repaired name still has broken markup, or braces that do not match; null is not corrupt."""
    n = lambda c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))
    broken = n("{") != n("}")
    for pattern in CORRUPT:
        broken |= x.rlike(pattern)
    return F.coalesce(x.rlike(r"[\\{}]") & broken, F.lit(False))


def name_score(x: Column) -> Column:
    letters, wide = F.regexp_replace(x, r"[^\p{L}]", ""), F.regexp_replace(x, r"[^\p{L}]|[\x00-\x7F]", "")
    n = F.length(wide)
    return (F.length(x) + F.least(F.length(letters), F.lit(200)) + F.when(n > 0, n * 10 + 1000).otherwise(0) - F.when(x.rlike(r"[\\{}]"), 500).otherwise(0) - F.when(F.length(strip(x)) <= 3, 300).otherwise(0)).cast("long")


_L = r"[\p{L}\p{Nl}\p{No}]"


def problem_name_repaired(x: Column) -> Column:
    """A name (unescaped) with the damage of a lost LaTeX conversion mended: diaereses and sharp s, names split around
    umlauts or after hyphens, a known wrong ``forür``, spaces before commas; in composed form."""
    x = F.regexp_replace(x, r'(?U)\\\s*"\s*(?:\{\s*([A-Za-z])\s*\}|([A-Za-z])(?=\s))', "$1$2\u0308")
    for c in "aouAOU":
        x = F.replace(x, F.lit(c + "\u0308"), F.lit(unicodedata.normalize("NFC", c + "\u0308")))
    for command, letter in (("ss", "ß"), ("SS", "ẞ")):
        x = F.regexp_replace(x, rf"(?U)({_L})\s*\\\s*{command}\s*({_L})", f"$1{letter}$2")
        x = F.regexp_replace(x, rf"(?U)\\\s*{command}\b", letter)
    x = repeated(x, rf"(?U)({_L}+)\s+([äöüÄÖÜ])\s+({_L}+)", "$1$2$3", 6)
    x = repeated(x, rf"(?U)\b({_L})\s+([äöüÄÖÜ]{_L}+)\b", "$1$2", 6)
    x = repeated(x, rf"(?U)\b([A-ZÄÖÜ][a-zäöüß])\s+([äöü]{_L}+)\b", "$1$2", 6)
    x = repeated(x, r"(?U)(\w)-\s+(\w)", "$1-$2", 6)
    x = F.regexp_replace(F.regexp_replace(x, r"(?U)\bforür\b", "für"), r"(?U)\s+,", ",")
    return F.when(x.rlike(ASCII), x).otherwise(arrow(lambda t: unicodedata.normalize("NFC", t))(F.when(~x.rlike(ASCII), x)))
